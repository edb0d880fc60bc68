"""DataFrame to DataFrame steps over messages."""

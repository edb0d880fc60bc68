"""Where messages come from."""

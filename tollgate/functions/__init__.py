"""Column expressions: JSON, timestamps, envelope."""

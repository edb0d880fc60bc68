"""Plans generated from schemas, table layout and reporting SQL."""

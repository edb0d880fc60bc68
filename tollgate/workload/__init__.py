"""The driver tables seen as messages, and the queries over them."""

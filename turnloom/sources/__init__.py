"""Reading and writing conversation tables."""

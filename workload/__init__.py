"""The supplied tables turned into change logs, and the queries over them."""

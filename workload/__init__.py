"""The engine's operators as queries over the given tables, each with its SQL."""

"""Library of Spark analytics operators (see README)."""

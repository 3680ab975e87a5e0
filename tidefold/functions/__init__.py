"""Types and scalar expressions that turn source text into Spark values."""

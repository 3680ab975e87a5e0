"""Change-data capture and corpus preparation on Spark."""

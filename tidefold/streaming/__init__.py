"""The mirror as a streaming query."""

"""Decoders of change streams and the data sources on top of them."""

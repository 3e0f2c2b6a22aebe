"""The catalogue of queries over the stand-in tables."""

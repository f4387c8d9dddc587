"""The same plans over streams."""

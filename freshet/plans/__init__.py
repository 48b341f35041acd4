"""The impact analyses as lazy plans."""

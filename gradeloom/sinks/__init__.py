"""Training files."""

"""Grading of completions as they arrive."""

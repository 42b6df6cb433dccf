"""Filter operators and the labeler."""

"""operators of sparkcurate."""

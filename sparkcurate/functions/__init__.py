"""functions of sparkcurate."""

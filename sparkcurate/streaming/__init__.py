"""streaming of sparkcurate."""

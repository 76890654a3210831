"""sources of sparkcurate."""

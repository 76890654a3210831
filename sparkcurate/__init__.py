"""sparkcurate: corpus curation and evaluation analytics as DataFrame operators."""

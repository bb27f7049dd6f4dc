"""Event encoding, and the Structured Streaming jobs."""

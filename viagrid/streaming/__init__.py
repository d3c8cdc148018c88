"""Carbon-intensity events, in batch and on Structured Streaming."""

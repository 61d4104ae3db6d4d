"""Live views over Structured Streaming."""

"""The audit controls on Structured Streaming."""

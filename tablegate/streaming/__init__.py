"""The contract gate on Structured Streaming sources."""

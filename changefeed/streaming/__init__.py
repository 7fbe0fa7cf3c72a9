"""The three jobs as Structured Streaming queries."""

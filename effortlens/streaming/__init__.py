"""The incremental sync as a Structured Streaming job."""

"""The ingest as a Structured Streaming job."""

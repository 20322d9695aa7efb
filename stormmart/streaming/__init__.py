"""Structured Streaming: the landing folder as a file stream, one ingest per micro-batch."""

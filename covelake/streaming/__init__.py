"""Event windows: the same operators on batches and in a Structured Streaming job."""

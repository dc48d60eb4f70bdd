"""The stateless prediction stage applied to a Structured Streaming source."""

"""Structured Streaming re-aims: incremental chunk collection and live coverage."""

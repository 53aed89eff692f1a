"""Structured Streaming forms: keyed-state processors, stream sources/sinks, job wiring."""

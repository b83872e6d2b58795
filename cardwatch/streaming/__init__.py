"""Structured Streaming: sources, jobs built from the batch operators, progress counters."""

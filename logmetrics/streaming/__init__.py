"""Structured Streaming jobs: source readers, the per-batch metrics job and sinks."""

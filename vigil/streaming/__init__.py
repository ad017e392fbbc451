"""Structured Streaming jobs: landing, replay and micro-batch scoring."""

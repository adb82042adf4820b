"""Structured Streaming faces of the stateful behaviours: slots, health of sources, and merges into stored tables."""

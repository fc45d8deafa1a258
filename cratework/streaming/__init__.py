"""Arrival-driven and event-time jobs on Structured Streaming."""

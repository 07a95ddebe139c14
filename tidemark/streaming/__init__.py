"""Structured Streaming form of the event log report."""

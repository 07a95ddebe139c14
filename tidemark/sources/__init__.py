"""Readers for source systems and fixtures, and the table sinks."""

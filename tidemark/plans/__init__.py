"""Ordered runs that read, transform and publish whole layers."""

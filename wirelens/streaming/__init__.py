"""Streaming of the DNS traffic engine."""

"""Operators of the DNS traffic engine."""

"""Functions of the DNS traffic engine."""

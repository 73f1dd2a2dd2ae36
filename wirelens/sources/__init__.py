"""Sources of the DNS traffic engine."""

"""Plans of the DNS traffic engine."""

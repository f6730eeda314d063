"""DataFrame operators of the daily-indicator engine."""

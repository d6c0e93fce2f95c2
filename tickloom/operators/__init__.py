"""DataFrame-to-DataFrame operators over ticks."""

"""Column expressions and narrow (shuffle-free) frame functions."""

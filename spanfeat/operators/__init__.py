"""Operators that join, aggregate or scan over windows."""

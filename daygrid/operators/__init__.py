"""Operators on entity-by-day frames: grid, fill, state, movement, growth, reports."""

"""Column-level helpers: calendar windows, cleaning, measures, labels."""

"""Reading, cleaning and merging source tables; keyed table writes."""

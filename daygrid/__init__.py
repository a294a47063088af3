"""Daily operations analytics on Spark: functions over entity-by-day tables.

Every function takes and returns DataFrames (or Columns) and adds no side
effect, except the table writers in ``daygrid.sources.tables``.
"""

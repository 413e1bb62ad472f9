"""Building blocks as Spark SQL text.

Each function takes SQL expressions (mostly column names) and returns one. A
table is then a handful of ``selectExpr`` calls: building hundreds of
``Column`` objects one by one costs seconds per query on the driver.
"""

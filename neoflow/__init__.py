"""neoflow: nested JSON event feeds -> typed tables, on Spark.

All public functions take and return DataFrames (or start StreamingQuery
objects); nothing is collected to the driver and no Python UDF is used.
"""

__version__ = "0.1.0"

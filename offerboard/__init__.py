"""Page-to-offers analytics on Spark.

Every operator takes and returns DataFrames; column names are parameters so the
same function runs on menu tables and on any other table of the same shape.
"""

__version__ = "0.1.0"

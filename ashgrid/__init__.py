"""ashgrid: yearly tables with drifting columns, queried as one, on Spark.

Layers:
  sources/    read and write the yearly CSV layouts and the driver's parquet tables
  functions/  column expressions (built-in Spark functions only)
  operators/  DataFrame -> DataFrame transforms, composed with ``df.transform``
  plans/      end-to-end plans: the unit-year panel and the registered queries
  streaming/  incremental ingest of newly landed yearly files
"""

__version__ = "0.1.0"

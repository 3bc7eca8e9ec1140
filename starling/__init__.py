"""starling — a Spark-native star-schema ETL, data-quality and reporting engine.

Layout:
  functions/  column-expression helpers (null-safe casts, slugs, keys)
  sources/    readers / writers: file globs, JSON landing zone, versioned table store
  operators/  DataFrame -> DataFrame operators (clean, keys, load, joins, aggregates,
              windows, quality)
  plans/      compositions: dashboard reports, the warehouse load and repair jobs,
              and the bindings of every operator to the TPC-H-style test tables
  streaming/  Structured Streaming jobs for the landing zone
"""

__version__ = "0.1.0"

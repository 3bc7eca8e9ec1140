"""Bindings of every operator key to the driver's TPC-H-style tables.

Each key registers a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
result is expressible in SQL, the equivalent DuckDB query over the same parquet views.
Importing this package registers everything.
"""

from starling.plans.bindings.common import ORACLE, QUERIES  # noqa: F401
from starling.plans.bindings import (  # noqa: F401
    sources, clean, keys_load, joins_aggs, quality_reports, stream, incremental,
)

"""Registered analyses over the test tables.

Each analysis is ``fn(spark, sf_dir) -> DataFrame`` built from the
library operators, optionally paired with an independent SQL text (DuckDB
dialect) that computes the same answer; ``__spark_entry__`` exposes both.
"""

from quarry.plans.registry import ORACLE, QUERIES, query  # noqa: F401
from quarry.plans import (  # noqa: F401  (import registers the analyses)
    retail, aggregates, profiling, scalars, features_q, metrics_q, timeseries_q, sources_q, streaming_q, models_q,
)

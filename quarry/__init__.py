"""quarry: Spark-first analytics operators.

Every public operator takes and returns DataFrames (or Columns for the
scalar helpers) and keeps the heavy work on executors. Learned state
(fences, medians, levels, scale factors) lives in small fit objects with
a ``transform`` method so the same state can be applied to new data.
"""

from quarry.session import get_session, scratch_path, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "scratch_path", "checkpoint_dir"]

"""Block against block: every left row meets every right row, no cross join.

Both sides are rows that hold a block (of queries, of vectors). Cells of a grid
are the join keys: a left row is hashed to one line of cells and copied along
it, a right row to one column. A cell is a task-sized unit of work, and any
number of tasks can share the grid. Spark judges the copies by the size of the
rows before they are copied, so the join is told not to broadcast them: they
would all meet in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grid_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, lines: int, columns: int) -> DataFrame:
    """All pairs of a left and a right row; the keys should tell the rows of a
    side apart. ``lines`` x ``columns`` cells; a left row is copied ``columns``
    times, a right row ``lines`` times."""
    cell = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    along = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    at_left = left.withColumn("_line", cell(left_key, lines)).withColumn("_column", along(columns))
    at_right = right.withColumn("_column", cell(right_key, columns)).withColumn("_line", along(lines))
    return at_left.join(at_right.hint("merge"), ["_line", "_column"]).drop("_line", "_column")


def grid_shape(left_rows: int, right_rows: int, per_cell: int = 4) -> tuple[int, int]:
    """Lines and columns for cells of about ``per_cell`` x ``per_cell`` rows, of
    one row each while the grid is small."""
    small = left_rows * right_rows <= 4096
    side = lambda n: max(1, n if small else -(-n // per_cell))
    return side(left_rows), side(right_rows)

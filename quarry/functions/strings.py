"""String scalars (2.9): recode, map, replace, concatenate.

Two recode flavours with different unmatched-value rules (trap T11):
``replace_values`` keeps an unmatched value, ``map_values`` turns it
into NULL. Both compile to a literal map lookup inside codegen; no
Python runs per row.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in itertools.chain.from_iterable(mapping.items())])


def map_values(col, mapping: dict) -> Column:
    """Whole-value map; a value not in ``mapping`` becomes NULL."""
    return F.try_element_at(_literal_map(mapping), _c(col))


def replace_values(col, mapping: dict) -> Column:
    """Whole-value recode; a value not in ``mapping`` is kept.

    The result type is the mapping's value type; keys and values should
    share the column's type (as in the pandas ``replace`` it mirrors).
    """
    c = _c(col)
    m = _literal_map(mapping)
    return F.when(F.array_contains(F.map_keys(m), c), F.try_element_at(m, c)).otherwise(c)


def replace_values_frame(df: DataFrame, mapping: dict, cols: list[str] | None = None) -> DataFrame:
    """Frame-wide whole-value replace over all string columns (T12)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: replace_values(c, mapping) for c in cols})


def replace_text(col, old: str, new: str) -> Column:
    """Literal (non-regex) substring replace."""
    return F.replace(_c(col), F.lit(old), F.lit(new))


def concat_label(sep: str, *cols) -> Column:
    """``concat_ws`` over label and number columns (numbers cast to text)."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def recode(df: DataFrame, col: str, mapping: DataFrame, key: str = "from_value",
           value: str = "to_value", keep_unmatched: bool = True, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Recode ``col`` through a mapping *table* (op 9.6).

    Of several values for a key the smallest is taken. The mapping table is
    broadcast only when the plan's statistics put it under
    ``max_broadcast_bytes``; otherwise a shuffle join is used.
    """
    from quarry.operators.joins import broadcast_if_small

    m = mapping.groupBy(F.col(key).alias("__k")).agg(F.min(value).alias("__v"))
    out = df.join(broadcast_if_small(m, max_broadcast_bytes), F.col(col) == F.col("__k"), "left")
    newv = F.coalesce(F.col("__v"), F.col(col)) if keep_unmatched else F.col("__v")
    return out.withColumn(col, newv).drop("__k", "__v")

"""Plan regression checks: pruning and pushdown reach the Parquet scan,
facts are pre-aggregated before the exchange, small dimensions are
broadcast only after the size check, no key-partitioned window over raw
rows in the positional operators."""

import contextlib
import io

import __spark_entry__ as E

from conftest import SF_SMALL


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def plan(spark, name):
    return explain(E.queries()[name](spark, SF_SMALL))


def test_filter_pushdown_and_pruning(spark):
    p = plan(spark, "filter_range")
    assert "GreaterThan(l_extendedprice,50000.0), LessThanOrEqual(l_discount,0.02), LessThan(l_quantity,30.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double," \
           "l_discount:double>" in p


def test_dimension_totals_preaggregate_then_broadcast(spark):
    p = plan(spark, "store_qty")
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "partial_sum" in p
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in p


def test_conditional_aggregates_single_scan(spark):
    p = plan(spark, "events_conditional")
    import re

    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1


def test_per_key_numbers_large_keys_use_no_key_window(spark, monkeypatch):
    from quarry.operators import ranking as R

    monkeypatch.setattr(R, "SMALL_TABLE_BYTES", 0)  # as for a table too big for one task
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    df = R.per_key_numbers(o, "o_custkey", ["o_orderdate", "o_orderkey"], "rn", strategy="join")
    p = explain(df)
    assert "partitionBy=[o_custkey" not in p and "windowspecdefinition(o_custkey" not in p
    assert df.count() == o.count()


def test_customer_features_are_joined_once(spark, capsys):
    from quarry.plans.models_q import _cust

    d, cols = _cust(spark, SF_SMALL)
    d.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan and set(cols) <= set(d.columns)

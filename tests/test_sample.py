"""Tables derived from the sample order tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from accolade.sources import sample

SPLITS, ORDERS, LINES = 3, 600, 4


def tables(spark):
    """Orders with four lines each, of which every third comes twice, the second time with a larger part."""
    orders = spark.range(0, ORDERS, 1, 1).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "TIMESTAMP_NTZ'2000-01-01 00:00:00' + make_dt_interval(int(id % 90)) AS o_orderdate")
    lines = spark.range(0, ORDERS * LINES, 1, SPLITS).selectExpr("id", "explode(IF(id % 3 = 0, array(0, 24), array(0))) AS more").selectExpr(
        f"id div {LINES} AS l_orderkey", f"int(id % {LINES}) AS l_linenumber", "id + more AS l_partkey", "id % 7 AS l_suppkey",
        "double(id % 50 + 1) AS l_quantity", "double(id) AS l_extendedprice", "0.05D AS l_discount", "'R' AS l_returnflag")
    return lines, orders


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_sessions_stay_dealt_in_parts(spark, broadcast):
    """Adaptive execution would put all of these few rows into one task, and millions of a large table."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        sessions = sample.player_session(*tables(spark)).select("SessionID", "PlayerID", "PointsAwarded", F.spark_partition_id().alias("part"))
        found = sessions.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len({r["part"] for r in found}) >= sample.PARTS_A_SPLIT * SPLITS - 1
    wanted = {(i // LINES * 8 + i % LINES, i // LINES % 50, (i + 24 * (i % 3 == 0)) % 500) for i in range(ORDERS * LINES)}
    assert {(r["SessionID"], r["PlayerID"], r["PointsAwarded"]) for r in found} == wanted and len(found) == ORDERS * LINES


def test_one_exchange_serves_the_merge_and_the_join(spark):
    lines, orders = tables(spark)
    sessions = sample.player_session(lines.withColumn("l_orderkey", F.expr("nullif(l_orderkey, -1)")), orders)
    plan = sessions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert "isnotnull" in plan.partition("Exchange hashpartitioning(l_orderkey")[2].partition("Range")[0]  # lines of no order stay

"""Landed tables derived from the sample order tables, so the pipeline runs on given data.

Customers are the guests, order lines their gaming sessions, orders their restaurant checks,
hotel stays and comps, nations the outlets and regions the properties.  Column names follow
the styles in which tables land: some without separators, some in snake_case, one with
contact columns that staging must drop, and with a soft-delete flag.  All arithmetic is on
integers, dates and decimals, so results do not depend on the engine or on row order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accolade.sources.readers import FreshnessRule, LazyTables, Registry, read_source

AS_OF = dt.date(2000, 3, 15)

# The five tiers, as (name, credits required, point multiplier) from tier 1 up.
TIERS = (("Silver", 0, 1.0), ("Gold", 1000, 1.25), ("Platinum", 5000, 1.5), ("Diamond", 20000, 2.0),
         ("Noir", 75000, 3.0))


#: Given tables by the system they stand for; reference tables load on no schedule.
SYSTEMS = {"events": "log", "orders": "pos", "lineitem": "cms", "region": "ref", "nation": "ref"}


def registry(sf_dir: str) -> Registry:
    late = {"log": FreshnessRule("ts"), "pos": FreshnessRule("o_orderdate"),
            "cms": FreshnessRule("loaded_at", columns={"lineitem": "l_shipdate"})}
    return Registry(root=sf_dir, fmt="parquet", suffix=".parquet", freshness=late)


def player(customer: DataFrame, nation: DataFrame) -> DataFrame:
    homes = nation.select("n_nationkey", "n_regionkey")
    return customer.join(homes, customer.c_nationkey == homes.n_nationkey).selectExpr(
        "c_custkey AS playerid",
        "substring(c_name, 1, 8) AS firstname",
        "substring(c_name, 10) AS lastname",
        "date_add(DATE'1935-01-01', int(c_custkey * 37 % 17500)) AS dateofbirth",
        "n_regionkey AS homepropertyid",
        "CASE c_custkey % 50 WHEN 0 THEN 'SelfExcluded' WHEN 1 THEN 'Banned' WHEN 2 THEN 'Inactive' "
        "ELSE 'Active' END AS playerstatus",
        "IF(c_custkey % 11 = 0, NULL, c_acctbal > 9000) AS vipflag",
        "TIMESTAMP_NTZ'1999-01-01 00:00:00' AS createdat",
        "concat('guest', c_custkey, '@example.com') AS email",
        "IF(c_custkey % 13 = 0, NULL, c_custkey % 97 = 0) AS _deleted",
    )


def member(customer: DataFrame) -> DataFrame:
    return customer.where("c_custkey % 20 <> 19").selectExpr(
        "c_custkey + 100000 AS member_id",
        "c_custkey AS player_id",
        "concat('M', c_custkey) AS member_number",
        "int(c_custkey % 5 + 1) AS tier_id",
        "date_add(DATE'1979-01-01', int(c_custkey * 53 % 8000)) AS enroll_date",
        "int(c_custkey % 5) AS enroll_property_id",
        "c_custkey * 10 % 5000 AS points_balance",
        "c_custkey * 7 % 3000 AS tier_credits_ytd",
        "IF(c_custkey % 30 = 0, 'Inactive', 'Active') AS member_status",
        "DATE'2000-03-01' AS last_activity_date",
        "IF(c_custkey % 7 = 0, NULL, c_custkey % 2 = 0) AS email_opt_in",
        "IF(c_custkey % 6 = 0, NULL, c_custkey % 3 = 0) AS sms_opt_in",
    )


def tier(region: DataFrame) -> DataFrame:
    """One tier per region row, with the fixed names and terms."""
    terms = ", ".join(f"named_struct('n', '{n}', 'c', {c}, 'm', double({m}))" for n, c, m in TIERS)
    return (
        region.selectExpr("r_regionkey + 1 AS tier_id", f"element_at(array({terms}), r_regionkey + 1) AS t")
        .selectExpr("tier_id", "t.n AS tier_name", "t.c AS tier_credits_required", "t.m AS point_multiplier")
    )


#: Parts into which the order lines of one split of their scan are dealt.
PARTS_A_SPLIT = 4


def player_session(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One session per (order, line number); repeated lines are merged by maxima.

    The one-letter flag is compared by its code, which keeps the grouping a hash aggregate.  The lines
    are dealt by order into a few parts at least for each split of their scan, and that one exchange
    serves the merge and the join with the orders.  Left to itself, adaptive execution puts parts
    together up to 64 MB of compressed rows: millions of lines, which one task would sort for the join
    and then hold as wide sums by guest and day.
    """
    parts = PARTS_A_SPLIT * lineitem.select("l_orderkey").rdd.getNumPartitions()
    kept = ("l_suppkey", "flag", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    lines = (
        lineitem.selectExpr("l_orderkey", "l_linenumber", "ascii(l_returnflag) AS flag", *[c for c in kept if c != "flag"])
        .repartition(parts, "l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg({c: "max" for c in kept})
        .withColumnsRenamed({f"max({c})": c for c in kept})
        .selectExpr(
            "*", "CAST(l_extendedprice AS DECIMAL(18,2)) AS price", "CAST(l_discount AS DECIMAL(4,2)) AS rate"
        )
    )
    visits = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(visits, lines.l_orderkey == visits.o_orderkey).selectExpr(
        "l_orderkey * 8 + l_linenumber AS SessionID",
        "o_custkey AS PlayerID",
        "int(l_suppkey % 5) AS PropertyID",
        "CASE flag WHEN ascii('A') THEN 'Slots' WHEN ascii('N') THEN 'Table' ELSE 'Poker' END AS GameCategory",
        "date(o_orderdate + make_dt_interval(0, int(l_partkey % 24) - 6)) AS GamingDate",
        "o_orderdate + make_dt_interval(0, int(l_partkey % 24)) AS StartTime",
        "o_orderdate + make_dt_interval(0, int(l_partkey % 24), int(l_quantity * 8)) AS EndTime",
        "int(l_quantity * 8) AS MinutesPlayed",
        "price AS CashIn",
        "CAST(price - CAST(price * (rate - 0.03BD) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS CashOut",
        "price AS CoinInOrAction",
        "CAST(l_quantity AS DECIMAL(18,2)) AS AverageBet",
        "CAST(price * rate AS DECIMAL(18,2)) AS TheoreticalWin",
        "CAST(price * (rate - 0.03BD) AS DECIMAL(18,2)) AS ActualWin",
        "int(l_partkey % 500) AS PointsAwarded",
    )


def jackpot(sessions: DataFrame) -> DataFrame:
    """Long poker sessions win; odd ids win on the day after, without a session."""
    return sessions.where("GameCategory = 'Poker' AND MinutesPlayed >= 360").selectExpr(
        "SessionID AS jackpotid",
        "SessionID % 1000 AS assetid",
        "IF(SessionID % 23 = 0, NULL, PlayerID) AS playerid",
        "CAST(date_add(GamingDate, int(SessionID % 2)) AS TIMESTAMP_NTZ) + make_dt_interval(0, 12) AS jackpotdatetime",
        "CashIn AS amount",
        "'Progressive' AS jackpottype",
    )


def check(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS check_id",
        "int(o_orderkey % 25) AS outlet_id",
        "IF(o_orderkey % 4 = 0, NULL, o_custkey + 100000) AS member_id",
        "o_orderdate AS opened_at",
        "o_orderdate + make_dt_interval(0, int(o_orderkey % 24)) AS closed_at",
        "int(o_orderkey % 6 + 1) AS guest_count",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS subtotal",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount",
        "IF(o_orderstatus = 'O', 'Open', 'Closed') AS check_status",
    )


def reservation(orders: DataFrame) -> DataFrame:
    return orders.where("o_orderpriority = '5-LOW'").selectExpr(
        "o_orderkey AS reservation_id",
        "IF(o_orderkey % 19 = 0, NULL, o_custkey) AS player_id",
        "int(o_orderkey % 5) AS property_id",
        "date(o_orderdate) AS arrival_date",
        "date_add(date(o_orderdate), int(o_orderkey % 13 + 2)) AS departure_date",
        "CAST(o_orderkey % 200 + 100 AS DECIMAL(18,2)) AS nightly_rate",
        "IF(o_orderkey % 17 = 0, NULL, o_orderkey % 3 = 0) AS is_comp",
        "CASE o_orderkey % 4 WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'InHouse' ELSE 'CheckedOut' END AS reservation_status",
    )


def comp(orders: DataFrame) -> DataFrame:
    return orders.where("o_orderpriority IN ('2-HIGH', '3-MEDIUM')").selectExpr(
        "o_orderkey AS comp_id",
        "o_custkey + 100000 AS member_id",
        "int(o_orderkey % 5) AS property_id",
        "o_orderdate AS comp_date_time",
        "IF(o_orderkey % 2 = 0, 'Dining', 'FreePlay') AS comp_category",
        "CAST(o_orderkey * 7 % 490 + 10 AS DECIMAL(18,2)) AS comp_amount",
        "o_orderkey % 40 AS authorized_by_employee_id",
    )


def tier_history(orders: DataFrame, members: DataFrame) -> DataFrame:
    """Tier moves on urgent orders, plus an enrolment row without an old tier per member."""
    moves = orders.where("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey AS tier_history_id",
        "o_custkey + 100000 AS member_id",
        "int(o_orderkey % 5 + 1) AS old_tier_id",
        "int(o_orderkey div 5 % 5 + 1) AS new_tier_id",
        "date(o_orderdate) AS change_date",
        "'Review' AS change_reason",
    )
    enrolments = members.selectExpr(
        "-member_id AS tier_history_id", "member_id", "CAST(NULL AS INT) AS old_tier_id", "1 AS new_tier_id",
        "enroll_date AS change_date", "'Enrollment' AS change_reason",
    )
    return moves.unionByName(enrolments)


def outlet(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        "n_nationkey AS outletid",
        "n_regionkey AS propertyid",
        "n_name AS outletname",
        "CASE n_nationkey % 3 WHEN 0 THEN 'Restaurant' WHEN 1 THEN 'Bar' ELSE 'Cafe' END AS outlettype",
    )


def property_(region: DataFrame) -> DataFrame:
    return region.selectExpr(
        "r_regionkey AS property_id", "substring(r_name, 1, 3) AS property_code", "r_name AS property_name"
    )


def with_second_cards(landed: LazyTables) -> LazyTables:
    """The landed tables where every tenth member holds a second card, on which a third of the comps were given."""
    second = "member_id % 10 = 0"
    makers = {name: lambda name=name: landed[name] for name in landed}
    makers["member"] = lambda: landed["member"].unionByName(
        landed["member"].where(second).withColumn("member_id", F.col("member_id") + 1_000_000))
    makers["comp"] = lambda: landed["comp"].withColumn(
        "member_id", F.expr(f"IF({second} AND comp_id % 3 = 0, member_id + 1000000, member_id)"))
    return LazyTables(makers)


def landed_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The eleven landed tables over the sample tables in ``sf_dir``, each built on first use."""
    reg = registry(sf_dir)
    given = LazyTables({
        t: lambda t=t: read_source(spark, reg, t) for t in ("region", "nation", "customer", "orders", "lineitem")
    })
    landed = LazyTables({
        "player": lambda: player(given["customer"], given["nation"]),
        "player_session": lambda: player_session(given["lineitem"], given["orders"]),
        "jackpot": lambda: jackpot(landed["player_session"]),
        "member": lambda: member(given["customer"]),
        "tier": lambda: tier(given["region"]),
        "tier_history": lambda: tier_history(given["orders"], landed["member"]),
        "comp": lambda: comp(given["orders"]),
        "check": lambda: check(given["orders"]),
        "outlet": lambda: outlet(given["nation"]),
        "reservation": lambda: reservation(given["orders"]),
        "property": lambda: property_(given["region"]),
    })
    return landed

"""Rules as data: threshold crossings and the highest milestone per family and day."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from accolade.functions.recognition import surrogate_key

RULE_ATTRIBUTES = (
    "milestone_family", "milestone_name", "metric_name", "threshold", "lead_days", "recognition_window_days",
    "reward_type", "reward_budget_usd", "action_owner", "priority_weight", "recommended_action", "talking_point",
)


@dataclass(frozen=True)
class Catalog:
    """The live rules on the driver: an index of thresholds, one sorted stretch for each metric.

    ``rows`` are ordered by metric and threshold, so the rules that an event crosses are one
    slice, found by two binary searches.  Each has its ``rule_number``, which grows with what it
    outranks in its family (a higher threshold, or the smaller id at the same one), and the place
    of its metric among the family's metrics, ``metric_slot``.
    """

    rows: tuple[dict, ...]
    frame: DataFrame
    slots: int
    widest: tuple[int, int]

    @classmethod
    def of(cls, rules: DataFrame, max_rows: int = 10_000) -> Catalog | None:
        """The index of a catalog of at most ``max_rows`` live rules, else None.  Nothing beyond that
        bound reaches the driver; a catalog that ships with the package needs no job."""
        live = rules.where(F.col("is_active") == 1)
        found = live.limit(max_rows + 1).collect()
        if len(found) > max_rows:
            return None
        rows = [r.asDict() for r in found]
        families: dict[str, list[dict]] = {}
        for r in rows:
            families.setdefault(r["milestone_family"], []).append(r)
        for family in families.values():
            metrics = sorted({r["metric_name"] for r in family}, key=lambda m: (m is not None, m))
            family.sort(key=lambda r: r["rule_id"], reverse=True)
            family.sort(key=lambda r: (r["threshold"] is not None, r["threshold"]))
            for number, r in enumerate(family, 1):
                r |= {"rule_number": number, "metric_slot": metrics.index(r["metric_name"])}
        rows = [r for r in rows if r["threshold"] is not None and r["metric_name"] is not None]
        rows.sort(key=lambda r: (r["metric_name"], r["threshold"], r["rule_id"]))
        places = [r | {"rule_at": at} for at, r in enumerate(rows)]
        wide = StructType([*rules.schema.fields, *[StructField(c, IntegerType()) for c in ("rule_number", "metric_slot", "rule_at")]])
        columns = {f.name: pa.array([r[f.name] for r in places], to_arrow_type(f.dataType)) for f in wide}
        frame = rules.sparkSession.createDataFrame(pa.table(columns)).select(*[F.col(f.name).cast(f.dataType) for f in wide])
        reach = lambda c: max([r[c] or 0 for r in rows], default=0)
        slots = max((r["metric_slot"] for r in rows), default=0) + 1
        return cls(tuple(places), frame, slots, (reach("recognition_window_days"), reach("lead_days")))

    def crossed(self, metric: Column, value: Column, prior: Column) -> Column:
        """Places of the rules with a threshold in (prior, value], as an array; NULL where there are none."""
        stretches: dict[str, list[int]] = {}
        for r in self.rows:
            stretches.setdefault(r["metric_name"], []).append(r["rule_at"])
        if not stretches:
            return F.lit(None).cast("array<int>")
        sorted_ = F.split(F.lit(",".join(repr(float(r["threshold"])) for r in self.rows)), ",").cast("array<double>")
        pick = lambda of: F.create_map(*[F.lit(x) for m, places in stretches.items() for x in (m, of(places))])[metric]
        start, size = pick(lambda places: places[0]), pick(len)
        widest = max(map(len, stretches.values())).bit_length()
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(widest))])

        def not_above(x: Column) -> Column:
            """How many thresholds of the stretch are at most ``x``: a step is taken if it stays at or below."""
            ahead = lambda at, step: (at + step <= size) & (F.get(sorted_, start + at + step - 1) <= x)
            return F.aggregate(steps, F.lit(0), lambda at, step: F.when(ahead(at, step), at + step).otherwise(at))

        low = not_above(prior)
        any_ = (low < size) & (F.get(sorted_, start + low) <= value)
        return F.when(any_ & prior.isNotNull(), F.sequence(start + low, start + not_above(value) - 1))


def cross_thresholds(
    events: DataFrame, rules: DataFrame, max_rows: int = 10_000, salts: int = 64, catalog: Catalog | None = None
) -> DataFrame:
    """Each event with each live rule whose threshold it reaches from below.

    With the catalog's index (built here unless given), an event without a crossing costs one binary
    search, and the join on the rule's place has a row for each crossing and no more.  A catalog
    of over ``max_rows`` rules is joined on the metric's name with the crossing as residual
    condition: there are few names, so it is repeated per salt and the events are spread.
    """
    extra = [c for c in ("rule_number", "metric_slot") if catalog or c in rules.columns]
    columns = ["rule_id", "milestone_family", "threshold", *extra]
    index = catalog or Catalog.of(rules, max_rows)
    if index is not None:
        places = index.crossed(F.col("metric_name"), F.col("metric_value"), F.col("prior_value"))
        named = F.broadcast(index.frame.select("rule_at", *columns))
        return events.withColumn("rule_at", F.explode(places)).join(named, "rule_at").drop("rule_at")
    live = rules.where(F.col("is_active") == 1).select(*columns, F.col("metric_name").alias("rule_metric"))
    crossed = (
        (F.col("metric_name") == F.col("rule_metric"))
        & (F.col("metric_value") >= F.col("threshold"))
        & (F.col("prior_value") < F.col("threshold"))
    )
    spread = events.withColumn("salt", F.pmod(F.xxhash64("player_id", "event_date"), F.lit(salts)).cast("int"))
    repeated = live.withColumn("rule_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, (F.col("salt") == F.col("rule_salt")) & crossed).drop(
        "rule_metric", "salt", "rule_salt"
    )


def numbered(rules: DataFrame) -> DataFrame:
    """Live rules of a catalog too large for the driver with the numbers of ``Catalog``."""
    family = Window.partitionBy("milestone_family")
    return rules.where(F.col("is_active") == 1).withColumns({
        "rule_number": F.row_number().over(family.orderBy(F.col("threshold"), F.col("rule_id").desc())),
        "metric_slot": F.dense_rank().over(family.orderBy("metric_name")) - 1,
    })


def highest_per_family(crossings: DataFrame, slots: int = 1) -> DataFrame:
    """Of several thresholds of one family crossed on one day, the number of the highest, and the
    largest value of each of the family's metrics.

    Maxima of fixed-width numbers: they hash-aggregate, combine before the exchange, and carry
    no id and no text.  An event that crosses the highest rule of its metric has the largest
    value of those that cross any, so the value found is the one that reached the rule.
    """
    value = lambda i: F.max(F.when(F.col("metric_slot") == i, F.col("metric_value"))).alias(f"value_{i}")
    return crossings.groupBy("player_id", "milestone_family", "event_date").agg(
        F.max("rule_number").alias("rule_number"), *[value(i) for i in range(slots)]
    )


def milestones(events: DataFrame, rules: DataFrame, max_rows: int = 10_000, catalog: Catalog | None = None) -> DataFrame:
    """Every milestone reached, with its key and its rule's attributes."""
    index = catalog or Catalog.of(rules, max_rows)
    live = index.frame if index else numbered(rules)
    slots = index.slots if index else (live.agg(F.max("metric_slot")).first()[0] or 0) + 1
    reached = highest_per_family(cross_thresholds(events, live, max_rows, catalog=index), slots)
    attributes = live.select("rule_id", *RULE_ATTRIBUTES, "rule_number", "metric_slot")
    if index:
        attributes = F.broadcast(attributes)
    achieved = F.coalesce(*[F.when(F.col("metric_slot") == i, F.col(f"value_{i}")) for i in range(slots)])
    joined = reached.join(attributes, ["milestone_family", "rule_number"])
    return joined.withColumn("achieved_value", achieved).select(
        surrogate_key(F.col("player_id"), F.col("rule_id"), F.col("event_date")).alias("milestone_id"),
        "player_id", "rule_id", "milestone_family", "milestone_name", "metric_name", "threshold",
        "achieved_value", "event_date", "lead_days", "recognition_window_days", "reward_type",
        "reward_budget_usd", "action_owner", "priority_weight", "recommended_action", "talking_point",
    )


def actionable(milestone_rows: DataFrame, as_of) -> DataFrame:
    """Milestones inside their rule's own window around ``as_of``."""
    today = F.lit(as_of)
    opens = F.date_sub(today, F.col("recognition_window_days"))
    closes = F.date_add(today, F.col("lead_days"))
    return milestone_rows.where((F.col("event_date") >= opens) & (F.col("event_date") <= closes)).withColumn(
        "days_since_event", F.datediff(today, "event_date")
    )

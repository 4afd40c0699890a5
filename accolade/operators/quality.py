"""Data-quality checks.  Each returns the offending rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accolade import policy as P


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Key values held by more than one row; with one column, NULL is not a value."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def outside(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row counts."""
    return df.where(outside(column, values)).groupBy(column).agg(F.count("*").alias("n"))


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values absent from the parent, with their row counts.

    The child is counted per value before the join, so a hot value is one row there.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")


# --- business rules on the recommendations and the worklist --------------------


def incentive_while_flagged() -> Column:
    return F.col("rg_review_flag") & (
        (F.col("final_reward_type") == "GamingOffer") | (F.col("approved_reward_usd") > 0)
    )


def reward_over_budget() -> Column:
    return F.col("approved_reward_usd") > F.greatest(F.col("remaining_budget_usd"), F.lit(0.0))


def wrong_script(phrase: str) -> Column:
    return (F.col("recommendation_status") == P.RG_CHECK_IN) & ~F.col("talking_point").like(f"%{phrase}%")


def check_no_incentive_when_flagged(recs: DataFrame) -> DataFrame:
    """Flagged guests who would get a gaming offer or money."""
    return recs.where(incentive_while_flagged()).select(
        "recommendation_id", "player_id", "final_reward_type", "approved_reward_usd"
    )


def check_reward_within_budget(recs: DataFrame) -> DataFrame:
    return recs.where(reward_over_budget()).select(
        "recommendation_id", "player_id", "approved_reward_usd", "remaining_budget_usd"
    )


def check_script_match(recs: DataFrame, phrase: str) -> DataFrame:
    """Check-ins whose text is not the check-in script."""
    return recs.where(wrong_script(phrase)).select("recommendation_id", "player_id", "talking_point")


def check_excludes_ineligible(worklist: DataFrame, guests: DataFrame) -> DataFrame:
    """Listed guests who may not be recognised at all."""
    barred = guests.where(~F.col("is_eligible")).select("player_id", "ineligible_reason")
    return worklist.join(barred, "player_id").select("player_id", "ineligible_reason")


def check_one_row_per_key(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


# --- runner ---------------------------------------------------------------------


@dataclass(frozen=True)
class Refers:
    """A column whose values are looked up among those of another checked table's column.

    A row is bad if its value is missing there, or, with ``barred``, if it is found there.  ``where``
    limits the other table's rows.
    """

    column: str
    table: str
    key: str
    barred: bool = False
    where: Column | None = None


@dataclass(frozen=True)
class TableChecks:
    """Checks of one table: predicates that mark a bad row, key sets that must be unique, ready-made
    frames of offending rows, and values that must (not) occur in other tables.  ``counted`` holds bad rows by predicate where the pass
    that wrote the table has counted them already."""

    table: str
    df: DataFrame
    bad_rows: Mapping[str, Column] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    violations: Mapping[str, DataFrame] = field(default_factory=dict)
    refers: Mapping[str, Refers] = field(default_factory=dict)
    counted: Mapping[str, int] = field(default_factory=dict)


def not_null_and_unique(*columns: str) -> dict:
    """Both checks for each column, in the form ``TableChecks`` takes."""
    return {"bad_rows": {f"not_null({c})": F.col(c).isNull() for c in columns}, "unique": [(c,) for c in columns]}


def _key(*columns: str) -> Column:
    """Text that is equal for equal values only; NULL parts are equal to each other."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("-")) for p in parts])


ROWS, UNIQUE, MISSING, BARRED = "rows", "unique", "missing", "barred"


def run_checks(tables: Sequence[TableChecks]) -> DataFrame:
    """One row per check: ``(check, table, violations)``, from one read of each table.

    A row of a table leaves marks: one for each predicate it breaks and one for each key it holds.
    A mark has the number of its check and the key's text, and counts on the own side or on the
    side of the table referred to.  The marks of all tables are grouped once by number and key;
    equal ones combine before that exchange, so a value that is everywhere is one row per split.
    """
    names: list[tuple[int, str, str, str, int | None]] = []
    marks: dict[str, list[tuple[Column, Column]]] = {t.table: [] for t in tables}
    text = F.lit(None).cast("string")
    ready: list[DataFrame] = []

    def mark(number: int, key: Column, own: bool) -> Column:
        return F.struct(F.lit(number).alias("no"), key.alias("key"), F.lit(int(own)).alias("own"), F.lit(int(not own)).alias("other"))

    def add(table: str, check: str, kind: str, known: int | None = None) -> int:
        names.append((len(names), check, table, kind, known))
        return len(names) - 1

    for t in tables:
        for check, bad in t.bad_rows.items():
            known = t.counted.get(check)
            number = add(t.table, check, ROWS, known)
            if known is None:
                marks[t.table].append((bad, mark(number, text, True)))
        for columns in t.unique:
            number = add(t.table, f"unique({', '.join(columns)})", UNIQUE)
            value = F.col(columns[0]).isNotNull() if len(columns) == 1 else F.lit(True)
            marks[t.table].append((value, mark(number, _key(*columns), True)))
        for check, rows in t.violations.items():
            ready.append(rows.select(mark(add(t.table, check, ROWS), text, True).alias("m")).select("m.*"))
        for check, ref in t.refers.items():
            number = add(t.table, check, BARRED if ref.barred else MISSING)
            marks[t.table].append((F.col(ref.column).isNotNull(), mark(number, _key(ref.column), True)))
            inside = F.col(ref.key).isNotNull() if ref.where is None else ref.where & F.col(ref.key).isNotNull()
            marks[ref.table].append((inside, mark(number, _key(ref.key), False)))
    left = ready + [
        t.df.select(F.explode(F.array(*[F.when(c, m) for c, m in marks[t.table]])).alias("m")).where("m IS NOT NULL").select("m.*")
        for t in tables if marks[t.table]
    ]
    spark = tables[0].df.sparkSession
    listed = spark.createDataFrame(names, "no int, check string, table string, kind string, known long")
    if not left:
        return listed.select("check", "table", F.coalesce("known", F.lit(0)).alias("violations"))
    keyed = reduce(DataFrame.unionByName, left).groupBy("no", "key").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
    numbers = lambda kind: F.col("no").isin([n[0] for n in names if n[3] == kind])
    bad = (
        F.when(numbers(UNIQUE), (F.col("own") > 1).cast("long"))
        .when(numbers(MISSING), F.when(F.col("other") == 0, F.col("own")))
        .when(numbers(BARRED), F.when(F.col("other") > 0, F.col("own")))
        .otherwise(F.col("own"))
    )
    found = keyed.groupBy("no").agg(F.sum(bad).alias("n"))
    return listed.join(found, "no", "left").select("check", "table", F.coalesce("known", "n", F.lit(0)).alias("violations"))

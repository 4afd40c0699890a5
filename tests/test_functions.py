"""Date, scoring and text expressions on hand-made rows."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from accolade import policy as P
from accolade.functions import dates as D
from accolade.functions import recognition as R
from accolade.policy import Policy

DAY = dt.date


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def date(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("text,expected", [
    ("2000-03-15 05:59:59", DAY(2000, 3, 14)),
    ("2000-03-15 06:00:00", DAY(2000, 3, 15)),
    ("2000-03-01 00:00:00", DAY(2000, 2, 29)),
])
def test_business_day_rolls_over_at_six(spark, text, expected):
    assert one(spark, D.business_day(ts(text), 6)) == expected


@pytest.mark.parametrize("text", ["2000-03-15 05:59:59", "2000-03-15 06:00:00", "2000-03-16 05:59:59", "2000-03-16 06:00:00"])
def test_raw_bounds_agree_with_business_day(spark, text):
    day = DAY(2000, 3, 15)
    raw = one(spark, D.in_business_days(ts(text), day, day, 6))
    assert raw == (one(spark, D.business_day(ts(text), 6)) == day)


def test_as_of_from_clock_and_override():
    at = lambda h, m=0: dt.datetime(2000, 3, 15, h, m, tzinfo=dt.timezone.utc)
    assert D.resolve_as_of(Policy(), at(12, 59)) == DAY(2000, 3, 14)  # 05:59 local
    assert D.resolve_as_of(Policy(), at(13)) == DAY(2000, 3, 15)  # 06:00 local
    assert D.resolve_as_of(Policy(as_of_date=DAY(1999, 1, 1)), at(13)) == DAY(1999, 1, 1)


@pytest.mark.parametrize("born,ref,age", [
    ("1980-03-16", "2000-03-15", 19), ("1980-03-15", "2000-03-15", 20), ("1980-03-14", "2000-03-15", 20),
    ("2000-02-29", "2001-02-28", 0), ("2000-02-29", "2001-03-01", 1), ("1999-12-31", "2000-01-01", 0),
])
def test_age(spark, born, ref, age):
    assert one(spark, D.age_on(date(born), date(ref))) == age


def test_year_arithmetic(spark):
    assert one(spark, D.year_boundaries(date("1999-12-31"), date("2000-01-01"))) == 1
    assert one(spark, D.add_years(date("2000-02-29"), 1)) == DAY(2001, 2, 28)
    assert one(spark, D.add_years(date("2000-02-29"), 4)) == DAY(2004, 2, 29)


def test_surrogate_key(spark):
    key = one(spark, R.surrogate_key(F.lit(7), F.lit("A"), date("2000-01-02")))
    assert key == hashlib.md5(b"7-A-2000-01-02").hexdigest()
    null = one(spark, R.surrogate_key(F.lit(None).cast("int"), F.lit("A"), null_tag="?"))
    assert null == hashlib.md5(b"?-A").hexdigest()


@pytest.mark.parametrize("days,penalty", [(-3, 0), (0, 0), (1, 1.5), (14, 21), (99, 21)])
def test_score_penalty_is_clamped(spark, days, penalty):
    score = R.priority_score(F.lit(50), F.lit(2), F.lit(days), F.lit(True), F.lit(None).cast("boolean"))
    assert one(spark, score) == 50 + 6 + 15 - penalty


@pytest.mark.parametrize("eligible,flagged,comps,score,budget,left,status", [
    (False, True, 0, 95, 10, 10, P.INELIGIBLE),
    (True, True, 99, 50, 10, -1, P.RG_CHECK_IN),
    (True, False, 25, 89.5, 10, 10, P.SUPPRESSED_COOLDOWN),
    (True, False, 25, 90, 10, 10, P.RECOMMEND),
    (True, False, 24.99, 50, 10, 10, P.RECOMMEND),
    (True, False, 0, 50, 10, 0, P.SUPPRESSED_BUDGET),
    (True, False, 0, 50, 0, 0, P.RECOMMEND),
])
def test_status(spark, eligible, flagged, comps, score, budget, left, status):
    lits = [F.lit(v) for v in (eligible, flagged, float(comps), float(score), float(budget), float(left))]
    assert one(spark, R.recommendation_status(*lits, Policy())) == status


@pytest.mark.parametrize("status,budget,left,reward", [
    (P.RECOMMEND, 100.0, 40.0, 40.0), (P.RECOMMEND, 100.0, 400.0, 100.0), (P.RECOMMEND, 0.0, -5.0, 0.0),
    (P.RECOMMEND, 100.0, -5.0, 0.0), (P.RG_CHECK_IN, 100.0, 400.0, 0.0),
])
def test_reward(spark, status, budget, left, reward):
    assert one(spark, R.capped_reward(F.lit(status), F.lit(budget), F.lit(left))) == reward


def test_texts(spark):
    text = R.render_template(F.lit("{first_name} - {value}"), first_name=F.lit("Ann"),
                             value=R.whole_number_text(F.lit(2500000000.5)))
    assert one(spark, text) == "Ann - 2500000001"
    assert one(spark, R.context_text(F.lit(3), F.lit(9), F.lit(None).cast("string"))) == (
        "Member 3 yrs - 9 visits - favorite spot: n/a"
    )
    assert one(spark, R.context_text(F.lit(None).cast("int"), F.lit(9), F.lit("x"))) is None


def test_eligibility_with_unknown_status(spark):
    unknown = F.lit(None).cast("string")
    args = (F.lit(1), unknown, F.lit("Active"), F.lit(30), 21)
    assert one(spark, R.is_eligible(*args)) is False
    assert one(spark, R.ineligible_reason(*args)) is None
    barred = (F.lit(1), F.lit("Banned"), F.lit("Active"), F.lit(30), 21)
    assert one(spark, R.ineligible_reason(*barred)) == "player status: Banned"
    assert one(spark, R.ineligible_reason(F.lit(1), F.lit("Active"), F.lit("Active"), F.lit(20), 21)) == "under minimum age"

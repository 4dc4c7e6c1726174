"""Loads shuffle whole rows once, whatever the sizes: latest rule and delta are decided on narrow rows."""

import datetime as dt

import pytest

from wardflow.plans.run import FrameIO, build_load
from wardflow.plans.spec import Latest, LoadSpec, rules_of

SPEC = LoadSpec(name="form", source="Form", target="Target", columns=("Pk", "Visit", "Day", "Note"),
                delta_keys=("Pk", ("Visit", "Visit")), latest=Latest(("Pk", "Day"), ("ID",)),
                select=(("Day", "CAST(Day AS DATE)"),), rules=rules_of("blank", ["Visit"]))
T = dt.datetime


def _load(spark):
    rows = [(1, 5, "v", T(2020, 1, 1, 3), "a"), (1, 7, "v", T(2020, 1, 1, 3), "b"),  # an older row of one time
            (2, 8, "w", T(2020, 1, 2, 3), "c"), (2, 9, "w", T(2020, 1, 2, 17), "c"),  # one row of the day's two
            (3, 1, "w", T(2020, 1, 2, 3), "d"), (3, 1, "w", T(2020, 1, 2, 3), "e"),  # ties stay
            (4, 2, "", T(2020, 1, 2, 3), "loaded as no visit"), (5, 3, None, T(2020, 1, 2, 3), None),
            (None, 4, "v", T(2020, 1, 2, 3), "no key"), (6, 6, "v", None, "no day")]
    form = spark.createDataFrame(rows, "Pk int, ID int, Visit string, Day timestamp_ntz, Note string")
    loaded = spark.createDataFrame([(4, None), (9, "v")], "Pk int, Visit string")
    return build_load(SPEC, FrameIO({"Form": form}, {"Target": loaded}), dt.date(2021, 1, 1))


def _nodes(plan):
    yield plan
    kids = plan.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


@pytest.fixture
def large(spark):
    """Plans as for large tables."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_rows_of_a_load(spark):
    got = sorted((r.Pk, r.Visit, str(r.Day), r.Note) for r in _load(spark).collect() if r.Pk != 5)
    assert got == [(1, "v", "2020-01-01", "b"), (2, "w", "2020-01-02", "c"), (3, "w", "2020-01-02", "d"), (3, "w", "2020-01-02", "e")]
    assert [(r.Visit, r.Note) for r in _load(spark).where("Pk = 5").collect()] == [(None, None)]


def test_whole_rows_are_shuffled_once(spark, large):
    plan = _load(spark)._jdf.queryExecution().executedPlan()
    wide = [n for n in _nodes(plan) if n.getClass().getSimpleName() in ("ShuffleExchangeExec", "SortExec")
            and "Note#" in n.output().mkString(" ")]
    assert len(wide) == 1

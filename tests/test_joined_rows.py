"""Loads whose latest rule runs over joined rows: rule and delta are decided on narrow rows, the texts are shuffled afterwards."""

import datetime as dt
from dataclasses import replace

import pytest

from wardflow.plans.run import FrameIO, _narrow_delta, build_load
from wardflow.plans.spec import Latest, LoadSpec, Lookup, Parent, rule

PARENTS = (Parent("Person", (("PersonId", "ID"),), columns=(("Pid", "Pk"), ("Name", "Name"), ("FacilityId", "FacilityId"))),
           Parent("Facility", (("FacilityId", "Id"),), where="Voided = 0", columns=(("Code", "Site"),)))
SPEC = LoadSpec(name="form", source="Form", target="Target", columns=("Pk", "Site", "Name", "Day", "voided", "Note"),
                delta_keys=("Site", "Pk", ("cast(Day as date)", "Day")), parents=PARENTS, where=("Name <> 'Unknown'",),
                latest=Latest(("Pk", "Site", "Day", "voided"), ("ID", "cast(Created as date)"), join_keys=("Pk", "Site", "Day"),
                              stage="joined"),
                rules=(rule("Day", "date", lo="2004-01-01"),))
D, AS_OF = dt.date, dt.date(2010, 1, 1)
OLD, A, B, LATE = D(2001, 1, 1), D(2005, 1, 1), D(2006, 1, 1), D(2012, 1, 1)
FORM = [  # ID, PersonId, Day, voided, Created, Note
    (1, 1, A, False, D(2005, 1, 1), "older"), (2, 1, A, False, D(2005, 1, 2), "latest"), (3, 1, A, True, D(2005, 1, 1), "voided, latest too"),
    (2, 1, A, True, D(2005, 1, 2), "not its own group's, but the other's latest"),
    (4, 2, B, None, D(2006, 1, 1), "voided unknown"), (5, 2, A, False, D(2006, 1, 1), "loaded"),
    (6, 2, OLD, False, D(2006, 1, 1), "cleaned to 1900, loaded as such"), (7, 1, LATE, False, D(2006, 1, 1), "cleaned to 1900, new"),
    (8, 3, A, False, D(2006, 1, 1), "two persons of one id"), (8, 3, A, False, D(2006, 1, 1), "two persons of one id"),
    (1, 1, B, False, D(2006, 1, 1), "older than person 4's"),
    (9, 4, B, False, D(2006, 1, 1), "same Pk as person 1, later"), (10, 5, A, False, D(2006, 1, 1), "unknown name"),
    (11, 6, A, False, D(2006, 1, 1), "voided facility"), (12, None, A, False, D(2006, 1, 1), "no person"),
    (13, 7, B, False, D(2006, 1, 1), "person without Pk"), (14, 2, None, False, D(2006, 1, 1), "no day")]
PERSON = [(1, 10, "a", 1), (2, 20, "b", 1), (3, 30, "c", 1), (3, 30, "c2", 1), (3, 31, "c", 1), (4, 10, "a", 1), (5, 50, "Unknown", 1), (6, 60, "f", 2),
          (7, None, "g", 1)]
FACILITY = [(1, 100, 0), (2, 200, 1)]
LOADED = [(100, 20, A), (100, 20, D(1900, 1, 1)), (100, 31, B)]


def _load(spark, spec=SPEC, **tables):
    tables |= {"Form": spark.createDataFrame(FORM, "ID int, PersonId int, Day date, voided boolean, Created date, Note string"),
               "Person": spark.createDataFrame(PERSON, "ID int, Pid int, Name string, FacilityId int"),
               "Facility": spark.createDataFrame(FACILITY, "Id int, Code int, Voided int")}
    return build_load(spec, FrameIO(tables, {"Target": spark.createDataFrame(LOADED, "Site int, Pk int, Day date")}), AS_OF)


def _expected():
    """The rule word by word: join, maxima by group, join back on the coarser keys, clean, leave out what is loaded."""
    rows = [(pk, code, name, day, voided, note, (i, created)) for i, person, day, voided, created, note in FORM
            for pid, pk, name, fid in PERSON if pid == person for f, code, off in FACILITY if f == fid and not off]
    groups = {}
    for pk, code, _, day, voided, _, (i, created) in rows:
        was = groups.get((pk, code, day, voided), (i, created))
        groups[pk, code, day, voided] = max(was[0], i), max(was[1], created)
    tops = {(pk, code, day, top) for (pk, code, day, _), top in groups.items() if None not in (pk, code, day)}
    out = set()
    for pk, code, name, day, voided, note, held in rows:
        if (pk, code, day, held) in tops and name != "Unknown":
            clean = day if D(2004, 1, 1) <= day <= AS_OF else D(1900, 1, 1)
            if (code, pk, clean) not in LOADED:
                out.add((pk, code, name, str(clean), voided, note))
    return sorted(out, key=repr)


def _rows(df):
    return sorted(((r.Pk, r.Site, r.Name, str(r.Day), r.voided, r.Note) for r in df.collect()), key=repr)


def test_rows_are_those_of_the_rule_word_by_word(spark):
    assert len(_expected()) == 8 and _rows(_load(spark)) == _expected()


def test_delta_over_a_looked_up_column_waits_for_the_lookup(spark):
    spec = replace(SPEC, lookups=(Lookup("Pk", "lkp"),))
    assert _narrow_delta(spec) is None and _narrow_delta(SPEC) == {"Pk": "__k0", "Site": "__k1", "Day": "__k2"}
    lkp = spark.createDataFrame([(30, 20)], "source_name int, target_name int")  # 30 becomes a loaded key
    assert _rows(_load(spark, spec, lkp=lkp)) == [r for r in _expected() if r[0] != 30]


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


def test_texts_are_shuffled_for_their_join_and_the_distinct_only(spark, large):
    nodes = list(_nodes(_load(spark)._jdf.queryExecution().executedPlan()))
    texts = [n.output().mkString(" ") for n in nodes if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert sum("Note#" in t for t in texts) == 2
    windows = [n for n in nodes if n.getClass().getSimpleName() == "WindowExec"]
    below = [n.output().mkString(" ") for n in _nodes(windows[0]) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert len(windows) == 2 and below and not [t for t in below if "Name#" in t]
    assert not [n for n in list(_nodes(windows[0]))[1:4] if n.getClass().getSimpleName() == "ShuffleExchangeExec"]  # one for both windows

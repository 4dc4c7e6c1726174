import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import rules as R
from wardflow.functions.dates import month_diff_boundary, year_diff_boundary


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_blank_to_null(spark):
    assert _one(spark, [("",), (" ",), (None,), ("a",)], "c string", R.blank_to_null("c")) == [None, " ", None, "a"]


def test_clamp_date_bounds_inclusive(spark):
    lo, hi = dt.date(1980, 1, 1), dt.date(2000, 1, 1)
    rows = [(dt.date(1979, 12, 31),), (lo,), (dt.date(1980, 1, 2),), (hi,), (dt.date(2000, 1, 2),), (None,),
            (dt.date(1, 1, 1),)]
    got = _one(spark, rows, "d date", R.clamp_date("d", lo, hi))
    s = R.SENTINEL_DATE
    assert got == [s, lo, dt.date(1980, 1, 2), hi, s, None, s]


def test_clamp_date_to_null_open_end(spark):
    rows = [(dt.date(1979, 12, 31),), (dt.date(2999, 1, 1),), (None,)]
    assert _one(spark, rows, "d date", R.clamp_date("d", lo="1980-01-01", fill=None)) == [None, dt.date(2999, 1, 1), None]


def test_clamp_number_on_text(spark):
    rows = [("",), ("abc",), ("-1",), ("0",), ("120",), ("121",), ("72.5",), (None,)]
    got = _one(spark, rows, "a string", R.clamp_number("a", 0, 120, text=True))
    assert got == ["", "abc", "999", "0", "120", "999", "72.5", None]


def test_cap_to_null(spark):
    assert _one(spark, [(12,), (13,), (None,)], "m int", R.cap_to_null("m", 12)) == [12, None, None]


def test_recode_keep_null_and_closed(spark):
    rows = [("M",), ("F",), ("U",), ("",), ("x",), (None,)]
    m = {"Male": ["M"], "Female": ["F"], None: [""]}
    assert _one(spark, rows, "g string", R.recode("g", m)) == ["Male", "Female", "U", None, "x", None]
    assert _one(spark, rows, "g string", R.recode("g", m, default="Not Done")) == \
        ["Male", "Female", "Not Done", None, "Not Done", "Not Done"]
    assert _one(spark, rows, "g string", R.recode("g", m, default=None)) == ["Male", "Female", None, None, None, None]


def test_recode_first_listing_wins(spark):
    m = {"A": ["x"], "B": ["x", "y"]}
    assert _one(spark, [("x",), ("y",)], "g string", R.recode("g", m)) == ["A", "B"]


def test_present_flag_and_negative_label(spark):
    rows = [("No",), ("Yes",), ("Blind",), (None,)]
    assert _one(spark, rows, "d string", R.present_flag("d")) == ["No", "Yes", "Yes", None]
    rows = [("-1",), ("0",), ("abc",), (None,)]
    assert _one(spark, rows, "r string", R.negative_label("r", "Viral Load")) == ["Viral Load", "0", "abc", None]


def test_sentinel_and_default(spark):
    rows = [("NULL",), ("N/A",), ("ok",), (None,)]
    assert _one(spark, rows, "t string", R.sentinel_to_null("t", ["NULL", "N/A"])) == [None, None, "ok", None]
    assert _one(spark, [(None,), (1,)], "v int", R.null_default("v", 0)) == [0, 1]


def test_parse_mixed_date(spark):
    rows = [("2023-12-25",), ("25/12/2023",), ("05/12/2023",), ("n/a",), ("",), (None,), ("2023-12-25 10:00:00",)]
    got = _one(spark, rows, "s string", R.parse_mixed_date("s"))
    assert got == [dt.date(2023, 12, 25), dt.date(2023, 12, 25), dt.date(2023, 12, 5), None, None, None,
                   dt.date(2023, 12, 25)]


def test_boundary_diffs(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31), dt.date(2001, 1, 1))], "a date, b date")
    r = df.select(year_diff_boundary("a", "b").alias("y"), month_diff_boundary("a", "b").alias("m")).first()
    assert (r.y, r.m) == (1, 1)

"""Column functions on hand-made rows (P*, A*, S3)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rentmart.functions import expr as X


def test_null_tokens_and_to_long(spark):
    df = spark.createDataFrame([("\\N",), ("NULL",), ("NUL",), ("",), ("93.0",), ("7",)], "v string")
    out = [r[0] for r in df.select(X.to_long(X.null_tokens("v"))).collect()]
    assert out == [None, None, None, None, 93, 7]
    # tokens are case-sensitive: 'nul' stays text
    odd = spark.createDataFrame([("nul",)], "v string")
    assert odd.select(X.null_tokens("v").alias("t")).first().t == "nul"


def test_month_floor_text_and_prefix(spark):
    df = spark.createDataFrame([(dt.date(2020, 10, 17), "LGA10050")], "d date, code string")
    r = df.select(X.month_floor("d").alias("m"), X.month_text("d").alias("t"),
                  X.substr_prefix("code").alias("c")).first()
    assert r.m == dt.date(2020, 10, 1) and r.t == "2020-10" and r.c == "10050"


def test_parse_date_round_trip_equals_month_floor(spark):
    df = spark.createDataFrame([(dt.date(2021, 4, 30),), (dt.date(1999, 12, 1),)], "d date")
    out = df.select((X.parse_date(X.month_text("d"), "yyyy-MM") == X.month_floor("d")).alias("same")).collect()
    assert all(r.same for r in out)


def test_ratio_forms(spark):
    df = spark.createDataFrame([(1, 3, 715890, 270, 0)], "a long, b long, r long, h long, z long")
    r = df.select(X.ratio_pct("a", "b").alias("pct"), X.ratio("a", "z").alias("div0"),
                  X.ratio_decimal("r", "h").alias("dec")).first()
    assert abs(r.pct - 100 / 3) < 1e-9
    assert r.div0 is None                      # nullif guard instead of a divide-by-zero error
    assert r.dec == Decimal("2651.444444")     # exact quotient, 6 places


def test_conditional_aggregates(spark):
    df = spark.createDataFrame(
        [(True, 10, 1), (True, 30, 1), (False, 99, 2), (None, 5, 3), (True, None, 2)],
        "act boolean, price long, host long")
    r = df.agg(X.count_if("act").alias("n_act"), X.count_if(~F.col("act")).alias("n_inact"),
               X.min_if("act", "price").alias("lo"), X.max_if("act", "price").alias("hi"),
               X.median_if("act", "price").alias("med"), X.sum_if("act", "price").alias("s"),
               X.avg_if("act", "price").alias("avg"),
               X.count_distinct_if("act", "host").alias("hosts_act")).first()
    assert (r.n_act, r.n_inact, r.lo, r.hi, r.s, r.hosts_act) == (3, 1, 10, 30, 40, 2)
    assert r.med == 20.0 and r.avg == 20.0


def test_stays_and_revenue_propagate_null(spark):
    df = spark.createDataFrame([(100, 10), (100, None)], "price long, a30 long")
    out = df.select(X.stays("a30").alias("s"), X.revenue("price", "a30").alias("r")).collect()
    assert (out[0].s, out[0].r) == (20, 2000) and (out[1].s, out[1].r) == (None, None)

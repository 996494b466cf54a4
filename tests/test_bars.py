import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorspark.operators import bars as B
from factorspark.operators import calendar as cal
from factorspark.operators import quality as Q
from factorspark.schema import BAR, ContractError, check_retention

c = F.col


def d(s):
    return dt.date.fromisoformat(s)


def calendar(spark, days):
    return spark.createDataFrame([(x, i + 1) for i, x in enumerate(sorted(days))], "date date, td_idx long")


def bars(spark, days, codes=("600000",), amount=1.0):
    rows = [(k, x, float(i), float(i + 3), float(i - 2), float(i + 1), 100, amount) for k in codes for i, x in enumerate(days, 10)]
    return spark.createDataFrame(rows, BAR)


def weekdays(a, b, skip=()):
    return [x.date() for x in pd.bdate_range(a, b) if x.date().isoformat() not in skip]


def test_weekly_bars_cross_the_year(spark):
    days = weekdays("2024-12-30", "2025-01-10", {"2025-01-01"})
    out = B.aggregate_period(bars(spark, days), "weekly", calendar(spark, days)).orderBy("period_key").collect()
    assert [r.period_key for r in out] == ["2025-W01", "2025-W02"]
    assert (out[0].open, out[0].close, out[0].volume, out[0].date) == (10.0, 14.0, 400, d("2025-01-03"))
    assert not any(r.is_partial for r in out)


def test_partial_week_follows_the_calendar_not_the_weekday(spark):
    holiday = {"2025-10-02", "2025-10-03"}
    cal_days = weekdays("2025-09-22", "2025-10-10", holiday)
    data = [x for x in cal_days if x <= d("2025-10-01")]
    full = B.aggregate_period(bars(spark, data), "weekly", calendar(spark, cal_days)).collect()
    assert not any(r.is_partial for r in full)
    cut = [x for x in data if x <= d("2025-09-30")]
    last = B.aggregate_period(bars(spark, cut), "weekly", calendar(spark, cal_days)).orderBy(c("date").desc()).first()
    assert last.is_partial
    closed = B.load_derived(B.aggregate_period(bars(spark, cut), "weekly", calendar(spark, cal_days)))
    assert closed.count() == 1


def test_sums_stay_null_and_shuffling_changes_nothing(spark):
    days = weekdays("2025-03-03", "2025-04-30")
    k = calendar(spark, days)
    a = B.aggregate_period(bars(spark, days, ("600000", "000001"), None), "monthly", k)
    assert {r.amount for r in a.collect()} == {None}
    b = B.aggregate_period(bars(spark, days, ("600000", "000001"), None).orderBy(F.rand(1)).repartition(7), "monthly", k)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))


def test_warmup_and_missing_close(spark):
    days = weekdays("2025-03-03", "2025-03-07")
    with pytest.raises(ContractError):
        B.aggregate_period(bars(spark, days), "weekly", calendar(spark, days), warmup_days=3)
    with pytest.raises(ContractError):
        B.aggregate_period(bars(spark, days).drop("close"), "weekly", calendar(spark, days))
    with pytest.raises(ContractError):
        B.load_derived(bars(spark, days))


def test_codes_are_normalised_before_repairs(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "code string, date date, close double")
    base = rows(("sh.600000", d("2025-01-02"), 10.0), ("sz.000001", d("2025-01-02"), 12.0), ("sh.600000", d("2025-01-03"), 10.1))
    fix = rows(("1.600000", d("2025-01-02"), 10.5))
    out = B.load_bars([base], fix).orderBy("code").collect()
    assert [(r.code, r.close) for r in out] == [("000001", 12.0), ("600000", 10.5)]


def test_later_shards_win_and_first_can_be_kept(spark):
    one = spark.createDataFrame([("600000", d("2025-01-02"), 1.0)], "code string, date date, close double")
    two = spark.createDataFrame([("sh600000", d("2025-01-02"), 2.0)], "code string, date date, close double")
    assert B.load_bars([one, two]).first().close == 2.0
    assert B.load_bars([one, two], keep="first").first().close == 1.0


def test_dedupe_of_a_hot_key_combines_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.lit("600000").alias("code"), F.lit(d("2025-01-02")).alias("date"), c("id").cast("double").alias("close"))
    assert B.keep_last(df, ["code", "date"], ["close"]).collect()[0].close == 19_999.0
    plan = B.keep_last(df, ["code", "date"], ["close"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_filters_count_dates_of_the_whole_frame(spark):
    days = weekdays("2025-03-03", "2025-03-14")
    df = bars(spark, days, ("600000",)).unionByName(bars(spark, days[:3], ("000001",)))
    out = B.filter_rows(df, last_n=5)
    assert {r.code for r in out.collect()} == {"600000"}
    assert B.query_bars(df, "sz.000001", last_n=2).count() == 2
    with pytest.raises(ContractError):
        B.select_columns(df, ["close", "nope"])


def test_units(spark):
    df = spark.createDataFrame([("a", d("2025-01-02"), 1.0, 1.0, 1.0, 10.0, 5, 2_000.0), ("b", d("2025-01-02"), 1.0, 1.0, 1.0, 10.0, 5, 0.0),
                                ("c", d("2025-01-02"), 1.0, 1.0, 1.0, 10.0, 5, None), ("e", d("2025-01-02"), 1.0, 1.0, 1.0, 0.0, 5, 7.0)], BAR)
    out = {r.code: (r.volume, r.amount) for r in B.reconcile_units(df).collect()}
    assert out == {"a": (200, 2000.0), "b": (500, 5000.0), "c": (500, 5000.0), "e": (500, 7.0)}


def test_dividend_fuse(spark):
    n = 200
    stored = spark.createDataFrame([(f"{i:06d}", d("2025-01-02"), 10.0) for i in range(n)], "code string, date date, close double")
    snap = lambda k: spark.createDataFrame([(f"{i:06d}", 9.4 if i < k else 10.04) for i in range(n)], "code string, prev_close double")
    assert B.detect_dividends(snap(3), stored).count() == 3
    with pytest.raises(Exception, match="misaligned"):
        B.detect_dividends(snap(100), stored).collect()


def test_calendar_shift_from_non_trading_days(spark):
    k = calendar(spark, weekdays("2025-01-06", "2025-01-17"))
    df = spark.createDataFrame([(d("2025-01-11"),), (d("2025-01-10"),)], "date date")
    got = {r.date: r.shifted for r in cal.shift(df, k, 1).collect()}
    assert got == {d("2025-01-11"): d("2025-01-14"), d("2025-01-10"): d("2025-01-13")}
    back = {r.date: r.shifted for r in cal.shift(df, k, -1).collect()}
    assert back == {d("2025-01-11"): d("2025-01-09"), d("2025-01-10"): d("2025-01-09")}
    one = k.limit(1)
    assert one.select(cal.closed_cutoff(k, "2025-01-10 14:59").alias("x")).first().x == d("2025-01-09")
    assert one.select(cal.closed_cutoff(k, "2025-01-10 15:00").alias("x")).first().x == d("2025-01-10")
    assert one.select(cal.closed_cutoff(k, "2025-01-10 11:30", ("2025-01-10",)).alias("x")).first().x == d("2025-01-10")


@pytest.mark.parametrize("rate,level", [(1.00, "green"), (0.96, "green"), (0.95, "green"), (0.949, "yellow"), (0.85, "yellow"), (0.80, "yellow"),
                                        (0.799, "red"), (0.50, "red"), (0.0, "red")])
def test_coverage_levels(spark, rate, level):
    exp = spark.range(1000).select(F.lpad((600000 + c("id")).cast("string"), 6, "0").alias("code"))
    got = exp.filter(c("code").cast("int") < 600000 + int(round(rate * 1000)))
    assert Q.coverage(got, exp).first().level == level


def test_one_missing_market_is_red(spark):
    exp = spark.createDataFrame([(f"60{i:04d}",) for i in range(232)] + [(f"00{i:04d}",) for i in range(2900)], "code string")
    got = exp.filter(c("code").startswith("00"))
    r = Q.coverage(got, exp).first()
    assert r.overall > 0.9 and r.worst == 0.0 and r.level == "red"
    assert [x.code for x in Q.missing_codes(got, exp, 3).orderBy("code").collect()] == ["600000", "600001", "600002"]
    empty = exp.filter("false")
    assert Q.coverage(got, empty).first().level == "red"


def test_retention_may_only_grow():
    check_retention("stock", 1250)
    check_retention("index", None)
    for asset, keep in (("stock", 700), ("stock", None), ("index", 5000), ("bond", 1)):
        with pytest.raises(ContractError):
            check_retention(asset, keep)

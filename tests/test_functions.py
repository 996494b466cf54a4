import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W
from factorspark.operators import bars as B
from factorspark.operators import stocks as K

c = F.col


@pytest.fixture(scope="module")
def panel():
    """Three codes with gaps and ties."""
    rng = np.random.default_rng(3)
    days = pd.bdate_range("2023-01-02", periods=160)
    rows = []
    for code in ("600001", "000002", "300003"):
        px = 10.0
        for d in days:
            if rng.random() < 0.1:
                continue
            px = round(px * (1 + rng.normal(0, 0.02)), 1)
            rows.append((code, d.date(), px, int(rng.integers(1, 5)), None if rng.random() < 0.1 else round(rng.normal(), 1)))
    return pd.DataFrame(rows, columns=["code", "date", "close", "vol", "x"])


def pdf_to_spark(spark, pdf):
    return spark.createDataFrame([tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)],
                                 "code string, date date, close double, vol int, x double")


def collect(df, *cols):
    p = df.select("code", "date", *cols).toPandas().sort_values(["code", "date"]).reset_index(drop=True)
    return p


def same(a, b, tol=1e-9):
    np.testing.assert_allclose(np.asarray(a, dtype=float), np.asarray(b, dtype=float), rtol=tol, atol=tol, equal_nan=True)


@pytest.mark.parametrize("raw,want", [
    ("sh.600000", "600000"), ("sz.000001", "000001"), ("bj.830799", "830799"), ("1.600000", "600000"), ("0.000001", "000001"),
    ("sh600000", "600000"), ("SZ000001", "000001"), ("600000", "600000"), ("1", "000001"), ("h20269", "H20269"), ("custom", "custom"), (" 512890 ", "512890")])
def test_normalize_code_is_idempotent(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string").select(C.normalize_code(c("s")).alias("a"))
    r = df.select("a", C.normalize_code(c("a")).alias("b")).first()
    assert (r.a, r.b) == (want, want)
    assert B.short_code(raw) == want


def test_secid_strict_refuses_index_codes(spark):
    df = spark.createDataFrame([("H20269",)], "s string")
    assert df.select(C.code_to_secid(c("s")).alias("v")).first().v is None
    with pytest.raises(Exception, match="no market"):
        df.select(C.code_to_secid(c("s"), strict=True)).collect()


def test_rolling_matches_pandas(spark, panel):
    w = W.by()
    ranked = W.with_rolling_ranks(pdf_to_spark(spark, panel), {"a": ("close", 30, 30, 0.0), "b": ("x", 30, 24, 0.0)})
    out = collect(ranked.withColumns({
        "m": W.roll(c("x"), 5, F.avg, w), "s": W.roll(c("close"), 20, F.stddev_samp, w), "lo": W.prior(c("close"), 10, F.min, w),
        "sk": F.when(F.count("close").over(W.last_rows(w, 20)) == 20, K.skew_sample(c("close"), w)(20)),
        "ku": F.when(F.count("close").over(W.last_rows(w, 20)) == 20, K.kurt_sample(c("close"), w)(20)),
        "le": c("a_le"), "pr": c("b_pct")}), "m", "s", "lo", "sk", "ku", "le", "pr")
    p = panel.sort_values(["code", "date"]).reset_index(drop=True)
    g = lambda col, fn: p.groupby("code")[col].transform(fn)
    same(out["m"], g("x", lambda s: s.rolling(5, min_periods=5).mean()))
    same(out["s"], g("close", lambda s: s.rolling(20).std()))
    same(out["lo"], g("close", lambda s: s.rolling(10).min().shift(1)))
    same(out["sk"], g("close", lambda s: s.rolling(20).skew()), 1e-6)
    same(out["ku"], g("close", lambda s: s.rolling(20).kurt()), 1e-6)
    same(out["le"], g("close", lambda s: s.rolling(30).apply(lambda a: (a <= a[-1]).mean(), raw=True)))
    same(out["pr"], g("x", lambda s: s.rolling(30, min_periods=24).rank(pct=True)))


def test_ewm_with_gaps_matches_pandas(spark, panel):
    df = W.with_ewm(pdf_to_spark(spark, panel), {"e": ("x", 1 / 3, 0), "d": ("e", 1 / 3, 0), "m": ("x", 1 / 14, 14), "q": (("e", "d"), 0.2, 0)})
    out = collect(df, "e", "d", "m", "q")
    p = panel.sort_values(["code", "date"]).reset_index(drop=True)
    e = p.groupby("code")["x"].transform(lambda s: s.ewm(alpha=1 / 3, adjust=False).mean())
    same(out["e"], e)
    same(out["m"], p.groupby("code")["x"].transform(lambda s: s.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()))
    d = e.groupby(p["code"]).transform(lambda s: s.ewm(alpha=1 / 3, adjust=False).mean())
    same(out["d"], d)
    same(out["q"], (e - d).groupby(p["code"]).transform(lambda s: s.ewm(alpha=0.2, adjust=False).mean()))


@pytest.mark.parametrize("pieces", [None, 1, 40])
def test_cross_section_ranks_match_pandas(spark, panel, pieces):
    df = pdf_to_spark(spark, panel)
    df = W.rank_columns(df, {"r": ("vol", True), "rd": ("x", False)}, ["date"], pieces=pieces)
    df = W.share_columns(df, {"p": ("x", True)}, ["date"])
    out = collect(df, "r", "rd", "p")
    p = panel.sort_values(["code", "date"]).reset_index(drop=True)
    g = p.groupby("date")
    same(out["r"], g["vol"].rank())
    same(out["rd"], g["x"].rank(ascending=False))
    same(out["p"], g["x"].rank(pct=True))


def test_zscores_match_windows(spark, panel):
    df = pdf_to_spark(spark, panel)
    a = collect(W.zscore_columns(df, {"z": "x"}, ["date"]), "z")
    b = collect(df.withColumn("z", W.zscore(F.col("x"), ["date"])), "z")
    same(a["z"], b["z"])


def test_seat_ranks_of_one_hot_group(spark):
    """One group holds most seats, many with the same amount."""
    from factorspark.operators.limits import rank_seats, top_seats
    rows = [("2025-01-02", "600000", 1, "buy", f"s{i:04d}", float(i % 37), 0.0) for i in range(900)] + [("2025-01-02", "600001", 2, "sell", "s1", 0.0, None)]
    df = spark.createDataFrame(rows, "date string, code string, trade_id long, side string, seat_code string, buy double, sell double")
    key = lambda d: sorted((r.code, r.seat_code, r["rank"]) for r in d.collect())
    want = sorted(rows[:900], key=lambda r: (-r[5], r[4]))
    got = key(rank_seats(df))
    assert key(rank_seats(df, pieces=32)) == got
    assert key(top_seats(df, 5)) == [x for x in got if x[2] <= 5]
    assert {(s, r) for k, s, r in got if k == "600000"} == {(r[4], i + 1) for i, r in enumerate(want)}


def test_bucketed_rank_with_one_hot_value(spark):
    """Two thirds of one group share a value; the ranks stay exact and no row is lost."""
    vals = [7.0] * 400 + [float(i) for i in range(200)]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(vals)] + [("h", 1, 1.0), ("h", 2, None)], "k string, i int, v double")
    out = W.bucketed_rank(df, "v", ["k"], "r", 8).toPandas()
    assert len(out) == len(vals) + 2
    want = out.groupby("k")["v"].rank()
    same(out["r"], want)


@pytest.mark.parametrize("pieces", [None, 1, 40])
def test_quantile_labels_match_qcut(spark, pieces):
    rng = np.random.default_rng(5)
    rows = []
    for d in pd.date_range("2024-01-01", periods=12):
        for i in range(23):
            rows.append((f"{i:06d}", d.date(), float(round(rng.normal(), 0 if d.day % 2 else 3))))
    pdf = pd.DataFrame(rows, columns=["code", "date", "v"])
    df = K.quantile_labels(spark.createDataFrame(pdf), "v", pieces=pieces)
    out = df.select("code", "date", "label").toPandas().sort_values(["date", "code"]).reset_index(drop=True)
    p = pdf.sort_values(["date", "code"]).reset_index(drop=True)
    want = p.groupby("date")["v"].transform(lambda s: pd.qcut(s, 5, labels=False, duplicates="drop"))
    same(out["label"], want)


def test_streak_offset(spark):
    days = pd.date_range("2024-01-01", periods=6)
    df = spark.createDataFrame([("a", d.date(), f) for d, f in zip(days, [False, True, True, False, True, None])], "code string, date date, f boolean")
    plain = W.with_streak(df, c("f"), "s", W.by()).orderBy("date").toPandas()["s"].tolist()
    shifted = W.with_streak(df, c("f"), "s", W.by(), offset=1).orderBy("date").toPandas()["s"].tolist()
    assert plain == [0, 1, 2, 0, 1, 0]
    assert shifted == [0, 2, 3, 0, 2, 0]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(W.corr(c("a"), c("b")).alias("r")).first().r is None

"""Queries over the stock operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorspark.functions import windows as W
from factorspark.operators import stocks as K
from factorspark.plans.ctes import cte
from factorspark.plans.registry import R, query, rounded

c = F.col

FLAGSHIP = K.ScreenParams(rank_min=0.80, amt20_min=10_000.0)


def sql_roll(fn: str, col: str, n: int, part: str = "code") -> str:
    f = f"OVER (PARTITION BY {part} ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) {f} >= {n} THEN {fn}({col}) {f} END"


def sql_lag(col: str, n: int = 1, part: str = "code") -> str:
    return f"lag({col}, {n}) OVER (PARTITION BY {part} ORDER BY date)"


def sql_rank(col: str, by: str = "date", direction: str = "ASC") -> str:
    w = f"PARTITION BY {by} ORDER BY {col} {direction} NULLS LAST"
    return (f"CASE WHEN {col} IS NOT NULL THEN (rank() OVER ({w}) + count({col}) OVER "
            f"({w} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / CAST(2 AS DOUBLE) END")


def sql_pct(col: str, by: str = "date", direction: str = "ASC") -> str:
    return f"({sql_rank(col, by, direction)}) / count({col}) OVER (PARTITION BY {by})"


cte("f_ind0", f"""SELECT h.code, h.date, h.open, h.high, h.low, h.close, r.volume, r.amount, r.open AS raw_open, r.close AS raw_close,
    coalesce(r.amount, h.close * r.volume * 100) AS amt FROM f_hfq AS h LEFT JOIN f_bars AS r USING (code, date)""")
cte("f_ind1", f"""SELECT *, {', '.join(f'{sql_roll("avg", "close", n)} AS ma{n}' for n in (5, 10, 20, 50, 60))},
    {sql_roll("avg", "volume", 5)} AS vol_ma5, {sql_roll("avg", "volume", 20)} AS vol_ma20,
    close / {sql_lag("close", 1)} - 1 AS ret, close / {sql_lag("close", 20)} - 1 AS ret20,
    close / {sql_lag("close", 120)} - 1 AS ret120 FROM f_ind0""")
cte("f_ind2", f"""SELECT *, {sql_lag("vol_ma5")} AS prev_vol_ma5, {sql_lag("vol_ma20")} AS prev_vol_ma20,
    coalesce(ma60 - {sql_lag("ma60", 20)} > 1e-9, false) AS ma60_rising, {sql_roll("avg", "amt", 20)} AS amt20,
    {sql_roll("stddev_samp", "ret", 20)} AS vol20,
    {sql_roll("avg", "CAST(coalesce(ret > 0, false) AS INT)", 60)} AS win60,
    {sql_roll("avg", "(abs(ret) / nullif(amt, 0))", 20)} AS illiq20,
    coalesce(ma5 - ma10 > 1e-9 AND ma10 - ma20 > 1e-9 AND ma20 - ma60 > 1e-9, false) AS bull FROM f_ind1""")
cte("f_ind", """SELECT *, ret20 / CASE WHEN vol20 > 0 THEN vol20 END / sqrt(CAST(20 AS DOUBLE)) AS sharpe20,
    CAST(CASE WHEN bull THEN sum(CAST(bull AS INT)) OVER (PARTITION BY code, seg ORDER BY date ROWS UNBOUNDED PRECEDING)
      + CASE WHEN seg > 0 THEN 1 ELSE 0 END ELSE 0 END AS BIGINT) AS trend_streak FROM (
    SELECT *, sum(CAST(NOT bull AS INT)) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS seg FROM f_ind2)""")
cte("f_screen", f"""SELECT *, coalesce(rk >= 0.80 AND close - ma20 > 1e-9 AND ma20 - ma60 > 1e-9 AND ma60_rising AND ret20 < 0.60
    AND ret120 > 0 AND amt20 >= 10000, false) AS hit FROM (SELECT *, {sql_pct("ret20")} AS rk FROM f_ind)""")

# Exponential means as a recursive walk: y and the weight w left after gaps.
EWM_STEP = """CASE WHEN t.x IS NULL THEN e.y WHEN e.y IS NULL THEN t.x
    ELSE (e.w * (1 - {a}) * e.y + {a} * t.x) / (e.w * (1 - {a}) + {a}) END"""


def ewm_cte(name: str, source: str, key: str, col: str, alpha: str, recursive_source: str | None = None) -> None:
    """Register <name>(key, rn, y): the exponential mean of col in source, which has key and rn."""
    a = f"CAST({alpha} AS DOUBLE)"
    # Keys with many rows walk in step, one row number at a time.
    cte(name, f"""SELECT {key}, rn, {col} AS y, CAST(1 AS DOUBLE) AS w FROM {source} WHERE rn = 1 UNION ALL
        SELECT t.{key}, t.rn, CASE WHEN t.{col} IS NULL THEN e.y WHEN e.y IS NULL THEN t.{col}
          ELSE (e.w * (1 - {a}) * e.y + {a} * t.{col}) / (e.w * (1 - {a}) + {a}) END,
          CASE WHEN t.{col} IS NULL THEN e.w * (1 - {a}) ELSE CAST(1 AS DOUBLE) END
        FROM {name} AS e JOIN {source} AS t ON t.{key} = e.{key} AND t.rn = e.rn + 1""")


def scored(t):
    """Indicator block with J columns and the screen flag."""
    return K.momentum_screen(K.indicators(K.with_kdj(t.both_bases)), FLAGSHIP)


@query("p16_momentum_screen", f"""SELECT date, code, {R('ret20', 9)} AS ret20, {R('rk', 9)} AS rk,
    {R('amt20', 4)} AS amt20 FROM f_screen WHERE hit""")
def p16(t):
    block = K.indicators(t.both_bases).select("code", "date", "close", "ma20", "ma60", "ma60_rising", "ret20", "ret120", "amt20")
    df = K.momentum_screen(block, FLAGSHIP)
    return rounded(df.filter("hit").select("date", "code", "ret20", "rk", "amt20"), ret20=9, rk=9, amt20=4)


@query("w1_rolling", f"""SELECT code, date, {R('m20', 9)} AS m20, {R('s20', 9)} AS s20, {R('p20', 9)} AS p20, lo63, hi63, v5
    FROM (SELECT code, date, {sql_roll("avg", "close", 20)} AS m20, {sql_roll("stddev_samp", "close", 20)} AS s20,
    {sql_roll("stddev_pop", "close", 20)} AS p20, {sql_roll("min", "close", 63)} AS lo63, {sql_roll("max", "close", 63)} AS hi63,
    CAST({sql_roll("sum", "volume", 5)} AS BIGINT) AS v5 FROM f_bars)""")
def w1(t):
    w = W.by()
    px = c("close")
    return rounded(t.bars.select(
        "code", "date", W.roll(px, 20, F.avg, w).alias("m20"), W.roll(px, 20, F.stddev_samp, w).alias("s20"),
        W.roll(px, 20, F.stddev_pop, w).alias("p20"), W.roll(px, 63, F.min, w).alias("lo63"),
        W.roll(px, 63, F.max, w).alias("hi63"), W.roll(c("volume"), 5, F.sum, w).alias("v5")), m20=9, s20=9, p20=9)


@query("w2_shift_return", f"""SELECT code, date, {sql_lag("close", 3)} AS c3, {R(f'close / {sql_lag("close", 1)} - 1', 9)} AS ret1,
    {R(f'close / {sql_lag("close", 20)} - 1', 9)} AS ret20 FROM f_bars""")
def w2(t):
    w = W.by()
    return rounded(t.bars.select("code", "date", F.lag("close", 3).over(w).alias("c3"), W.ret(c("close"), 1, w).alias("ret1"),
                                 W.ret(c("close"), 20, w).alias("ret20")), ret1=9, ret20=9)


@query("w3_forward_return", f"""SELECT code, date, {R('lead(close, 5) OVER (PARTITION BY code ORDER BY date) / close - 1', 9)} AS fut
    FROM f_bars""")
def w3(t):
    return rounded(K.forward_return(t.bars, 5).select("code", "date", "fut"), fut=9)


IND = dict(ma5=9, ma10=9, ma20=9, ma50=9, ma60=9, vol_ma5=6, vol_ma20=6, prev_vol_ma5=6, prev_vol_ma20=6, ret=9, ret20=9,
           ret120=9, amt20=4, vol20=9, sharpe20=9, win60=9, illiq20=15)


@query("w4_indicators", f"""SELECT code, date, ma60_rising, trend_streak, raw_open, raw_close,
    {', '.join(f'{R(k, n)} AS {k}' for k, n in IND.items())} FROM f_ind""")
def w4(t):
    df = K.indicators(t.both_bases)
    return rounded(df.select("code", "date", "ma60_rising", "trend_streak", "raw_open", "raw_close", *IND), **IND)


cte("f_kd0", f"""SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS rn,
    (close - ll) / nullif(hh - ll, 0) * 100 AS rsv FROM (
    SELECT code, date, close, {sql_roll("max", "high", 9)} AS hh, {sql_roll("min", "low", 9)} AS ll FROM f_hfq)""")
ewm_cte("f_kk", "f_kd0", "code", "rsv", "1.0 / 3")
cte("f_kd1", "SELECT code, rn, y AS k FROM f_kk")
ewm_cte("f_dd", "f_kd1", "code", "k", "1.0 / 3")
cte("f_kdj", f"""SELECT code, date, j AS kdj_j, {sql_roll("avg", "j", 20)} - j AS j_dev FROM (
    SELECT a.code, a.date, 3 * k.y - 2 * d.y AS j FROM f_kd0 AS a JOIN f_kk AS k USING (code, rn) JOIN f_dd AS d USING (code, rn))""")


@query("w5_kdj", f"SELECT code, date, {R('kdj_j', 6)} AS kdj_j, {R('j_dev', 6)} AS j_dev FROM f_kdj")
def w5(t):
    return rounded(K.with_kdj(t.bars_hfq).select("code", "date", "kdj_j", "j_dev"), kdj_j=6, j_dev=6)


@query("w12_xs_pct_rank", f"SELECT code, date, {R(sql_pct('ret'), 9)} AS p FROM f_ind1")
def w12(t):
    df = t.bars_hfq.withColumn("ret", W.ret(c("close"), 1, W.by()))
    return rounded(W.share_columns(df.select("code", "date", "ret"), {"p": ("ret", True)}, ["date"]).drop("ret"), p=9)


@query("w12b_xs_rank_bucketed", f"""SELECT code, date, {R(sql_rank('volume'), 1)} AS r FROM f_ubars""")
def w12b(t):
    return W.bucketed_rank(t.ubars.select("code", "date", "volume"), "volume", ["date"], "r", 16).select("code", "date", "r")


@query("a22b_quantile_labels_wide", "SELECT code, date, CAST(label AS INTEGER) AS label FROM f_labels")
def a22b(t):
    """The days cut into pieces between their names."""
    return K.quantile_labels(K.forward_return(t.bars, 5), "fut", pieces=24).select("code", "date", "label")


@query("w13_xs_rank", f"""SELECT code, date, {R(sql_rank('volume'), 1)} AS r_up, {R(sql_rank('volume', direction='DESC'), 1)} AS r_down
    FROM f_bars""")
def w13(t):
    b = t.bars.select("code", "date", "volume")
    return W.rank_columns(b, {"r_up": ("volume", True), "r_down": ("volume", False)}, ["date"]).drop("volume")


@query("w14_xs_zscore", f"""SELECT code, date, {R('''CASE WHEN ret IS NOT NULL THEN CASE WHEN stddev_pop(ret) OVER (PARTITION BY date) > 1e-12
    THEN (ret - avg(ret) OVER (PARTITION BY date)) / stddev_pop(ret) OVER (PARTITION BY date) ELSE 0 END END''', 9)} AS z FROM f_ind1""")
def w14(t):
    df = t.bars_hfq.withColumn("ret", W.ret(c("close"), 1, W.by()))
    return rounded(W.zscore_columns(df.select("code", "date", "ret"), {"z": "ret"}, ["date"]).drop("ret"), z=9)


@query("w8_cumprod", f"""SELECT code, date, {R('exp(sum(ln(1 + coalesce(ret, 0))) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING))', 9)} AS nav
    FROM f_ind1""")
def w8(t):
    df = t.bars_hfq.withColumn("ret", W.ret(c("close"), 1, W.by()))
    return rounded(df.select("code", "date", W.cumprod(c("ret"), W.by()).alias("nav")), nav=9)


@query("w9_drawdown", f"""SELECT code, date, max(close) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak,
    {R('close / max(close) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) - 1', 9)} AS dd FROM f_bars""")
def w9(t):
    w = W.by()
    return rounded(t.bars.select("code", "date", F.max("close").over(W.running(w)).alias("peak"),
                                 W.drawdown(c("close"), w).alias("dd")), dd=9)


cte("f_e0", """SELECT code, date, row_number() OVER (PARTITION BY code ORDER BY date) AS rn,
    close / lag(close) OVER (PARTITION BY code ORDER BY date) - 1 AS ret, close,
    CASE WHEN isodow(date) = 3 THEN NULL ELSE close END AS gap FROM f_bars""")
ewm_cte("f_e14", "f_e0", "code", "ret", "1.0 / 14")
ewm_cte("f_e12", "f_e0", "code", "close", "2.0 / 13")
ewm_cte("f_eg", "f_e0", "code", "gap", "1.0 / 3")


@query("w10_ewm", f"""SELECT a.code, a.date, {R('e14.y', 9)} AS e14, {R('e12.y', 6)} AS e12, {R('g.y', 6)} AS eg
    FROM f_e0 AS a JOIN f_e14 AS e14 USING (code, rn) JOIN f_e12 AS e12 USING (code, rn) JOIN f_eg AS g USING (code, rn)""")
def w10(t):
    df = t.bars.select("code", "date", "close", W.ret(c("close"), 1, W.by()).alias("ret"),
                       F.when(F.weekday("date") != 2, c("close")).alias("gap"))
    df = W.with_ewm(df, {"e14": ("ret", 1 / 14, 0), "e12": ("close", 2 / 13, 0), "eg": ("gap", 1 / 3, 0)})
    return rounded(df.select("code", "date", "e14", "e12", "eg"), e14=9, e12=6, eg=6)


@query("w11_momentum_r2", f"""SELECT code, date, {R('m', 9)} AS m FROM (SELECT code, date,
    CASE WHEN n = 60 THEN (pow(close / c60, CAST(252 AS DOUBLE) / 60) - 1) * pow(r, 2) END AS m FROM (
    SELECT b.code, b.date, b.close, lag(b.close, 60) OVER w1 AS c60, count(*) OVER w60 AS n,
    corr(ln(b.close), k.i) OVER w60 AS r FROM f_bars AS b JOIN f_bdays AS k USING (date)
    WINDOW w1 AS (PARTITION BY code ORDER BY date),
    w60 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)))""")
def w11(t):
    from factorspark.operators.sectors import day_index, trend_momentum
    df = t.bars.join(day_index(t.bars), "date")
    return rounded(df.select("code", "date", trend_momentum(c("close"), c("i"), 60, 60, W.by()).alias("m")), m=9)


cte("f_bdays", "SELECT date, CAST(row_number() OVER (ORDER BY date) AS DOUBLE) AS i FROM (SELECT DISTINCT date FROM f_bars)")


@query("w15_rolling_percentile", f"""SELECT code, date, {R('le', 9)} AS le, {R('pr', 9)} AS pr FROM (
    SELECT a.code, a.date, CASE WHEN a.rn >= 120 THEN sum(CASE WHEN b.close <= a.close THEN 1 ELSE 0 END) / CAST(120 AS DOUBLE) END AS le,
    CASE WHEN a.rn >= 96 THEN (sum(CASE WHEN b.close < a.close THEN 1 ELSE 0 END) + (sum(CASE WHEN b.close = a.close THEN 1 ELSE 0 END) + 1)
      / CAST(2 AS DOUBLE)) / count(*) END AS pr
    FROM f_e0 AS a JOIN f_e0 AS b ON a.code = b.code AND b.rn BETWEEN a.rn - 119 AND a.rn GROUP BY a.code, a.date, a.rn)""")
def w15(t):
    r = W.with_rolling_ranks(t.bars.select("code", "date", "close"), {"close": ("close", 120, 96, 0.0)})
    return rounded(r.select("code", "date", c("close_le").alias("le"), c("close_pct").alias("pr")), le=9, pr=9)


@query("w16_streak", """SELECT code, date, CAST(CASE WHEN up THEN sum(CAST(up AS INT)) OVER (PARTITION BY code, seg ORDER BY date
    ROWS UNBOUNDED PRECEDING) ELSE 0 END AS BIGINT) AS streak FROM (SELECT *, sum(CAST(NOT up AS INT)) OVER (PARTITION BY code ORDER BY date
    ROWS UNBOUNDED PRECEDING) AS seg FROM (SELECT code, date, coalesce(ret > 0, false) AS up FROM f_ind1))""")
def w16(t):
    df = t.bars_hfq.withColumn("up", F.coalesce(W.ret(c("close"), 1, W.by()) > 0, F.lit(False)))
    return W.with_streak(df, c("up"), "streak", W.by()).select("code", "date", "streak")


@query("w19_last_row", """SELECT code, arg_max(close, date) AS close, max(date) AS date FROM f_bars WHERE date < DATE '2000-06-01' GROUP BY code""")
def w19(t):
    from factorspark.operators.bars import last_row
    return last_row(t.bars, ["code"], before="2000-06-01").select("code", "close", "date")


FEAT = dict(ret1=9, ret3=9, ret5=9, ret10=9, ret20=9, ret60=9, vol5=9, vol20=9, vol60=9, dvol20=9, skew20=6, kurt20=6, vol_ratio=9,
            vma_ratio=9, amt_ratio=9, amp=9, amp20=9, intraday=9, overnight=9, bias20=9, bias60=9, rsi14=6, macd_hist=6, win20=9,
            win60=9, sharpe20=9, kdj_j=6, j_dev=6, illiq20=15, rk_ret5=9, rk_ret20=9, rk_vol20=9, rk_amt20=9, rk_sharpe20=9)

cte("f_fe0", """SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS rn, greatest(ret, 0) AS up, greatest(-ret, 0) AS dn
    FROM f_ind""".replace("greatest(ret, 0)", "CASE WHEN ret IS NOT NULL THEN greatest(ret, 0) END").replace(
    "greatest(-ret, 0)", "CASE WHEN ret IS NOT NULL THEN greatest(-ret, 0) END"))
ewm_cte("f_au", "f_fe0", "code", "up", "1.0 / 14")
ewm_cte("f_ad", "f_fe0", "code", "dn", "1.0 / 14")
ewm_cte("f_m12", "f_fe0", "code", "close", "2.0 / 13")
ewm_cte("f_m26", "f_fe0", "code", "close", "2.0 / 27")
cte("f_macd", "SELECT a.code, a.rn, a.y - b.y AS m FROM f_m12 AS a JOIN f_m26 AS b USING (code, rn)")
ewm_cte("f_sig", "f_macd", "code", "m", "2.0 / 10")
cte("f_fe1", f"""SELECT code, date, close, {', '.join(f'close / {sql_lag("close", n)} - 1 AS ret{n}' for n in (1, 3, 5, 10, 60))}, ret20,
    {sql_roll("stddev_samp", "ret", 5)} AS vol5, vol20, {sql_roll("stddev_samp", "ret", 60)} AS vol60,
    {sql_roll("stddev_samp", "(CASE WHEN ret < 0 THEN ret END)", 20)} AS dvol20,
    CASE WHEN vol20 > 0 THEN {sql_roll("skewness", "ret", 20)} END AS skew20,
    CASE WHEN vol20 > 0 THEN {sql_roll("kurtosis", "ret", 20)} END AS kurt20,
    volume / nullif(vol_ma5, 0) AS vol_ratio, vol_ma5 / nullif(vol_ma20, 0) AS vma_ratio, amt / nullif(amt20, 0) AS amt_ratio,
    (high - low) / nullif(close, 0) AS amp, close / open - 1 AS intraday, open / {sql_lag("close", 1)} - 1 AS overnight,
    close / ma20 - 1 AS bias20, close / ma60 - 1 AS bias60,
    {sql_roll("avg", "CAST(coalesce(ret > 0, false) AS INT)", 20)} AS win20, win60, sharpe20, trend_streak, illiq20, amt20, rn FROM f_fe0""")
cte("f_feat", f"""SELECT f.*, {sql_roll("avg", "amp", 20)} AS amp20, 100 - 100 / (1 + au.y / nullif(ad.y, 0)) AS rsi14,
    (m.m - s.y) / f.close * 100 AS macd_hist, k.kdj_j, k.j_dev, {sql_pct("ret5")} AS rk_ret5, {sql_pct("ret20")} AS rk_ret20,
    {sql_pct("vol20")} AS rk_vol20, {sql_pct("amt20")} AS rk_amt20, {sql_pct("sharpe20")} AS rk_sharpe20
    FROM f_fe1 AS f JOIN f_au AS au USING (code, rn) JOIN f_ad AS ad USING (code, rn) JOIN f_macd AS m USING (code, rn)
    JOIN f_sig AS s USING (code, rn) JOIN f_kdj AS k USING (code, date)""")


@query("w6_features", f"""SELECT code, date, trend_streak, {', '.join(f'{R(k, n)} AS {k}' for k, n in FEAT.items())} FROM f_feat""")
def w6(t):
    return rounded(K.features(t.both_bases).select("code", "date", "trend_streak", *FEAT), **FEAT)


@query("p15_tradable", """SELECT b.code, b.date, b.close FROM f_bars AS b LEFT JOIN f_uni AS u USING (code)
    WHERE NOT EXISTS (SELECT 1 FROM f_st AS s WHERE s.code = b.code AND s.date = b.date)
    AND (u.out_date IS NULL OR b.date < u.out_date - 30) AND NOT (u.out_date IS NULL AND u.name LIKE '%退%')""")
def p15(t):
    return K.tradable(t.bars, t.st_history, t.universe).select("code", "date", "close")


@query("p17_volume_shrink", """SELECT code, date, coalesce(volume >= 2 * prev_vol_ma5 AND ret < 0 AND close < open, false) AS shrink FROM f_ind""")
def p17(t):
    df = K.indicators(t.both_bases)
    return df.select("code", "date", K.volume_shrink().alias("shrink"))


cte("f_ulimit", """SELECT *, open / last_value(close IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING) - 1 AS open_ret, CASE WHEN substr(code, 1, 2) IN ('30', '68') THEN 0.20 ELSE 0.10 END - 0.002 AS edge FROM f_ubars""")


@query("p18_limit_open", f"""SELECT code, date, {R('open_ret', 9)} AS open_ret, coalesce(open_ret >= edge, false) AS no_buy,
    coalesce(open_ret <= -edge, false) AS no_sell FROM f_ulimit""")
def p18(t):
    return rounded(K.limit_open_flags(t.ubars).select("code", "date", "open_ret", "no_buy", "no_sell"), open_ret=9)


SC = ["momentum", "quality", "quality_kdj5", "quality_kdj10", "rrf", "wrrf", "amihud", "voladj", "kdj", "kdj_rev"]
cte("f_ranks", f"""SELECT *, {sql_rank("ret20")} AS r_ret20, {sql_rank("sharpe20")} AS r_sharpe20, {sql_rank("win60")} AS r_win60,
    {sql_rank("trend_streak")} AS r_trend, {sql_rank("vol20", direction="DESC")} AS r_vol20, {sql_rank("j_dev")} AS r_jdev,
    {sql_rank("j_dev", direction="DESC")} AS r_jrev, {sql_rank("(1 / nullif(illiq20, 0))")} AS r_liquid
    FROM f_screen JOIN f_kdj USING (code, date)""")
cte("f_pct", f"""SELECT *, {', '.join(f'r_{k} / count(r_{k}) OVER (PARTITION BY date) AS p_{k}' for k in
    ('ret20', 'sharpe20', 'win60', 'trend', 'vol20', 'jdev', 'jrev', 'liquid'))} FROM f_ranks""")
cte("f_scores", """SELECT code, date, hit, p_ret20 AS momentum,
    0.30 * p_ret20 + 0.25 * p_sharpe20 + 0.20 * p_win60 + 0.15 * p_trend + 0.10 * p_vol20 AS quality,
    0.30 * p_ret20 + 0.25 * p_sharpe20 + 0.20 * p_win60 + 0.15 * p_trend + 0.05 * p_vol20 + 0.05 * p_jdev AS quality_kdj5,
    0.27 * p_ret20 + 0.225 * p_sharpe20 + 0.18 * p_win60 + 0.135 * p_trend + 0.09 * p_vol20 + 0.10 * p_jdev AS quality_kdj10,
    1 / (5 + r_ret20) + 1 / (5 + r_sharpe20) + 1 / (5 + r_win60) + 1 / (5 + r_trend) + 1 / (5 + r_vol20) + 1 / (5 + r_jdev) AS rrf,
    0.30 / (2 + r_ret20) + 0.25 / (2 + r_sharpe20) + 0.20 / (2 + r_win60) + 0.15 / (2 + r_trend) + 0.05 / (2 + r_vol20)
      + 0.05 / (2 + r_jdev) AS wrrf,
    p_ret20 * p_liquid AS amihud, p_sharpe20 AS voladj, p_jdev AS kdj, p_jrev AS kdj_rev FROM f_pct""")


@query("w22_scores", f"SELECT code, date, {', '.join(f'{R(m, 9)} AS score_{m}' for m in SC)} FROM f_scores")
def w22(t):
    df = K.scores(K.indicators(K.with_kdj(t.both_bases)))
    return rounded(df.select("code", "date", *[f"score_{m}" for m in SC]), **{f"score_{m}": 9 for m in SC})


@query("w22c_scores_wide", f"SELECT code, date, {', '.join(f'{R(m, 9)} AS score_{m}' for m in SC)} FROM f_scores")
def w22c(t):
    """All scores with the days cut into pieces between their names."""
    df = K.scores(K.indicators(K.with_kdj(t.both_bases)), pieces=24)
    return rounded(df.select("code", "date", *[f"score_{m}" for m in SC]), **{f"score_{m}": 9 for m in SC})


cte("f_signals", f"""SELECT date, 'momentum' AS strategy, code, {R(sql_pct('round(quality_kdj5, 12)'), 9)} AS score FROM f_scores WHERE hit""")


def signal_table(t):
    df = K.scores(scored(t), ["quality_kdj5"])
    df = df.withColumn("score_quality_kdj5", F.round("score_quality_kdj5", 12))
    return rounded(K.signals(df, "score_quality_kdj5"), score=9)


@query("w22b_signals", "SELECT date, strategy, code, score FROM f_signals")
def w22b(t):
    return signal_table(t)


cte("f_rg0", f"""SELECT *, {sql_lag('ma5', part='series_id')} AS ma5p, {sql_lag('ma10', part='series_id')} AS ma10p,
    close / {sql_lag('close', part='series_id')} - 1 AS r, row_number() OVER (PARTITION BY series_id ORDER BY date) AS rn FROM (
    SELECT series_id, date, close, {', '.join(f"{sql_roll('avg', 'close', n, 'series_id')} AS ma{n}" for n in (5, 10, 20))} FROM f_index)""")
cte("f_rg1", """SELECT *, CASE WHEN ma20 IS NULL OR ma5p IS NULL THEN 'warm'
    WHEN ma20 - ma5 > 1e-9 AND (ma10 - ma5 > 1e-9 OR r < -0.01) THEN 'Z0'
    WHEN close - ma5 > 1e-9 AND ma5 - ma10 > 1e-9 AND ma10 - ma20 > 1e-9 THEN 'Z3'
    WHEN close - ma20 > 1e-9 THEN 'Z2' WHEN ma5 - ma5p > 1e-9 AND ma10 - ma10p > 1e-9 THEN 'Z1' ELSE 'keep' END AS rule FROM f_rg0""")
cte("f_rg2", """SELECT series_id, rn, 'Z1' AS state, 'Z1' AS prev FROM f_rg1 WHERE rn = 1 UNION ALL
    SELECT t.series_id, t.rn, CASE WHEN t.rule = 'warm' THEN 'Z1' WHEN t.rule <> 'keep' THEN t.rule
      WHEN e.prev = 'Z3' AND ma10 - close > 1e-9 THEN 'Z2' WHEN e.prev IN ('Z2', 'Z3') AND ma20 - close > 1e-9 THEN 'Z1' ELSE e.prev END,
      CASE WHEN t.rule = 'warm' THEN e.prev WHEN t.rule <> 'keep' THEN t.rule
      WHEN e.prev = 'Z3' AND ma10 - close > 1e-9 THEN 'Z2' WHEN e.prev IN ('Z2', 'Z3') AND ma20 - close > 1e-9 THEN 'Z1' ELSE e.prev END
    FROM f_rg2 AS e JOIN f_rg1 AS t ON t.series_id = e.series_id AND t.rn = e.rn + 1""")
cte("f_regime", """SELECT a.series_id, a.date, a.close, b.state, CASE b.state WHEN 'Z0' THEN CAST(0.0 AS DOUBLE) WHEN 'Z1' THEN 0.3
    WHEN 'Z2' THEN 0.5 ELSE 1.0 END AS target_ratio FROM f_rg1 AS a JOIN f_rg2 AS b USING (series_id, rn)""")


@query("w26_regime", "SELECT series_id, date, state, target_ratio FROM f_regime")
def w26(t):
    return K.regime(t.index_series).select("series_id", "date", "state", "target_ratio")


@query("a16_state_counts", "SELECT series_id, state, count(*) AS n FROM f_regime GROUP BY series_id, state")
def a16(t):
    return K.regime(t.index_series).groupBy("series_id", "state").agg(F.count("*").alias("n"))


cte("f_fut", "SELECT code, date, close, lead(close, 5) OVER (PARTITION BY code ORDER BY date) / close - 1 AS fut FROM f_bars")
cte("f_labels", """SELECT f.code, f.date, f.fut, CASE WHEN f.fut IS NOT NULL AND len(e.edges) > 1 THEN
    greatest(0, len(list_filter(e.edges, lambda x: x < f.fut)) - 1) END AS label FROM f_fut AS f LEFT JOIN (
    SELECT date, list_distinct(quantile_cont(fut, [0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS edges FROM (
      SELECT date, CAST(fut AS DOUBLE) AS fut FROM f_fut WHERE fut IS NOT NULL) GROUP BY date) AS e USING (date)""")


@query("a22_quantile_labels", "SELECT code, date, CAST(label AS INTEGER) AS label FROM f_labels")
def a22(t):
    return K.quantile_labels(K.forward_return(t.bars, 5), "fut").select("code", "date", "label")


cte("f_ic", f"""SELECT date, corr(a, b) AS ic, count(*) AS n FROM (SELECT date, {sql_rank('ret20')} AS a, {sql_rank('fut')} AS b FROM (
    SELECT date, ret20, fut FROM f_ind1 JOIN f_fut USING (code, date) WHERE ret20 IS NOT NULL AND fut IS NOT NULL))
    GROUP BY date HAVING count(*) > 10""")


@query("a21_rank_ic", f"SELECT date, {R('ic', 9)} AS ic, n FROM f_ic")
def a21(t):
    df = K.forward_return(t.bars.withColumn("ret20", W.ret(c("close"), 20, W.by())), 5)
    return rounded(K.rank_ic(df, "ret20", "fut"), ic=9)


@query("a21b_rank_ic_summary", f"""SELECT {R('avg(ic)', 9)} AS ic_mean, {R('avg(ic) / stddev_samp(ic)', 9)} AS icir, count(*) AS days
    FROM f_ic WHERE ic IS NOT NULL AND NOT isnan(ic)""")
def a21b(t):
    df = K.forward_return(t.bars.withColumn("ret20", W.ret(c("close"), 20, W.by())), 5)
    return rounded(K.rank_ic_summary(K.rank_ic(df, "ret20", "fut")), ic_mean=9, icir=9)

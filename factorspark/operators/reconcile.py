"""Reconciliation of two published snapshots, run health and promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions.arrays import let, running

c = F.col

# Payload keys that change on every run, and marks of KPI names.
VOLATILE = ("generated_at", "built_at", "timestamp", "run_id", "workflow_run_id", "generated")
KPI_MARKS = ("ret", "return", "sharpe", "mdd", "drawdown", "trade", "win", "cagr", "vol", "alpha", "beta", "ir", "calmar",
             "exposure", "nav")
SEVERITY = ("PROMOTE-READY", "NOT-STARTED", "MISSING", "BLOCKED")
MAP = "map<string,string>"


#: Parts of a JSON text; possessive, so that a long string costs no stack.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^\s{}\[\],:"]++'
_STEP = "struct<key:string,at:int>"
_LEAF = f"struct<steps:array<{_STEP}>,value:string>"


def json_leaves(payload: Column) -> Column:
    """Every value of a JSON text with the keys and list places that lead to it, in one walk over its parts.

    An array of ``steps`` (each a quoted key, or a place ``at`` in a list) and ``value``: scalars as they are written, objects as ``{``
    and lists as ``[``, which stand before what they hold. A text that is no JSON gives null.
    """
    path = f"array<{_STEP}>"

    def entry(key: Column, at: Column) -> Column:
        return F.struct(key.cast("string").alias("key"), at.cast("int").alias("at"))

    def step(steps: Column, x: Column) -> Column:
        # The last step is the key or place of the value that comes next; an object's first key follows its brace.
        top, outer = F.try_element_at(steps, F.lit(-1)), F.slice(steps, 1, F.greatest(F.size(steps) - 1, F.lit(0)))
        name, now = x["token"], F.lit(None)
        return (F.when(x["is_key"], F.concat(outer, F.array(entry(name, now))))
                .when(name == "{", F.concat(steps, F.array(entry(F.lit(""), now)))).when(name == "[", F.concat(steps, F.array(entry(now, F.lit(0)))))
                .when(name.isin("}", "]"), outer)
                .when((name == ",") & top["at"].isNotNull(), F.concat(outer, F.array(entry(now, top["at"] + 1)))).otherwise(steps))

    def out(steps: Column, x: Column) -> Column:
        return F.when(~x["is_key"] & ~x["token"].isin("}", "]", ",", ":"), F.struct(steps.alias("steps"), x["token"].alias("value")))

    tokens = F.regexp_extract_all(F.to_json(F.try_parse_json(payload)), F.lit(_TOKEN), 0)
    items = let(tokens, lambda t: F.transform(t, lambda x, i: F.struct(x.alias("token"), F.coalesce(F.get(t, i + 1) == ":", F.lit(False)).alias("is_key"))))
    return F.array_compact(running(items, F.array().cast(path), step, out, _LEAF))


def flatten_payload(df: DataFrame) -> DataFrame:
    """JSON payloads to rows ``domain, variant, path, value, volatile, kpi``, one for each object, list and scalar at any depth.

    ``path`` holds the quoted keys and list places that lead to the value. ``volatile`` marks what lies under a key that changes on
    every run, ``kpi`` numbers outside of lists whose own key has a KPI mark.
    """
    leaf = F.explode(json_leaves(c("payload"))).alias("leaf")
    d = df.select("domain", "variant", leaf).select("domain", "variant", c("leaf.steps").alias("steps"), c("leaf.value").alias("value"))
    path = F.array_join(F.transform("steps", lambda x: F.concat(F.lit("/"), F.coalesce(x["key"], x["at"].cast("string")))), "")
    volatile = F.exists("steps", lambda x: F.coalesce(x["key"].isin([f'"{k}"' for k in VOLATILE]), F.lit(False)))
    listed = F.exists("steps", lambda x: x["at"].isNotNull())
    return d.select("domain", "variant", path.alias("path"), "value", volatile.alias("volatile"),
                    (~listed & is_kpi(F.try_element_at("steps", F.lit(-1))["key"], c("value"))).alias("kpi"))


def is_kpi(key: Column, value: Column) -> Column:
    """Whether a JSON value is a number whose key has a KPI mark."""
    leaf = F.lower(F.coalesce(key, F.lit("")))
    named = F.lit(False)
    for m in KPI_MARKS:
        named = named | F.contains(leaf, F.lit(m))
    return named & F.rlike(value, F.lit("^[-0-9]"))


def reconcile(shadow: DataFrame, legacy: DataFrame, tol: float = 1e-9) -> DataFrame:
    """Verdict per (domain, variant): dates, KPI values within tol and all other leaves must agree.

    Inputs: domain, variant, data_date, payload (JSON). Leaves meet in one full join on their path, so no
    payload is collected anywhere.
    """
    keys = ["domain", "variant"]
    heads = shadow.select(*keys, c("data_date").alias("s_date"), F.lit(True).alias("in_s")).join(
        legacy.select(*keys, c("data_date").alias("l_date"), F.lit(True).alias("in_l")), keys, "full_outer")
    a = flatten_payload(shadow).withColumnsRenamed({"value": "sv", "kpi": "sk", "volatile": "s_skip"})
    b = flatten_payload(legacy).withColumnsRenamed({"value": "lv", "kpi": "lk", "volatile": "l_skip"})
    j = a.join(b, [*keys, "path"], "full_outer")
    sk, lk = F.coalesce("sk", F.lit(False)), F.coalesce("lk", F.lit(False))
    delta = F.when(sk & lk, F.abs(c("sv").try_cast("double") - c("lv").try_cast("double")))
    g = j.withColumns({"delta": delta, "skip": F.coalesce("s_skip", "l_skip")}).groupBy(*keys).agg(
        F.coalesce(F.max("delta"), F.lit(0.0)).alias("max_kpi_delta"), F.count_if(sk != lk).alias("missing_kpi"),
        F.count_if(~c("skip") & ~c("sv").eqNullSafe(c("lv"))).alias("changed_leaves"))
    out = heads.join(g, keys, "left")
    out = out.withColumns({"data_date_equal": c("s_date").eqNullSafe(c("l_date")), "kpi_equal": (c("max_kpi_delta") <= tol) & (c("missing_kpi") == 0),
                           "sha_equal": c("changed_leaves") == 0})
    both = c("in_s").isNotNull() & c("in_l").isNotNull()
    verdict = (F.when(c("in_l").isNull(), "MISSING").when(c("in_s").isNull(), "NOT-STARTED")
               .when(both & c("data_date_equal") & c("kpi_equal") & c("sha_equal"), "PROMOTE-READY").otherwise("BLOCKED"))
    cols = ["max_kpi_delta", "missing_kpi", "data_date_equal", "kpi_equal", "sha_equal"]
    return out.select(*keys, *[F.when(both, c(x)).alias(x) for x in cols], verdict.alias("verdict"))


def severity(verdict: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), verdict)


def domain_verdict(by_variant: DataFrame) -> DataFrame:
    """The worst verdict of each domain."""
    return by_variant.groupBy("domain").agg(F.max_by("verdict", severity(c("verdict"))).alias("verdict"))


def promotion_streak(verdicts: DataFrame, threshold: int = 3) -> DataFrame:
    """Consecutive ready days per domain. Inputs: domain, day, seq, verdict; the first verdict of a day
    counts, later ones of the same day do not move the streak."""
    d = verdicts.groupBy("domain", "day").agg(F.min_by("verdict", "seq").alias("verdict"))
    w = Window.partitionBy("domain").orderBy("day")
    ready = (c("verdict") == "PROMOTE-READY").cast("int")
    d = d.withColumn("__seg", F.sum(1 - ready).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("domain", "__seg").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("consecutive", F.sum(ready).over(run)).drop("__seg")
    return d.withColumn("promoted", c("consecutive") >= threshold)


def run_health(runs: DataFrame, last: int = 5) -> DataFrame:
    """Per domain: how many of the last run logs exist and which of their stages failed."""
    w = Window.partitionBy("domain").orderBy(c("run_date").desc())
    d = runs.withColumn("rn", F.row_number().over(w)).filter(c("rn") <= last)
    bad = F.map_filter("stages", lambda k, v: F.lower(v).isin("fail", "failed", "error", "exception"))
    d = d.withColumns({"bad": F.size(bad), "empty": (F.size("stages") == 0).cast("int")})
    return d.groupBy("domain").agg(F.count("*").alias("n_logs"), F.sum("bad").alias("bad_stages"), F.sum("empty").alias("empty_logs"),
                                   F.max("run_date").alias("last_run")).withColumn(
        "state", F.when(c("n_logs") < last, "too_few").when((c("bad_stages") > 0) | (c("empty_logs") > 0), "issues").otherwise("ok"))


def publication_health(envelopes: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Newest data date and the share of the expected domains with a payload that holds something."""
    m = F.from_json("payload", MAP)
    some = F.size(F.map_filter(m, lambda k, v: ~F.coalesce(v.isin("", "0", "false", "null", "[]", "{}", "0.0"), F.lit(True)))) > 0
    filled = envelopes.withColumn("filled", F.coalesce(some, F.lit(False)))
    hit = filled.filter(c("filled") & c("domain").isin(*domains)).agg(F.countDistinct("domain").alias("n"))
    return envelopes.agg(F.max("data_date").alias("day")).withColumn("coverage", hit.scalar() / F.lit(float(len(domains))))

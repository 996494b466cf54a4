"""URL filter: rules by host and path, gradient-boosted trees on lexical features for the URLs that no rule judges.

DataFrame operations and the JVM's tree learner only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "path_depth", "host_depth", "digit_ratio", "host_digit_ratio", "letter_ratio",
            "hyphens", "parameters", "has_fragment", "is_secure", "host_entropy", "url_entropy", "longest_label", "suffix_rate",
            "suffix_share"]


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class Model:
    trees: GBTClassificationModel | None
    suffixes: DataFrame  # suffix, suffix_rate, suffix_share: at most as many rows as trained the model
    rate: float  # share of blocked URLs among the labelled ones


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and the rule's ``rule_verdict``; null where no rule fits.

    A rule fits its host and all subdomains where the path starts with its path. Of several the one with the longest name
    wins, of equally long ones the first.
    """
    df = urls.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    name = verdict = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return df.withColumn("rule", none if name is None else name).withColumn("rule_verdict", none if verdict is None else verdict)


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _entropy(text: Column, alphabet: str) -> Column:
    """Bits per character over the alphabet's characters."""
    n = F.greatest(_count(text, alphabet), F.lit(1))
    total = F.lit(0.0)
    for c in alphabet:
        p = _count(text, c) / n
        total = total + F.when(p > 0, -p * F.log2(p)).otherwise(0.0)
    return total


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """The features that need no training; expects ``host`` and ``path``. A null URL counts as empty."""
    u, h, p = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    n = F.greatest(F.length(u), F.lit(1))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    low = F.translate(u, UPPER, LOWER)
    values = {
        "url_length": F.length(u), "host_length": F.length(h), "path_length": F.length(p), "path_depth": _count(p, "/"),
        "host_depth": _count(h, "."), "digit_ratio": _count(u, "0123456789") / n,
        "host_digit_ratio": _count(h, "0123456789") / F.greatest(F.length(h), F.lit(1)), "letter_ratio": _count(low, LOWER) / n,
        "hyphens": _count(h, "-_"), "parameters": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0),
        "has_fragment": u.contains("#").cast("int"), "is_secure": low.startswith("https://").cast("int"),
        "host_entropy": _entropy(h, LOWER + "0123456789-."), "url_entropy": _entropy(low, LOWER + "0123456789-./?=&"),
        "longest_label": F.array_max(F.transform(F.split(h, r"\."), F.length)),
    }
    return df.withColumns({k: v.cast("double") for k, v in values.items()} | {"suffix": F.element_at(F.split(h, r"\."), -1)})


def with_features(df: DataFrame, model: Model, url: str = "url") -> DataFrame:
    df = lexical(df, url).join(F.broadcast(model.suffixes), "suffix", "left")  # no more rows than the training sample
    return df.withColumns({"suffix_rate": F.coalesce("suffix_rate", F.lit(model.rate)), "suffix_share": F.coalesce("suffix_share", F.lit(0.0))})


def training_urls(labelled: DataFrame, url: str = "url", label: str = "rule_verdict", rows: int = 20_000) -> DataFrame:
    """The ``rows`` distinct labelled URLs with the smallest hashes (all, if fewer) with host, path and label, written once.

    A hash limit from the estimated number of distinct URLs leaves somewhat more than ``rows`` to the exact cut, so copies of
    a URL neither count nor cost.
    """
    known = labelled.where(F.col(label).isin("allow", "block") & F.col(url).isNotNull())
    distinct = known.agg(F.approx_count_distinct(url, 0.02)).first()[0]
    order = F.xxhash64(url).bitwiseAND(F.lit((1 << 40) - 1))
    known = known.where(order < F.lit(int((1 << 40) * min(1.0, (1.3 * rows + 200) / max(distinct, 1)))))
    return materialize(known.groupBy(url, "host", "path").agg(F.max(label).alias(label)).orderBy(order, url).limit(rows), "urls")


def train(labelled: DataFrame, url: str = "url", label: str = "rule_verdict", rows: int = 20_000, iterations: int = 12, depth: int = 4,
          seed: int = 3) -> Model:
    """Fit on at most ``rows`` distinct labelled URLs (see ``training_urls``); labels are ``allow`` and ``block``.

    Without labels, or with one label only, there are no trees and the more frequent label is the verdict (``allow`` if there
    is none).
    """
    known = training_urls(labelled, url, label, rows)
    total, blocked = known.agg(F.count("*"), F.count_if(F.col(label) == "block")).first()
    rate = blocked / total if total else 0.0
    known = known.withColumn("label", (F.col(label) == "block").cast("double"))
    by_suffix = known.groupBy(F.element_at(F.split("host", r"\."), -1).alias("suffix")).agg(
        ((F.sum("label") + 2 * rate) / (F.count("*") + 2)).alias("suffix_rate"), (F.count("*") / F.lit(float(max(1, total)))).alias("suffix_share"))
    model = Model(None, by_suffix, rate)
    if 0 < blocked < total:
        sample = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(known, model, url)).select("features", "label")
        trees = GBTClassifier(maxIter=iterations, maxDepth=depth, maxBins=32, stepSize=0.3, seed=seed, minInstancesPerNode=5)
        model.trees = trees.fit(sample.coalesce(4))
    return model


def verdicts(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict``: the rule's, else the trees', which learn from the URLs that
    rules judge. A null URL has no host and is judged by its features alone. Repeated rows and null keys keep their rows, an
    empty table gives none. Columns of the input with these names are replaced."""
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    df = judged(urls.select(*keep), rules, url)
    model = train(df.select(url, "host", "path", "rule_verdict"), url)
    if model.trees is None:
        return df.withColumn("verdict", F.coalesce("rule_verdict", F.lit("block" if model.rate > 0.5 else "allow"))).drop("rule_verdict")
    scored = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(df, model, url))
    scored = model.trees.transform(scored)
    other = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return scored.select(*keep, "host", "path", "rule", F.coalesce("rule_verdict", other).alias("verdict"))

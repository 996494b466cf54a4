"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm import common, textcodes

WIDTHS = (1, 2, 3)


@dataclass
class Model:
    embed: np.ndarray  # (buckets + 1, dims); the last row is the padding's, zero
    filters: list[np.ndarray]  # for each width (width, dims, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    tables: list[np.ndarray] | None = None

    def lookup(self) -> list[np.ndarray]:
        """Embeddings times filters for each place of each filter: scoring adds rows of these tables."""
        if self.tables is None:
            self.tables = [np.ascontiguousarray(self.embed @ f[j]) for f in self.filters for j in range(f.shape[0])]
        return self.tables


def word_ids(parts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Two buckets for each word (the whole word, its first four letters), two paddings after each part; bounds."""
    codes, bounds = textcodes.code_points([p.lower() for p in parts])
    starts, ends = textcodes.word_spans(codes, textcodes.kinds(codes))
    mask = np.uint32(buckets - 1)
    whole = textcodes.word_hashes(codes, starts, ends) & mask
    head = textcodes.word_hashes(codes, starts, np.minimum(ends, starts + 4)) if len(starts) else whole
    head = textcodes.mix(head + np.uint32(7)) & mask
    at = np.searchsorted(starts, bounds)
    n = np.diff(at)
    new = np.concatenate([[0], np.cumsum(n + WIDTHS[-1] - 1)])
    ids = np.full((2, new[-1]), buckets, dtype=np.int64)
    to = np.arange(len(whole)) + np.repeat(np.arange(len(parts)) * (WIDTHS[-1] - 1), n)
    ids[0, to], ids[1, to] = whole, head
    return ids, new


def pooled(model: Model, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Max over the places of each part of every filter's value, before bias and rectifier."""
    tables, out, k = model.lookup(), [], 0
    pad = np.full((2, WIDTHS[-1]), len(model.embed) - 1, dtype=np.int64)
    wide = np.concatenate([ids, pad], axis=1)
    total = ids.shape[1]
    for f in model.filters:
        acc = None
        for j in range(f.shape[0]):
            a = tables[k][wide[0, j:j + total]] + tables[k][wide[1, j:j + total]]
            acc = a if acc is None else acc + a
            k += 1
        out.append(np.maximum.reduceat(acc, bounds[:-1], axis=0))
    return np.concatenate(out, axis=1)


def score(model: Model, texts: list[str | None]) -> np.ndarray:
    """Probability of each text, whole; texts without words get that of padding alone."""
    filters = sum(f.shape[2] for f in model.filters)
    top = np.full((len(texts), filters), -np.inf, dtype=np.float32)
    for rows, parts in textcodes.pieces(texts, size=1 << 18, overlap=WIDTHS[-1] - 1):
        ids, bounds = word_ids(parts, len(model.embed) - 1)
        np.maximum.at(top, rows, pooled(model, ids, bounds))
    return head(model, top)


def head(model: Model, top: np.ndarray) -> np.ndarray:
    z = np.maximum(top + np.concatenate(model.bias), 0) @ model.out + model.out_bias
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def fit(rows: list[tuple[int, str]], prior: float, buckets: int = 1 << 14, dims: int = 12, filters: int = 8, epochs: int = 6,
        batch: int = 32, rate: float = 0.01, seed: int = 7) -> Model:
    """Train on ``(label, text)`` rows with Adam on the weighted log-loss; ``prior`` is the share of label 1 among all rows.

    Without rows of both labels the model gives the share of label 1 (0 if there are no rows).
    """
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (buckets + 1, dims)).astype(np.float32)
    embed[-1] = 0
    fs = [rng.normal(0, 0.4, (w, dims, filters)).astype(np.float32) for w in WIDTHS]
    model = Model(embed, fs, [np.zeros(filters, np.float32) for _ in WIDTHS], rng.normal(0, 0.3, filters * len(WIDTHS)).astype(np.float32), 0.0)
    y = np.array([float(r[0]) for r in rows], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        model.out[:] = 0
        model.out_bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
        return model
    weight = np.where(y > 0, prior / y.mean(), (1 - prior) / (1 - y.mean())).astype(np.float32)
    data = []
    for _, parts in textcodes.pieces([r[1] for r in rows], size=1 << 16):
        ids, bounds = word_ids(parts, buckets)
        data += [ids[:, a:b].astype(np.int32) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    params = [model.embed, *model.filters, *model.bias, model.out, np.zeros(1, np.float32)]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(max(epochs, min(30, 400 * batch // len(data)))):  # few rows need more rounds
        order = rng.permutation(len(data))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            step += 1
            grads = _gradients(model, params, [data[i] for i in pick], y[pick], weight[pick])
            for p, g, (m, v) in zip(params, grads, moment, strict=True):
                if p is model.embed:  # only the rows that the batch touched
                    at, g = g
                    m_, v_ = m[at] * 0.9 + 0.1 * g, v[at] * 0.999 + 0.001 * g * g
                    m[at], v[at] = m_, v_
                    p[at] -= rate * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.999**step)) + 1e-8)
                else:
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            model.embed[-1] = 0
    model.out_bias = float(params[-1][0])
    return model


def _gradients(model: Model, params: list, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> list:
    lens = np.array([d.shape[1] for d in docs])
    bounds = np.concatenate([[0], np.cumsum(lens)])
    ids = np.concatenate([*docs, np.full((2, WIDTHS[-1]), len(model.embed) - 1)], axis=1)
    words, place = np.unique(ids, return_inverse=True)
    place = place.reshape(ids.shape)
    small, total, tops, where = model.embed[words], bounds[-1], [], []
    for f in model.filters:
        acc = np.zeros((total, f.shape[2]), dtype=np.float32)
        for j in range(f.shape[0]):
            t = small @ f[j]
            acc += t[place[0, j:j + total]] + t[place[1, j:j + total]]
        at = np.stack([acc[a:b].argmax(0) + a for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        where.append(at)
        tops.append(np.take_along_axis(acc, at, axis=0))
    z = np.concatenate(tops, axis=1) + np.concatenate(model.bias)
    active = np.maximum(z, 0)
    p = 1 / (1 + np.exp(-np.clip(active @ model.out + params[-1][0], -40, 40)))
    d = (p - y) * weight / len(y)
    d_z = (d[:, None] * model.out) * (z > 0)
    g_embed = np.zeros_like(small)
    g_filters, g_bias, k = [], [], 0
    for f, at in zip(model.filters, where, strict=True):
        n = f.shape[2]
        dz = d_z[:, k:k + n]
        g = np.zeros_like(f)
        for j in range(f.shape[0]):
            for side in (0, 1):
                w = place[side][at + j]  # (docs, filters)
                g[j] += np.einsum("dnk,dn->kn", small[w], dz)
                np.add.at(g_embed, w, dz[:, :, None] * f[j].T[None])
        g_filters.append(g)
        g_bias.append(dz.sum(0))
        k += n
    return [(words, g_embed), *g_filters, *g_bias, active.T @ d + 1e-4 * model.out, np.array([d.sum()], np.float32)]


#: The thresholds that calibration chooses from.
GRID = np.round(np.arange(0.2, 0.701, 0.05), 2)


def lang_key(lang: object) -> str:
    """The key of a language's threshold; a null language has the empty one."""
    return "" if lang is None else str(lang)


def threshold(scored: np.ndarray, rows: np.ndarray, default: float = 0.3) -> float:
    """The threshold of ``GRID`` with the best F1, the one nearest to ``default`` of equals.

    ``scored`` has for labels 0 and 1 the number of scored rows by the thresholds they reach (none, one, ...), ``rows`` the
    number of all rows of the label: scored rows stand for the others of their label.
    """
    weight = rows / scored.sum(1)
    hit = np.cumsum(scored[:, ::-1], axis=1)[:, ::-1][:, 1:] * weight[:, None]
    f1 = np.round(2 * hit[1] / (hit.sum(0) + rows[1]), 9)
    return float(min((-f, abs(g - default), g) for f, g in zip(f1, GRID, strict=True))[2])


def calibrate(docs: DataFrame, labels: DataFrame, model: Model, fitted: list, held: tuple[int, int], label: str = "toxic", key: str = "doc_id",
              text: str = "text", lang: str | None = "lang", least: int = 20) -> dict:
    """``threshold`` for each language, from all labelled rows that are neither held out nor of the ``fitted`` keys.

    Tasks score the texts, whole, and only counts by language, label and thresholds reached go to the driver. The fitted
    rows count in the share of each label. Equal scores of a repeated key count once. A null language is one of its own.
    Languages with fewer than ``least`` scored rows of either label have no threshold.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast((model, frozenset(fitted)))
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("_l"))
    rows = rows.where(F.col("_k").isNotNull() & F.col("_t").isNotNull() & ~common.held_out(F.col("_k"), *held))

    def run(b):
        m, known = shared.value
        seen = np.array([k in known for k in b.column(0).to_pylist()], dtype=bool)
        s = score(m, b.column(1).to_pylist())
        return {"_k": b.column(0), "_l": [lang_key(x) for x in b.column(2).to_pylist()], "_b": np.where(seen, -1, np.searchsorted(GRID, s, side="right"))}

    scored = common.map_batches(rows, run, f"_k {kind}, _l string, _b int").distinct()
    given = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_k"), F.col(label).alias("_y")).where("_k is not null")
    both = scored.join(given.groupBy("_k").agg(F.max("_y").alias("_y")), "_k")
    bins = range(-1, len(GRID) + 1)
    n = both.groupBy("_l").agg(*[F.count_if((F.col("_y") == y) & (F.col("_b") == i)).alias(f"n{y}_{i + 1}") for y in (0, 1) for i in bins])
    for y in (0, 1):
        n = n.where(sum((F.col(f"n{y}_{i + 1}") for i in bins if i >= 0), F.lit(0)) >= least)
    out = {}
    for r in n.collect():
        found = np.array([[r[f"n{y}_{i + 1}"] for i in bins] for y in (0, 1)], dtype=float)
        out[r["_l"]] = threshold(found[:, 1:], found.sum(1))
    return out


def train(docs: DataFrame, labels: DataFrame, held: tuple[int, int], label: str = "toxic", key: str = "doc_id", text: str = "text",
          lang: str | None = "lang", per_label: int = 1500) -> Model:
    """Fit on four fifths of a sample of at most ``per_label`` rows of each label and calibrate thresholds by language on all
    labelled rows that don't train the weights. Only labels 0 and 1 count."""
    rows, counts = common.labelled_sample(docs, labels.where(F.col(label).isin(0, 1)), label, key, held, text, per_label, max_labels=2)
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    used = [r for i, r in enumerate(rows) if i % 5 != 4]
    model = fit(used, prior)
    if len(counts) == 2:
        model.thresholds = calibrate(docs, labels, model, [r[3] for r in used], held, label, key, text, lang)
    return model


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for each row, from its whole text; null is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b):
        return {key: b.column(0), "score": score(shared.value, b.column(1).to_pylist())}

    return common.map_batches(docs.select(key, text), run, f"{key} {docs.schema[key].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: Model, text: str = "text", lang: str | None = "lang", default: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all columns, whose score is below the threshold calibrated for their language (``default``
    where none is). Rows pass through in the task that scores them."""
    common.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, tongue = docs.columns.index(text), docs.columns.index(lang) if lang else None

    def run(batches):
        for b in common.slices(batches):
            s = score(shared.value, b.column(place).to_pylist())
            names = b.column(tongue).to_pylist() if tongue is not None else [None] * len(s)
            limit = np.array([shared.value.thresholds.get(lang_key(x), default) for x in names])
            yield b.filter(common.pa.array(s < limit))

    return docs.mapInArrow(run, docs.schema)

"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm import common, textcodes

#: Structure statistics of a text; the last one is metadata, the declared number of characters.
STATISTICS = ("log_chars", "log_words", "letters", "digits", "upper", "space", "marks", "mean_word", "line_share", "line_length", "mark_runs",
              "word_marks", "upper_words", "declared")


@dataclass
class Model:
    bias: float
    weight: np.ndarray  # one for each hashed word, then for each statistic
    factors: np.ndarray  # (features, rank)
    mean: np.ndarray
    spread: np.ndarray


def raw_features(texts: list[str | None], declared: list, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse words (row, bucket, share of the text's words) and dense statistics of each text, whole."""
    n = len(texts)
    sums = np.zeros((n, 11))
    pairs, amounts = [], []
    for rows, parts in textcodes.pieces(texts):
        codes, bounds = textcodes.code_points(parts)
        at = np.asarray(rows)
        kind = textcodes.kinds(codes)
        letter, digit, upper, space = ((kind & b) > 0 for b in (1, 2, 4, 8))
        mark = (kind & 11) == 0
        low = codes.copy()
        latin = low < 0x250
        low[latin & upper] = _lower()[low[latin & upper]]
        starts, ends = textcodes.word_spans(codes, kind)
        bucket = textcodes.word_hashes(low, starts, ends) & np.uint32(buckets - 1)
        word_at = np.searchsorted(starts, bounds)
        words = np.diff(word_at)
        spread = lambda x: textcodes.segment_sums(x, bounds)
        of_words = lambda x: textcodes.segment_sums(x, word_at)
        values = [np.diff(bounds) - 2, words, spread(letter), spread(digit), spread(upper), spread(space) - 2, spread(mark),
                  spread(codes == 10), spread(np.concatenate([[False], mark[1:] & mark[:-1]])), of_words(mark[ends] & mark[np.minimum(ends + 1, len(mark) - 1)]),
                  of_words(upper[ends - 1] & upper[starts] & (ends - starts > 1))]
        for c, v in enumerate(values):
            np.add.at(sums[:, c], at, v)
        key = np.repeat(at, words).astype(np.int64) * buckets + bucket
        found, count = np.unique(key, return_counts=True)
        pairs.append(found)
        amounts.append(count)
    key, place = np.unique(np.concatenate(pairs), return_inverse=True) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    count = np.bincount(place, weights=np.concatenate(amounts), minlength=len(key)) if pairs else np.zeros(0)
    row, bucket = key // buckets, key % buckets
    chars, words = np.maximum(sums[:, 0], 1), np.maximum(sums[:, 1], 1)
    lines = sums[:, 7] + 1
    said = np.array([np.nan if d is None else float(d) for d in declared])
    dense = np.stack([np.log1p(sums[:, 0]), np.log1p(sums[:, 1]), *(sums[:, c] / chars for c in range(2, 7)), sums[:, 2] / words, lines / chars,
                      np.log1p(sums[:, 0] / lines), sums[:, 8] / words, sums[:, 9] / words, sums[:, 10] / words,
                      np.where(np.isnan(said), 0, np.log1p(np.maximum(np.nan_to_num(said), 0)) - np.log1p(sums[:, 0]))], axis=1)
    return row, bucket, (count / np.sqrt(words[row])).astype(np.float32), dense


def _lower() -> np.ndarray:
    return np.array([ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(0x250)], dtype=np.uint32)


def _normal(x: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Word amounts scaled to unit length in each text."""
    return x / np.sqrt(np.maximum(np.bincount(row, weights=x * x, minlength=n), 1e-12))[row].astype(np.float32)


def margins(model: Model, row: np.ndarray, bucket: np.ndarray, x: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """bias + sum w x + half of (square of sum v x minus sum of squares v x) over the factors: linear in the features."""
    n, k = len(dense), model.factors.shape[1]
    d = np.clip((dense - model.mean) / model.spread, -4, 4)
    words = len(model.weight) - d.shape[1]
    z = model.bias + np.bincount(row, weights=model.weight[bucket] * x, minlength=n) + d @ model.weight[words:]
    for f in range(k):
        vx = model.factors[bucket, f] * x
        dx = d * model.factors[words:, f]
        one = np.bincount(row, weights=vx, minlength=n) + dx.sum(1)
        two = np.bincount(row, weights=vx * vx, minlength=n) + (dx * dx).sum(1)
        z += 0.5 * (one * one - two)
    return z


def fit(rows: list[tuple], prior: float, buckets: int = 1 << 14, rank: int = 6, epochs: int = 12, batch: int = 64, rate: float = 0.02,
        seed: int = 5) -> Model:
    """Train on ``(label, text, declared length)`` rows with Adagrad on the weighted log-loss; ``prior`` is the share of label 1.

    Without rows of both labels the model gives the share of label 1 (0.5 if there are no rows).
    """
    rng = np.random.default_rng(seed)
    size = buckets + len(STATISTICS)
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.02, (size, rank)), np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    y = np.array([float(r[0]) for r in rows])
    if not len(y) or y.min() == y.max():
        model.factors[:] = 0
        model.bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))) if len(y) else 0.0
        return model
    row, bucket, x, dense = raw_features([r[1] for r in rows], [r[2] for r in rows], buckets)
    x = _normal(x, row, len(rows))
    model.mean, model.spread = dense.mean(0), dense.std(0) + 1e-6
    d = np.clip((dense - model.mean) / model.spread, -4, 4)
    weight = np.where(y > 0, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    ends = np.searchsorted(row, np.arange(len(rows) + 1))
    square_w, square_v, square_b = np.full(size, 1e-4), np.full((size, rank), 1e-4), 1e-4
    for _ in range(max(epochs, 30_000 // max(1, len(rows)))):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in pick])
            local = np.repeat(np.arange(len(pick)), ends[pick + 1] - ends[pick])
            ids = np.concatenate([bucket[at], np.tile(np.arange(buckets, size), len(pick))])
            values = np.concatenate([x[at], d[pick].ravel()])
            local = np.concatenate([local, np.repeat(np.arange(len(pick)), len(STATISTICS))])
            v = model.factors[ids] * values[:, None]
            one = np.stack([np.bincount(local, weights=v[:, f], minlength=len(pick)) for f in range(rank)], axis=1)
            two = np.bincount(local, weights=(v * v).sum(1), minlength=len(pick))
            z = model.bias + np.bincount(local, weights=model.weight[ids] * values, minlength=len(pick)) + 0.5 * ((one * one).sum(1) - two)
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) * weight[pick] / len(pick)
            used, place = np.unique(ids, return_inverse=True)
            each = g[local] * values
            g_w = np.bincount(place, weights=each, minlength=len(used)) + 1e-5 * model.weight[used]
            pull = each[:, None] * (one[local] - v)
            g_v = np.stack([np.bincount(place, weights=pull[:, f], minlength=len(used)) for f in range(rank)], axis=1) + 1e-5 * model.factors[used]
            square_w[used] += g_w * g_w
            square_v[used] += g_v * g_v
            square_b += g.sum() ** 2
            model.weight[used] -= 5 * rate * g_w / np.sqrt(square_w[used])
            model.factors[used] -= rate * g_v / np.sqrt(square_v[used])
            model.bias -= 5 * rate * g.sum() / np.sqrt(square_b)
    return model


def score(model: Model, texts: list[str | None], declared: list) -> np.ndarray:
    """Probability of label 1 for each text, whole; an empty text is scored by its statistics alone."""
    row, bucket, x, dense = raw_features(texts, declared, len(model.weight) - len(STATISTICS))
    z = margins(model, row, bucket, _normal(x, row, len(texts)), dense)
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, held: tuple[int, int], label: str = "quality", key: str = "doc_id", text: str = "text",
          declared: str | None = "n_chars", per_label: int = 1500) -> Model:
    """Fit on at most ``per_label`` rows of each label; only labels 0 and 1 count. ``declared`` is the metadata column."""
    rows, counts = common.labelled_sample(docs, labels.where(F.col(label).isin(0, 1)), label, key, held, text, per_label,
                                          max_labels=2, extra=declared)
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit([(y, t, float(x) if x else None) for y, t, x, _ in rows], prior)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", declared: str | None = "n_chars") -> DataFrame:
    """``key, score`` for each row; a null text is empty, a null declared length counts as right."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b):
        return {key: b.column(0), "score": score(shared.value, b.column(1).to_pylist(), b.column(2).to_pylist())}

    said = (F.col(declared) if declared else F.lit(None)).cast("double").alias("_declared")
    return common.map_batches(docs.select(key, text, said), run, f"{key} {docs.schema[key].dataType.simpleString()}, score double")

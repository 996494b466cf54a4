"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm import common, textcodes

UNKNOWN = "und"


@dataclass
class Model:
    classes: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # (classes, buckets)


def grams(parts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of lower-cased parts and their bounds; the bigrams and trigrams around each letter."""
    codes, bounds = textcodes.code_points([p.lower() for p in parts] if parts else [])
    codes = codes.copy()
    letter = (textcodes.kinds(codes) & 1) > 0
    codes[~letter] = 32
    at = np.flatnonzero(letter)
    c0, c1, c2 = codes[at - 1], codes[at], codes[at + 1]
    two = textcodes.mix(c1 * np.uint32(0x85EBCA77) + c2 * np.uint32(0xC2B2AE3D))
    three = textcodes.mix(c0 * np.uint32(0x27D4EB2F) + c1 * np.uint32(0x9E3779B1) + c2 * np.uint32(0x165667B1) + np.uint32(1))
    mask = np.uint32(buckets - 1)
    # str.lower may lengthen a part: bounds come from the lowered parts
    return two & mask, three & mask, np.searchsorted(at, bounds)


def counts_of(texts: list[str], buckets: int) -> np.ndarray:
    """How often each n-gram occurs in the texts, whole."""
    out = np.zeros(buckets, dtype=np.int64)
    for _, parts in textcodes.pieces(texts):
        two, three, _ = grams(parts, buckets)
        out += np.bincount(two, minlength=buckets) + np.bincount(three, minlength=buckets)
    return out


def from_counts(classes: list[str], counts: np.ndarray, smoothing: float = 0.5) -> Model:
    """Counts of n-grams by class, smoothed; priors are equal, so a rare language isn't held back."""
    counts = counts + smoothing
    return Model(classes, np.full(len(classes), -np.log(max(1, len(classes)))), np.log(counts / counts.sum(1, keepdims=True)))


def fit(rows: list[tuple], buckets: int = 1 << 15) -> Model:
    classes = sorted({r[0] for r in rows})
    counts = [counts_of([r[1] for r in rows if r[0] == y], buckets) for y in classes]
    return from_counts(classes, np.array(counts).reshape(len(classes), buckets))


def judge(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``score`` and whether each text has a letter."""
    n, k = len(texts), len(model.classes)
    total = np.zeros((n, k))
    letters = np.zeros(n, dtype=bool)
    buckets = model.log_prob.shape[1]
    for rows, parts in textcodes.pieces(texts, size=max(1 << 14, min(1 << 18, (1 << 22) // max(1, k)))):
        two, three, bounds = grams(parts, buckets)
        at = np.asarray(rows)
        np.logical_or.at(letters, at, np.diff(bounds) > 0)
        for c in range(k):
            p = model.log_prob[c]
            np.add.at(total[:, c], at, textcodes.segment_sums(p[two] + p[three], bounds))
    if not k:
        return [UNKNOWN] * n, np.zeros(n), letters
    total += model.log_prior
    best = total.argmax(1)
    share = 1 / np.exp(np.minimum(total - total.max(1, keepdims=True), 0)).sum(1)
    names = [model.classes[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
    return names, np.where(letters, share, 0.0), letters


def score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest class of each text and its share of the posterior; ties go to the first class by name."""
    return judge(model, texts)[:2]


def train(docs: DataFrame, held: tuple[int, int], key: str = "doc_id", text: str = "text", label: str = "lang",
          per_label: int = 600, max_labels: int = 256) -> Model:
    """Fit on the whole texts of at most ``per_label`` keys of each of the ``max_labels`` most frequent languages.

    Tasks count the n-grams, so texts of any length train and none goes to the driver: that gets one number for each
    language and bucket.
    """
    rows, found = common.sampled(docs, None, label, key, held, text, per_label, max_labels)
    classes, buckets = sorted(found), 1 << 15
    counts = np.zeros((len(classes), buckets), dtype=np.int64)
    if classes:
        place = {y: i for i, y in enumerate(classes)}
        common.ship(docs.sparkSession)

        def run(batches):
            total: dict[int, np.ndarray] = {}
            for b in common.slices(batches, 100):
                of: dict[int, list[str]] = {}
                for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    of.setdefault(place[y], []).append(t)
                for i, texts in of.items():
                    total[i] = total.get(i, 0) + counts_of(texts, buckets)
            for i, n in total.items():
                at = np.flatnonzero(n).astype(np.int32)
                yield common.pa.RecordBatch.from_arrays([common.pa.array(np.full(len(at), i, np.int32)), common.pa.array(at), common.pa.array(n[at])], ["i", "bucket", "n"])

        summed = rows.select("_y", "_t").mapInArrow(run, "i int, bucket int, n long").groupBy("i", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[summed["i"].to_numpy(), summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return from_counts(classes, counts)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for each row; null texts and texts without a letter are ``und`` with score 0.

    The matrix of log-probabilities goes to the tasks once as a broadcast variable; its size is bounded by the number
    of languages and of buckets.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(b):
        names, share = score(shared.value, b.column(1).to_pylist())
        return {key: b.column(0), "lang_pred": names, "score": share}

    return common.map_batches(docs.select(key, text), run, f"{key} {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, held: tuple[int, int], key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is known, with all their columns: rows judged ``und`` go. Where no language could
    be learned only null texts and texts without a letter go.

    Rows pass through in the same task that scores them, so texts are never shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, held, key, text, label))
    common.ship(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches):
        for b in common.slices(batches):
            names, _, letters = judge(shared.value, b.column(place).to_pylist())
            yield b.filter(common.pa.array([x != UNKNOWN for x in names] if shared.value.classes else letters))

    return docs.mapInArrow(run, docs.schema)


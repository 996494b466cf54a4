"""SimHash near duplicates: fingerprints, a range join over segment popcounts, exact distances."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.llm import common
from factorspark.session import materialize

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEGMENTS = 0x55555555  # the low bit of each two-bit segment of a half


def fingerprint(text: str | None, words: int = 4, block: int = 1 << 16) -> int:
    """64 bits, each set if over half the shingles' hashes have it; no words give zero."""
    found = WORD.findall((text or "").encode("utf-8", "replace").translate(LOWER))
    if not found:
        return 0
    flat = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        last = np.minimum(np.arange(lo, hi) + words, len(found)) - 1
        spans = zip(starts[lo:hi].tolist(), (ends[last] - 1).tolist(), strict=True)
        h = np.array([digest(flat[a:b], 42) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """``key, fp, hash`` for each row: the fingerprint as a signed long, and the XXH64 of the text, which tells rows of a key apart."""
    def run(b):
        out = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], dtype=np.uint64)
        return {key: b.column(0), "fp": out.view(np.int64), "hash": b.column(2)}

    return common.map_batches(docs.select(key, text, F.xxhash64(text)), run, f"{key} {docs.schema[key].dataType.simpleString()}, fp long, hash long")


def _shift_left(x: Column | int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(x).cast("long") if isinstance(x, int) else x, by.cast("int"))


def halves(fp: Column) -> tuple[Column, Column]:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)


def embedding(half: Column) -> Column:
    """The bit counts of 32 overlapping segments of a half (32 bits): each bit with the next one, the last with the first.

    Counts are kept in unary (00, 01, 11), so that the Manhattan distance of two count vectors is the number of differing
    bits of their codes. A bit lies in two segments: the distance is at most twice the number of differing bits.
    """
    def counts(x: Column) -> Column:
        some = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(SEGMENTS))
        both = x.bitwiseAND(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(SEGMENTS))
        return some.bitwiseOR(F.shiftleft(both, 1))

    turned = F.shiftrightunsigned(half, 1).bitwiseOR(F.shiftleft(half.bitwiseAND(F.lit(1)), 31))
    return counts(half).bitwiseOR(F.shiftleft(counts(turned), 32))


def manhattan(a: Column, b: Column) -> Column:
    """Distance of the count vectors of two fingerprints."""
    return sum((F.bit_count(embedding(x).bitwiseXOR(embedding(y))) for x, y in zip(halves(a), halves(b), strict=True)), F.lit(0))


def links(fps: DataFrame, distance: int = 4, crowd: int = 64) -> DataFrame:
    """Edges ``a, b`` between distinct ``fp`` that connect exactly those at most ``distance`` (4 or less) bits apart.

    A range join on a grid: two such fingerprints differ in at most two bits of one half, so their count vectors for that
    half are at most two steps apart, a step being what one bit changes, and some cell lies within one step of both. Each
    fingerprint enters the 33 cells within one step for each half; those that share a cell are candidates. Half their
    Manhattan distance is a lower bound that is tested first, then the bits themselves.

    A cell with more than ``crowd`` members isn't paired off. Its members are linked through the values around them that
    together prove the distance: for an even distance of 2 r two fingerprints have a value within r bits of both if and only
    if they are at most 2 r bits apart. Each such value ties its members to the smallest, so a crowd of n costs 2081 n
    rows (for r = 2), not n squared, and no link between components is lost.
    """
    if distance not in (0, 2, 4):
        raise ValueError("the grid and the crowds prove distances 0, 2 and 4")
    parts = max(1, fps.count() // 16384)
    at = fps.repartition(parts, "fp").select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    at = at.select("fp", "side", F.explode(F.sequence(F.lit(-1), F.lit(31))).alias("i"))
    low, high = halves(F.col("fp"))
    half = F.when(F.col("side") == 0, low).otherwise(high)
    step = F.when(F.col("i") < 0, F.lit(0).cast("long")).otherwise(_shift_left(1, F.greatest("i", F.lit(0))))
    # Cells of both halves share one number; where two fall together the tests below tell them apart.
    cell = embedding(half.bitwiseXOR(step)).bitwiseXOR(F.col("side") * F.lit(0x5851F42D4C957F2D))
    at = at.select("fp", cell.alias("cell"))
    shared = materialize(at.groupBy("cell").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b"), "cells")
    met = materialize(at.join(shared.where("n > 2").select("cell", "n").hint("merge"), "cell"), "met")
    few = met.where(F.col("n") <= crowd)
    pairs = few.select("cell", F.col("fp").alias("a")).join(few.select("cell", F.col("fp").alias("b")).hint("merge"), "cell").where("a < b")
    pairs = pairs.select("a", "b").union(shared.where("n = 2").select("a", "b"))
    pairs = pairs.where((manhattan(F.col("a"), F.col("b")) <= 2 * distance) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    many = met.where(F.col("n") > crowd).select("fp").distinct()
    last = F.lit(63 if distance else -1)
    first = many.select("fp", F.explode(F.sequence(F.lit(-1), last)).alias("i"))
    second = first.select("fp", "i", F.explode(F.when(
        (F.col("i") >= 0) & (F.col("i") < 63) & F.lit(distance == 4),
        F.concat(F.array(F.lit(-1)), F.sequence(F.col("i") + 1, F.lit(63)))).otherwise(F.array(F.lit(-1)))).alias("j"))
    bit = lambda x: F.when(F.col(x) < 0, F.lit(0).cast("long")).otherwise(_shift_left(1, F.greatest(x, F.lit(0))))
    ball = second.select("fp", F.col("fp").bitwiseXOR(bit("i").bitwiseXOR(bit("j"))).alias("point"))
    least = ball.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("top > b").select("point", "b")
    tied = ball.join(least.hint("merge"), "point").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(tied).distinct()


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4, crowd: int = 64) -> DataFrame:
    """``key, fp, component_id`` for each row: near duplicates share the smallest key of their group.

    Null text is empty; texts without words have fingerprint zero and are linked like others. Repeated rows give
    repeated results. A null key leads no group; a group of null keys only has a null ``component_id``.
    """
    fps = materialize(fingerprints(docs, key, text, words).drop("hash"), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min(key).alias("rep")), "classes")
    found = links(classes.select("fp"), distance, crowd)
    rep = classes.where("rep is not null")
    edges = (found.join(rep.select(F.col("fp").alias("a"), F.col("rep").alias("ra")).hint("merge"), "a")
             .join(rep.select(F.col("fp").alias("b"), F.col("rep").alias("rb")).hint("merge"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    roots = common.components(edges)
    named = classes.join(roots.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
    named = materialize(named.select("fp", F.coalesce("root", "rep").alias("component_id")), "named")
    return fps.join(named.hint("merge"), "fp").select(key, "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4, crowd: int = 64) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates, with all its columns: that of the smallest key.

    Groups are those of the fingerprints, whatever the keys: rows that share a key, or have none, stay one for each group.
    A group of null keys only keeps the row with the smallest fingerprint; rows of equal keys are told apart by their
    fingerprints, then by the hashes of their texts. Of repeated rows with one key and text a single one stays.
    """
    rows = fingerprints(docs, key, text, words).groupBy("fp", key, "hash").agg(F.count("*").alias("copies"))
    first = F.struct(F.col(key).isNull().alias("bare"), F.col(key).alias("key"), "fp", "hash", "copies")
    classes = materialize(rows.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    roots = common.components(links(classes.select("fp"), distance, crowd))
    named = classes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
    stay = named.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    stay = materialize(stay.select(F.col("first.key").alias("_key"), F.col("first.hash").alias("_hash"), F.col("first.copies").alias("_copies")), "stay")
    stay = stay.hint("merge")
    same = docs[key].eqNullSafe(stay["_key"]) & (F.xxhash64(docs[text]) == stay["_hash"])
    once = docs.join(stay.where("_copies = 1"), same, "left_semi")
    again = docs.join(stay.where("_copies > 1"), same, "left_semi").dropDuplicates([key, text])
    return once.union(again)

"""Packing of token sequences: linear grouping of lengths, few-size configurations, best fit for the rest."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorspark.llm import bpe, common
from factorspark.session import materialize


def group_sizes(hist: dict[int, int], groups: int) -> list[tuple[int, deque]]:
    """Groups of equal cardinality of the lengths in ``hist``, largest first: the size they are rounded up to and their
    ``[length, count]`` runs, largest first."""
    total = sum(hist.values())
    share = -(-total // groups)
    out, runs, held = [], [], 0
    for length in sorted(hist, reverse=True):
        n = hist[length]
        while n:
            t = min(n, share - held)
            runs.append([length, t])
            held, n = held + t, n - t
            if held == share:
                out.append((runs[0][0], deque(runs)))
                runs, held = [], 0
    if runs:
        out.append((runs[0][0], deque(runs)))
    return out


def best_fill(sizes: dict[int, int], room: int, most: int) -> list[int]:
    """Sizes that fill ``room`` best, each used at most as often as it is there; sums are kept as bits of integers."""
    usable = [s for s in sizes if s <= room]
    mask = (1 << (room + 1)) - 1
    layers = [1]
    for _ in range(most):
        new = 0
        for s in usable:
            new |= layers[-1] << s
        new &= mask
        if not new:
            break
        layers.append(new)
    tops = [(layer.bit_length() - 1, -j) for j, layer in enumerate(layers)]
    at, j = max(tops)
    j, out = -j, []
    while j:
        s = next(s for s in usable if at >= s and layers[j - 1] >> (at - s) & 1)
        out.append(s)
        at, j = at - s, j - 1
    if all(out.count(s) <= sizes[s] for s in set(out)):
        return out
    left, out = dict(sizes), []
    for s in sorted(usable, reverse=True):  # too few of one size: fill with the largest that fit
        while left[s] and s <= room:
            out.append(s)
            left[s] -= 1
            room -= s
    return out


def pack_lengths(hist: dict[int, int], capacity: int, small: int, groups: int) -> list[tuple[int, list[int]]]:
    """Bins as ``(how many, their lengths)`` for items given as counts of lengths.

    Lengths of at least ``small`` are large: they are rounded up within groups of equal cardinality, so that few sizes
    remain. For the largest size left the configuration that fills its bin best is used as often as the counts allow.
    Actual lengths then take the places of the rounded ones, and smaller items go, largest first, into the bin with the
    least room that holds them, or into a new one.
    """
    made = group_sizes({n: c for n, c in hist.items() if n >= small}, groups)
    by_size: dict[int, deque] = {}
    for size, runs in made:
        by_size.setdefault(size, deque()).extend(runs)
    left = {s: sum(c for _, c in runs) for s, runs in by_size.items()}
    bins: list[tuple[int, list[int]]] = []
    while left:
        top = max(left)
        rest = {s: c - (s == top) for s, c in left.items() if c - (s == top) > 0}
        chosen = [top, *best_fill(rest, capacity - top, capacity // small)]
        times = min(left[s] // chosen.count(s) for s in set(chosen))
        open_bins: list[list] = [[times, []]]
        for s in chosen:
            left[s] -= times
            if not left[s]:
                del left[s]
            queue, filled = by_size[s], []
            for count, lengths in open_bins:
                while count:
                    run = queue[0]
                    t = min(count, run[1])
                    filled.append([t, [*lengths, run[0]]])
                    count -= t
                    run[1] -= t
                    if not run[1]:
                        queue.popleft()
            open_bins = filled
        bins += [(t, lengths) for t, lengths in open_bins]
    rooms: dict[int, list] = {}
    for t, lengths in bins:
        rooms.setdefault(capacity - sum(lengths), []).append((t, lengths))
    order = sorted(rooms)
    for length in sorted((n for n in hist if n < small), reverse=True):
        n = hist[length]
        at = int(np.searchsorted(order, length))
        changed: dict[int, list] = {}
        while n:
            while at < len(order) and not rooms[order[at]]:
                at += 1
            if at == len(order):  # new bins
                k = capacity // length
                for t, each in ((n // k, k), (1 if n % k else 0, n % k)):
                    if t:
                        changed.setdefault(capacity - each * length, []).append((t, [length] * each))
                n = 0
                break
            room = order[at]
            t, lengths = rooms[room].pop()
            k = room // length
            use = min(t, n // k)
            if use:
                changed.setdefault(room - k * length, []).append((use, lengths + [length] * k))
                n -= use * k
            if t > use:
                if n:  # fewer than one bin's worth are left
                    changed.setdefault(room - n * length, []).append((1, lengths + [length] * n))
                    n, use = 0, use + 1
                if t > use:
                    rooms[room].append((t - use, lengths))
        for room, blocks in changed.items():
            rooms.setdefault(room, []).extend(blocks)
        order = sorted(r for r, blocks in rooms.items() if blocks)
    return [b for blocks in rooms.values() for b in blocks]


def plan(hist: dict[int, int], capacity: int, choices: tuple[tuple[int, int], ...] = ((2, 64), (4, 64), (8, 64), (4, 256), (8, 256))
         ) -> dict[str, np.ndarray]:
    """Where the items of each length go: item number ``lo`` and following of ``length`` go to sequences ``seq`` and following,
    at ``offset``. Of some thresholds (a fraction of the capacity) and numbers of groups the best result is taken."""
    best = None
    for part, groups in choices:
        bins = pack_lengths(hist, capacity, max(1, capacity // part), groups)
        n = sum(t for t, _ in bins)
        if best is None or n < best[0]:
            best = (n, bins)
    length, lo, seq, offset = [], [], [], []
    used: dict[int, int] = {}
    base = 0
    for t, lengths in best[1] if best else []:
        at = 0
        for n in lengths:
            length.append(n)
            lo.append(used.get(n, 0))
            seq.append(base)
            offset.append(at)
            used[n] = used.get(n, 0) + t
            at += n
        base += t
    cols = {k: np.array(v, dtype=np.int64) for k, v in (("length", length), ("lo", lo), ("seq", seq), ("offset", offset))}
    by = np.lexsort((cols["lo"], cols["length"]))
    return {k: v[by] for k, v in cols.items()}


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32``: each document's ids and ``end_id``, cut where they exceed ``capacity``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(b):
        cols = {"row": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        ids, ends = bpe.encoder(path).encode_all(b.column(1))
        for i, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            for j, at in enumerate(range(lo, hi + 1, capacity)):  # the end id stands at hi
                crc, stop = zlib.crc32(ids[at:min(hi, at + capacity)]), min(hi + 1, at + capacity)
                crc = zlib.crc32(end, crc) if stop > hi else crc
                for name, v in (("row", i), ("piece", j), ("start", at - lo), ("length", stop - at), ("ids_crc32", crc)):
                    cols[name].append(v)
        return {key: b.column(0).take(common.pa.array(cols.pop("row"))), **cols}

    kind = docs.schema[key].dataType.simpleString()
    return common.map_batches(docs.select(key, text), run, f"{key} {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each piece with ``sequence_id`` and ``offset``: sequences of at most ``capacity`` tokens, as few as the method finds.

    The plan is made from the number of pieces of each length, at most ``capacity`` numbers whatever the input; pieces
    are then numbered within their length and look their place up. The pieces of one length are numbered in salted
    parts, so a length that most documents share is no single task. Null text is empty and holds ``end_id`` alone;
    repeated rows are packed each; an empty table gives no rows.
    """
    from pyspark.sql.types import LongType, StructField, StructType

    pieces = materialize(token_pieces(docs, path, capacity, end_id, key, text), "pieces")
    parts = max(64, pieces.count() // 50_000)
    pieces = pieces.withColumn("_part", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(parts)))
    counts = materialize(pieces.groupBy("length", "_part").agg(F.count("*").alias("_n")), "counts")
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    places = docs.sparkSession.sparkContext.broadcast(plan(hist, capacity))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_part").orderBy(key, "piece", "start", "ids_crc32"))
    numbered = pieces.withColumn("_i", number).join(starts, ["length", "_part"])
    numbered = numbered.select(key, "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_i") - 1).alias("_i"))

    def place(batches):
        p = places.value
        # One sorted key for both: lengths are bounded by the capacity, numbers by the rows.
        keys = p["length"] * (1 << 44) + p["lo"]
        for b in batches:
            if b.num_rows:
                length, i = b.column(3).to_numpy(zero_copy_only=False), b.column(5).to_numpy(zero_copy_only=False)
                at = np.searchsorted(keys, length * (1 << 44) + i, side="right") - 1
                yield common.pa.RecordBatch.from_arrays(
                    [*b.columns[:5], common.pa.array(p["seq"][at] + i - p["lo"][at]), common.pa.array(p["offset"][at])],
                    names=[*b.schema.names[:5], "sequence_id", "offset"])

    schema = StructType([*numbered.schema.fields[:5], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return numbered.mapInArrow(place, schema)

"""Texts as arrays of code points and hashed words, for numpy inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np

SPACE = re.compile(r"\s")
WORD_CHARS = re.compile(r"\w")


@cache
def _kinds() -> np.ndarray:
    """For each code point: 1 letter, 2 digit, 4 upper case, 8 white space."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for i in range(0x20000):
        c = chr(i)
        out[i] = c.isalpha() | (c.isdigit() << 1) | (c.isupper() << 2) | (c.isspace() << 3)
    for i in range(0x20000, 0x33480):  # rare ideographs
        out[i] = chr(i).isalpha()
    return out


def kinds(codes: np.ndarray) -> np.ndarray:
    return _kinds()[codes]


def pieces(texts: list[str | None], size: int = 1 << 18, overlap: int = 0) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of about ``size`` characters that together hold every text whole.

    A longer text is cut at white space; ``overlap`` words before a cut are repeated after it. Null is empty.
    """
    rows, parts, held = [], [], 0
    for i, t in enumerate(texts):
        t = t or ""
        at = 0
        while True:
            end = at + size
            if end < len(t):
                cut = SPACE.search(t, end)
                end = cut.start() if cut else len(t)
            else:
                end = len(t)
            rows.append(i)
            parts.append(t[at:end])
            held += end - at
            if held >= size:
                yield rows, parts
                rows, parts, held = [], [], 0
            if end >= len(t):
                break
            at = end
            for _ in range(overlap):
                back = at
                while back > 0 and t[back - 1].isspace():
                    back -= 1
                while back > 0 and not t[back - 1].isspace() and at - back < 200:
                    back -= 1
                at = back
    if rows:
        yield rows, parts


def code_points(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all parts, each between two spaces, with the start of each part and the end of the last."""
    joined = " " + "  ".join(parts) + "  "
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    lens = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 2
    return codes, np.concatenate([[0], np.cumsum(lens)])


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13))


def word_spans(codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters and digits."""
    inside = (kind & 3) > 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # a space stands at both ends
    return edge[0::2], edge[1::2]


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each word: code points times powers by their place, summed."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint32)
    n = len(codes)
    power = np.cumprod(np.concatenate([[1], np.full(63, 0x01000193)]).astype(np.uint32), dtype=np.uint32)
    place = np.arange(n, dtype=np.int64)
    place -= np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [n]])))
    weighted = mix(codes * np.uint32(0x9E3779B1)) * power[place & 63]
    total = np.concatenate([np.zeros(1, np.uint32), np.cumsum(weighted, dtype=np.uint32)])
    return mix(total[ends] - total[starts])

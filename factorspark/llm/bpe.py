"""BPE encoding and decoding by a tokenization automaton.

``compile_merges`` builds the automaton of correct tokenizations by one gadget for each merge, in the order of the merges.
It reads tokens: the state after a token knows which tokens may follow. The gadget of (u, v) -> w

* gives w an arc wherever u has one, leading to the state that v leads to, and
* lets u lead to a new state: the old one without its arc for v (for u = v, without the one for w as well).

States are kept as versions: a new one names the token whose state it replaces and the arc it lost, so a gadget costs
constant work and the whole compilation is linear in the merges. The state's row of arcs is filled in as encoding asks for it and kept.

A word has exactly one tokenization that the automaton accepts, the one that BPE makes, and so has each of its prefixes.
Encoding walks the arcs that fit the word, longest first, and steps back where no arc leads on.
Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from factorspark.llm import common


@dataclass
class Automaton:
    """``target[t]`` is the state behind token t. State s was made by the gadget ``made[s]`` from the states of token
    ``owner[s]``; ``origin[t]`` is the state that t led to when it was born. ``lost[t * size + v]`` numbers the gadget in
    which t's state lost its arc for v. ``born[t]`` numbers t's own gadget (-1 for symbols), ``left[t]`` is its first half,
    ``label[t]`` its text; ``special`` holds texts that are matched whole; ``dead`` tokens have no arc."""

    target: list[int]
    owner: list[int]
    made: list[int]
    origin: list[int]
    lost: dict[int, int]
    born: list[int]
    left: list[int]
    label: list[str]
    token: dict[str, int]
    suffix: str
    special: dict[str, int]
    dead: set[int]


def compile_merges(vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str, special: dict[str, int]) -> Automaton:
    size = max([*vocab.values(), *special.values()], default=-1) + 1
    label = [""] * size
    for text, i in chain(vocab.items(), special.items()):
        label[i] = text
    target, origin, born, left = [0] * size, [0] * size, [-1] * size, [-1] * size
    owner, made = [-1], [-1]  # state 0 has arcs for all tokens
    lost: dict[int, int] = {}
    built = Automaton(target, owner, made, origin, lost, born, left, label, dict(vocab), suffix, dict(special), set())
    for k, (a, b) in enumerate(merges):
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        if u in built.dead or arc(built, target[u], v) < 0:  # an earlier merge always takes u or v: w is never made
            built.dead.add(w)
            continue
        born[w], left[w] = k, u
        target[w] = origin[w] = target[v]
        owner.append(u)
        made.append(k)
        lost[u * size + v] = k
        target[u] = len(owner) - 1
    return built


def arc(a: Automaton, state: int, t: int) -> int:
    """The state behind token ``t`` read in ``state``, -1 if there is no such arc.

    ``t`` inherited its arc from its first half when it was born, that one from its own first half, and so on: the arc is
    missing if the state or one it stems from had lost a token of this chain before the next one in it was born.
    """
    if t in a.dead:
        return -1
    size = len(a.target)
    while state > 0:
        at, until = a.owner[state] * size, a.made[state]
        x, limit = t, until
        while x >= 0:
            k = a.lost.get(at + x)
            if k is not None and k <= limit:
                return -1
            limit = min(until, a.born[x])
            x = a.left[x]
        state = a.origin[a.owner[state]]
    return a.target[t]


#: Keys of a trie node for the token that ends there, inside a word and at its end; bytes lead on.
INNER, LAST = -1, -2

BYTE_CHARS = {}


def byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the other
    bytes follow from code point 256 on."""
    if not BYTE_CHARS:
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        BYTE_CHARS.update({b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)})
    return BYTE_CHARS


# The pattern that splits a text into words, as the vocabulary file has it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space as the split and the replacement of the vocabulary file have it (Unicode's White_Space).
BLANK = "\t-\r \x85\xa0  -     　"
NOT_BLANK_FOR_SPLIT = re.compile("[\x1c-\x1f]")
BLANK_RUN = re.compile(f"[{BLANK}]+")


class Encoder:
    """Encodes and decodes texts as the tokenizer described by a vocabulary file (JSON text) does."""

    def __init__(self, automaton: Automaton, kept: int = 400_000):
        self.a = automaton
        self.kept = kept
        self.rows: dict[int, dict[int, int]] = {}
        self.filled = 0
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.pattern = regex.compile(WORDS.replace(r"\s", BLANK))
        self.specials = re.compile("|".join(sorted(map(re.escape, automaton.special), key=len, reverse=True))) if automaton.special else None
        self.numbers = [str(i) for i in range(len(automaton.label))]
        self.trie: dict = {}
        byte = {c: b for b, c in byte_chars().items()}
        for text, t in automaton.token.items():
            last = bool(automaton.suffix) and text.endswith(automaton.suffix)
            node = self.trie
            for c in text.removesuffix(automaton.suffix) if last else text:
                node = node.setdefault(byte[c], {})
            if last or not automaton.suffix:
                node[LAST] = t
            if not last:
                node[INNER] = t

    def _word(self, word: str) -> list[int]:
        """The accepted path of arcs for one word.

        Longest arcs are tried first. A prefix has one tokenization only, so a place from which the end can't be reached
        is never tried again and a word of n bytes takes at most n steps back.
        """
        w = word.encode("utf-8", "replace")
        n, rows, trie, c_last = len(w), self.rows, self.trie, w[-1]
        view = memoryview(w)  # its slices are no copies
        dead = set()
        path: list[tuple[int, int]] = []  # the place before each token, the token
        state, p = 0, 0
        while p < n:
            row = rows.get(state)
            if row is None:
                row = rows[state] = {}
            node, fits = trie, []
            e = p
            for c in view[p:n - 1]:
                node = node.get(c)
                if node is None:
                    break
                e += 1
                t = node.get(INNER)
                if t is not None and e not in dead:
                    fits.append((e, t))
            else:
                if c_last in node and LAST in node[c_last]:
                    fits.append((n, node[c_last][LAST]))
            for e, t in reversed(fits):
                to = row.get(t)
                if to is None:
                    to = row[t] = arc(self.a, state, t)
                    self.filled += 1
                if to >= 0:
                    path.append((p, t))
                    p, state = e, to
                    break
            else:
                if not path:
                    raise ValueError(f"no tokens for {word!r}")
                dead.add(p)
                p = path.pop()[0]
                state = self.a.target[path[-1][1]] if path else 0
        if self.filled > 8 * self.kept:
            rows.clear()
            self.filled = 0
        return [t for _, t in path]

    def _split(self, chunk: str) -> tuple[str, ...] | list[str]:
        low = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if low.isalpha():
            return (low,)
        if low[:-1].isalpha():  # letters and one other character are two words
            return (low[:-1], low[-1])
        return self.pattern.findall(low)

    def _plain(self, chunk: str) -> bytes:
        parts = []
        for w in self._split(chunk):
            got = self.words.get(w)
            if got is None:
                got = array("I", self._word(w)).tobytes()
                if len(w) <= 64 and len(self.words) < self.kept:
                    self.words[w] = got
            parts.append(got)
        return b"".join(parts)

    def _chunk(self, chunk: str) -> bytes:
        if self.specials and self.specials.search(chunk):
            parts, at = [], 0
            for m in self.specials.finditer(chunk):
                parts += [self._plain(chunk[at:m.start()]), np.array([self.a.special[m[0]]], dtype="<u4").tobytes()]
                at = m.end()
            got = b"".join([*parts, self._plain(chunk[at:])])
        else:
            return self._kept(chunk)
        return got

    def _kept(self, chunk: str) -> bytes:
        got = self._plain(chunk)
        if len(chunk) <= 64 and len(self.chunks) < self.kept // 4:
            self.chunks[chunk] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers; null is empty."""
        if not text:
            return b""
        chunks = BLANK_RUN.split(text) if NOT_BLANK_FOR_SPLIT.search(text) else text.split()
        get, more = self.chunks.get, self._chunk
        return b"".join([get(c) or more(c) for c in chunks if c])

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin (with the end of the last); null is empty.

        The texts are split at once, each distinct chunk between spaces is encoded once, and all ids are gathered by its number.
        """
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():  # Arrow splits there as well
            parts = [np.frombuffer(self.encode(t), dtype="<u4") for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, "<u4"), *parts]), np.cumsum([0, *map(len, parts)])
        lists = pc.utf8_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        chunks = lists.flatten().dictionary_encode()
        special = any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.a.special)
        get, more = self.chunks.get, self._chunk if special else self._kept
        parts = [(get(c) or more(c)) if c else b"" for c in chunks.dictionary.to_pylist()]
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        ids, first = np.frombuffer(b"".join(parts), dtype="<u4"), np.cumsum(size) - size
        at = chunks.indices.to_numpy()
        size, first = size[at], first[at]
        total = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(total[-1]) + np.repeat(first - total[:-1], size)
        return ids[place], total[ends]

    def join_numbers(self, ids: np.ndarray) -> str:
        return " ".join(map(self.numbers.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the ids' arcs; without a decoder in the vocabulary file they are joined by one space."""
        return " ".join(map(self.a.label.__getitem__, ids.tolist()))


def load(path: str) -> Automaton:
    """Compile the automaton from a vocabulary file of the form this module follows: NFC, white space, lower case; words by
    pattern; byte-level symbols with a word end."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return compile_merges(model["vocab"], merges, model.get("end_of_word_suffix") or "", special)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file; compiling takes under a second and what it has met is kept."""
    if path not in _encoders:
        _encoders[path] = Encoder(load(path))
    return _encoders[path]


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids`` for each row: the ids of the whole text (binary, little-endian unsigned 32 bits; null text: none).

    ``path`` names a vocabulary file that every machine has.
    """
    def run(b):
        ids, ends = encoder(path).encode_all(b.column(1))
        return {key: b.column(0), "ids": [ids[lo:hi].tobytes() for lo, hi in zip(ends[:-1], ends[1:], strict=True)]}

    return common.map_batches(docs.select(key, text), run, f"{key} {docs.schema[key].dataType.simpleString()}, ids binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` for each row: encodes, then decodes the ids, in one pass."""
    from hashlib import sha256

    def run(b):
        e = encoder(path)
        n, coded, decoded = [], [], []
        all_ids, ends = e.encode_all(b.column(1))
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            ids = all_ids[lo:hi]
            n.append(len(ids))
            coded.append(sha256(e.join_numbers(ids).encode()).hexdigest())
            decoded.append(sha256(e.decode(ids).encode("utf-8")).hexdigest())
        return {key: b.column(0), "n_tokens": n, "ids_sha256": coded, "decoded_sha256": decoded}

    kind = docs.schema[key].dataType.simpleString()
    return common.map_batches(docs.select(key, text), run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

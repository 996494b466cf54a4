"""Fingerprints, tokens, packing, language, toxicity, quality and the pipeline on small tables with odd rows."""
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from factorspark.llm import bpe, common, langid, packing, quality, queries, simhash, textcodes, toxicity

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, rank int"
ODD = [None, "", " \n ", "a", "1", "...", "Ä", "one two three", "a\x1cb", "ΑΣ ΣΑΣ", "I'm they'LL", "<|startoftext|>x<|endoftext|>", "日本語 🎉", "é é", "x" * 5000,
       "word " * 3000, "İstanbul ẞ ​ ½ Ⅷ", "<|EndOfText|>", "　a b", "'s't're"]


def table(spark, texts):
    rows = [(i, t, "en" if i % 2 else None, "s", None if t is None else len(t), 0, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_equal_the_definition():
    for t in [*ODD, "A b C d E f", "the quick brown fox jumps over the lazy dog " * 40]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    long = " ".join(str(i) for i in range(3000))
    assert simhash.fingerprint(long, block=64) == simhash.fingerprint(long)


def brute_components(fps, distance):
    fps = np.array(fps, dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= distance
    root = np.arange(len(fps))
    while True:
        new = np.where(near, root[None], len(fps)).min(1)
        if (new == root).all():
            return root.tolist()
        root = new


@pytest.mark.parametrize(("distance", "crowd"), [(4, 64), (4, 2), (2, 2), (0, 2)])
def test_links_connect_as_brute_force(spark, distance, crowd):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = list(base)
    for b in base[:20]:  # chains of flips, and one crowd
        for _ in range(4):
            for i in rng.choice(64, rng.integers(1, 6), replace=False):
                b ^= np.uint64(1) << np.uint64(i)
            fps.append(b)
    fps += [base[0] ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(0, 64, 5) for j in range(1, 64, 9) if i != j]
    fps = sorted(set(np.array(fps, dtype=np.uint64).view(np.int64).tolist()))
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), distance, crowd).collect()
    place = {x: i for i, x in enumerate(fps)}
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for e in edges:
        assert bin((e.a ^ e.b) & (2**64 - 1)).count("1") <= distance
        a, b = sorted((top(place[e.a]), top(place[e.b])))
        root[b] = a
    assert [top(i) for i in range(len(fps))] == brute_components(fps, distance)


def test_groups_and_kept_rows_of_odd_texts(spark):
    docs = table(spark, ODD)
    docs = docs.union(docs.where("doc_id = 7")).union(docs.where("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long")))
    got = simhash.groups(docs).collect()
    assert len(got) == len(ODD) + 2
    zero = [r for r in got if r.fp == 0]
    assert len(zero) == 4 and {r.component_id for r in zero} == {0}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(set(r.component_id for r in got))
    empty = table(spark, [])
    assert simhash.groups(empty).collect() == [] and simhash.keep_first(empty).collect() == []


def test_rows_without_or_with_one_key_stay_by_text(spark):
    rng = np.random.default_rng(12)
    text = [" ".join(rng.choice([f"w{i}" for i in range(500)], 80)) for _ in range(12)]
    keys = [None] * 5 + [3, 3, 3, 4, 4, 5, 6]
    rows = [(k, t, "en", "s", i, 0, 1) for i, (k, t) in enumerate(zip(keys, text, strict=True))]
    rows += [(None, text[0], "en", "s", 100, 0, 1), (None, text[5], "en", "s", 101, 0, 1), (3, text[6], "en", "s", 102, 0, 1), (9, text[6], "en", "s", 103, 0, 1),
             (4, text[11], "en", "s", 104, 0, 1)]  # the last row leads the group of 6
    kept = [(r.doc_id, r.text) for r in simhash.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = [*zip(keys[:11], text[:11], strict=True), (4, text[11])]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def reference():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_tokens_equal_the_library(spark):
    ref = reference()
    texts = [*ODD, *[r.text for r in common.table(spark, SF, "documents").limit(60).collect()]]
    rng = np.random.default_rng(7)
    alphabet = list("aabeeinrst  \n'.,-!019éüñßçΣσ<|>THEand日")
    texts += ["".join(rng.choice(alphabet, rng.integers(1, 50))) for _ in range(1500)]
    e = bpe.Encoder(bpe.load(PATH), kept=50)  # a small store is left and refilled
    for t in texts:
        ids = np.frombuffer(e.encode(t), dtype="<u4")
        want = ref.encode(t or "", add_special_tokens=False).ids
        assert ids.tolist() == want, t
        assert e.decode(ids) == ref.decode(want, skip_special_tokens=False)


def test_automaton_accepts_one_tokenization_of_each_word():
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "aa", "ab", "bc", "aab", "abc", "aaaa"])}
    merges = [("a", "a"), ("b", "c"), ("a", "b"), ("aa", "b"), ("ab", "c"), ("aa", "aa")]
    a = bpe.compile_merges(vocab, merges, "", {})
    rank = {m: i for i, m in enumerate(merges)}

    def plain(word):
        parts = list(word)
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
            if best is None:
                return [vocab[p] for p in parts]
            pair, out, i = merges[best[0]], [], 0
            while i < len(parts):
                if tuple(parts[i:i + 2]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out

    def accepted(word, state=0):
        if not word:
            return [[]]
        return [[t, *rest] for text, t in vocab.items() if word.startswith(text) and (to := bpe.arc(a, state, t)) >= 0
                for rest in accepted(word[len(text):], to)]

    def words(n):
        return [""] if n == 0 else [w + c for w in words(n - 1) for c in "abc"]
    for n in range(1, 8):
        for w in words(n):
            assert accepted(w) == [plain(w)], w


def test_round_trip_query_rows(spark, tmp_path):
    docs = table(spark, ODD)
    ref = reference()
    for r in bpe.round_trip(docs, PATH).collect():
        ids = ref.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_texts(table(spark, []), PATH).collect() == []


@pytest.mark.parametrize("capacity", [16, 64])
def test_packing_is_gapless_and_tight(spark, capacity):
    docs = common.table(spark, SF, "documents").select("doc_id", F.substring("text", 1, 400).alias("text")).union(
        table(spark, ODD).select(F.col("doc_id") + 10_000, "text"))
    rows = packing.pack(docs, PATH, capacity).collect()
    ref, by_seq, by_doc = reference(), {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for d in docs.collect():
        ids = [*ref.encode(d.text or "", add_special_tokens=False).ids, 1]
        want = [(i, s, len(ids[s:s + capacity]), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes())) for i, s in enumerate(range(0, len(ids), capacity))]
        assert sorted(by_doc[d.doc_id]) == want
    bound = -(-sum(r.length for r in rows) // capacity)
    assert len(by_seq) <= 1.02 * bound + 1
    assert packing.pack(table(spark, []), PATH).collect() == []


def test_plans_use_every_item_once():
    rng = np.random.default_rng(8)
    for hist in ({5: 1}, {10: 7}, {4: 3, 7: 2}, dict(enumerate(rng.integers(0, 60, 40).tolist(), 1)), {3: 1000, 10: 1}):
        hist = {k: v for k, v in hist.items() if v}
        for small, groups in ((1, 1), (5, 3), (11, 2)):
            bins = packing.pack_lengths(hist, 40, small, groups)
            used = {}
            for n, lengths in bins:
                assert sum(lengths) <= 40
                for x in lengths:
                    used[x] = used.get(x, 0) + n
            assert used == hist


def test_long_texts_are_read_whole():
    t = " ".join(f"word{i}" for i in range(2000))
    for overlap in (0, 2):
        parts = [p for _, group in textcodes.pieces([t, None, ""], size=300, overlap=overlap) for p in group]
        words = [w for p in parts for w in p.split()]
        assert words == t.split() if not overlap else set(words) == set(t.split()) and len(parts) > 20
    m = langid.fit([("a", "abcab cab", ""), ("b", "xyzzy zyx", "")])
    whole = langid.score(m, [t])[1]
    codes = langid.grams([t.lower()], 1 << 15)
    assert len(codes[0]) and whole.shape == (1,)


def test_language_of_odd_rows(spark):
    train = [(i, t, lang, "s", 1, 0, 1) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 40)]
    docs = spark.createDataFrame(train, SCHEMA)
    model = langid.train(docs, held=(4, 2))
    assert model.classes == ["de", "en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(table(spark, ODD), model).collect()}
    assert all((got[i][0] == "und") == (not any(c.isalpha() for c in t or "")) for i, t in enumerate(ODD))
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.score(model, ["The DOG and"])[0] == ["en"]
    kept = langid.keep_known(docs.union(table(spark, ODD)), held=(4, 2))
    assert kept.columns == docs.columns and kept.count() == 80 + sum(any(c.isalpha() for c in t or "") for t in ODD)
    none = langid.train(docs.withColumn("lang", F.lit(None).cast("string")), held=(4, 2))
    assert langid.score(none, ["a"])[0] == ["und"]
    assert langid.predict(table(spark, []), model).collect() == []


def test_long_texts_train_and_unlabelled_ones_stay(spark):
    rows = [(i, t * 1500, lang, "s", 1, 0, 1) for i, (t, lang) in enumerate([("the cat and the dog ", "en"), ("der hund und die katze ", "de")] * 8)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert min(len(r[1]) for r in rows) > 16384
    model = langid.train(docs, held=(4, 2))
    assert model.classes == ["de", "en"] and langid.score(model, ["the dog", "die katze"])[0] == ["en", "de"]
    train = [(r.lang, r.text) for r in docs.where(~common.held_out(F.col("doc_id"), 4, 2)).collect()]
    assert np.allclose(model.log_prob, langid.fit(train).log_prob)
    assert langid.keep_known(docs, held=(4, 2)).count() == len(rows)
    bare = table(spark, ODD).withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_known(bare, held=(4, 2)).count() == sum(any(c.isalpha() for c in t or "") for t in ODD)


def test_toxicity_learns_words_and_takes_odd_rows(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = " ".join(rng.choice(words, 40))
        toxic = i % 4 == 0
        if toxic:
            text += " vile " + " ".join(rng.choice(words, 5)) + " nasty"
        rows.append((i, text, "en", "s", len(text), 0, 1))
        labels.append((i, 1, int(toxic)))
    labels += [(0, 1, 0), (None, 1, 1), (5, 1, None)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, held=(4, 2))
    s = toxicity.score(model, ["w1 w2 vile w3", "w1 w2 w3", *ODD])
    assert s[0] > 0.5 > s[1] and ((s >= 0) & (s <= 1)).all()
    long = "w1 w2 " * 90_000 + "vile nasty " + "w3 " * 90_000
    assert toxicity.score(model, [long])[0] > 0.5
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and 440 <= kept.count() <= 460
    none = toxicity.train(docs, labels.where("false"), held=(4, 2))
    assert (toxicity.score(none, ODD) < 0.01).all()
    assert toxicity.predict(table(spark, []), model).collect() == []


def test_thresholds_count_all_rows_of_a_language(spark):
    rng = np.random.default_rng(13)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(4000):
        lang = "rare" if i % 40 == 0 else None if i % 40 == 1 else "en"
        toxic = i % 8 == 3 or i % 80 in (0, 1)
        rows.append((i, " ".join(rng.choice(words, 12)) + (" vile nasty" if toxic else ""), lang, "s", 1, 0, 1))
        labels.append((i, 1, int(toxic)))
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, held=(4, 2), per_label=60)
    assert set(model.thresholds) == {"", "en", "rare"}
    model.thresholds = {"": 0.0, "en": 1.1, "rare": 1.1}
    kept = toxicity.keep_clean(docs, model)
    assert kept.where("lang is null").count() == 0 and kept.count() == 3900


def test_thresholds_weigh_labels_by_their_rows():
    scored = np.zeros((2, len(toxicity.GRID) + 1))
    scored[0, [0, 5]] = 80, 20  # a fifth of clean rows reach the first five thresholds
    scored[1, [5, 11]] = 20, 80
    assert toxicity.threshold(scored, np.array([100.0, 100.0])) <= 0.4
    assert toxicity.threshold(scored, np.array([1600.0, 100.0])) > 0.4


def test_factorisation_machine_equals_the_double_sum():
    texts = ["good words in a line", None, "", "BAD!!! BAD!!!", "x" * 400]
    rng = np.random.default_rng(10)
    k, buckets = 3, 64
    size = buckets + len(quality.STATISTICS)
    m = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, k)), np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    row, bucket, x, dense = quality.raw_features(texts, [5, None, 0, 3, 400], buckets)
    x = quality._normal(x, row, len(texts))
    got = quality.margins(m, row, bucket, x, dense)
    for i in range(len(texts)):
        f = np.zeros(size)
        f[bucket[row == i]] = x[row == i]
        f[buckets:] = np.clip(dense[i], -4, 4)
        pairs = sum(m.factors[a] @ m.factors[b] * f[a] * f[b] for a in range(size) for b in range(a))
        assert np.isclose(got[i], m.bias + m.weight @ f + pairs)


def test_quality_learns_structure_and_takes_odd_rows(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(500):
        w = rng.choice(words, 60)
        good = i % 5 != 1
        text = " ".join(w) if good else " ".join(x + "%%%" for x in w)
        rows.append((i, text, "en", "s", len(text), 0, 1))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), held=(5, 0))
    s = quality.score(model, [" ".join(words[:60]), "%%% ".join(words[:60]), *ODD], [229, 400, *[None] * len(ODD)])
    assert s[0] > 0.5 > s[1] and ((s >= 0) & (s <= 1)).all()
    assert quality.predict(table(spark, []), model).collect() == []
    got = quality.predict(docs.union(docs.limit(1)), model)
    assert got.count() == 501


def test_a_sample_takes_each_key_once_and_counts_what_can_train(spark):
    rows = [(7, "copy", "en", "s", 4, 0, 1)] * 400 + [(i, f"text {i}", "en", "s", 6, 0, 1) for i in range(8, 400)]
    rows += [(i, "x" * 20_000, "en", "s", 20_000, 0, 1) for i in range(400, 4400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in range(60_000)], "doc_id long, toxic int")
    got, counts = common.labelled_sample(docs, labels, "toxic", "doc_id", (4, 2), per_label=200)
    n = docs.where((F.col("doc_id") < 400) & ~common.held_out(F.col("doc_id"), 4, 2)).select("doc_id").distinct().count()
    assert counts == {1: n} and len(got) == 200 and len({r[3] for r in got}) == 200
    found, _ = common.sampled(docs, labels, "toxic", "doc_id", (4, 2), per_label=200, max_chars=16384)
    assert found.count() == 200


@pytest.mark.parametrize(("name", "label", "column"), [("op6_toxicity", "toxic", "score"), ("op9_language", "lang", "lang_pred"), ("op10_quality", "quality", "score")])
def test_classifiers_on_held_out_rows(spark, name, label, column):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, sf)
    truth = common.table(spark, sf, "documents" if label == "lang" else "labels").select("doc_id", F.col(label).alias("truth"))
    rows = got.where("held_out").join(truth, "doc_id").where("truth is not null").select("truth", column).collect()
    if label == "lang":
        assert np.mean([r.truth == r[column] for r in rows]) > 0.97
        return
    y, s = np.array([r.truth for r in rows]), np.array([r[column] for r in rows])
    assert (s[y == 1][:, None] > s[y == 0][None]).mean() > 0.9
    assert ((s >= 0.3) == y).mean() > 0.93


def test_pipeline_stages(spark):
    docs = common.table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "packing"]
    for _, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert f(spark, docs.limit(0), SF).count() == 0
    kept = simhash.keep_first(toxicity.keep_clean(langid.keep_known(docs, (4, 2)), toxicity.train(
        langid.keep_known(docs, (4, 2)), common.table(spark, SF, "labels"), held=(4, 2))))
    rows = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}

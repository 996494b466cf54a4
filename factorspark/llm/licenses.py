"""License scan: ordered signature rules over a text's words, gated by keywords, overlaps settled by priority and containment.

Everything here is column expressions: one pass over each text, no shuffle, no Python in the tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.llm.license_rules import KINDS, RULES, STEMS, Rule

#: What stands between words once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are all counted, with their labels (fixed values).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: A keyword of the rules that every text with the phrase holds.
BASE_KEYWORDS = {"gnu general public license": "licen", "apache license": "licen", "cc by": "cc by", "mit license": "licen"}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(items: Column, state: Column, step: Callable[[Column, Column], Column], out: Callable[[Column, Column], Column], kind: str,
            block: int = 256) -> Column:
    """``out(state before the item, item)`` for each item of an array, where ``step(state, item)`` gives the next state.

    The array is walked in blocks, so that appending costs a block's length at most and the work grows with the array.
    """
    def walk(first: Column, part: Column) -> Column:
        return F.aggregate(part, F.struct(first.alias("state"), F.array().cast(f"array<{kind}>").alias("out")),
                           lambda a, x: F.struct(step(a["state"], x).alias("state"), F.concat(a["out"], F.array(out(a["state"], x))).alias("out")))

    def blocks(all_items: Column) -> Column:
        start = F.array(F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out")))
        done = F.aggregate(F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / block).cast("int")), start,
                           lambda a, i: F.concat(a, F.array(walk(F.element_at(a, -1)["state"], F.slice(all_items, i * block + 1, F.lit(block))))))
        return F.flatten(F.transform(done, lambda c: c["out"]))

    return let(items, lambda x: F.when(F.size(x) > 0, blocks(x)).otherwise(F.array().cast(f"array<{kind}>")))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def pattern_of(rule: str) -> str:
    """A rule as a regex over spaced words: each word has a space of its own on both sides, so matches next to each other share none."""
    return " (?:" + rule.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + ") "


def held(spaced: Column, keywords: Sequence[str]) -> Column:
    """Those of the keywords that the text holds; bytes are compared, which is faster than characters."""
    octets = spaced.cast("binary")
    return F.array_compact(F.array(*[F.when(F.contains(octets, F.lit(k.replace(" ", "  ").encode())), F.lit(k)) for k in keywords]))


def spans_of(spaced: Column, rule: Column) -> Column:
    """Matches of one rule, as (first word, last word and priority negated for sorting, label, kind, weight)."""
    kind = "struct<start:int,below:int,under:int,label:string,kind:string,weight:double>"
    marked = F.regexp_replace(spaced, rule["pattern"], F.lit("\u0001$0\u0002"))
    def cut(part: Column) -> Column:
        return F.struct(spaces(part).alias("all"), spaces(F.substring_index(part, "\u0002", 1)).alias("inside"))
    def span(before: Column, part: Column) -> Column:
        start = ((before - 1) / 2).cast("int")
        return F.struct(start.alias("start"), (-(start + (part["inside"] / 2).cast("int"))).alias("below"), (-rule["priority"]).alias("under"),
                        rule["label"].alias("label"), rule["kind"].alias("kind"), rule["weight"].alias("weight"))
    # What stands before the first match is a part like the others; its span is cut off again.
    return let(F.split(marked, "\u0001", -1), lambda parts: F.when(F.size(parts) > 1, F.slice(running(
        F.transform(parts, cut), F.lit(0), lambda s, x: s + x["all"], span, kind), 2, F.size(parts) - 1)).otherwise(F.array().cast(f"array<{kind}>")))


def unsuppressed(spans: Column) -> Column:
    """The spans that lie in no other span of the same or a higher priority; of equal ones that with the least label stays.

    In the order of their starts, longer ones first, a span lies in an earlier one just if the farthest end so far reaches its own.
    """
    levels = sorted(p for p, _ in KINDS.values())
    zero = F.struct(*[F.lit(-1).alias(f"far{p}") for p in levels])
    def step(far: Column, x: Column) -> Column:
        return F.struct(*[F.when(-x["under"] >= p, F.greatest(far[f"far{p}"], -x["below"])).otherwise(far[f"far{p}"]).alias(f"far{p}") for p in levels])
    def out(far: Column, x: Column) -> Column:
        reach = F.lit(-1)
        for p in levels:
            reach = F.when(x["under"] == -p, far[f"far{p}"]).otherwise(reach)
        return F.when(reach < -x["below"], F.struct(x["label"].alias("label"), x["kind"].alias("kind"), x["start"].alias("first_word"),
                                                    (-x["below"] - x["start"]).alias("n_words"), x["weight"].alias("weight")))
    kept = F.array_compact(running(F.array_sort(spans), zero, step, out, "struct<label:string,kind:string,first_word:int,n_words:int,weight:double>"))
    # A reference without a known name says something only where nothing else does.
    return let(kept, lambda k: let(F.filter(k, lambda x: x["kind"] != "any"), lambda named: F.when(F.size(named) > 0, named).otherwise(k)))


def keywords_of(rules: Sequence[Rule]) -> list[str]:
    return sorted({r.keyword for r in rules} | set(BASE_KEYWORDS.values()))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = tuple(RULES), stems: Sequence[str] | None = None) -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, detections, score`` for each row.

    Words are the runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. ``n_base`` counts all places of the
    phrases of ``BASE``, ``first_word`` and ``last_word`` are the smallest and largest of their starts (null without one),
    ``base_labels`` their labels. A text without any of ``stems`` (by default ``STEMS`` for ``RULES``, the keywords for other rules)
    is done; in others a rule runs only where its keyword occurs. Its matches are detections; one that lies inside another of the
    same or a higher priority is suppressed (equal places: the higher priority, then the least label stays), and references without a known name count only where nothing else is detected. ``detections`` holds the rest by
    place, ``labels`` their labels and the base labels, distinct and sorted, ``score`` the greatest weight among them, 0 without one.

    A null text counts as empty; an empty text, or one of marks only, has no words and no labels. Texts of any length are
    scanned whole, in the task that reads them, in time that grows with their length. Null and repeated keys keep their rows; an
    empty table gives no rows. Other columns of ``docs``, whatever their names, are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    table = [{"keyword": r.keyword, "pattern": pattern_of(r.pattern), "label": r.label, "kind": r.kind, "priority": KINDS[r.kind][0],
              "weight": KINDS[r.kind][1]} for r in rules]
    known = F.from_json(F.lit(json.dumps(table)), "array<struct<keyword:string,pattern:string,label:string,kind:string,priority:int,weight:double>>")
    stems = stems or (STEMS if tuple(rules) == tuple(RULES) else keywords_of(rules))
    keywords = keywords_of(rules)
    # lower() also changes letters beyond ASCII, which stay parts of words, but for these two, which would become ASCII.
    lowered = F.lower(F.when(F.col("_text").contains("\u0130") | F.col("_text").contains("\u212a"),
                             F.translate("_text", "\u0130\u212a", "\u0131\u03ba")).otherwise(F.col("_text")))
    rows = rows.withColumn("_spaced", F.regexp_replace(F.concat(F.lit("\n"), lowered, F.lit("\n")), BETWEEN, "  "))
    rows = rows.withColumn("_n", (spaces(F.col("_spaced")) / 2 - 1).cast("int")).withColumn("_open", F.size(held(F.col("_spaced"), stems)) > 0)
    rows = rows.withColumn("_hits", F.when(F.col("_open"), held(F.col("_spaced"), keywords)).otherwise(F.array().cast("array<string>")))

    parts = {p: F.when(F.array_contains("_hits", k), F.split("_spaced", pattern_of(p), -1)) for p, k in BASE_KEYWORDS.items()}
    rows = rows.select("*", *[x.alias(f"_parts{i}") for i, x in enumerate(parts.values())])
    counts, firsts, lasts, labels = [], [], [], []
    for i, (phrase, label) in enumerate(BASE.items()):
        x = F.col(f"_parts{i}")
        n, some = F.coalesce(F.size(x) - 1, F.lit(0)), F.size(x) > 1
        counts.append(n)
        firsts.append(F.when(some, ((spaces(x[0]) - 1) / 2).cast("long")))
        lasts.append(F.when(some, F.col("_n") - ((spaces(F.element_at(x, -1)) - 1) / 2).cast("long") - len(phrase.split(" "))))
        labels.append(F.when(some, F.lit(label)))
    rows = rows.withColumn("_base", F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))))

    gated = F.filter(known, lambda r: F.array_contains(F.col("_hits"), r["keyword"]))
    found = F.flatten(F.transform(gated, lambda r: spans_of(F.col("_spaced"), r)))
    none = F.array().cast("array<struct<label:string,kind:string,first_word:int,n_words:int,weight:double>>")
    rows = rows.withColumn("_kept", F.when(F.size("_hits") > 0, unsuppressed(found)).otherwise(none))
    return rows.select(
        F.col("_key").alias(key), F.col("_n").cast("long").alias("n_words"), sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"), F.col("_base").alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat("_base", F.transform("_kept", lambda x: x["label"])))).alias("labels"),
        F.col("_kept").alias("detections"), F.coalesce(F.array_max(F.transform("_kept", lambda x: x["weight"])), F.lit(0.0)).alias("score"))


def oracle_sql(rules: Sequence[Rule] = tuple(RULES)) -> str:
    """The scan of ``documents`` in DuckDB, without the keyword gates: each rule meets each text; spans meet in a join."""
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {text(r.label)}, {text(r.kind)}, {KINDS[r.kind][0]}, {KINDS[r.kind][1]}::double, {text(pattern_of(r.pattern))})"
                     for i, r in enumerate(rules))
    base = ", ".join(f"({text(b)}, {len(p.split())}, {text(pattern_of(p))})" for p, b in BASE.items())

    def spaced(x: str) -> str:
        return f"(length({x}) - length(replace({x}, ' ', '')))"

    return rf"""
with docs as materialized (select doc_id, row_number() over () rid, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') low from documents),
spaced as materialized (select doc_id, rid, len(regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))::bigint n_words,
    regexp_replace(chr(10) || low || chr(10), '{BETWEEN}', '  ', 'g') t from docs),
base as (select * from (values {base}) b(label, n, pattern)),
parts as materialized (select rid, n_words, label, n, regexp_split_to_array(t, pattern) p from spaced, base where regexp_matches(t, pattern)),
places as (select rid, sum(len(p) - 1)::bigint n_base, min(({spaced('p[1]')} - 1) // 2)::bigint first_word,
    max(n_words - ({spaced('p[-1]')} - 1) // 2 - n)::bigint last_word, list(label) base_labels from parts group by rid),
rules as materialized (select * from (values {rows}) r(id, label, kind, priority, weight, pattern)),
pieces as (select rid, id, label, kind, priority, weight, unnest(p) piece, generate_subscripts(p, 1) i from (
    select rid, id, label, kind, priority, weight, string_split(regexp_replace(t, pattern, chr(1) || '\0' || chr(2), 'g'), chr(1)) p
    from spaced, rules where regexp_matches(t, pattern))),
spans as materialized (select rid, label, kind, priority, weight, (before - 1) // 2 a, (before - 1) // 2 + {spaced("split_part(piece, chr(2), 1)")} // 2 z
    from (select *, sum({spaced('piece')}) over (partition by rid, id order by i) - {spaced('piece')} before from pieces) where i > 1),
kept as materialized (select * from spans s where not exists (from spans o where o.rid = s.rid and o.a <= s.a and o.z >= s.z and o.priority >= s.priority
    and (o.a < s.a or o.z > s.z or o.priority > s.priority or o.label < s.label))),
named as (select rid, list(label) labels, max(weight) score from kept k where kind <> 'any'
    or not exists (from kept o where o.rid = k.rid and o.kind <> 'any') group by rid)
select doc_id, n_words, coalesce(n_base, 0) n_base, first_word, last_word, coalesce(array_to_string(list_sort(base_labels), ','), '') base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(base_labels, [])))), ','), '') labels,
    coalesce(score, 0)::double score
from spaced left join places using (rid) left join named using (rid)
"""

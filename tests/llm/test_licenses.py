"""The license scan against a plain scan, and its rules against their keywords."""
import re
import re._parser as regex_parser

import pytest

from factorspark.llm import licenses
from factorspark.llm.license_rules import KINDS, RULES, STEMS, Rule


def examples(parsed) -> list[str]:
    """Texts that a rule matches: each branch and each optional part taken and left."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            parts = [chr(arg)]
        elif op == "IN":
            parts = [next(chr(a[1] if str(a[0]) == "LITERAL" else a[1][0]) for a in arg)]
        elif op == "SUBPATTERN":
            parts = examples(arg[3])
        elif op == "BRANCH":
            parts = [x for b in arg[1] for x in examples(b)]
        else:
            assert op == "MAX_REPEAT"
            parts = ([""] if arg[0] == 0 else []) + [x * max(1, arg[0]) for x in examples(arg[2])]
        out = [a + b for a in out for b in parts]
    return out


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"{r.label}:{r.pattern[:40]}")
def test_every_match_holds_the_keyword_and_a_stem(rule):
    for text in examples(regex_parser.parse(rule.pattern)):
        spaced = "  " + text.replace(" ", "  ") + "  "
        assert re.search(licenses.pattern_of(rule.pattern), spaced)
        assert rule.keyword.replace(" ", "  ") in spaced and any(s.replace(" ", "  ") in spaced for s in STEMS), text


def plain(text: str | None, rules):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(i, b) for p, b in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    spaced, spans = "".join(f" {w} " for w in words), []
    for r in rules:
        for m in re.finditer(licenses.pattern_of(r.pattern), spaced):
            start = spaced[:m.start()].count(" ") // 2
            spans.append((start, start + m.group().count(" ") // 2, KINDS[r.kind][0], r.label, r.kind))
    spans = set(spans)
    kept = [s for s in spans if not any(o[0] <= s[0] and o[1] >= s[1] and o[2] >= s[2] and (o[:3] != s[:3] or o[3] < s[3]) for o in spans)]
    kept = [s for s in kept if s[4] != "any"] or kept
    base = sorted({b for _, b in places})
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), base,
            sorted({s[3] for s in kept} | set(base)), max((KINDS[s[4]][1] for s in kept), default=0.0), sorted((s[0], s[1] - s[0], s[3]) for s in kept))


TEXTS = [
    None, "", " \n\t.,;", "plain words without any", "MIT License", "mit-license MIT LICENSE, (mit\nlicense)", "The Apache License, Version 2.0 and the Apache License.",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "Licensed under CC BY-NC 4.0.", "CC BY cc by CC-BY-SA 4.0 cc0",
    "released under the GNU General Public License, version 3. GNU General Public License", "GNU Lesser General Public License v2.1",
    "// SPDX-License-Identifier: GPL-3.0-or-later\n# SPDX-License-Identifier: Foo-1.0", "// SPDX-License-Identifier: Foo-1.0",
    "Released under the Wobbly Public Licence. See the LICENSE file for details", "smit licenses", "submit license", "naïve mit license é mit licenseé",
    "Kİ mit license K", "x\x01\x02mit\x00license\x7f", "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "https://www.apache.org/licenses/LICENSE-2.0.txt https://opensource.org/licenses/MIT", "mit license " * 700, "word " * 5000 + "Apache License",
    "a" * 300_000 + " gpl v2", "\U0001F600 GPLv2 or later \U0001F600", "all rights reserved. Proprietary and confidential",
]


def test_scan_equals_a_plain_one(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string, _text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        found = sorted((d.first_word, d.n_words, d.label) for d in r.detections)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, found) == plain(t, RULES), t and t[:80]


def test_priority_and_containment(spark):
    rules = [Rule("long", "name", "wide", "a wide b c d"), Rule("part", "name", "wide", "wide b"), Rule("tag", "tag", "wide", "wide b c"),
             Rule("edge", "name", "wide", "d e"), Rule("same", "name", "wide", "wide b"), Rule("guess", "any", "wide", "a wide b c d e")]
    docs = spark.createDataFrame([(1, "a wide b c d e"), (2, "wide b"), (3, "wide b c a wide"), (4, "wide x")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs, rules=rules).collect()}
    assert got == {1: ["edge", "long", "tag"], 2: ["part"], 3: ["tag"], 4: []}


def test_null_and_repeated_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "mit license"), (None, None), (7, "mit license"), (7, "mit license")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_base) for r in licenses.scan(docs).collect()) == [(False, 1), (False, 1), (True, 0), (True, 1)]
    assert licenses.scan(docs.limit(0)).collect() == []


def test_the_plan_stays_in_the_jvm(spark):
    plan = licenses.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "InArrow" not in plan

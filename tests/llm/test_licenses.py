"""License scans against a plain reading of the same rules."""

import random
import re
from itertools import product
from re import _parser

import pytest

from tallyweave.llm import licenses
from tallyweave.llm.license_rules import BASE, rules
from tallyweave.llm.licenses import Detection, license_scan, resolved, scan

SCHEMA = "doc_id long, text string, labels string, score string"
TEXTS = [
    None, "", " .,!", "mit", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0 (the License)", "cc by nc cc BY nc", "xcc by nc",
    "SPDX-License-Identifier: GPL-2.0-or-later", "GNU Lesser General Public License v2.1 \x00 x",
    "Creative Commons Attribution-NonCommercial-ShareAlike", "éapache license version 2", "All rights reserved.",
    "under\x7fthe_mit(license", "x " * 700_000 + "under the mit license", "cc by nc " * 3000,
]


def plain(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = [
        (at, label) for phrase, label in BASE.items()
        for at in range(len(words)) if words[at:at + len(phrase.split())] == phrase.split()
    ]
    joined = " ".join(words).encode()
    hits = set()
    for rule in rules():
        for match in rule.pattern.finditer(joined) if rule.keyword.decode() in words else ():
            first = joined[:match.start()].count(b" ")
            hits.add(Detection(rule.label, rule.priority, rule.confidence, first, first + match[0].count(b" ")))
    rank = lambda d: (d.priority, d.first - d.last, d.first, d.label)
    left = {d for d in hits if not any(
        e.first <= d.first and e.last >= d.last and rank(e) < rank(d) for e in hits)}
    return len(words), base, left


@pytest.mark.parametrize("text", [text for text in TEXTS if len(text or "") < 30_000 and "cc by nc c" not in (text or "")]
                         + ["cc by nc " * 30])
def test_scan(text):
    count, base, left = plain(text)
    got = scan(text or "")
    assert (got["n_words"], got["n_base"]) == (count, len(base))
    assert got["first_word"] == (min(base)[0] if base else None)
    assert got["last_word"] == (max(base)[0] if base else None)
    assert got["base_labels"] == ",".join(sorted({label for _, label in base}))
    assert got["labels"] == ",".join(sorted({label for _, label in base} | {d.label for d in left}))
    assert {tuple(s.values()) for s in got["spans"]} == {tuple(d) for d in left}


def test_rules():
    assert len(rules()) > 300
    for rule in rules():
        assert rule.keyword.decode() in rule.pattern.pattern.decode()


def test_labels():
    assert scan(TEXTS[6])["labels"] == "gpl-3"
    assert scan(TEXTS[7])["labels"] == "apache-2"
    assert scan(TEXTS[11])["labels"] == "lgpl-2-1"
    assert scan(TEXTS[10])["labels"] == "gpl-2-plus"
    assert scan("the license of the community")["labels"] == ""


def test_containment():
    pick = random.Random(12)
    for _ in range(300):
        hits = []
        for _ in range(pick.randint(0, 30)):
            first = pick.randint(0, 20)
            hits.append(Detection(pick.choice("abc"), pick.randint(0, 3), 0.5, first, first + pick.randint(0, 8)))
        rank = lambda d: (d.priority, d.first - d.last, d.first, d.label)
        left = {d for d in hits if not any(
            e.first <= d.first and e.last >= d.last and rank(e) < rank(d) for e in hits)}
        assert set(resolved(hits)) == left


def test_long_texts_alike(monkeypatch):
    texts = [text or "" for text in TEXTS]
    whole = [scan(text) for text in texts]
    monkeypatch.setattr(licenses, "SPLIT_BYTES", 3)
    assert [scan(text) for text in texts] == whole


def test_rows(spark):
    data = [(i, text, "x", "y") for i, text in enumerate(TEXTS)] + [(None, "cc by nc", None, None)] * 2
    got = license_scan(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    for row in got:
        text = "cc by nc" if row.doc_id is None else TEXTS[row.doc_id] or ""
        assert row.asDict(recursive=True) == {"doc_id": row.doc_id, **scan(text)}
    assert license_scan(spark.createDataFrame([], SCHEMA)).count() == 0


def wordings(parsed):
    """Texts that a parsed pattern matches, with each alternative and each optional part."""
    out = [""]
    for kind, own in parsed:
        if kind is _parser.LITERAL:
            more = [chr(own)]
        elif kind is _parser.IN:
            kinds = [k for k, _ in own]
            more = ["x"] if _parser.NEGATE in kinds or _parser.RANGE in kinds else [chr(c) for _, c in own]
        elif kind is _parser.NOT_LITERAL:
            more = ["x"]
        elif kind is _parser.BRANCH:
            more = [text for part in own[1] for text in wordings(part)]
        elif kind is _parser.SUBPATTERN:
            more = wordings(own[3])
        elif kind is _parser.MAX_REPEAT:
            least, _, part = own
            once = wordings(part)
            more = ["".join(t) for n in (least, least + 1) for t in product(once, repeat=n)]
        else:
            assert kind in (_parser.ASSERT, _parser.ASSERT_NOT)
            continue
        out = [a + b for a in out for b in more]
    return out


def test_keyword_is_a_word_of_every_wording():
    for rule in rules():
        if rule.priority == 3:  # the names of priority 4 after what grants them
            continue
        for text in wordings(_parser.parse(rule.pattern.pattern.decode())):
            assert rule.keyword.decode() in text.split(), (rule.label, text)


def test_gate_makes_no_difference():
    """Each wording gives the labels that it has if no rule looks for its keyword."""
    own = rules()
    for rule in own:
        if rule.priority in (0, 2, 4):
            for text in wordings(_parser.parse(rule.pattern.pattern.decode()))[:40]:
                joined = " ".join(text.split()).encode()
                hits = {Detection(r.label, r.priority, r.confidence, joined[:m.start()].count(b" "),
                                  joined[:m.end()].count(b" "))
                        for r in own for m in r.pattern.finditer(joined)}
                gated = licenses.words_of(text)[1]
                assert set(licenses.detections(gated) if gated else ()) == hits


def test_one_word_alternatives():
    assert scan("for noncommercial use only")["labels"] == "non-commercial"
    assert scan("for non-commercial use only")["labels"] == "non-commercial"
    assert scan("released under freebsd")["labels"] == "bsd-2"
    assert scan("the PNG Reference Library License")["labels"] == "libpng"

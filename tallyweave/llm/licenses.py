"""License scans: ordered signature rules over the words of whole texts."""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_text
from .license_rules import BASE, Rule, rules

# Letters, digits and all that is not ASCII make words; A-Z become a-z.
_TO_WORDS = bytes(
    byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
).lower()
SPLIT_BYTES = 1 << 20  # larger texts are not taken apart into a list of words


class Detection(NamedTuple):
    label: str
    priority: int
    confidence: float
    first: int  # its first word
    last: int  # its last word


@cache
def rules_by_keyword() -> dict[bytes, list[Rule]]:
    found: dict[bytes, list[Rule]] = {}
    for rule in rules():
        found.setdefault(rule.keyword, []).append(rule)
    return found


@cache
def base_patterns() -> list[tuple[str, re.Pattern]]:
    return [
        (label, re.compile(rf"(?<![^ ])(?={phrase}(?![^ ]))".encode()))
        for phrase, label in BASE.items()
    ]


def words_of(text: str) -> tuple[int, bytes | None]:
    """How many words, and the words with one space between if a keyword is among them."""
    plain = text.encode("utf-8", "surrogatepass").translate(_TO_WORDS)
    keywords = rules_by_keyword().keys()
    if len(plain) <= SPLIT_BYTES:
        words = plain.split()
        return len(words), None if keywords.isdisjoint(words) else b" ".join(words)
    joined = re.sub(b" +", b" ", plain).strip()
    return joined.count(b" ") + bool(joined), joined


def _places(joined: bytes, starts: list[int]) -> list[int]:
    """Word numbers of ascending byte positions."""
    out, at, count = [], 0, 0
    for start in starts:
        count += joined.count(b" ", at, start)
        at = start
        out.append(count)
    return out


def detections(joined: bytes) -> list[Detection]:
    """Every hit of a rule whose keyword is a word of the text."""
    padded = b" " + joined + b" "
    out = []
    for keyword, own in rules_by_keyword().items():
        if b" " + keyword + b" " not in padded:
            continue
        for rule in own:
            hits = [match.span() for match in rule.pattern.finditer(joined)]
            places = _places(joined, [a for a, _ in hits])
            for (a, b), first in zip(hits, places):
                last = first + joined.count(b" ", a, b)
                out.append(Detection(rule.label, rule.priority, rule.confidence, first, last))
    return out


def resolved(found: list[Detection]) -> list[Detection]:
    """Detections that no better one contains, best first.

    Better is a lower priority number, then more words, then an earlier place,
    then the name. What has been kept never contains another of its kind, so
    its beginnings and ends ascend together and one look-up is enough.
    """
    ranked = sorted(set(found), key=lambda d: (d.priority, d.first - d.last, d.first, d.label))
    kept: list[Detection] = []
    firsts: list[int] = []
    lasts: list[int] = []
    for hit in ranked:
        at = bisect_right(firsts, hit.first) - 1
        if at >= 0 and lasts[at] >= hit.last:
            continue
        kept.append(hit)
        # intervals that the new one contains can no longer decide
        begin = bisect_right(firsts, hit.first - 1)
        end = begin
        while end < len(lasts) and lasts[end] <= hit.last:
            end += 1
        firsts[begin:end] = [hit.first]
        lasts[begin:end] = [hit.last]
    return kept


def scan(text: str) -> dict:
    """What `license_scan` gives for one text."""
    count, joined = words_of(text)
    base: list[tuple[int, str]] = []
    kept: list[Detection] = []
    if joined:
        for label, pattern in base_patterns():
            starts = [match.start() for match in pattern.finditer(joined)]
            base += [(place, label) for place in _places(joined, starts)]
        kept = resolved(detections(joined))
    base_labels = {label for _, label in base}
    return {
        "n_words": count,
        "n_base": len(base),
        "first_word": min(base)[0] if base else None,
        "last_word": max(base)[0] if base else None,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {hit.label for hit in kept})),
        "score": max([hit.confidence for hit in kept], default=0.0),
        "spans": [hit._asdict() for hit in sorted(kept, key=lambda hit: (hit.first, hit.last))],
    }


_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()),
        T.StructField("priority", T.LongType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]))),
])


@F.arrow_udf(_RESULT)
def _scanned(texts):
    import pyarrow as pa

    from pyspark.sql.pandas.types import to_arrow_type

    return pa.array([scan(text.as_py() or "") for text in texts], to_arrow_type(_RESULT))


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text) with what the rules find in it.

    n_words; n_base, first_word and last_word: places of the base phrases;
    base_labels and labels: distinct, sorted, comma-joined; score: the highest
    confidence of a detection, 0 without one; spans: the detections that are
    left, with label, priority, confidence, first and last word.

    A rule runs where its keyword is a word. Of overlapping detections one that
    lies within another of better or equal priority goes; base labels stay.
    NULL counts as empty: no words, no labels, score 0. Rows stay as they are,
    repeated ones and NULL ids too; other columns are not looked at.
    """
    return docs.select("doc_id", _scanned(whole_text("text")).alias("found")).select("doc_id", "found.*")

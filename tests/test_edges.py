"""Header and footer lines, by hand and against a plain version."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some

from tallyweave.operators import edges as ed

SCHEMA = "id long, body string, src string"


def cut(spark, data, **terms):
    made = ed.without_edges(spark.createDataFrame(data, SCHEMA), "id", "body", "src", **terms)
    return sorted(tuple(row) for row in made.collect())


def plain(data, edge, fewest, one_in):
    def ends(text):
        lines = [(at, re.sub("[0-9]+", "#", line.strip(" \t\r\f"))) for at, line in enumerate(text.split("\n"))]
        lines = [line for line in lines if line[1]]
        return {"head": lines[:edge], "foot": lines[-edge:]}

    def runs(lines):
        return [lines[i:j] for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)]

    def key(run):
        return tuple(line for _, line in run)

    texts = {(src, body or "") for _, body, src in data}
    totals = Counter(src for src, _ in texts)
    counts = Counter((src, side, own) for src, text in texts for side, lines in ends(text).items()
                     for own in {key(run) for run in runs(lines)})
    out = []
    for at, body, src in data:
        gone, sizes = set(), []
        for side, lines in ends(body or "").items():
            found = [run for run in runs(lines) if (n := counts[src, side, key(run)]) >= fewest
                     and n * one_in >= totals[src]]
            best = max(found, key=lambda run: (len(run), -run[0][0]), default=[])
            sizes.append(len(best))
            gone |= set(range(best[0][0], best[-1][0] + 1)) if best else set()
        kept = [line for i, line in enumerate((body or "").split("\n")) if i not in gone]
        out.append((at, "\n".join(kept), *sizes))
    return sorted(out)


def test_header_and_footer_go(spark):
    data = [(i, f"Report\n\nYear {1990 + i}\nbody {'x' * i}\nend {'y' * i}\n  Page {i}\r\n", "a") for i in range(1, 6)]
    data += [(9, "Report\nbody", "b"), (10, None, "a"), (11, "", None)]
    got = {row[0]: row[1:] for row in cut(spark, data, edge=2)}
    assert got[1] == ("body x\nend y\n", 2, 1)
    assert got[9] == ("Report\nbody", 0, 0)
    assert got[10] == got[11] == ("", 0, 0)


def test_copies_make_no_header(spark):
    data = [(i, "one\ntwo", "a") for i in range(50)] + [(60, "three", None)]
    assert all(row[2:] == (0, 0) for row in cut(spark, data))


def test_source_without_value_is_a_source(spark):
    data = [(i, f"top\n{'z' * i}", None) for i in range(1, 5)]
    assert cut(spark, data, edge=1)[0] == (1, "z", 1, 0)


def test_empty_table(spark):
    assert cut(spark, []) == []


def test_many_runs_by_join(spark, monkeypatch):
    data = [(i, f"top\n{'z' * i}\nq", "a") for i in range(1, 9)]
    sent = cut(spark, data, edge=2)
    monkeypatch.setattr(ed, "SENT_RUNS", -1)
    assert cut(spark, data, edge=2) == sent == plain(data, 2, ed.FEWEST, ed.ONE_IN)


LINES = some.sampled_from(["a", "b", "a 1", "a 22", "", "  ", " b", "c\t", "long line"])
ROWS = some.lists(some.tuples(some.one_of(some.none(), some.lists(LINES, max_size=9).map("\n".join)),
                              some.sampled_from(["p", "q", None])), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=ROWS)
def test_equals_plain(spark, data):
    data = [(i, body, src) for i, (body, src) in enumerate(data)]
    assert cut(spark, data, edge=3, fewest=2, one_in=4) == plain(data, 3, 2, 4)

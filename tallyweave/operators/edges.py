"""Header and footer lines that many texts of one source share.

The lines near either end of a text are looked at, runs of them that recur in
a source are its headers and footers, and every text loses the longest of its
own. Equal texts count once, so copies of a text do not make its lines a header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..session import stored

EDGE = 5  # lines at either end that may belong to a header or footer
FEWEST = 3  # texts that must share a run
ONE_IN = 20  # and it must be in one text of so many of its source
_BLANKS = " \t\r\f"
# A source has at most ONE_IN times the runs of one text; below so many in all
# sources together they are sent to every task.
SENT_RUNS = 200_000


def _ends(text: Column, edge: int) -> Column:
    """The lines that are not blank at the two ends: their place and a digest.

    Numbers are alike in the digest, as pages count.
    """
    def keyed(lines: Column, side: str) -> Column:
        return F.transform(lines, lambda line: F.struct(
            line["at"].alias("at"),
            F.md5(F.concat(F.lit(side), F.regexp_replace(line["line"], "[0-9]+", "#"))).alias("key"),
        ))

    def both(lines: Column) -> Column:
        last = F.greatest(F.size(lines) - edge, F.lit(0)) + 1
        return F.struct(keyed(F.slice(lines, 1, edge), "head ").alias("head"),
                        keyed(F.slice(lines, last, F.lit(edge)), "foot ").alias("foot"))

    lines = F.transform(F.split(text, "\n"), lambda line, at: F.struct(
        at.alias("at"), F.btrim(line, F.lit(_BLANKS)).alias("line")))
    return let(F.filter(lines, lambda line: line["line"] != ""), both)


def _runs(lines: Column) -> Column:
    """All runs of neighbours among `lines`; NULL where there are none."""
    def run(start: Column, length: Column) -> Column:
        return let(F.slice(lines, start, length), lambda own: F.struct(
            length.alias("length"), (-start).alias("early"),
            own[0]["at"].alias("first"), F.element_at(own, -1)["at"].alias("last"),
            F.md5(F.array_join(F.transform(own, lambda line: line["key"]), " ")).alias("key"),
            F.transform(own, lambda line: line["key"]).alias("lines"),
        ))

    size = F.size(lines)
    return F.when(size > 0, F.flatten(F.transform(F.sequence(F.lit(1), size), lambda start: F.transform(
        F.sequence(F.lit(1), size - start + 1), lambda length: run(start, length)))))


def _often(counts: DataFrame, totals: DataFrame, fewest: int, one_in: int) -> DataFrame:
    """One row per source: the digests that enough of its texts have."""
    source = F.col("source").eqNullSafe(F.col("of"))
    return (
        counts.join(totals, source)
        .filter((F.col("n") >= fewest) & (F.col("n") * one_in >= F.col("n_texts")))
        .groupBy("of").agg(F.collect_set("key").alias("common"))
    )


def _beside(rows: DataFrame, source: str, common: DataFrame) -> DataFrame:
    """`rows` with the digests of their source; sent to every task if they are few."""
    held = common.agg(F.sum(F.size("common"))).first()[0] or 0
    side = F.broadcast(common) if held <= SENT_RUNS else common
    return rows.join(side, F.col(source).eqNullSafe(F.col("of")), "left").drop("of")


def common_edges(
    texts: DataFrame, text: str, source: str,
    edge: int = EDGE, fewest: int = FEWEST, one_in: int = ONE_IN,
) -> DataFrame:
    """The runs of lines at the ends that texts share: of (a source), common (digests).

    A run recurs in at least `fewest` different texts of the source, and in one
    of `one_in`. A run can only recur if all its lines do, so lines are counted
    first and only runs of such lines after; counts are summed before they
    move, so a line that all texts have is no single task's work. NULL is a
    source like any other, a NULL text is empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    read = texts.select(F.col(source).alias("source"), F.md5(whole).alias("own"), _ends(whole, edge).alias("ends"))
    keys = [F.transform(f"ends.{side}", lambda line: line["key"]).alias(side) for side in ("head", "foot")]
    distinct = stored(read.select("source", "own", *keys).distinct(), "edges")
    totals = stored(
        distinct.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("n_texts")), "edge-totals")
    lines = (
        distinct.select("source", F.explode(F.array_distinct(F.concat("head", "foot"))).alias("key"))
        .groupBy("source", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)
    )
    known = stored(_often(lines, totals, fewest, one_in), "edge-lines")

    def shared(side: str) -> Column:
        placed = F.transform(side, lambda key, at: F.struct(at.alias("at"), key.alias("key")))
        whole_runs = F.filter(_runs(placed), lambda run: F.forall(
            run["lines"], lambda key: F.array_contains("common", key)))
        return F.transform(whole_runs, lambda run: run["key"])

    either = F.arrays_overlap("common", F.concat("head", "foot"))
    runs = (
        _beside(distinct, "source", known).filter(either)
        .select("source", F.explode(F.array_distinct(F.concat(
            F.coalesce(shared("head"), F.array().cast("array<string>")),
            F.coalesce(shared("foot"), F.array().cast("array<string>"))))).alias("key"))
        .groupBy("source", "key").agg(F.count("*").alias("n"))
    )
    return stored(_often(runs, totals, fewest, one_in), "edge-runs")


def without_edges(
    texts: DataFrame, key: str, text: str, source: str,
    edge: int = EDGE, fewest: int = FEWEST, one_in: int = ONE_IN,
) -> DataFrame:
    """Every text without its longest header and footer: key, text, n_head, n_foot.

    Of two runs of equal length the earlier one goes. Only the lines of the run
    go, with no blank line around it; a text of nothing else becomes empty, a
    NULL text too. Texts move through no exchange unless the runs of all
    sources are too many to be sent to every task.
    """
    common = common_edges(texts, text, source, edge, fewest, one_in)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = _beside(texts.select(F.col(key), whole.alias(text), F.col(source).alias("_source")), "_source", common)

    def longest(side: str) -> Column:
        return F.array_max(F.filter(_runs(F.col(f"_ends.{side}")), lambda run: F.array_contains("common", run["key"])))

    def within(at: Column, run: str) -> Column:
        return F.coalesce(at.between(F.col(f"{run}.first"), F.col(f"{run}.last")), F.lit(False))

    found = (
        rows.withColumn("_ends", F.when(F.col("common").isNotNull(), _ends(F.col(text), edge)))
        .withColumns({"_head": longest("head"), "_foot": longest("foot")})
    )
    kept = F.filter(F.split(text, "\n"), lambda _, at: ~within(at, "_head") & ~within(at, "_foot"))
    some = F.col("_head").isNotNull() | F.col("_foot").isNotNull()
    return found.select(
        key, F.when(some, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(text),
        *[F.coalesce(F.col(f"_{side}.length"), F.lit(0)).cast("long").alias(f"n_{side}") for side in ("head", "foot")],
    )

"""Mixing sources to target weights: budgets down a tree, prefixes of epochs.

The tree has domains, in them languages, in them sources. A budget of tokens is
shared out from the top by weight. What a node cannot fill goes to its siblings
by their weights; only what all siblings together cannot fill goes up. Every
leaf then reads its documents in the order of a seeded epoch, epoch after
epoch, up to its budget.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, whole_text

LEVELS = ("domain", "lang", "source")
# Rows of an epoch that one task puts in order; more rows make more slices.
SLICE_DOCS = 4_096
ORDERS = 1 << 60  # places of an epoch that the hash order tells apart


def tokens_of(text: str | Column) -> Column:
    """Words without white space; NULL counts as empty."""
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def weight_of(column: str, weights: Mapping[str, int] | None, default: int) -> Column:
    """A positive whole-number weight by name; unnamed and NULL ones get `default`."""
    if not weights:
        return F.lit(default).cast("long")
    named = F.create_map(*[F.lit(part) for pair in weights.items() for part in pair])
    return F.coalesce(F.element_at(named, F.coalesce(column, F.lit(""))), F.lit(default)).cast("long")


def share_out(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """`nodes` with `budget`: what each gets of its parent's `above`, at most its `room`.

    Siblings come in the order of room per weight. As long as a node's share of
    what is left fills it, it takes its room; the first that is not filled
    fixes the rate for itself and all after it. Whole numbers throughout;
    rounding down loses less than one token per node.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), name)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    siblings = nodes.withColumn(
        "_rest", F.col("above") - F.coalesce(F.sum("room").over(earlier), F.lit(0))
    ).withColumn("_onward", F.sum("weight").over(onward))
    unfilled = F.expr("_rest * weight div _onward < room")
    rate = F.first(F.when(unfilled, F.struct("_rest", "_onward")), ignorenulls=True).over(so_far)
    return siblings.withColumn("_rate", rate).withColumn(
        "budget",
        F.expr("coalesce(least(room, _rate._rest * weight div _rate._onward), room)"),
    ).drop("_rest", "_onward", "_rate")


def same_keys(keys: Sequence[str]) -> Column:
    """Each key equals the one with an underscore before it; NULL equals NULL."""
    conditions = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return reduce(lambda a, b: a & b, conditions)


def leaf_budgets(
    leaves: DataFrame, budget: int, epochs: int,
    weights: Mapping[str, Mapping[str, int]] | None = None, default: int = 1,
) -> DataFrame:
    """`leaves` (domain, lang, source, tokens, ...) with `budget` tokens for each.

    A leaf has room for `epochs` passes over its tokens, an inner node for what
    its leaves have. `weights` has whole numbers by level and name. There is
    one row per leaf, and nothing here grows with the documents.
    """
    level = leaves.withColumn("room", F.col("tokens") * epochs)
    above = None
    for depth in range(1, len(LEVELS) + 1):
        parent, name = LEVELS[:depth - 1], LEVELS[depth - 1]
        nodes = level if depth == len(LEVELS) else level.groupBy(*LEVELS[:depth]).agg(
            F.sum("room").alias("room")
        )
        if above is None:
            nodes = nodes.withColumn("above", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(above, same_keys(parent)).drop(*[f"_{key}" for key in parent])
        weight = weight_of(name, (weights or {}).get(name), default)
        shared = share_out(nodes.withColumn("weight", weight), parent, name)
        above = shared.select(
            *[F.col(key).alias(f"_{key}") for key in LEVELS[:depth]], F.col("budget").alias("above")
        )
    return shared.drop("above", "weight", "room")


def epoch_order(seed: int, epoch: str, doc_id: str) -> Column:
    """The place of a document in an epoch: 60 bits of the MD5 of seed, epoch and id."""
    key = F.concat_ws("|", F.lit(str(seed)), F.col(epoch).cast("string"),
                      F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def mix(
    docs: DataFrame, domain: Column, share: tuple[int, int], epochs: int = 1, seed: int = 0,
    weights: Mapping[str, Mapping[str, int]] | None = None, default: int = 1,
    slice_docs: int = SLICE_DOCS,
) -> DataFrame:
    """One row per document and epoch that the mixture takes.

    `docs` has doc_id, text, lang and source; `domain` is an expression over
    it. The budget is `share` (a fraction) of all tokens. Columns: doc_id,
    domain, lang, source, epoch (from 0), tokens, before (tokens of the leaf's
    last epoch that come earlier; NULL in whole epochs), taken (tokens that the
    budget covers; less than `tokens` for the last document of a leaf).

    Whole epochs take every document. The hash order of the last, part epoch is
    cut into slices of about `slice_docs` documents; slice totals say where
    each begins, and only slices that begin within the budget are summed row
    by row. So no task orders a whole leaf, however large.

    Rows with one doc_id in a leaf count as one document with all their tokens.
    NULL is a language, source or domain like any other, and NULL ids are one
    document per leaf. A leaf without tokens gives its documents once. No rows
    give no rows; other columns of `docs` are not looked at.
    """
    leaf = list(LEVELS)
    units = stored(
        docs.select(
            "doc_id", domain.cast("string").alias("domain"),
            F.col("lang").cast("string").alias("lang"),
            F.col("source").cast("string").alias("source"), tokens_of("text").alias("tokens"),
        ).groupBy(*leaf, "doc_id").agg(F.sum("tokens").alias("tokens")),
        "mix-documents",
    )
    budget = (units.agg(F.sum("tokens")).first()[0] or 0) * share[0] // share[1]
    leaves = units.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    plan = stored(
        leaf_budgets(leaves, budget, epochs, weights, default).select(
            *[F.col(key).alias(f"_{key}") for key in leaf],
            F.expr("if(tokens > 0, budget div tokens, 1)").alias("_whole"),
            F.expr("if(tokens > 0, budget % tokens, 0)").alias("_part"),
            F.expr(f"{ORDERS} div ((docs + {slice_docs} - 1) div {slice_docs})").alias("_width"),
        ),
        "mix-plan",
    )
    planned = units.join(plan, same_keys(leaf)).drop(*[f"_{key}" for key in leaf])
    whole = planned.filter("_whole > 0").select(
        "doc_id", *leaf, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_whole") - 1)).alias("epoch"),
        "tokens", F.lit(None).cast("long").alias("before"), F.col("tokens").alias("taken"),
    )
    part = (
        planned.filter("_part > 0")
        .withColumn("_order", epoch_order(seed, "_whole", "doc_id"))
        .withColumn("_slice", F.expr("_order div _width"))
    )
    earlier = Window.partitionBy(*leaf).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        part.groupBy(*leaf, "_slice", "_part").agg(F.sum("tokens").alias("_sum"))
        .withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .filter("_start < _part")
        .select(*[F.col(key).alias(f"_{key}") for key in leaf], F.col("_slice").alias("__slice"), "_start")
    )
    inside = Window.partitionBy(*leaf, "_slice").orderBy("_order", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    cut = (
        part.join(starts, same_keys([*leaf, "_slice"]))
        .withColumn("before", F.col("_start") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .filter("before < _part")
        .select(
            "doc_id", *leaf, F.col("_whole").alias("epoch"), "tokens", "before",
            F.expr("least(tokens, _part - before)").alias("taken"),
        )
    )
    return whole.unionByName(cut)


def mixed(docs: DataFrame, domain: Column, share: tuple[int, int], **how) -> DataFrame:
    """The rows of `docs` that one pass of the mixture takes, with all their columns, whatever their names."""
    taken = mix(docs.select("doc_id", "text", "lang", "source"), domain, share, epochs=1, **how)
    keys = ("doc_id", *LEVELS)
    taken = taken.select(*[F.col(key).alias(f"_{key}") for key in keys])
    own = [F.col("doc_id"), domain.cast("string"), F.col("lang").cast("string"), F.col("source").cast("string")]
    keyed = docs.select(
        F.struct("*").alias("whole"), *[value.alias(key) for key, value in zip(keys, own)]
    )
    return keyed.join(taken, same_keys(keys), "left_semi").select("whole.*")

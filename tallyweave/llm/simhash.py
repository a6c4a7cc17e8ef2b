"""Near duplicates: 64-bit SimHash fingerprints linked through Golay codewords.

Two fingerprints link when at most 3 bits differ. Then one half of 32 bits has
at most one error, and of the four bytes of the other half one has none. A half
is cut into 23 bits and 9 bits: either the 9 are equal and the 23 have at most
one error, or the 23 are equal. Vectors of 23 bits that differ in one bit have
a codeword of the perfect Golay code in common, if each is given its nearest
codeword and, where that is three bits away, the five that are four away. So
any linked pair shares a key: (codeword, 9 bits, byte) or (23 bits, byte).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import stored, whole_text

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
GENERATOR = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1, of the Golay code of length 23
BLOCK_WORDS = 65_536  # words of a text that are shingled at a time
SMALL_GROUP = 32  # groups up to this size are compared position by position
CHUNK = 8_192  # fingerprints of a larger group that one comparison holds


def _blocks(text: bytes, words: int) -> Iterator[list[bytes]]:
    """The words, some at a time; blocks overlap so that no shingle is lost."""
    carry: list[bytes] = []
    while text:
        if len(text) <= 8 * BLOCK_WORDS:
            block, text = text.split(), b""
        else:
            block = text.split(None, BLOCK_WORDS)
            text = block.pop() if len(block) > BLOCK_WORDS else b""
        carry += block
        if len(carry) >= words or not text:
            yield carry
            carry = carry[len(carry) - words + 1:]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the text's word shingles as a signed 64-bit number.

    A-Z are lower-cased, words are runs without white space. Fewer words than
    a shingle has make one shingle; no words make 0.
    """
    ones, total = np.zeros(64, np.int64), 0
    for block in _blocks((text or "").encode("utf-8", "surrogatepass").lower(), words):
        if not block or (total and len(block) < words):
            continue
        joined = b" ".join(block)
        ends = list(accumulate((len(word) + 1 for word in block)))
        starts = [0, *ends]
        digest = xxhash.xxh64_digest
        hashes = b"".join(
            [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[words - 1:] or ends[-1:])]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
        total += len(bits)
    packed = np.packbits(2 * ones > total).tobytes()
    return int.from_bytes(packed, "big", signed=True)


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(text) for text in texts], dtype="int64")


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; errors up to a codeword.

    The last has for each syndrome the error to the nearest codeword and, where
    that has three bits, the five errors of four bits; -1 fills the rest.
    """
    unit = []
    for bit in range(23):
        value = 1 << bit
        for high in range(22, 10, -1):
            if value >> high & 1:
                value ^= GENERATOR << (high - 11)
        unit.append(value)

    def spread(units):
        table = np.zeros(1 << len(units), np.int64)
        for at, value in enumerate(units):
            table[1 << at:2 << at] = table[:1 << at] ^ value
        return table

    low, high = spread(unit[:12]), spread(unit[12:])
    near = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << bit for bit in bits)
            found = near[low[error & 4095] ^ high[error >> 12]]
            if weight < 4 or found[0].bit_count() == 3:
                found.append(error)
    return low, high, np.array([row + [-1] * (6 - len(row)) for row in near], np.int64)


def golay_indices(vectors: np.ndarray) -> np.ndarray:
    """Up to six codeword numbers (12 bits) for each vector of 23 bits; else -1."""
    low, high, near = golay_tables()
    errors = near[low[vectors & 4095] ^ high[vectors >> 12]]
    return np.where(errors < 0, -1, (vectors[:, None] ^ errors) >> 11)


def link_keys(prints: np.ndarray) -> np.ndarray:
    """Keys for each fingerprint, 56 columns, -1 where there is none."""
    bits = prints.astype(np.int64).view(np.uint64)
    halves = [(bits >> np.uint64(32)).astype(np.int64), (bits & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    columns = []
    for side, half in enumerate(halves):
        long_part, short_part, other = half >> 9, half & 511, halves[1 - side]
        words = golay_indices(long_part)
        for place in range(4):
            byte = other >> 8 * place & 255
            tag = (side << 3 | place << 1) << 32
            for word in words.T:
                key = tag | word << 17 | short_part << 8 | byte
                columns.append(np.where(word < 0, -1, key))
            columns.append(tag | 1 << 32 | long_part << 8 | byte)
    return np.stack(columns, axis=1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 16_384):
            part = prints[at:at + 16_384]
            keys = link_keys(part)
            row, column = np.nonzero(keys >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[row, column]), pa.array(part[row])], ["key", "fp"]
            )


def forest(prints: np.ndarray, distance: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is connected by links: fewer than there are members."""
    bits = prints.view(np.uint64)
    rest, left, right = np.arange(len(prints)), [], []
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            at = stack.pop()
            near = np.bitwise_count(bits[rest] ^ bits[at]) <= distance
            if near.any():
                hits, rest = rest[near], rest[~near]
                left.append(np.full(len(hits), prints[at]))
                right.append(prints[hits])
                stack.extend(hits)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


LINKED = "a long, b long, key long, task long, piece long, prints array<long>"
_LINKED = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("task", pa.int64()),
    ("piece", pa.int64()), ("prints", pa.list_(pa.int64())),
])


def _edges(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
    none = pa.nulls(pairs.shape[1], pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[0]), pa.array(pairs[1]), none, none, none,
         pa.nulls(pairs.shape[1], pa.list_(pa.int64()))], schema=_LINKED)


def _close(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside the groups of sorted `keys`, all of them whole and none hot."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    for start, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
        yield forest(prints[start:start + size])
    few = np.repeat((sizes > 1) & (sizes <= SMALL_GROUP), sizes)
    keys, bits = keys[few], prints[few].view(np.uint64)
    for shift in range(1, SMALL_GROUP):
        at = np.flatnonzero(keys[shift:] == keys[:-shift])
        if not len(at):
            break
        at = at[np.bitwise_count(bits[at] ^ bits[at + shift]) <= MAX_DISTANCE]
        yield bits[at].view(np.int64), bits[at + shift].view(np.int64)


def _linker(chunk: int):
    """Edges from (key, fp) rows in sorted order, and pieces of groups that go on.

    A group may go on in the tasks before and after, so the first and the last
    group of a task are handed on as pieces; so is one above `chunk`, piecewise.
    """

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, pieces = TaskContext.get().partitionId(), 0

        def piece(key, prints):
            nonlocal pieces
            pieces += 1
            yield _edges(*forest(prints))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([key], pa.int64()),
                 pa.array([task], pa.int64()), pa.array([pieces], pa.int64()),
                 pa.array([prints], pa.list_(pa.int64()))], schema=_LINKED)

        keys = prints = np.empty(0, np.int64)
        going_on = None  # the key whose rows are pieces: the task's first, then any hot one
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False)])
            going_on = keys[0] if going_on is None else going_on
            cut = np.searchsorted(keys, keys[-1])
            begin = np.searchsorted(keys[:cut], going_on, "right")
            for at in range(0, begin, chunk):
                yield from piece(going_on, prints[at:min(at + chunk, begin)])
            if cut > begin:
                found = list(_close(keys[begin:cut], prints[begin:cut]))
                if found:
                    yield _edges(*map(np.concatenate, zip(*found)))
            keys, prints = keys[cut:], prints[cut:]
            while len(keys) > chunk:
                going_on = keys[0]
                yield from piece(going_on, prints[:chunk])
                keys, prints = keys[chunk:], prints[chunk:]
        if len(keys):
            yield from piece(keys[0], prints)

    return linked


def _linked_pieces(group: pa.Table) -> pa.Table:
    prints = np.concatenate([np.asarray(row, np.int64) for row in group.column("prints").to_pylist()])
    left, right = forest(np.unique(prints))
    return pa.table({"a": np.minimum(left, right), "b": np.maximum(left, right)})


def linked_prints(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) between the distinct numbers in `fp` that connect all links.

    Rows of one key are spread over tasks by range, so a key that most
    fingerprints have is cut as well; its pieces meet two by two afterwards.
    Emitted are spanning edges: in number like the rows, not like the pairs.
    """
    keyed = prints.select("fp").mapInArrow(_keyed, "key long, fp long")
    found = stored(
        keyed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp")
        .mapInArrow(_linker(chunk), LINKED),
        "simhash-links",
    )
    edges = found.filter("key IS NULL").select("a", "b")
    pieces = found.filter("key IS NOT NULL").select("key", "task", "piece", "prints")
    order = pieces.select("key", "task", "piece").selectExpr(
        "key", "task", "piece",
        "row_number() OVER (PARTITION BY key ORDER BY task, piece) AS place",
        "count(*) OVER (PARTITION BY key) AS places",
    ).filter("places > 1")
    blocks = pieces.join(order, ["key", "task", "piece"]).selectExpr(
        "key", "place", "prints", "explode(sequence(1, int(places))) AS other"
    ).filter("place != other").selectExpr(
        "key", "least(place, other) AS i", "greatest(place, other) AS j", "prints"
    )
    across = blocks.groupBy("key", "i", "j").applyInArrow(_linked_pieces, "a long, b long")
    return edges.unionByName(across).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is its least reachable node.

    Alternates two steps until nothing changes: every node's larger neighbours
    move to its least neighbour, then its smaller ones do. The edges end as
    stars. Each round is written to the shared folder.
    """
    edges = stored(edges.selectExpr("greatest(a, b) AS node", "least(a, b) AS root")
                   .filter("node != root").distinct(), "components")
    while True:
        both = edges.unionByName(edges.selectExpr("root AS node", "node AS root"))
        least = both.groupBy("node").agg(F.min("root").alias("low"))
        large = (
            both.join(least, "node").filter("root > node")
            .selectExpr("root AS node", "least(node, low) AS root").distinct()
        )
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node").filter("root != low").selectExpr("root AS node", "low AS root")
        after = stored(
            small.unionByName(low.selectExpr("node", "low AS root")).distinct(), "components"
        )
        gauge = [F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))]
        if edges.agg(*gauge).first() == after.agg(*gauge).first():
            return after
        edges = after


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): fingerprint (long) and component_id.

    component_id is the smallest doc_id that links of at most 3 bits reach.
    Copies have one fingerprint and only distinct ones are compared. NULL and
    empty texts have fingerprint 0, which links like any other. A NULL doc_id
    is never the smallest, unless the component has no other: then its id is
    NULL. Repeated rows each come back. No rows give no rows. Other columns are
    `root`, the component's least fingerprint, and `content`, a hash of the text.
    """
    ship_package(docs.sparkSession)
    text = whole_text("text")
    marked = stored(
        docs.select("doc_id", fingerprints(text).alias("fp"), F.xxhash64(text).alias("content")),
        "simhash-prints",
    )
    smallest = stored(
        marked.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "simhash-distinct"
    )
    roots = connected(linked_prints(smallest))
    labelled = smallest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "smallest"
    )
    ids = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    members = labelled.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(members, "fp").select(
        "doc_id", F.col("fp").alias("fingerprint"), "component_id", "root", "content"
    )


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """`docs` with one row of every component, that of the smallest doc_id.

    Of several rows with this doc_id one stays; a component without ids keeps
    one row as well. All columns come back, whatever their names:
    a row travels as one struct.
    """
    kept = (
        simhash_groups(docs.select("doc_id", "text"))
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("doc_id").alias("keep_id"), F.min("content").alias("keep_content"),
             F.count("*").alias("copies"))
    )
    staying = docs.select(
        F.struct("*").alias("whole"), F.col("doc_id").alias("own_id"),
        F.xxhash64(whole_text("text")).alias("own_content"),
    ).join(
        kept,
        F.col("own_id").eqNullSafe(F.col("keep_id"))
        & (F.col("own_content") == F.col("keep_content")),
    )
    single = staying.filter("copies = 1").select("whole.*")
    repeated = staying.filter("copies > 1").dropDuplicates(["root"]).select("whole.*")
    return single.unionByName(repeated)

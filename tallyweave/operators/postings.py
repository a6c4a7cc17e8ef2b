"""Posting lists and runs of terms inside a task: plain arrays, no Spark."""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

_MIX = np.uint64(0x9E3779B97F4A7C15)
RUN_BITS = 53  # of a run's hash, so that it and the place of a text fit 63 bits

# Sent along with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _words(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of every line, the number of each word, and the different words."""
    words = pc.split_pattern(lines, " ")
    coded = words.flatten().dictionary_encode()
    return np.diff(words.offsets.to_numpy()), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def lists(ids: pa.Array, lines: pa.Array, mean: float, repeats: float, share: float) -> dict[str, pa.Array]:
    """term, ids and shares of all terms of lines that have one, by id.

    A share is the saturated count of the term in that line, which the line's length lowers.
    """
    order = np.argsort(ids.to_numpy(), kind="stable")
    ids = ids.to_numpy()[order]
    lengths, code, terms = _words(lines.take(pa.array(order)))
    keys = code * len(ids) + np.repeat(np.arange(len(ids)), lengths)
    keys.sort()
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    n = np.diff(starts, append=len(keys)).astype(np.float64)
    term, row = np.divmod(keys[starts], max(len(ids), 1))
    shares = n * (repeats + 1) / (n + repeats * (1 - share + share * lengths[row] / mean))
    owners = ids[row]
    if len(ids) and (ids[1:] == ids[:-1]).any():
        order = np.lexsort((shares, owners, term))
        owners, shares = owners[order], shares[order]
    offsets = pa.array(np.searchsorted(term, np.arange(len(terms) + 1)), pa.int32())
    return {
        "term": terms, "ids": pa.ListArray.from_arrays(offsets, pa.array(owners, pa.int64())),
        "shares": pa.ListArray.from_arrays(offsets, pa.array(shares, pa.float64())),
    }


def runs(lines: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the line and hash of all its different runs of `length` words; at most 1,000 lines."""
    lengths, code, words = _words(lines)
    hashes = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
    word, row = hashes[code], np.repeat(np.arange(len(lines)), lengths)
    count = max(len(word) - length + 1, 0)
    rolled = np.zeros(count, np.uint64)
    for at in range(length):
        rolled = rolled * _MIX + word[at:at + count]
    whole = row[:count] == row[len(row) - count:]
    own = np.unique(row[:count][whole] << RUN_BITS | (rolled[whole] >> np.uint64(64 - RUN_BITS)).astype(np.int64))
    return own >> RUN_BITS, own & ((1 << RUN_BITS) - 1)

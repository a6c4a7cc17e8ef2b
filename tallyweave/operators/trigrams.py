"""Trigrams counted inside a task: plain arrays, no Spark."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Characters and texts counted at a time, so that an owner and three letters fit 63 bits
# even if all letters of Unicode occur; a longer text is counted alone.
MOST_CHARS, MOST_TEXTS = 1_000_000, 1_000
_BITS, _MARK = 21, ord("_")

# Sent along with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts (first, how many) of bounded size."""
    before = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))])
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(before, before[first] + MOST_CHARS, side="right")) - 1
        last = min(max(last, first + 1), first + MOST_TEXTS, len(texts))
        yield first, last - first
        first = last


def counted(texts: pa.Array, owners: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, trigram and count of all trigrams around a letter, by owner and trigram.

    A text has its words between single marks, one before the first and one behind the last.
    An owner is the place of the text, or what `owners` has for it, small and from 0. A
    trigram is a number, in the order of its text.
    """
    letters = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)) if owners is None else owners, lengths)
    middle = np.flatnonzero(letters != _MARK)
    seen = np.zeros(int(letters.max(initial=0)) + 1, bool)
    seen[letters] = True
    alphabet = np.flatnonzero(seen)
    size = len(alphabet)
    place = np.cumsum(seen) - 1
    own = place[letters]
    keys = ((owner[middle] * size + own[middle - 1]) * size + own[middle]) * size + own[middle + 1]
    keys.sort()
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    n = np.diff(starts, append=len(keys))
    rest, third = np.divmod(keys[starts], max(size, 1))
    rest, second = np.divmod(rest, max(size, 1))
    who, first = np.divmod(rest, max(size, 1))
    return who, (alphabet[first] << 2 * _BITS) | (alphabet[second] << _BITS) | alphabet[third], n


def number(gram: str) -> int:
    first, second, third = map(ord, gram)
    return (first << 2 * _BITS) | (second << _BITS) | third


def text(gram: int) -> str:
    low = (1 << _BITS) - 1
    return chr(gram >> 2 * _BITS) + chr(gram >> _BITS & low) + chr(gram & low)


class Profiles:
    """The lists of all languages: `known` has lang, gram and place."""

    def __init__(self, known: list[tuple[str, str, int]], places: int):
        self.places = places
        self.langs = sorted({lang for lang, _, _ in known})
        at = {lang: i for i, lang in enumerate(self.langs)}
        rows = sorted((number(gram), at[lang], place) for lang, gram, place in known)
        grams, self.lang, self.place = np.array(rows, np.int64).reshape(-1, 3).T.copy()
        self.grams, self.start, self.having = np.unique(grams, return_index=True, return_counts=True)

    def told(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts with a letter: place, number of the nearest language, distance.

        Equal counts are placed by gram, equal distances settled by the language's name.
        """
        who, gram, n = counted(texts)
        order = np.lexsort((gram, -n, who))
        who, gram = who[order], gram[order]
        place = np.arange(len(who)) - np.searchsorted(who, who) + 1
        listed = place <= self.places
        who, gram, place = who[listed], gram[listed], place[listed]
        size = np.bincount(who, minlength=len(texts))
        some = np.flatnonzero(size)
        if not self.langs:
            return some, np.zeros(len(some), np.int64), size[some] * self.places
        found = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        shared = np.flatnonzero(self.grams[found] == gram)
        found = found[shared]
        # a row for every language that has the gram
        times = self.having[found]
        mine = np.repeat(shared, times)
        theirs = np.arange(len(mine)) + np.repeat(self.start[found] - (np.cumsum(times) - times), times)
        nearer = np.bincount(
            who[mine] * len(self.langs) + self.lang[theirs],
            np.abs(place[mine] - self.place[theirs]) - self.places, len(texts) * len(self.langs),
        ).reshape(len(texts), -1)[some]
        # one that shares nothing is 0 nearer, so only where none shares the first is told
        best = nearer.argmin(axis=1)
        return some, best, size[some] * self.places + nearer[np.arange(len(some)), best].astype(np.int64)

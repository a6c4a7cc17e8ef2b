"""Byte-pair merging of one piece of text."""

from __future__ import annotations

from heapq import heapify, heappop, heappush
from itertools import pairwise


def merge_pairs(symbols: list[str], ranks: dict[str, float], between: str = "") -> list[str]:
    """`symbols` after all merges: always the adjacent pair of lowest rank, leftmost first.

    `ranks` has the pairs that merge, under both symbols with `between` amid.
    The symbols form a linked list and the pairs a heap, so n symbols take
    n log n steps. A heap entry whose symbols are gone by the time it comes up
    is passed over.
    """
    get, count = ranks.get, len(symbols)
    heap = []
    for at in range(count - 1):
        left, right = symbols[at], symbols[at + 1]
        found = get(left + between + right)
        if found is not None:
            heap.append((found, at, left, right))
    if not heap:
        return symbols
    heapify(heap)
    symbols = [*symbols]
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    while heap:
        _, at, left, right = heappop(heap)
        other = after[at]
        if symbols[at] != left or other >= count or symbols[other] != right:
            continue
        joined = symbols[at] = left + right
        symbols[other] = ""
        follower = after[at] = after[other]
        if follower < count:
            before[follower] = at
            right = symbols[follower]
            found = get(joined + between + right)
            if found is not None:
                heappush(heap, (found, at, joined, right))
        leader = before[at]
        if leader >= 0:
            left = symbols[leader]
            found = get(left + between + joined)
            if found is not None:
                heappush(heap, (found, leader, left, joined))
    return [symbol for symbol in symbols if symbol]


def merge_few(symbols: list[str], ranks: dict[str, float], between: str = "") -> list[str]:
    """`merge_pairs` for a handful of symbols: looks through all ranks for each merge."""
    get, never = ranks.get, float("inf")
    symbols = [*symbols]
    pairs = [get(a + between + b, never) for a, b in pairwise(symbols)]
    while pairs and (best := min(pairs)) != never:
        at = pairs.index(best)
        symbols[at] += symbols.pop(at + 1)
        del pairs[at]
        if at:
            pairs[at - 1] = get(symbols[at - 1] + between + symbols[at], never)
        if at < len(pairs):
            pairs[at] = get(symbols[at] + between + symbols[at + 1], never)
    return symbols

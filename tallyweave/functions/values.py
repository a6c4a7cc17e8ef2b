"""Casts and arithmetic that give NULL where ANSI mode would raise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_double(value: Column | str) -> Column:
    return _col(value).try_cast("double")


def as_date(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Quotient; NULL for a zero or missing divisor."""
    return F.try_divide(_col(top), _col(bottom))


def like_any(value: Column | str, patterns, exact: bool = False) -> Column:
    """LIKE against any pattern.

    `_` is a one-character wildcard, as in SQL. With `exact` it stands for
    itself and only `%` stays a wildcard.
    """
    return any_of(_like(_col(value), pattern, exact) for pattern in patterns)


def _like(value: Column, pattern: str, exact: bool) -> Column:
    """One LIKE, behind tests of its fixed ends.

    The ends are plain comparisons that settle most rows without a regular
    expression, and the scan can use them to skip data.
    """
    fixed = re.split("%" if exact else "[%_]", pattern)
    head, tail = fixed[0], fixed[-1]
    if len(fixed) == 1:
        return value == pattern
    tests = []
    if head:
        tests.append(value.startswith(head))
    if tail:
        tests.append(value.endswith(tail))
    if pattern not in (f"{head}%", f"%{tail}"):
        tests.append(value.like(pattern.replace("_", "\\_") if exact else pattern))
    return all_of(tests) if tests else value.isNotNull()


def any_of(tests) -> Column:
    tests = list(tests)
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found


def all_of(tests) -> Column:
    tests = list(tests)
    held = tests[0]
    for test in tests[1:]:
        held = held & test
    return held

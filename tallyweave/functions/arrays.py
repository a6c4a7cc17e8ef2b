"""JSON array text and positional zips."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once.

    Inside a lambda an outer expression runs again for every element; bound
    like this it runs once per row however often the body mentions it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def json_array(text: Column | str, element: str) -> Column:
    """Parse JSON array text; malformed text gives NULL."""
    return F.from_json(text, f"array<{element}>")


def zip_shortest(**arrays: Column) -> Column:
    """Zip arrays by position and cut to the shortest; NULL if any is NULL."""
    def zipped(parsed: Column) -> Column:
        sizes = [F.size(parsed[name]) for name in arrays]
        present = parsed[next(iter(arrays))].isNotNull()
        for name in arrays:
            present = present & parsed[name].isNotNull()
        whole = F.arrays_zip(*[parsed[name].alias(name) for name in arrays])
        # least() skips NULL sizes, so missing arrays are tested on their own.
        return F.when(present, F.slice(whole, F.lit(1), F.least(*sizes)))

    return let(F.struct(*[array.alias(name) for name, array in arrays.items()]), zipped)

"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import stored

__all__ = ["stored", "whole_text"]


def whole_text(column: str | Column) -> Column:
    """The text as it is; NULL counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))

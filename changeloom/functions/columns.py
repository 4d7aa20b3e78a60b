"""Small helpers for naming columns safely."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """Column reference that also works for names with dots or backticks."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    """A name as SQL text can hold it."""
    return "`" + name.replace("`", "``") + "`"

"""Casts that turn bad values into NULL and never fail a job, under ANSI mode too."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.columns import ref

logger = logging.getLogger(__name__)


def safe_casts(df: DataFrame, wanted: Mapping[str, T.DataType]) -> dict[str, Column]:
    """One cast expression per wanted column, aliased to the column's own name.

    A column that already has the type is passed through, which keeps its filters eligible for
    pushdown. A pair of types Spark has no cast for (a date to an int, say) gives NULL.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    casts = {
        name: ref(name) if present[name] == to else ref(name).try_cast(to)
        for name, to in wanted.items()
    }
    if not _resolves(df, list(casts.values())):
        for name, to in wanted.items():
            if not _resolves(df, [casts[name]]):
                logger.warning(
                    "no cast from %s to %s: column %r becomes NULL",
                    present[name].simpleString(), to.simpleString(), name,
                )
                casts[name] = F.lit(None).cast(to)
    return {name: expr.alias(name) for name, expr in casts.items()}


def _resolves(df: DataFrame, exprs: list[Column]) -> bool:
    try:
        df.select(*exprs)
    except AnalysisException:
        return False
    return True

"""MERGE into a catalog table whose format supports row-level operations.

On such formats this takes the place of the keyed table on Parquet. None is part of a plain Spark
installation, so here only the refusal by a plain Parquet table is tested.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.changes import IS_DELETED, reduced_changes


def as_new(order_by: Sequence[str], source: str, target: str) -> Column:
    """True unless the target's row is newer than the source's; NULL is the oldest value."""
    older, tied = F.lit(False), F.lit(True)
    for name in order_by:
        change, stored = F.col(f"{source}.{name}"), F.col(f"{target}.{name}")
        older = older | (tied & stored.isNotNull() & (change.isNull() | (stored > change)))
        tied = tied & stored.eqNullSafe(change)
    return ~F.coalesce(older, F.lit(False))


def merge_into_catalog(
    changes: DataFrame,
    table: str,
    keys: Sequence[str],
    op: str | None = None,
    order_by: Sequence[str] = (),
    deletes: str = "hard",
) -> None:
    """Reduce the changes to one per key by their total order, then let the table format merge them by name.

    A change older than the stored row is left out, by the columns of the order that the table stores. A deleted
    row that is gone can't hold a late change back.
    """
    shape = [f for f in changes.sparkSession.table(table).schema.fields if f.name != IS_DELETED]
    latest = reduced_changes(changes, shape, keys, op, order_by)
    target = table.rsplit(".", 1)[-1]
    matches = [F.col(f"{target}.{k}").eqNullSafe(F.col(f"source.{k}")) for k in keys]
    values = {f.name: F.col(f"source.{f.name}") for f in shape if f.name in latest.columns}
    deleted, due = F.col(f"source.{IS_DELETED}"), as_new([n for n in order_by if n in values], "source", target)

    merge = latest.alias("source").mergeInto(table, reduce(and_, matches))
    if deletes == "soft":
        values[IS_DELETED] = deleted
        merge.whenMatched(due).update(values).whenNotMatched().insert(values).merge()
        return
    merge = merge.whenMatched(deleted & due).delete()
    merge.whenMatched(due).update(values).whenNotMatched(~deleted).insert(values).merge()

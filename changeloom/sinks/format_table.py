"""A keyed target table kept by the format its spec names, under its own name in the catalog.

The first batch creates the table and works for every format Spark can write. Later batches are merged by
the format itself, so only formats with row-level operations take them; others refuse. Such formats keep
versions and small files by their own means, so nothing waits here and nothing is left to maintain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.columns import ref
from changeloom.functions.types import check_types
from changeloom.operators.changes import IS_DELETED, effect_counts, reduced_changes
from changeloom.sinks.catalog_merge import merge_into_catalog
from changeloom.sinks.layout import even_files
from changeloom.sources.catalog import ensure_database, named


class FormatTable:
    """Handle on the catalog table ``name``; its files are below ``path``."""

    def __init__(
        self, spark: SparkSession, path: str, format: str, partition_by: Sequence[str] = (), *, name: str, compression: str = "snappy"
    ):
        self._spark, self.path, self.name = spark, path.rstrip("/"), name
        self._format, self._folders, self._compression = format, list(partition_by), compression

    def exists(self) -> bool:
        return self._spark.catalog.tableExists(named(self.name))

    def apply(
        self,
        changes: DataFrame,
        batch_key: str,
        *,
        keys: Sequence[str],
        op: str | None = None,
        order_by: Sequence[str] = (),
        buckets: int | None = None,
        sort_by: Sequence[str] = (),
        deletes: str = "hard",
        declared: Mapping[str, T.DataType] | None = None,
    ) -> None:
        """Apply one batch; the first one creates the table, with the ``declared`` columns it lacks.

        The table is deemed created once the catalog has it; files a dead writer left are overwritten.
        Under ``hard`` a deleted key leaves nothing behind, so a change that comes later still makes a new row.
        ``batch_key`` and ``buckets`` are there so that all kinds of table can be asked alike.
        """
        op = op if op in changes.columns else None
        order_by = [name for name in order_by if name in changes.columns]
        if self.exists():
            held = self._spark.table(self.name)
            check_types(changes.schema, held.schema)
            merge_into_catalog(changes, self.name, keys, op, order_by, self._deletes(held))
            return
        lacking = {n: F.lit(None).cast(kind) for n, kind in (declared or {}).items() if n not in changes.columns}
        changes = changes.withColumns(lacking) if lacking else changes
        latest = reduced_changes(changes, changes.schema.fields, keys, op, order_by)
        kept = [n for n in changes.columns if n not in self._folders]
        rows = latest.select(*map(ref, kept), ref(IS_DELETED), *map(ref, self._folders))
        if deletes == "hard":
            rows = rows.where(~ref(IS_DELETED)).drop(IS_DELETED)
        laid = even_files(rows, self._folders).sortWithinPartitions(*map(ref, [*self._folders, *sort_by, *keys]))
        ensure_database(self._spark, self.name.rpartition(".")[0], self.path)
        writer = laid.write.format(self._format).mode("overwrite")
        writer = writer.option("path", f"{self.path}/rows").option("compression", self._compression)
        (writer.partitionBy(*self._folders) if self._folders else writer).saveAsTable(self.name)

    def read(self, deletes: str | None = None) -> DataFrame:
        """The current rows: ``hard`` without deleted keys, ``soft`` with the delete flag if the table has it."""
        held = self._spark.table(self.name)
        if IS_DELETED not in held.columns or (deletes or "soft") == "soft":
            return held
        return held.where(~ref(IS_DELETED)).drop(IS_DELETED)

    def effects(
        self, changes: DataFrame, op: str | None = None, *, keys: Sequence[str], order_by: Sequence[str] = ()
    ) -> DataFrame:
        """See ``effect_counts``."""
        return effect_counts(self._spark.table(self.name), changes, keys, op, order_by)

    def maintain(self, max_batches: int = 50, ratio: float = 0.1, retention: str | None = None) -> str:
        return "none"

    # Inner workings

    @staticmethod
    def _deletes(held: DataFrame) -> str:
        return "soft" if IS_DELETED in held.columns else "hard"

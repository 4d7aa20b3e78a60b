"""A keyed target table in partition folders, whose rows may move from one folder to another.

A batch is applied at once, to the folders it touches: those its rows belong to, and those that hold
the rows it replaces, found by matching its keys against the keys and partition columns of the table and
nothing else. These folders are merged with the batch and overwritten as partitions; all others keep their
files. A folder whose last row has moved away is dropped.

If a writer dies while it commits, some of the folders may be new and others old. The batch is applied
again then: it finds a moved key in both folders and replaces both rows. A table has one writer at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.columns import quoted, ref
from changeloom.functions.types import check_types
from changeloom.operators.changes import IS_DELETED, apply_changes, effect_counts, reduced_changes
from changeloom.sinks.layout import even_files
from changeloom.sources.catalog import ensure_database, location_of, named
from changeloom.storage import Storage, scratch_folder

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: where Spark puts rows without a partition value


class PartitionedTable:
    """Handle on the table in folders below ``path``, by the columns ``partition_by``."""

    def __init__(
        self, spark: SparkSession, path: str, partition_by: Sequence[str], *, name: str | None = None, compression: str = "snappy"
    ):
        self._spark, self._path, self._folders = spark, path.rstrip("/"), list(partition_by)
        self._compression, self.name = compression, name
        database, _, own = (name or "partitioned").rpartition(".")
        self._database = database or spark.catalog.currentDatabase()
        self._rows = f"{self._database}.{own}_{zlib.crc32(self._path.encode()):08x}_rows"

    @property
    def path(self) -> str:
        return self._path

    def exists(self) -> bool:
        return bool([n for n in Storage(self._spark).names(f"{self._path}/rows") if "=" in n])

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
        """Apply one batch; the first one creates the table. A batch that comes again changes nothing.

        The table has the columns of the first batch and the ``declared`` ones that it lacks, NULL at first.
        ``batch_key`` and ``buckets`` are there so that either kind of table can be asked alike.
        """
        if not self.exists():
            lacking = {n: F.lit(None).cast(kind) for n, kind in (declared or {}).items() if n not in changes.columns}
            changes = changes.withColumns(lacking) if lacking else changes
            columns = [T.StructField(f.name, f.dataType) for f in changes.schema.fields]
            self._enter(T.StructType([*columns, T.StructField(IS_DELETED, T.BooleanType())]), deletes)
        held = self._table()
        shape = [f for f in held.schema.fields if f.name != IS_DELETED]
        check_types(changes.schema, held.schema)
        op = op if op in changes.columns else None
        order_by = [name for name in order_by if name in held.columns and name in changes.columns]
        folder = scratch_folder(self._spark, "partitioned-batch")
        reduced_changes(changes, shape, keys, op, order_by).write.parquet(folder)
        batch = self._spark.read.parquet(folder)

        before = self._folders_of(batch, held, keys)
        touched = set(before) | self._values(batch)
        if not touched:
            return
        old = held.where(self._any(touched))
        merged = apply_changes(old, batch, keys, None, order_by, "soft", reduced=True)
        left = self._values(merged)
        laid = even_files(merged.select(*map(ref, held.columns)), self._folders)
        laid = laid.sortWithinPartitions(*map(ref, [*self._folders, *sort_by, *keys]))
        laid.write.insertInto(self._rows, overwrite=True)
        for values in set(before) - left:
            self._drop(values)
        self._spark.catalog.refreshTable(self._rows)
        Storage(self._spark).remove(folder)

    def read(self, deletes: str | None = None) -> DataFrame:
        """The current rows: ``hard`` without deleted keys, ``soft`` with the delete flag."""
        held = self._table()
        if (deletes or self._deletes()) == "soft":
            return held
        return held.where(~ref(IS_DELETED)).drop(IS_DELETED)

    def effects(
        self, changes: DataFrame, op: str | None = None, *, keys: Sequence[str], order_by: Sequence[str] = ()
    ) -> DataFrame:
        """See ``effect_counts``."""
        return effect_counts(self._table(), changes, keys, op, order_by)

    def maintain(self, max_batches: int = 50, ratio: float = 0.1, retention: str | None = None) -> str:
        """Nothing waits here: every batch is in its folders already. Deleted keys stay."""
        return "none"

    # Inner workings

    def _table(self) -> DataFrame:
        if location_of(self._spark, self._rows) != f"{self._path}/rows":  # a session that doesn't know it
            stored = self._spark.read.parquet(f"{self._path}/schema").schema
            self._enter(stored, self._deletes())
        return self._spark.table(self._rows)

    def _deletes(self) -> str:
        return Storage(self._spark).read_text(f"{self._path}/deletes").strip()

    def _enter(self, schema: T.StructType, deletes: str) -> None:
        storage = Storage(self._spark)
        ensure_database(self._spark, self._database, self._path)
        if not storage.exists(f"{self._path}/deletes"):
            self._spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self._path}/schema")
            storage.put_text(f"{self._path}/deletes", deletes)
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(map(quoted, self._folders))
        self._spark.sql(f"DROP TABLE IF EXISTS {named(self._rows)}")  # external: no file goes
        self._spark.sql(
            f"CREATE TABLE {named(self._rows)} ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic', compression '{self._compression}') "
            f"PARTITIONED BY ({by}) LOCATION '{self._path}/rows'"
        )
        if self.exists():
            self._spark.sql(f"ALTER TABLE {named(self._rows)} RECOVER PARTITIONS")
        if self.name:
            shown = ", ".join([quoted(f.name) for f in schema.fields if f.name != IS_DELETED] + [IS_DELETED] * (deletes == "soft"))
            kept = "" if deletes == "soft" else f" WHERE NOT {IS_DELETED}"
            self._spark.sql(f"CREATE OR REPLACE VIEW {named(self.name)} AS SELECT {shown} FROM {named(self._rows)}{kept}")

    def _values(self, rows: DataFrame) -> set[Row]:
        """Different partition values; as many as there are folders at most."""
        return set(rows.select(*map(ref, self._folders)).distinct().collect())

    def _folders_of(self, batch: DataFrame, held: DataFrame, keys: Sequence[str]) -> set[Row]:
        """Folders that hold a key of the batch."""
        wanted = batch.select(*[ref(k).alias(f"_held_{k}") for k in keys])
        matches = reduce(and_, [ref(k).eqNullSafe(ref(f"_held_{k}")) for k in keys])
        narrow = held.select(*map(ref, dict.fromkeys([*keys, *self._folders])))
        return self._values(narrow.join(wanted, matches, "left_semi"))

    def _any(self, values: set[Row]) -> Column:
        """True for rows of these folders, in a form by which Spark skips all others."""
        if len(self._folders) == 1:
            column, known = ref(self._folders[0]), [v[0] for v in values if v[0] is not None]
            found = column.isin(known) if known else F.lit(False)
            return found | column.isNull() if len(known) < len(values) else found
        each = [reduce(and_, [ref(n).eqNullSafe(F.lit(v[n])) for n in self._folders]) for v in values]
        return reduce(or_, each)

    def _drop(self, values: Row) -> None:
        texts = [_NULL_FOLDER if values[n] is None else str(values[n]) for n in self._folders]
        spec = ", ".join(f"{quoted(n)}='{t}'" for n, t in zip(self._folders, texts, strict=True) if t != _NULL_FOLDER)
        if _NULL_FOLDER not in texts:
            self._spark.sql(f"ALTER TABLE {named(self._rows)} DROP IF EXISTS PARTITION ({spec})")
        parts = "/".join(f"{n}={t}" for n, t in zip(self._folders, texts, strict=True))
        Storage(self._spark).remove(f"{self._path}/rows/{parts}")


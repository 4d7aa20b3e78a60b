"""A keyed target table in the catalog, on bucketed Parquet.

Three catalog entries make up a table. The base holds one row per key; a version of it is a folder, and the
entry is the pointer that moves to the next one. The changes hold the batches that were applied since, one
partition each. A view under the table's own name merges the two and is what readers ask for. Applying a
batch writes that batch, so its cost follows the batch and not the table; ``compact`` makes the next version.

Base and changes are bucketed alike by the key as text, which is never NULL and the same for equal keys. So
changes too many to broadcast are merged bucket by bucket, with no shuffle of either side.

A version counts once its settings file is there, a batch once its mark is, and both are written last. If a
writer dies before that, the table is as it was; if it dies after, whoever comes next continues from there,
for putting a change on top of itself changes nothing. A session whose catalog does not know the table
enters it again from these files. A table has one writer at a time; Spark sees to that for a stream.

Deleted keys stay in storage as rows marked deleted. That is what lets a late update be told from
a new row; readers ask for the ``hard`` view (without them) or the ``soft`` one.
"""

from __future__ import annotations

import json
import math
import re
import uuid
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.casts import safe_casts
from changeloom.functions.columns import quoted, ref
from changeloom.functions.keys import key_text
from changeloom.functions.types import TypeDrift, check_types
from changeloom.operators.changes import (
    IS_DELETED,
    effect_counts,
    estimated_bytes,
    fill_from_table,
    reduced_changes,
    row_hash,
)
from changeloom.sinks.merged_view import KEY, TIE, MergedView
from changeloom.sources.catalog import ensure_database, named
from changeloom.storage import Storage

__all__ = ["KeyedTable", "Settings", "TableMissing", "TypeDrift"]

SEQUENCE, BATCH = "_seq", "_batch"
_BUCKET_BYTES = 256 * 2**20
_GROWN = 4  # times the wanted bytes a bucket may have before the table is dealt anew
_UNKNOWN_BYTES = 2**60
_SETTINGS, _MARK = "_table.json", "_done"


class TableMissing(LookupError):
    """The table has no committed version."""


@dataclass(frozen=True)
class Settings:
    """What a version is made with."""

    keys: list[str]
    order_by: list[str]
    buckets: int
    sort_by: list[str]
    schema: dict
    deletes: str = "hard"  # what readers see if they do not choose

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    @property
    def stored(self) -> T.StructType:
        own = [(IS_DELETED, T.BooleanType()), (KEY, T.StringType()), (TIE, T.BinaryType())]
        return T.StructType([*self.columns.fields, *[T.StructField(*field) for field in own]])


class KeyedTable:
    """Handle on the table whose files are below ``path`` and whose view is ``name``, if it has one."""

    def __init__(self, spark: SparkSession, path: str, *, name: str | None = None, compression: str = "snappy"):
        self._spark, self._path, self._compression = spark, path.rstrip("/"), compression
        self._storage = Storage(spark)
        self.name = name
        # two tables may want one name, say in two lakes, but never share files
        database, _, own = (name or "keyed").rpartition(".")
        prefix = f"{own}_{zlib.crc32(self._path.encode()):08x}"
        self._database = database or spark.catalog.currentDatabase()
        self._base, self._changes, self._next = (
            f"{quoted(self._database)}.{quoted(prefix + part)}" for part in ("_base", "_changes", "_next")
        )

    @property
    def path(self) -> str:
        return self._path

    def exists(self) -> bool:
        return bool(self._versions())

    def settings(self) -> Settings:
        versions = self._versions()
        if not versions:
            raise TableMissing(self._path)
        return Settings(**json.loads(self._storage.read_text(f"{self._folder(versions[-1])}/{_SETTINGS}")))

    def version(self) -> int:
        return self._versions()[-1]

    def pending_batches(self) -> int:
        return len(self._batches())

    # Writing

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
        """Apply one batch; the first one creates the table with the given settings.

        The table has the columns of the first batch and the ``declared`` ones that it lacks, NULL at first.

        Without a number of buckets it is derived from the estimated size of the first batch.
        A batch that comes again under the same key replaces itself.
        """
        op = op if op in changes.columns else None
        if self.exists():
            # as it can stand in a folder's name
            return self._append(changes, re.sub(r"[^A-Za-z0-9._-]", lambda m: f"~{ord(m[0]):x}", batch_key), op)
        buckets = buckets or _bucket_count(estimated_bytes(changes))
        changes = _with_order_columns(changes, order_by)
        lacking = {n: F.lit(None).cast(kind) for n, kind in (declared or {}).items() if n not in changes.columns}
        changes = changes.withColumns(lacking) if lacking else changes
        sort_by = [name for name in sort_by if name in changes.columns and name not in keys]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in changes.schema.fields])
        settings = Settings([*keys], [*order_by], buckets, sort_by, schema.jsonValue(), deletes)
        rows = self._by_bucket(self._reduced(changes, op, settings), buckets, reduced=True)
        self._write_version(rows, settings)

    def _reduced(self, changes: DataFrame, op: str | None, settings: Settings) -> DataFrame:
        """One stored row per key, the last by the total order of changes."""
        shape = settings.columns.fields
        casts = safe_casts(changes, {f.name: f.dataType for f in shape if f.name in settings.keys})
        keyed = changes.withColumns(casts).withColumn(KEY, key_text(shape, settings.keys))
        batch = reduced_changes(keyed, shape, [KEY], op, settings.order_by)
        absent = [f.name for f in shape if f.name not in changes.columns]
        if absent:
            batch = fill_from_table(batch, self.read("soft"), settings.keys, absent)
        casts = safe_casts(batch, {f.name: f.dataType for f in shape})
        rows = batch.select(*casts.values(), ref(IS_DELETED), ref(KEY))
        return rows.withColumn(TIE, F.unhex(row_hash(shape)))

    def _append(self, changes: DataFrame, batch_key: str, op: str | None) -> None:
        settings = self._attached()
        changes = _with_order_columns(changes, settings.order_by)
        check_types(changes.schema, settings.columns)
        rows = self._by_bucket(self._reduced(changes, op, settings), settings.buckets, reduced=True)
        self._put_batch(rows, batch_key, [b for b in self._batches() if b[1] == batch_key])

    def compact(self, retention: str | None = None) -> bool:
        """Fold the waiting batches into a new version of the base; false if there are none.

        Base rows go from old to new files in the buckets they are in; only changes are dealt out. With a
        ``retention``, an interval such as ``30 days``, deleted keys go whose delete is older than the low-water
        mark: the newest change time in the table, or now if that is earlier, less the retention. A late
        change above the mark still finds every delete that is newer than it; one below the mark is taken
        for a new row. A deleted key for which a change waits stays until the next fold, so a writer that
        dies before the batches are dropped revives nothing.
        """
        settings, folded = self._attached(), self._batches()
        if not folded:
            return False
        view = self._view(settings)
        applied = self._by_bucket(self._spark.sql(view.applied()), settings.buckets)
        kept = self._spark.sql(view.kept(self._expired(settings, retention) if retention else None))
        self._write_version(kept.unionByName(applied), settings)
        self._drop_batches(folded)
        return True

    def low_water_mark(self, retention: str) -> str | None:
        """Deletes before this time may go, as text; nothing if the table holds no change time."""
        return self._low_water(self._attached(), retention)

    def _low_water(self, settings: Settings, retention: str) -> str | None:
        kind = settings.columns[settings.order_by[0]].dataType if settings.order_by else None
        if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return None
        time = ref(settings.order_by[0])
        now = F.localtimestamp() if isinstance(kind, T.TimestampNTZType) else F.current_timestamp()
        both = self._spark.table(self._base).select(time).unionAll(self._spark.table(self._changes).select(time))
        newest = F.least(F.max(time), now)
        return both.agg((newest - F.expr(f"INTERVAL '{retention}'")).cast("string")).first()[0]

    def _expired(self, settings: Settings, retention: str) -> str | None:
        mark = self._low_water(settings, retention)
        if mark is None:
            return None
        time = settings.columns[settings.order_by[0]]
        return f"k.{IS_DELETED} AND k.{quoted(time.name)} < CAST('{mark}' AS {time.dataType.simpleString()})"

    def merge_pending(self) -> None:
        """Put all waiting batches into one, without touching the base."""
        settings, merged = self._attached(), self._batches()
        if len(merged) > 1:
            rows = self._by_bucket(self._spark.sql(self._view(settings).latest()), settings.buckets)
            self._put_batch(rows, "merged", merged)

    def maintain(self, max_batches: int = 50, ratio: float = 0.1, retention: str | None = None) -> str:
        """Keep reads cheap: returns what was done, ``none``, ``merged``, ``compacted`` or ``rebucketed``.

        Nothing happens below ``max_batches``. Then the batches are merged, or, once they hold
        ``ratio`` of the bytes of the base, folded in. So a byte of changes causes at most about
        ``1 / ratio`` bytes of the base to be rewritten, however small the batches are. The version before
        stays for readers that are at work on it. ``retention`` is that of ``compact``.
        """
        if self.pending_batches() < max_batches:
            return "none"
        base = self._storage.bytes_under(self._folder(self.version()))
        if base > _GROWN * _BUCKET_BYTES * self.settings().buckets:
            self.rebucket()
            done = "rebucketed"
        elif self._storage.bytes_under(f"{self._path}/changes") >= ratio * base:
            self.compact(retention)
            done = "compacted"
        else:
            self.merge_pending()
            return "merged"
        self.expire(keep=2)
        return done

    def rebucket(self, buckets: int | None = None) -> int:
        """Write the table, waiting batches included, in a number of buckets that fits its size.

        Base and changes meet by a shuffle on the key here, since buckets that are too few are too big for a task.
        """
        settings, folded = self._attached(), self._batches()
        size = self._storage.bytes_under(self._folder(self.version())) + self._storage.bytes_under(f"{self._path}/changes")
        wanted = replace(settings, buckets=buckets or _bucket_count(size))
        # the base as plain files, or Spark would take it bucket by bucket
        base = f"rebucket_{uuid.uuid4().hex}"
        self._spark.read.schema(settings.stored).parquet(self._folder(self.version())).createOrReplaceTempView(base)
        changes = f"(SELECT /*+ REPARTITION({KEY}) */ * FROM {self._changes})"
        try:
            rows = self._spark.sql(replace(self._view(settings), base=base, changes=changes).stored())
            self._write_version(self._by_bucket(rows, wanted.buckets), wanted)
        finally:
            self._spark.catalog.dropTempView(base)
        self._drop_batches(folded)
        return wanted.buckets

    def expire(self, keep: int = 1) -> int:
        """Remove all but the last versions, and batches that no longer count. Returns folders removed.

        Run it when no reader still works on what it removes.
        """
        held = {self._batch_folder(b) for b in self._batches()}
        stale = [self._folder(v) for v in self._versions()[:-keep]]
        for sequence in self._storage.names(f"{self._path}/changes"):
            found = (f"{sequence}/{n}" for n in self._storage.names(f"{self._path}/changes/{sequence}"))
            stale += [f"{self._path}/changes/{n}" for n in found if n.split("/")[1].startswith(BATCH) and f"{self._path}/changes/{n}" not in held]
        for folder in stale:
            self._storage.remove(folder)
        return len(stale)

    # Reading

    def read(self, deletes: str | None = None) -> DataFrame:
        """The current rows: ``hard`` without deleted keys, ``soft`` with the delete flag.

        Without a choice it is the one the table was made with.
        """
        settings = self._attached()
        return self._spark.sql(self._view(settings).current(deletes or settings.deletes))

    def effects(
        self, changes: DataFrame, op: str | None = None, *, keys: Sequence[str] = (), order_by: Sequence[str] = ()
    ) -> DataFrame:
        """See ``effect_counts``; the table knows its keys and order itself."""
        settings = self.settings()
        changes = _with_order_columns(changes, settings.order_by)
        return effect_counts(self.read("soft"), changes, settings.keys, op, settings.order_by)

    def register(self, name: str, deletes: str | None = None) -> None:
        """Session view of the table under another name."""
        self.read(deletes).createOrReplaceTempView(name)

    # Inner workings

    def _folder(self, version: int) -> str:
        return f"{self._path}/base/v{version:012d}"

    def _versions(self) -> list[int]:
        names = self._storage.names(f"{self._path}/base")
        return [int(n[1:]) for n in names if self._storage.exists(f"{self._path}/base/{n}/{_SETTINGS}")]

    def _batch_folder(self, batch: tuple[int, str]) -> str:
        return f"{self._path}/changes/{SEQUENCE}={batch[0]}/{BATCH}={batch[1]}"

    def _batches(self) -> list[tuple[int, str]]:
        """Sequence number and key of the batches that count; there are never more than ``maintain`` allows."""
        root, out = f"{self._path}/changes", []
        for name in self._storage.names(root):
            if name.startswith(f"{SEQUENCE}="):
                inside = [n for n in self._storage.names(f"{root}/{name}") if n.startswith(f"{BATCH}=")]
                out += [(int(name.split("=")[1]), n.split("=", 1)[1]) for n in inside]
        return sorted(b for b in out if self._storage.exists(f"{self._batch_folder(b)}/{_MARK}"))

    def _view(self, settings: Settings) -> MergedView:
        return MergedView(self._base, self._changes, SEQUENCE, settings.columns.names, settings.order_by)

    def _by_bucket(self, rows: DataFrame, buckets: int, *, reduced: bool = False) -> DataFrame:
        """Rows dealt out as buckets are. The shuffle that reduced them has done so if the counts fit.

        Spark splits a bucket too big for one task, which then has several files, and puts small ones together.
        """
        partitions = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        return rows if reduced and buckets % partitions == 0 else rows.hint("rebalance", buckets, KEY)

    def _write_version(self, rows: DataFrame, settings: Settings) -> None:
        """Write the next version, then let the catalog point to it."""
        version = max(self._versions(), default=0) + 1
        folder = self._folder(version)
        self._storage.remove(folder)  # of a writer that died
        ensure_database(self._spark, self._database, self._path)
        self._spark.sql(f"DROP TABLE IF EXISTS {self._next}")
        (
            rows.write.format("parquet").bucketBy(settings.buckets, KEY).sortBy(*settings.sort_by, KEY)
            .option("path", folder).option("compression", self._compression).saveAsTable(self._next)
        )
        self._storage.put_text(f"{folder}/{_SETTINGS}", json.dumps(asdict(settings)))
        self._spark.sql(f"DROP TABLE {self._next}")
        self.publish()

    def _attached(self) -> Settings:
        """Let the catalog entries point to the last version and the batches that count."""
        settings, folder = self.settings(), self._folder(self.version())
        bucketed = f"CLUSTERED BY ({KEY}) INTO {settings.buckets} BUCKETS"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in settings.stored.fields)
        held = self._entry(self._base)
        if held is None or held != (folder, settings.buckets):
            if held is not None and held[1] == settings.buckets:
                self._spark.sql(f"ALTER TABLE {self._base} SET LOCATION '{folder}'")
            else:
                for name in (self._base, self._changes):  # external: no file goes
                    self._spark.sql(f"DROP TABLE IF EXISTS {name}")
                ensure_database(self._spark, self._database, self._path)
                self._spark.sql(f"CREATE TABLE {self._base} ({columns}) USING parquet {bucketed} LOCATION '{folder}'")
                self._spark.sql(
                    f"CREATE TABLE {self._changes} ({columns}, {SEQUENCE} BIGINT, {BATCH} STRING) USING parquet "
                    f"PARTITIONED BY ({SEQUENCE}, {BATCH}) {bucketed} LOCATION '{self._path}/changes'"
                )
        listed = {tuple(r[0].split("/")) for r in self._spark.sql(f"SHOW PARTITIONS {self._changes}").collect()}
        wanted = {(f"{SEQUENCE}={s}", f"{BATCH}={b}"): (s, b) for s, b in self._batches()}
        for part in listed - set(wanted):
            self._spark.sql(f"ALTER TABLE {self._changes} DROP IF EXISTS PARTITION {_spec(part)}")
        for part, batch in wanted.items():
            if part not in listed:
                self._spark.sql(f"ALTER TABLE {self._changes} ADD PARTITION {_spec(part)} LOCATION '{self._batch_folder(batch)}'")
        for name in (self._base, self._changes):
            self._spark.catalog.refreshTable(name)
        return settings

    def publish(self) -> None:
        """Let the table's own name, if it has one, mean this table."""
        settings = self._attached()
        if self.name:
            text = self._view(settings).current(settings.deletes)
            self._spark.sql(f"CREATE OR REPLACE VIEW {named(self.name)} AS {text}")

    def _entry(self, name: str) -> tuple[str, int] | None:
        """Folder and number of buckets of a table in the catalog."""
        if not self._spark.catalog.tableExists(name):
            return None
        told = {r.col_name: r.data_type for r in self._spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        return self._storage.plain(told["Location"]), int(told["Num Buckets"])

    def _put_batch(self, rows: DataFrame, batch_key: str, replaced: list[tuple[int, str]]) -> None:
        number = max((b[0] for b in self._batches()), default=0) + 1
        folder = self._batch_folder((number, batch_key))
        self._storage.remove(folder)  # of a writer that died
        placed = rows.withColumns({SEQUENCE: F.lit(number).cast("bigint"), BATCH: F.lit(batch_key)})
        wanted = self._spark.table(self._changes).columns
        placed.select(*map(ref, wanted)).write.option("compression", self._compression).insertInto(self._changes)
        self._storage.put_text(f"{folder}/{_MARK}", "")
        self._drop_batches(replaced)

    def _drop_batches(self, batches: list[tuple[int, str]]) -> None:
        """They count no longer; their files stay until ``expire``, for readers at work."""
        for batch in batches:
            self._storage.remove(f"{self._batch_folder(batch)}/{_MARK}")
        if batches:
            self._attached()


def _spec(part: tuple[str, str]) -> str:
    number, batch = (p.split("=", 1)[1] for p in part)
    return f"({SEQUENCE}={number}, {BATCH}='{batch}')"


def _bucket_count(size: int) -> int:
    """A power of two that makes buckets of about 256 MB; 16 if Spark does not know the size."""
    if size >= _UNKNOWN_BYTES:
        return 16
    wanted = math.ceil(size / _BUCKET_BYTES)
    return max(8, 1 << (wanted - 1).bit_length())


def _with_order_columns(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add the ordering columns a batch lacks as NULL (the oldest): a time, then sequences."""
    types = ["timestamp" if i == 0 else "bigint" for i in range(len(order_by))]
    absent = {n: F.lit(None).cast(t) for n, t in zip(order_by, types) if n not in df.columns}
    return df.withColumns(absent) if absent else df

"""Streaming loads: every micro-batch goes through the same steps as a batch load.

Delivery is at least once. A micro-batch that runs again replaces its rejects, its audit rows and
its change batch, and applying a change twice gives the same table, so the outcome is exactly once.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeloom.functions.columns import ref
from changeloom.operators.changes import row_hash
from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.loads import Counts, finish_run, load_rows, record_run
from changeloom.plans.specs import SourceSpec
from changeloom.sources.files import scan_stream
from changeloom.streaming.progress import ProgressAudit

logger = logging.getLogger(__name__)
_POOL = "spark.scheduler.pool"  # fixed value
_ARRIVED, _DIGEST = "_arrived", "_digest"
# What a stream that remembers rows is started with: no micro-batch without rows, which would only go through all that is
# remembered once more, and in memory the last state alone, not the one before too
_REMEMBERING = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
}
_AT_WORK: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)  # one writer a table


class StreamFailed(RuntimeError):
    """A streaming load ended with an error."""


@dataclass(frozen=True)
class StreamOptions:
    """How change files are picked up.

    interval: time between micro-batches. available_now: take what is there and end.
    max_files, max_bytes: size of a micro-batch; bytes win if both are set.
    redelivery: how long a row is remembered, such as ``3 days``, so that a file that lands again under another
        name counts once. None applies it again, which gives the same table.
    own_pool: run the jobs of each stream in a scheduler pool of its name. With ``spark.scheduler.mode=FAIR`` the
        streams then share the executors, and a backlog of one table doesn't hold up the others.
    progress: leave a row per micro-batch in the audit (see ``streaming.progress``).
    """

    interval: str = "5 minutes"
    available_now: bool = False
    max_files: int | None = 1
    max_bytes: int | None = None
    recursive: bool = True
    archive: bool = True
    redelivery: str | None = None
    own_pool: bool = True
    progress: bool = False


def without_redelivered(changes: DataFrame, keys: Sequence[str], window: str) -> DataFrame:
    """Rows of a stream that did not come before within the window, in whatever file.

    Rows are the same if all their columns are, so two changes of one key at one time both stay. What counts is
    when a row arrives: no row is late, however old its change time, and none is dropped for it. The
    state is spread by key over the shuffle partitions, 16 bytes and the key a row; for windows that
    do not fit in memory let ``spark.sql.streaming.stateStore.providerClass`` name the RocksDB provider.
    """
    names, held = changes.columns, [name for name in keys if name in changes.columns]
    marked = changes.withColumns(
        {_ARRIVED: F.current_timestamp(), _DIGEST: F.unhex(row_hash(changes.schema.fields))}
    )
    seen = marked.withWatermark(_ARRIVED, window).dropDuplicatesWithinWatermark([*held, _DIGEST])
    return seen.select(*map(ref, names))


def spread(df: DataFrame) -> DataFrame:
    """A micro-batch in at least as many partitions as there are cores.

    The scan of a file is one task, and without this so is every step up to the next shuffle. Rows are dealt by
    their plain columns, as Spark sorts rows that it deals in turn.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return df.repartition(cores, *map(ref, plain))


def apply_micro_batch(
    df: DataFrame,
    batch_id: int,
    source: SourceSpec,
    lake: Lake,
    options: LoadOptions = LoadOptions(),
    stream_id: str | None = None,
) -> Counts:
    """Validate, store rejects, apply, record. An error is recorded too and ends the query."""
    spark = df.sparkSession
    # the id of the query is part of the key: batch numbers start again with a new checkpoint
    stream_id = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    batch_key = f"{source.source}-{stream_id or uuid.uuid4().hex}-{batch_id}"
    started = datetime.now(timezone.utc)
    counts, error = Counts(), None
    cache = options.cache is not False
    try:
        rows = spread(df) if cache else df
        counts = load_rows(spark, rows, source, lake, batch_key, started=started, options=options, cache=cache)
        if options.compact_every and counts.written:
            table = lake.table(spark, source.target, options.layout)
            table.maintain(options.compact_every, options.compact_ratio, options.tombstone_retention)
        return counts
    except Exception as failure:
        error = failure
        raise
    finally:
        result = finish_run(source, batch_key, started, counts, error)
        record_run(spark, result, source, lake, batch_key, options)


def start_stream(
    spark: SparkSession,
    source: SourceSpec,
    lake: Lake,
    *,
    options: LoadOptions = LoadOptions(),
    stream: StreamOptions = StreamOptions(),
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Start the load of one table; it continues from its checkpoint."""
    changes = scan_stream(
        spark, source, schema=schema, recursive=stream.recursive, archive=stream.archive,
        max_files=stream.max_files, max_bytes=stream.max_bytes,
    )

    if stream.redelivery:
        changes = without_redelivered(changes, source.target.primary_key, stream.redelivery)

    def handle(df: DataFrame, batch_id: int) -> None:
        # a stop ends the stream but not the call it is in: the next start waits for that one
        with _AT_WORK[lake.table_path(source.target)]:
            apply_micro_batch(df, batch_id, source, lake, options)

    trigger = {"availableNow": True} if stream.available_now else {"processingTime": stream.interval}
    name = f"stream-{source.source}"
    with _pool(spark, name if stream.own_pool else None), _settings(spark, _REMEMBERING if stream.redelivery else {}):
        return (
            changes.writeStream.foreachBatch(handle)
            .outputMode("append")
            .trigger(**trigger)
            .queryName(name)
            .option("checkpointLocation", source.checkpoint_location)
            .start()
        )


@contextmanager
def _pool(spark: SparkSession, name: str | None) -> Iterator[None]:
    """Scheduler pool of what is started inside: a stream keeps the properties of its starter."""
    before = spark.sparkContext.getLocalProperty(_POOL)
    spark.sparkContext.setLocalProperty(_POOL, name or before)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(_POOL, before)


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session while a stream is started: it keeps them, others do not get them."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def run_streams(
    spark: SparkSession,
    sources: Sequence[SourceSpec],
    lake: Lake,
    *,
    options: LoadOptions = LoadOptions(),
    stream: StreamOptions = StreamOptions(),
    schemas: dict[str, T.StructType] | None = None,
    per_source: Mapping[str, StreamOptions] | None = None,
) -> None:
    """Run one query per table side by side until all end; the first failure stops the others.

    ``per_source`` holds the options of the sources that have their own, say a smaller ``max_bytes``; whether progress
    is recorded is up to ``stream``.
    """
    queries: list[StreamingQuery] = []
    audit = ProgressAudit(spark, lake.progress_path, lake.progress_name) if stream.progress else None
    if audit:
        spark.streams.addListener(audit)
    try:
        for source in sorted(sources, key=lambda item: item.order):
            schema, own = (schemas or {}).get(source.source), (per_source or {}).get(source.source, stream)
            queries.append(start_stream(spark, source, lake, options=options, stream=own, schema=schema))
            if audit:
                audit.watch(queries[-1])
        wait_for_all(queries, meanwhile=audit.flush if audit else None)
    finally:
        for query in queries:
            query.stop()  # also waits for a query that has just ended to clean up
        if audit:
            _recorded(audit, queries, options)
            spark.streams.removeListener(audit)


def _recorded(audit: ProgressAudit, queries: Sequence[StreamingQuery], options: LoadOptions) -> None:
    try:
        audit.finish(queries)
    except Exception as failure:
        if options.strict_audit:
            raise
        logger.warning("progress of streams was not recorded: %s", failure)


def wait_for_all(
    queries: Sequence[StreamingQuery], poll_seconds: float = 0.2, meanwhile: Callable[[], None] | None = None
) -> None:
    """Return when every query has ended; raise as soon as one has failed. ``meanwhile`` is called at every look."""
    while True:
        if meanwhile:
            meanwhile()
        for query in queries:
            failure = query.exception()
            if failure is not None:
                raise StreamFailed(f"streaming load {query.name!r} failed: {failure}")
        running = [query for query in queries if query.isActive]
        if not running:
            return
        try:
            running[0].awaitTermination(poll_seconds)
        except Exception:  # the failure is reported by the check above
            logger.debug("query %s ended with an error", running[0].name)

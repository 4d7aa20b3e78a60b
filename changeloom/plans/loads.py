"""Batch loads: one table end to end, or all tables of a plan."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from changeloom.functions.keys import OPERATION, declared_types, match_columns, prepare_for_target
from changeloom.operators.audit import RunResult, quality_metric_rows, run_log_row
from changeloom.operators.changes import EFFECT
from changeloom.operators.quality import (
    RULE,
    rejected_rows,
    rule_counts,
    tag_rules,
    valid_rows,
)
from changeloom.operators.sketches import column_sketches
from changeloom.plans.lake import Lake, LoadOptions
from changeloom.plans.specs import SourceSpec
from changeloom.sinks.audit import write_audit
from changeloom.sinks.rejects import clear_rejects, write_rejects
from changeloom.sources.files import scan_batch

logger = logging.getLogger(__name__)


class LoadFailed(RuntimeError):
    """A table could not be loaded."""


@dataclass(frozen=True)
class Counts:
    """Rows read, valid and rejected, and keys per effect if they were counted."""

    read: int = 0
    written: int = 0
    rejected: int = 0
    effects: Mapping[str, int] = field(default_factory=dict)


def load_rows(
    spark: SparkSession,
    df: DataFrame,
    source: SourceSpec,
    lake: Lake,
    batch_key: str,
    *,
    started: datetime,
    options: LoadOptions = LoadOptions(),
    cache: bool = False,
) -> Counts:
    """Validate rows, store the rejects, apply the valid rows to the target.

    Three jobs: counts (reads only the columns the rules use), rejects (if any), target (if any
    valid row); a fourth if columns are sketched. The counts come from their own job and not from accumulators, which would count
    twice when a lost executor makes Spark repeat a stage.
    """
    target = source.target
    tagged = tag_rules(df, target, source, options.quality)
    if cache:
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # one row per rule
        per_rule = {row[RULE]: row["n_rows"] for row in rule_counts(tagged).collect()}
        total, valid = sum(per_rule.values()), per_rule.get(None, 0)
        counts = Counts(total, valid, total - valid)
        if counts.rejected:
            rejects = rejected_rows(tagged, target, started)
            write_rejects(rejects, lake.rejects_path(target), batch_key, compression=target.compression)
        else:
            clear_rejects(spark, lake.rejects_path(target), batch_key)
        if counts.written:
            rows = valid_rows(tagged)
            if options.sketch_columns:
                write_audit(column_sketches(rows, target), lake.sketches_path, batch_key, lake.sketches_name)
            prepared = prepare_for_target(rows, target, source)
            table = lake.table(spark, target, options.layout)
            keys, order_by = match_columns(target, rows.columns), options.order_by([*target.schema, *rows.columns])
            if options.count_effects and table.exists():
                # one row per effect
                effects = table.effects(prepared, OPERATION, keys=keys, order_by=order_by).collect()
                counts = replace(counts, effects={r[EFFECT]: r["n_keys"] for r in effects})
            table.apply(
                prepared,
                batch_key,
                keys=keys,
                op=OPERATION,
                order_by=order_by,
                buckets=options.buckets,
                sort_by=[key.name for key in target.partition_keys],
                deletes=source.cdc.deletes if source.cdc else "hard",
                declared=declared_types(target, source),
            )
        return counts
    finally:
        if cache:
            tagged.unpersist()


def load_table(
    spark: SparkSession,
    source: SourceSpec,
    lake: Lake,
    *,
    dataframe: DataFrame | None = None,
    options: LoadOptions = LoadOptions(),
) -> RunResult:
    """Load one table from its full-load path, or from a frame that was read already.

    The run is always logged; an error is raised again as ``LoadFailed`` after that.
    """
    execution_id = str(uuid.uuid4())
    started = datetime.now(timezone.utc)
    counts, error = Counts(), None
    try:
        df = dataframe if dataframe is not None else scan_batch(spark, source)
        counts = load_rows(
            spark, df, source, lake, execution_id,
            started=started, options=options, cache=bool(options.cache),
        )
        table = lake.table(spark, source.target, options.layout)
        if options.compact_every and counts.written:
            table.maintain(options.compact_every, options.compact_ratio, options.tombstone_retention)
    except Exception as failure:
        error = failure
        raise LoadFailed(f"loading {source.source!r} failed: {failure}") from failure
    finally:
        result = finish_run(source, execution_id, started, counts, error)
        record_run(spark, result, source, lake, execution_id, options)
    return result


def load_tables(
    spark: SparkSession,
    sources: Sequence[SourceSpec],
    lake: Lake,
    *,
    options: LoadOptions = LoadOptions(),
) -> list[RunResult]:
    """Load all tables in order. With ``on_error="continue"`` failures are raised at the end."""
    results, failures = [], []
    for source in sorted(sources, key=lambda item: item.order):
        try:
            results.append(load_table(spark, source, lake, options=options))
        except LoadFailed as failure:
            if options.on_error == "stop":
                raise
            logger.error("%s", failure)
            failures.append(failure)
    if failures:
        raise LoadFailed("; ".join(map(str, failures)))
    return results


def finish_run(
    source: SourceSpec, execution_id: str, started: datetime, counts: Counts, error: Exception | None
) -> RunResult:
    return RunResult(
        execution_id=execution_id,
        source=source.source,
        status="failed" if error else "success",
        started=started,
        ended=datetime.now(timezone.utc),
        records_read=counts.read,
        records_written=counts.written,
        records_rejected=counts.rejected,
        effects=counts.effects,
        error_message=str(error) if error else "",
    )


def record_run(
    spark: SparkSession,
    result: RunResult,
    source: SourceSpec,
    lake: Lake,
    run_key: str,
    options: LoadOptions,
) -> None:
    """Write the run-log row and the metric rows of one run."""
    try:
        log = run_log_row(spark, result, source.target, options.job_name)
        write_audit(log, lake.run_log_path, run_key, lake.run_log_name)
        metrics = quality_metric_rows(spark, result, source.target)
        write_audit(metrics, lake.metrics_path, run_key, lake.metrics_name)
    except Exception as failure:
        if options.strict_audit and result.status != "failed":  # never hides the error of the run
            raise
        logger.warning("run of %s was not recorded: %s", source.source, failure)

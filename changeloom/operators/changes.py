"""Applying changes to a keyed table.

``apply_changes`` gives what an ordered MERGE gives. A change set whose keys fit a broadcast is
matched against the table, which is then scanned but never shuffled. A larger one is ranked together
with the table by one shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.casts import safe_casts
from changeloom.functions.columns import ref

IS_DELETED = "is_deleted"
EFFECT = "_effect"

_RANK = "_change_rank"
_SIDE = "_change_side"
_HELD = "_held_"
_TIE = "_change_tie"


def latest_change(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    tie_break: bool = True,
    ranking: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the last by ``order_by``, NULL counting as oldest.

    Spark keeps only the best row per key on the map side before it shuffles, so a key that owns
    a third of the changes sends one row per input partition. Rows equal in key and order are
    told apart by a hash of the row, which keeps the choice the same when a lost task runs again.
    ``ranking`` replaces order and hash, best first.
    """
    if ranking is None:
        ranking = [ref(name).desc_nulls_last() for name in order_by]
        if tie_break:
            ranking.append(row_hash(changes.schema.fields).desc())
    window = Window.partitionBy(*map(ref, keys)).orderBy(*(ranking or [F.lit(1)]))
    ranked = changes.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(ref(_RANK) == 1).drop(_RANK)


def arranged(changes: DataFrame, shape: Sequence[T.StructField], op: str | None) -> DataFrame:
    """Changes with the table's types, a delete flag and the hash that settles ties.

    The hash covers the table columns that the changes carry, with the table's types and in the
    table's order, so a row has the same hash as a change, as a waiting change and in the table.
    """
    flagged = _flag_deletes(changes, op)
    present = [field for field in shape if field.name in changes.columns]
    casts = safe_casts(flagged, {field.name: field.dataType for field in present})
    rest = [ref(name) for name in flagged.columns if name not in casts]
    rows = flagged.select(*casts.values(), *rest)
    return rows.withColumn(_TIE, row_hash(present))


def total_order(order_by: Sequence[str], later: Column | None = None) -> list[Column]:
    """Best change first: by change time and sequence, then deletes before others, then the row's hash.

    It doesn't depend on the plan or on how changes are split into batches. ``later`` (the batch) only
    counts between changes that state no time at all.
    """
    ranking = [ref(name).desc_nulls_last() for name in order_by]
    if later is not None:
        untimed = ref(order_by[0]).isNull() if order_by else F.lit(True)
        ranking.append(F.when(untimed, later).desc_nulls_last())
    return [*ranking, ref(IS_DELETED).desc(), ref(_TIE).desc()]


def reduced_changes(
    changes: DataFrame, shape: Sequence[T.StructField], keys: Sequence[str], op: str | None, order_by: Sequence[str]
) -> DataFrame:
    """One row per key in the table's types, deletes marked ``is_deleted``."""
    rows = arranged(changes, shape, op if op in changes.columns else None)
    return latest_change(rows, keys, order_by, ranking=total_order(order_by)).drop(_TIE)


def last_applied(rows: DataFrame, shape: Sequence[T.StructField], keys: Sequence[str], order_by: Sequence[str], batch: str) -> DataFrame:
    """One row per key of several reduced batches; ``batch`` numbers them."""
    ranked = latest_change(
        arranged(rows, shape, None), keys, order_by, ranking=total_order(order_by, ref(batch))
    )
    return ranked.drop(_TIE)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    counted = df.groupBy(*map(ref, keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(ref("n_rows") > 1)


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op: str | None = None,
    order_by: Sequence[str] = (),
    deletes: str = "hard",
    *,
    reduced: bool = False,
    strategy: str = "auto",
) -> DataFrame:
    """The table after the changes. ``base`` must hold one row per key.

    op: column with I, U or D; NULL counts as an insert or update; without it every row is one.
    order_by: change time, then sequence. If the base stores all of them, a change older than the
        stored row is ignored; an equal one is applied, which makes a replay harmless.
    deletes: ``hard`` drops deleted keys, ``soft`` keeps them with ``is_deleted`` true.
    reduced: the changes already hold one row per key.
    strategy: ``join`` matches the table against the changed keys; ``shuffle`` ranks table and
        changes together in one shuffle; ``auto`` joins if the changed keys fit a broadcast.
    """
    if deletes not in ("hard", "soft"):
        raise ValueError(f"deletes must be hard or soft, not {deletes!r}")
    if strategy not in ("auto", "join", "shuffle"):
        raise ValueError(f"strategy must be auto, join or shuffle, not {strategy!r}")
    op = op if op in changes.columns else None
    soft = deletes == "soft"
    if soft and IS_DELETED not in base.columns:
        base = base.withColumn(IS_DELETED, F.lit(False))

    shape = [field for field in base.schema.fields if field.name != IS_DELETED]
    absent = [field.name for field in shape if field.name not in changes.columns]
    guard = bool(order_by) and all(name in base.columns for name in order_by)

    if strategy == "auto":
        strategy = pick_strategy(changes, keys, order_by)
    if strategy == "shuffle" and not absent:
        result = _rank_together(base, changes, shape, keys, op, order_by, guard)
    else:
        kept, applied = split_by_match(base, changes, keys, op, order_by, reduced=reduced)
        result = kept.unionByName(applied, allowMissingColumns=True)

    columns = [ref(field.name) for field in shape]
    deleted = F.coalesce(ref(IS_DELETED), F.lit(False))
    if soft:
        return result.select(*columns, deleted.alias(IS_DELETED))
    return result.where(~deleted).select(*columns)


def pick_strategy(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> str:
    """``join`` if Spark's own size estimate of the changed keys is within its broadcast limit.

    Beyond it both sides of a join would be shuffled, the table more than once.
    """
    stored = [name for name in order_by if name in changes.columns]
    narrow = changes.select(*map(ref, dict.fromkeys([*keys, *stored])))
    limit = changes.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return "join" if estimated_bytes(narrow) <= limit else "shuffle"


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate of a plan, from file sizes; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def split_by_match(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op: str | None = None,
    order_by: Sequence[str] = (),
    *,
    reduced: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The two halves of an apply: table rows that stay, and change rows that take effect.

    Change rows have the table's columns and types, deletes among them marked ``is_deleted``.
    """
    op = op if op in changes.columns else None
    shape = [field for field in base.schema.fields if field.name != IS_DELETED]
    absent = [field.name for field in shape if field.name not in changes.columns]
    guard = bool(order_by) and all(name in base.columns for name in order_by)
    rows = arranged(changes, shape, op)
    latest = rows if reduced else latest_change(rows, keys, order_by, ranking=total_order(order_by))
    if guard:
        heads = latest.select(*map(ref, dict.fromkeys([*keys, *order_by])), ref(IS_DELETED), ref(_TIE))
    else:  # any change replaces the row, so which one it is does not matter here
        heads = changes.select(*map(ref, keys))
    other = _held(heads, heads.columns)
    if guard:
        tied = _tied(base, shape, changes.columns)
        stays = _stays(order_by)
        kept = tied.join(other, _matches(keys) & ~stays, "left_anti").select(*map(ref, base.columns))
        stale = tied.join(other, _matches(keys) & stays).select(*map(ref, keys))
        latest = _without(latest, stale, keys)
    else:
        kept = base.join(other, _matches(keys), "left_anti")
    if absent:
        latest = fill_from_table(latest, base, keys, absent)
    return kept, _in_shape(latest, shape)


def classify_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op: str | None = None,
    order_by: Sequence[str] = (),
    *,
    reduced: bool = False,
) -> DataFrame:
    """The latest change per key with what applying it does to the table.

    ``_effect`` is insert, update, delete, unknown_delete (a delete of a key the table lacks) or
    stale (older than the stored row).
    """
    op = op if op in changes.columns else None
    shape = [field for field in base.schema.fields if field.name != IS_DELETED]
    rows = arranged(changes, shape, op)
    latest = rows if reduced else latest_change(rows, keys, order_by, ranking=total_order(order_by))
    guard = bool(order_by) and all(name in base.columns for name in order_by)
    alive = ~F.coalesce(ref(IS_DELETED), F.lit(False)) if IS_DELETED in base.columns else F.lit(True)
    stale = _stays(order_by) if guard else F.lit(False)
    heads = latest.select(*map(ref, dict.fromkeys([*keys, *order_by])), ref(IS_DELETED), ref(_TIE))
    known = _tied(base, shape, changes.columns).withColumn("_hit_alive", alive)
    hits = known.join(_held(heads, heads.columns), _matches(keys)).select(
        *map(ref, keys), ref("_hit_alive"), stale.alias("_hit_stale")
    )
    hits = _held(hits, keys)
    known = F.coalesce(ref("_hit_alive"), F.lit(False))
    effect = (
        F.when(F.coalesce(ref("_hit_stale"), F.lit(False)), "stale")
        .when(ref(IS_DELETED) & known, "delete")
        .when(ref(IS_DELETED), "unknown_delete")
        .when(known, "update")
        .otherwise("insert")
    )
    matched = latest.join(hits, _matches(keys), "left")
    return matched.withColumn(EFFECT, effect).select(*map(ref, changes.columns), ref(EFFECT))


def effect_counts(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], op: str | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """How many keys applying the changes would insert, update, delete or leave alone."""
    return classify_changes(base, changes, keys, op, order_by).groupBy(EFFECT).agg(F.count(F.lit(1)).alias("n_keys"))


def _flag_deletes(changes: DataFrame, op: str | None) -> DataFrame:
    """Turn the operation into a delete flag; changes staged earlier carry the flag already."""
    if op is None and IS_DELETED in changes.columns:
        return changes
    deleted = F.coalesce(ref(op), F.lit("I")) == F.lit("D") if op else F.lit(False)
    return changes.withColumn(IS_DELETED, deleted)


def _tied(base: DataFrame, shape: Sequence[T.StructField], carried: Sequence[str]) -> DataFrame:
    """The table with a delete flag and the hash of the columns that the changes carry."""
    flag = F.coalesce(ref(IS_DELETED), F.lit(False)) if IS_DELETED in base.columns else F.lit(False)
    hashed = row_hash([field for field in shape if field.name in carried])
    return base.withColumns({IS_DELETED: flag, _TIE: hashed})


def _held(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: _HELD + name for name in names})


def _matches(keys: Sequence[str]) -> Column:
    """Null-safe match of the plain key columns with the renamed ones of the other side."""
    return reduce(and_, [ref(name).eqNullSafe(ref(_HELD + name)) for name in keys])


def _stays(order_by: Sequence[str]) -> Column:
    """True where the stored row comes after the change in the total order; NULL is the oldest value.

    A change equal to the stored row is applied, and so is one that states no time at all.
    """
    later, tied = F.lit(False), F.lit(True)
    for name in order_by:
        mine, other = ref(name), ref(_HELD + name)
        ahead = mine.isNotNull() & (other.isNull() | (mine > other))
        later = later | (tied & ahead)
        tied = tied & mine.eqNullSafe(other)
    tied = tied & ref(order_by[0]).isNotNull()
    for name in (IS_DELETED, _TIE):
        later = later | (tied & (ref(name) > ref(_HELD + name)))
        tied = tied & (ref(name) == ref(_HELD + name))
    return F.coalesce(later, F.lit(False))


def _without(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(_held(keyed, keys), _matches(keys), "left_anti")


def fill_from_table(
    latest: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    absent: Sequence[str],
    *,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Columns the changes do not carry keep the value the table holds for the key."""
    heads = latest if heads is None else heads
    narrow = base.select(*[ref(name) for name in dict.fromkeys([*keys, *absent])])
    stored = narrow.join(_held(heads.select(*map(ref, keys)), keys), _matches(keys))
    stored = _held(stored.select(*map(ref, narrow.columns)), keys)
    return latest.join(stored, _matches(keys), "left").drop(*[_HELD + name for name in keys])


def _in_shape(changes: DataFrame, shape: Sequence[T.StructField], also: Sequence[str] = ()) -> DataFrame:
    """The table's columns with the table's types, plus the delete flag."""
    casts = safe_casts(changes, {field.name: field.dataType for field in shape})
    return changes.select(*casts.values(), *map(ref, also), ref(IS_DELETED))


def _rank_together(
    base: DataFrame,
    changes: DataFrame,
    shape: Sequence[T.StructField],
    keys: Sequence[str],
    op: str | None,
    order_by: Sequence[str],
    guard: bool,
) -> DataFrame:
    stored = {field.name for field in shape}
    extra = [name for name in order_by if name not in stored]
    also = [*extra, _TIE]
    incoming = _in_shape(arranged(changes, shape, op), shape, also).withColumn(_SIDE, F.lit(1))
    held = _tied(base, shape, changes.columns).withColumn(_SIDE, F.lit(0))
    rows = held.unionByName(incoming, allowMissingColumns=True)
    ranking = total_order(order_by, ref(_SIDE)) if guard else [ref(_SIDE).desc(), *total_order(order_by)]
    return latest_change(rows, keys, order_by, ranking=ranking)


def row_hash(fields: Sequence[T.StructField]) -> Column:
    """MD5 of the row as text, maps included: any engine that can write the values can compute it."""
    parts = [F.coalesce(ref(f.name).cast("string"), F.lit("\\N")) for f in fields]
    return F.md5(F.concat_ws("|", *parts))

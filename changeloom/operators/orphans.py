"""Referential check kept up to date by what changed: no batch compares all children with all parents.

An orphan is a child row whose reference is not NULL and names no parent. After a batch, a child can have
become one if it is new or changed itself, or if its parent went; an orphan can have ceased to be one if it
changed itself or if its parent came. So changed children are held against the parents, the other children
only against the parents that went, and the known orphans only against those that came. The large
table of each of these joins is scanned and matched against the batch's keys, which Spark broadcasts if their
measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.functions.columns import ref

ORPHAN_OP = "orphan_op"  # I: is an orphan now, D: is none any more


def orphan_changes(
    orphans: DataFrame,
    children: DataFrame,
    changed_children: DataFrame,
    parents: DataFrame,
    parents_gone: DataFrame,
    parents_come: DataFrame,
    *,
    child_keys: Sequence[str],
    reference: str,
    parent_key: str,
) -> DataFrame:
    """Changes to the table of orphans (child keys, reference) that a batch of changes causes.

    ``children`` and ``parents`` are the tables after the batch; ``changed_children`` holds the keys of children
    that the batch inserted, updated or deleted; ``parents_gone`` and ``parents_come`` the parent keys it removed
    and added. A parent whose key changed is in both, under the old key and the new one.
    """
    own = [*child_keys, reference]
    rows = children.select(*map(ref, own)).where(ref(reference).isNotNull())
    touched = changed_children.select(*map(ref, child_keys)).distinct()
    gone, come = (p.select(ref(parent_key).alias(reference)).distinct() for p in (parents_gone, parents_come))

    fresh = _semi(rows, touched, child_keys)
    named = fresh.select(reference).distinct()
    known = _semi(parents.select(ref(parent_key).alias(reference)), named, [reference])
    now = _anti(fresh, known, [reference])
    back = _semi(parents.select(ref(parent_key).alias(reference)), gone, [reference])  # gone, but there again
    left_behind = _anti(_semi(rows, _anti(gone, back, [reference]), [reference]), touched, child_keys)
    joined = now.unionByName(left_behind).withColumn(ORPHAN_OP, F.lit("I"))

    held = orphans.select(*map(ref, own))
    settled = _semi(held, come, [reference]).unionByName(_semi(held, touched, child_keys)).distinct()
    ended = _anti(settled, joined, child_keys).withColumn(ORPHAN_OP, F.lit("D"))
    return joined.unionByName(ended)


def _semi(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    return _kept(left, right, names, "left_semi")


def _anti(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    return _kept(left, right, names, "left_anti")


def _kept(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    other = right.select(*[ref(n).alias(f"_held_{n}") for n in names])
    return left.join(other, reduce(and_, [ref(n).eqNullSafe(ref(f"_held_{n}")) for n in names]), how)

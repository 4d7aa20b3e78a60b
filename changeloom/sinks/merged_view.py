"""SQL of a keyed table: a base and the changes that wait, merged by the total order of changes.

Both sides hold the key as text and the hash that settles ties. Matching on that text alone is what lets Spark
join two tables bucketed by it as they are. A filter on the view reaches the scan of the base.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from changeloom.functions.columns import quoted
from changeloom.operators.changes import IS_DELETED

KEY, TIE = "_key", "_tie"


@dataclass(frozen=True)
class MergedView:
    """``changes`` may hold several batches, numbered by ``sequence``."""

    base: str
    changes: str
    sequence: str
    columns: Sequence[str]
    order_by: Sequence[str]

    @property
    def _all(self) -> str:
        return ", ".join([*map(quoted, self.columns), IS_DELETED, KEY, TIE])

    def latest(self) -> str:
        """One waiting change per key; the batch only counts between changes that state no time."""
        order = [f"{quoted(name)} DESC NULLS LAST" for name in self.order_by]
        untimed = f"{quoted(self.order_by[0])} IS NULL" if self.order_by else "true"
        order += [f"CASE WHEN {untimed} THEN {self.sequence} END DESC NULLS LAST", f"{IS_DELETED} DESC", f"{TIE} DESC"]
        rank = f"row_number() OVER (PARTITION BY {KEY} ORDER BY {', '.join(order)}) AS _rank"
        return f"SELECT {self._all} FROM (SELECT *, {rank} FROM {self.changes}) WHERE _rank = 1"

    def _stays(self) -> str:
        """True where the base row b comes after the change c; NULL is the oldest value."""
        if not self.order_by:
            return "false"
        terms, tied = [], []
        for name in map(quoted, self.order_by):
            ahead = f"b.{name} IS NOT NULL AND (c.{name} IS NULL OR b.{name} > c.{name})"
            terms.append(" AND ".join([*tied, ahead]))
            tied.append(f"b.{name} <=> c.{name}")
        tied.append(f"b.{quoted(self.order_by[0])} IS NOT NULL")
        for name in (IS_DELETED, TIE):
            terms.append(" AND ".join([*tied, f"b.{name} > c.{name}"]))
            tied.append(f"b.{name} = c.{name}")
        return "coalesce(" + " OR ".join(f"({term})" for term in terms) + ", false)"

    def kept(self, expired: str | None = None) -> str:
        """Base rows that no waiting change replaces, without ``expired`` ones for whose key no change waits."""
        if expired:
            waits = f"EXISTS (SELECT 1 FROM {self.changes} w WHERE w.{KEY} = k.{KEY})"
            return f"SELECT {self._all} FROM ({self.kept()}) k WHERE NOT coalesce({expired}, false) OR {waits}"
        heads = self.latest() if self.order_by else f"SELECT {KEY} FROM {self.changes}"
        return (
            f"SELECT {self._all} FROM {self.base} b LEFT ANTI JOIN ({heads}) c ON b.{KEY} = c.{KEY} AND NOT {self._stays()}"
        )

    def applied(self) -> str:
        """Waiting changes that take effect."""
        if not self.order_by:
            return self.latest()
        names = ", ".join([*map(quoted, self.order_by), IS_DELETED, KEY, TIE])
        return (
            f"SELECT {self._all} FROM ({self.latest()}) c LEFT ANTI JOIN (SELECT {names} FROM {self.base}) b "
            f"ON b.{KEY} = c.{KEY} AND {self._stays()}"
        )

    def stored(self) -> str:
        return f"{self.kept()} UNION ALL {self.applied()}"

    def current(self, deletes: str) -> str:
        """What readers see: ``hard`` without deleted keys, ``soft`` with the delete flag."""
        if deletes not in ("hard", "soft"):
            raise ValueError(f"deletes must be hard or soft, not {deletes!r}")
        columns = ", ".join(map(quoted, self.columns))
        if deletes == "soft":
            return f"SELECT {columns}, {IS_DELETED} FROM ({self.stored()})"
        return f"SELECT {columns} FROM ({self.stored()}) WHERE NOT {IS_DELETED}"

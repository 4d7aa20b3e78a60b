"""Packing: bounded-space online best-fit of whole documents into sequences of ``capacity`` tokens.

Every task takes its documents as they come. A document longer than a sequence is cut into full pieces
and a rest; each piece goes into the open sequence with the least free space that still holds it. The
free spaces that occur are the set bits of one integer, so that sequence is the lowest set bit at or above
the piece's length. At most ``open_bins`` sequences are open; if one more is needed, the fullest closes.

Sequences that are open when a task ends are packed once more, by the same rule and as if each were one
piece, in groups of about ``together`` that do not grow with the table. So the waste does not depend on how
many tasks there were.

Memory is bounded by the open sequences, the tokeniser's table of words and the longest document.

Defined results: a null or empty text is a document of the end id alone; repeated rows are packed each; rows
without an id are packed like others; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import bounded, documents, narrow, raw, staged
from changeloom.llm.packing import word_codes

NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
MERGED = 1 << 62  # marks sequences of the second pass


@dataclass(frozen=True)
class BestFit:
    capacity: int = 4096
    end_id: int = 1
    open_bins: int = 64
    together: int = 512  # sequences left open by tasks that are packed again in one group
    most_words: int = 1_000_000


class Bins:
    """Open bins by free space; ``place`` tells where a piece goes and which bins that closes."""

    def __init__(self, capacity: int, most: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.free_bits, self.n_open = 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        number = held.pop(0)
        if not held:
            del self.by_free[free]
            self.free_bits ^= 1 << free
        self.n_open -= 1
        return number

    def place(self, size: int) -> tuple[int, int, list[int]]:
        """Bin, place in it, and the bins that are closed now."""
        closed = []
        if fitting := self.free_bits >> size:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open == self.most:
                closed.append(self._take((self.free_bits & -self.free_bits).bit_length() - 1))
            number, free = self.next, self.capacity
            self.next += 1
        if left := free - size:
            self.by_free.setdefault(left, []).append(number)
            self.free_bits |= 1 << left
            self.n_open += 1
        else:
            closed.append(number)
        return number, self.capacity - free, closed


def fitted(rows: Iterator[tuple[int | None, np.ndarray]], fit: BestFit, first: int) -> Iterator[tuple]:
    """Pieces of documents (id, ids): doc_id, piece, start, ids, sequence, offset, and whether that is still open."""
    bins, held = Bins(fit.capacity, fit.open_bins, first), {}
    for doc_id, ids in rows:
        for piece, start in enumerate(range(0, len(ids), fit.capacity)):
            own = ids[start : start + fit.capacity]
            number, offset, closed = bins.place(len(own))
            held.setdefault(number, []).append((doc_id, piece, start, own, number, offset))
            for done in closed:
                yield from ((*row, False) for row in held.pop(done))
    for left in held.values():
        yield from ((*row, True) for row in left)


def refitted(table: pa.Table, group: int, fit: BestFit) -> pa.Table:
    """The same rows with the sequences they lie in packed into fewer."""
    sequence, length = table.column("sequence_id").to_numpy(), table.column("length").to_numpy()
    old, at = np.unique(sequence, return_inverse=True)
    used = np.bincount(at, weights=length).astype(np.int64)
    bins = Bins(fit.capacity, fit.open_bins, MERGED | group << 32)
    placed = np.array([bins.place(int(n))[:2] for n in used], np.int64).reshape(-1, 2)
    offset = table.column("offset").to_numpy() + placed[at, 1]
    for name, values in (("sequence_id", placed[at, 0]), ("offset", offset)):
        table = table.set_column(table.column_names.index(name), name, pa.array(values, pa.int64()))
    return table


def best_fit(docs: DataFrame, tokenizer_file: str, fit: BestFit = BestFit(), with_ids: bool = True) -> DataFrame:
    """One row per piece; ``ids`` are its tokens. A sequence is all pieces with its ``sequence_id``."""
    names = [*NAMES, *["ids"] * with_ids, "left_open"]
    types = [*TYPES, *[pa.list_(pa.int32())] * with_ids, pa.bool_()]

    def run(batches):
        codes = word_codes(tokenizer_file, fit.most_words)

        def coded():
            for batch in bounded(batches):
                texts = codes.encode(raw(batch.column("text")))
                for doc_id, (ids, _) in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                    yield doc_id, np.append(ids, np.uint32(fit.end_id))

        def batch(rows):
            ids = [r[3] for r in rows]
            columns = [[r[i] for r in rows] for i in (0, 1, 2)]
            columns += [list(map(len, ids)), [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]]
            columns += [[r[4] for r in rows], [r[5] for r in rows]]
            columns += [[x.astype(np.int32) for x in ids]] * with_ids + [[r[6] for r in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        rows, size = [], 0
        for row in fitted(coded(), fit, TaskContext.get().partitionId() << 40):
            rows.append(row)
            size += len(row[3]) + 8
            if size > 1 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    ids = ", ids array<int>" * with_ids
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
        f"offset long{ids}, left_open boolean"
    )
    placed = staged(narrow(docs).mapInArrow(run, schema), "best-fit")
    left = placed.where("left_open")
    groups = max(1, -(-left.select("sequence_id").distinct().count() // fit.together))

    def again(key, table):
        return refitted(table.drop_columns(["fit_group"]), key[0].as_py(), fit)

    dealt = left.withColumn("fit_group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    merged = dealt.groupBy("fit_group").applyInArrow(again, placed.schema)
    return placed.where("NOT left_open").unionByName(merged).drop("left_open")


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)

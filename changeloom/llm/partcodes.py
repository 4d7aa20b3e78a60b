"""Compressing vectors: one code of 256 per part, found through memoised grid cells.

A vector is cut into equal parts; each part position has a codebook, refined by rounds of assignment
and averaging. To assign a part, the grid cell it lies in is looked up. The first time a cell is seen, the
smallest and largest distance of every codebook entry to the cell's box are worked out; an entry whose
smallest distance exceeds another's largest is dominated all over the box, and the cell remembers the others.
Only those are evaluated exactly, so equal and near parts share that work. The memory is emptied when it is
full, which costs time and changes nothing.

Vectors are integers and all arithmetic is exact, so results don't depend on how rows are dealt. Codebooks
are as large as their parameters; a task sends its sums per entry, not its rows.

Defined results: a row whose vector is null or holds a null or non-finite number is dropped, and so is
one whose length is not that of the row with the smallest id whose length is a positive multiple of the
number of parts; a row without an id is coded but no codebook starts from it; an id that several rows hold
starts one entry, from the smallest of their vectors; rows without a label are one group; fewer than 256 ids
give smaller codebooks; without any id there are no codebooks and no rows; an empty table gives an empty
table; other columns are ignored. A component beyond ``LARGEST`` after scaling raises, for sums of squares
would not be exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import staged

LARGEST = 1 << 24
PAIRS = 1 << 21  # numbers compared at once


@dataclass(frozen=True)
class PartCodes:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    width: int = 64  # of a grid cell
    most_cells: int = 1 << 15  # remembered per part position


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components as integers, rounded down after scaling; null if one is null or not finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    scaled = F.transform(vector, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return F.when(finite, scaled)


def largest_component(rows: DataFrame, vector: str) -> int:
    found = rows.agg(F.max(F.array_max(F.transform(vector, F.abs)))).first()[0] or 0
    if found > LARGEST:
        raise ValueError(f"a component is {found} after scaling; beyond {LARGEST} distances are not exact")
    return found


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


class GridCells:
    """Nearest entries of one codebook for many points, by way of the cells they lie in."""

    def __init__(self, entries: np.ndarray, width: int, most: int):
        self.entries, self.width, self.most = entries, width, most
        self.kept: dict[bytes, np.ndarray] = {}

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, which entries are nearest to some point of its box, ties included."""
        out = np.zeros((len(cells), len(self.entries)), bool)
        step = max(1, PAIRS // self.entries.size)
        for a in range(0, len(cells), step):
            middle = 2 * cells[a : a + step] * self.width + self.width - 1  # twice the middle of the box
            gap = np.abs(2 * self.entries[None] - middle[:, None])
            inner = np.maximum(gap - (self.width - 1), 0)
            gap += self.width - 1
            nearest, farthest = np.einsum("ced,ced->ce", inner, inner), np.einsum("ced,ced->ce", gap, gap)
            out[a : a + step] = nearest <= farthest.min(1, keepdims=True)
        return out

    def candidates(self, cells: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For each different cell its entries, and which of these cells each point lies in."""
        keys = np.ascontiguousarray(cells).view(f"V{cells.shape[1] * 8}").ravel()
        _, first, at = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        if new := [i for i, name in enumerate(names) if name not in self.kept]:
            if len(self.kept) + len(new) > self.most:
                self.kept = {}
                new = list(range(len(names)))
            for i, mask in zip(new, self.undominated(cells[first[new]]), strict=True):
                self.kept[names[i]] = np.flatnonzero(mask).astype(np.int32)
        return [self.kept[name] for name in names], at

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point; of entries as near as each other the first."""
        lists, at = self.candidates(points // self.width)
        sizes = np.array([len(x) for x in lists], np.int64)
        flat, begins = np.concatenate(lists), np.cumsum(sizes) - sizes
        best, distance = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        ends = np.cumsum(sizes[at])
        most, a = max(1, PAIRS // points.shape[1]), 0
        while a < len(points):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + most, side="right")))
            n = sizes[at[a:b]]
            starts = np.cumsum(n) - n
            row = np.repeat(np.arange(b - a), n)
            entry = flat[np.repeat(begins[at[a:b]] - starts, n) + np.arange(len(row))]
            apart = points[a:b][row] - self.entries[entry]
            squares = np.einsum("ij,ij->i", apart, apart)
            least = np.minimum.reduceat(squares, starts)
            hits = np.flatnonzero(squares == least[row])
            _, first = np.unique(row[hits], return_index=True)
            best[a:b], distance[a:b] = entry[hits[first]], least
            a = b
        return best, distance


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray, how: PartCodes):
    """Per batch: its rows as a matrix, entries [row, part] and squared distances [row, part]."""
    grids = [GridCells(book, how.width, how.most_cells) for book in books]
    size = books.shape[2]
    for batch in batches:
        if not batch.num_rows:
            continue
        points = matrix(batch.column("v"), size * how.parts)
        found = [g.nearest(points[:, p * size : (p + 1) * size]) for p, g in enumerate(grids)]
        yield batch, points, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def refined(rows: DataFrame, books: np.ndarray, how: PartCodes) -> np.ndarray:
    """Codebooks [part, entry, position] after one round: entries move to the floor of their parts' mean."""
    parts, entries, size = books.shape

    def sums(batches):
        total, count = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for _, points, found, _ in _assigned(batches, books, how):
            at = (found + np.arange(parts) * entries).ravel()
            np.add.at(total, at, points.reshape(-1, size))
            count += np.bincount(at, minlength=len(count))
        used = np.flatnonzero(count)
        columns = [pa.array(used), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n", "total"])

    found = rows.select("v").mapInArrow(sums, "slot long, n long, total array<long>")
    added = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(size)]
    out = books.reshape(-1, size).copy()
    # one row per codebook entry, whatever the table
    for row in found.groupBy("slot").agg(F.sum("n").alias("n"), F.array(*added).alias("total")).collect():
        out[row.slot] = [t // row.n for t in row.total]
    return out.reshape(books.shape)


def first_books(rows: DataFrame, how: PartCodes) -> np.ndarray:
    """The parts of the vectors with the smallest ids."""
    ids = rows.select("vec_id").where("vec_id IS NOT NULL").distinct().orderBy("vec_id").limit(how.entries)
    wanted = [r[0] for r in ids.collect()]  # as many as a codebook has entries
    if not wanted:
        return np.zeros((how.parts, 0, 0), np.int64)
    found = rows.where(F.col("vec_id") <= wanted[-1]).groupBy("vec_id").agg(F.min("v").alias("v"))
    vectors = np.array([r.v for r in sorted(found.collect())], np.int64)
    return np.ascontiguousarray(vectors.reshape(len(vectors), how.parts, -1).transpose(1, 0, 2))


def prepared(vectors: DataFrame, how: PartCodes = PartCodes()) -> DataFrame:
    """vec_id, label and ``v``, the vector in integers, of the rows that are kept."""
    scaled = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", whole_numbers(F.col("embedding"), how.scale).alias("v")
    ).where("v IS NOT NULL")
    rows = staged(scaled, "part-codes")
    usable = rows.where((F.size("v") > 0) & (F.size("v") % how.parts == 0) & F.col("vec_id").isNotNull())
    one = usable.orderBy("vec_id", "v").select(F.size("v").alias("n")).first()
    return rows.where(F.size("v") == (one.n if one else -1))


def trained(rows: DataFrame, how: PartCodes = PartCodes()) -> np.ndarray:
    largest_component(rows, "v")
    books = first_books(rows, how)
    for _ in range(how.rounds if books.shape[1] else 0):
        books = refined(rows, books, how)
    return books


def coded(rows: DataFrame, books: np.ndarray, how: PartCodes = PartCodes()) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error, the squared distance to what the code stands for."""
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches):
        for batch, _, found, distances in _assigned(batches, books, how):
            text = found.astype(np.uint8).tobytes().hex()
            n = 2 * how.parts
            codes = pa.array([text[i : i + n] for i in range(0, len(text), n)], pa.string())
            columns = [batch.column("vec_id"), batch.column("label"), codes, pa.array(distances.sum(1))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    if not books.shape[1]:
        rows = rows.where(F.lit(False))
    return rows.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def op11_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    books = trained(rows)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = staged(coded(rows, books), "codes")
    # one row per label; whether it is small enough to be sent to all tasks is Spark's to measure
    sums = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    both = codes.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _near(source: str, book: str) -> str:
    """Per part the nearest entry: an exact distance in doubles, then the entry to settle ties."""
    apart = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"
    return f"""SELECT r, part, any_value(x) AS x, min(d) AS d, arg_min(entry, d * 256 + entry) AS entry
  FROM (SELECT r, p.part, x, entry, {apart} AS d FROM {source} p JOIN {book} b ON p.part = b.part) t GROUP BY r, part"""


def _moved(near: str, book: str) -> str:
    """The codebook after a round."""
    return f"""SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
    SELECT part, entry, list(s ORDER BY i) AS c FROM (
      SELECT part, entry, i, floor(sum(x[i]) / count(*)) AS s
      FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM {near}) u GROUP BY part, entry, i) g
    GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry"""


_ROUNDS = ",\n".join(
    f"near{k} AS MATERIALIZED ({_near('parts', f'book{k}')}),\nbook{k + 1} AS MATERIALIZED ({_moved(f'near{k}', f'book{k}')})"
    for k in range(4)
)
#: the same by brute force
OP11_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda e: floor(1024 * CAST(e AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
parts AS MATERIALIZED (
  SELECT r, part, v[CAST(part * len(v) / 4 AS BIGINT) + 1 : CAST((part + 1) * len(v) / 4 AS BIGINT)] AS x
  FROM kept, (SELECT unnest(range(4)) AS part) p),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM parts WHERE r <= 256),
{_ROUNDS},
last AS MATERIALIZED ({_near('parts', 'book4')}),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(n AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(c) AS n, unnest(range(len(c))) AS i FROM book4) t),
codes AS (
  SELECT r, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM last GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (r), digest
"""

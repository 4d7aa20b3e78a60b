"""Centroid clustering with zone maps along a space-filling curve.

Vectors are put in the order of a Hilbert curve and cut into blocks, each stored with the box of its smallest
and largest components. A centroid whose smallest distance to a block's box exceeds another's largest
distance can be nearest to no vector of the block; the others are compared exactly, in one matrix product.
Boxes don't change from round to round, so the order and the blocks are made once.

Equal vectors, however many, are parted by a hash of their ids before they are dealt into ranges of the
curve, so a common vector fills many blocks and not one task. Vectors are integers and all arithmetic is
exact: neither blocks nor bounds can change a result. What reaches the driver are sums per centroid.

Defined results: a row whose vector is null, has another length than asked for, or holds a null or non-finite
number is dropped; a row without an id is clustered but no centroid starts from it; repeated rows count each, and
rows with one id are ordered by their vectors where centroids start; fewer rows than centroids give fewer
centroids; an empty table gives an empty table; other columns are ignored. A component beyond ``LARGEST``
after scaling raises, for sums of squares would not be exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import staged
from changeloom.llm.partcodes import largest_component, matrix, whole_numbers


@dataclass(frozen=True)
class Clusters:
    centroids: int = 16
    rounds: int = 3
    scale: int = 64
    length: int = 64
    seed: str = "1"
    block: int = 256  # vectors
    bits: int = 4  # of each component on the curve


def curve_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve, as rows of bytes that sort like them.

    ``points`` are whole numbers of ``bits`` bits. Each level of the curve is the one above it, mirrored and
    turned; undoing that from the top bit down and then taking the Gray code leaves the place's bits.
    """
    x = points.T.astype(np.int64).copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            upper = (x[i] >> level & 1).astype(bool)
            swapped = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swapped)
            x[i] ^= swapped
    x = np.bitwise_xor.accumulate(x, axis=0)
    turned = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turned
    planes = x[None] >> np.arange(bits - 1, -1, -1)[:, None, None] & 1
    return np.packbits(planes.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)


def along_curve(rows: DataFrame, how: Clusters) -> DataFrame:
    """Rows (vec_id, v) in blocks: ids, vectors, and the box around them. All but the last of a task are full."""
    low, high = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    shift = max(0, ((high or 0) - (low or 0)).bit_length() - how.bits)

    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                keys = curve_keys((matrix(batch.column("v"), how.length) - low) >> shift, how.bits)
                width = keys.shape[1]
                column = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(width), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys))]
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, column.cast(pa.binary())], ["vec_id", "v", "place"])

    def cut(batches):
        ids, vectors, n = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, how.block - n)
                ids += part.column("vec_id").to_pylist()
                vectors.append(matrix(part.column("v"), how.length))
                n, at = n + part.num_rows, at + part.num_rows
                if n == how.block:
                    yield block(ids, np.concatenate(vectors))
                    ids, vectors, n = [], [], 0
        if n:
            yield block(ids, np.concatenate(vectors))

    def block(ids, points):
        columns = [
            pa.array([ids], pa.list_(pa.int64())), pa.array([points.ravel()], pa.list_(pa.int64())),
            *(pa.array([edge], pa.list_(pa.int64())) for edge in (points.min(0), points.max(0))),
        ]
        return pa.RecordBatch.from_arrays(columns, ["ids", "points", "low", "high"])

    placed = rows.select("vec_id", "v").mapInArrow(keyed, "vec_id long, v array<long>, place binary")
    parted = placed.withColumn("salt", F.xxhash64("vec_id", F.monotonically_increasing_id()))
    dealt = parted.repartitionByRange("place", "salt").sortWithinPartitions("place", "salt")
    return dealt.select("vec_id", "v").mapInArrow(
        cut, "ids array<long>, points array<long>, low array<long>, high array<long>"
    )


def possible(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that some point of the box may be nearest to, ties included."""
    below, above = low - centroids, centroids - high
    inner = np.maximum(np.maximum(below, above), 0)
    outer = np.maximum(high - centroids, centroids - low)
    nearest, farthest = (inner * inner).sum(1), (outer * outer).sum(1)
    return np.flatnonzero(nearest <= farthest.min())


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """Per block: ids, vectors, nearest centroid (of equally near ones the first) and squared distance."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids, points, low, high = (batch.column(c)[row].values for c in range(4))
            points = points.to_numpy().reshape(-1, centroids.shape[1])
            wanted = possible(low.to_numpy(), high.to_numpy(), centroids)
            chosen = centroids[wanted].astype(np.float64)
            own = points.astype(np.float64)  # whole numbers below 2**53 throughout
            squares = (own * own).sum(1)[:, None] - 2 * own @ chosen.T + (chosen * chosen).sum(1)
            best = squares.argmin(1)
            yield ids, points, wanted[best], squares[np.arange(len(best)), best].astype(np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round, each at the floor of the mean of its vectors."""
    k, length = centroids.shape

    def sums(batches):
        total, count = np.zeros((k, length), np.int64), np.zeros(k, np.int64)
        for _, points, cluster, _ in _assigned(batches, centroids):
            np.add.at(total, cluster, points)
            count += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(count)
        columns = [pa.array(used), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    found = blocks.mapInArrow(sums, "cluster long, n long, total array<long>")
    added = F.array(*[F.sum(F.col("total")[i]) for i in range(length)]).alias("total")
    out = centroids.copy()
    # one row per centroid, whatever the table
    for row in found.groupBy("cluster").agg(F.sum("n").alias("n"), added).collect():
        out[row.cluster] = [t // row.n for t in row.total]
    return out


def first_centroids(rows: DataFrame, how: Clusters) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    named = rows.where("vec_id IS NOT NULL")
    hashed = named.select(F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "v")
    found = hashed.orderBy("h", "v").limit(how.centroids).collect()  # as many as centroids
    return np.array([r.v for r in found], np.int64).reshape(-1, how.length)


def clustered(vectors: DataFrame, how: Clusters = Clusters()) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and squared distance of every kept row of (vec_id, embedding), and the final centroids."""
    scaled = whole_numbers(F.col("embedding"), how.scale)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")).where(F.size("v") == how.length)
    rows = staged(kept, "vectors")
    largest_component(rows, "v")
    centroids = first_centroids(rows, how)
    blocks = staged(along_curve(rows, how), "curve-blocks")
    for _ in range(how.rounds if len(centroids) else 0):
        centroids = moved(blocks, centroids)

    def assign(batches):
        for ids, _, cluster, distance in _assigned(batches, centroids):
            columns = [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    if not len(centroids):
        blocks = blocks.where(F.lit(False))
    return blocks.mapInArrow(assign, "vec_id long, cluster int, distance long"), centroids


def op12_curve_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = staged(found, "clusters")
    totals = rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # one row per centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = sum(r.inertia for r in totals)
    summary = [(r.cluster, r.inertia, whole, digests[r.cluster]) for r in totals]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # at most one row per centroid, a parameter
    return rows.join(F.broadcast(spark.createDataFrame(summary, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _near(book: str) -> str:
    """The nearest centroid of every vector: an exact distance in doubles, then the number to settle ties."""
    apart = "list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c)"
    return f"""SELECT r, any_value(v) AS v, min(d) AS d, arg_min(k, d * 16 + k) AS k
  FROM (SELECT r, v, k, {apart} AS d FROM kept, {book}) t GROUP BY r"""


def _moved(near: str, book: str) -> str:
    return f"""SELECT b.k, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
    SELECT k, list(s ORDER BY i) AS c FROM (
      SELECT k, i, floor(sum(v[i]) / count(*)) AS s FROM (SELECT *, unnest(range(1, 65)) AS i FROM {near}) u GROUP BY k, i) g
    GROUP BY k) m ON m.k = b.k"""


_ROUNDS = ",\n".join(
    f"near{k} AS MATERIALIZED ({_near(f'book{k}')}),\nbook{k + 1} AS MATERIALIZED ({_moved(f'near{k}', f'book{k}')})" for k in range(3)
)
#: the same by brute force
OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
         list_transform(embedding, lambda e: floor(64 * CAST(e AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
book0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v AS c FROM kept
  WHERE vec_id IS NOT NULL QUALIFY k < 16),
{_ROUNDS},
last AS MATERIALIZED ({_near('book3')}),
digests AS (
  SELECT k, sha256(string_agg(CAST(CAST(n AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM (SELECT k, unnest(c) AS n, unnest(range(64)) AS i FROM book3) t GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM last JOIN kept USING (r) JOIN digests USING (k)
"""

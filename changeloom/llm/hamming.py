"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments, and each segment value has a list of the codes that hold it. A query
looks up its own segment values first, then all values at one bit's distance, then at two, and so on.
Once every segment has been searched to radius r, any code not seen differs by more than r bits in
each of the m segments, so by m * (r + 1) bits or more in all. The search stops when the k-th verified
distance is below that, so nothing nearer can have been missed.

Equal codes are one entry that holds its k smallest ids, all that a result can use of it, so neither
a common vector nor a query held by many rows adds work. Entries and queries are dealt into blocks;
each pair of blocks is searched apart and the k best of all blocks are merged. A block is bounded
whatever the data: the queries are a stated set held against all rows.

Ties go to the smaller id. Defined results: a row without an id or a vector, or with a vector of no
number, has no code and is neither found nor a query; a value that is null or not a number counts as
not positive; repeated rows are found once; fewer than k rows give all of them; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import staged

BITS = 64


@dataclass(frozen=True)
class Search:
    k: int = 10
    segments: int = 4  # of 16 bits
    code_block: int = 1 << 15
    query_block: int = 1 << 10


def sign_code(vector: Column) -> Column:
    """Bit i is set if number i is positive; vectors may have up to 64 numbers."""
    bits = F.transform(vector, lambda v, i: F.when((v > 0) & ~F.isnan(v), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(0))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) > 0, code)


@lru_cache(maxsize=64)
def masks(width: int, radius: int) -> np.ndarray:
    """All segment differences of exactly ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


class Index:
    """The codes of a block by segment value: offsets into lists of code numbers."""

    def __init__(self, codes: np.ndarray, segments: int):
        self.codes, self.width = codes, BITS // segments
        self.lists = []
        for s in range(segments):
            value = self.segment(codes, s)
            order = np.argsort(value, kind="stable")
            values, start = np.unique(value[order], return_index=True)
            begin, size = np.zeros(1 << self.width, np.int64), np.zeros(1 << self.width, np.int64)
            begin[values], size[values] = start, np.diff(start, append=len(order))
            self.lists.append((order, values, begin, size))

    def segment(self, codes: np.ndarray, s: int) -> np.ndarray:
        return ((codes >> np.uint64(s * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def at_radius(self, s: int, value: int, radius: int) -> np.ndarray:
        """Numbers of the codes whose segment ``s`` differs from ``value`` by exactly ``radius`` bits."""
        order, values, begin, size = self.lists[s]
        if (flips := masks(self.width, radius)).size <= len(values):
            wanted = value ^ flips
        else:  # fewer values are held than could be asked for
            wanted = values[np.bitwise_count(values ^ value) == radius]
        n = size[wanted]
        wanted, n = wanted[n > 0], n[n > 0]
        ends = np.cumsum(n)
        return order[np.repeat(begin[wanted] - ends + n, n) + np.arange(ends[-1] if len(n) else 0)]

    def nearest(self, query: np.uint64, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of all codes that the k nearest ids can belong to."""
        seen = np.zeros(len(self.codes), bool)
        numbers, distances = np.zeros(0, np.int64), np.zeros(0, np.int64)
        values = [int(self.segment(np.array([query]), s)[0]) for s in range(len(self.lists))]
        for radius in range(self.width + 1):
            for s, value in enumerate(values):
                new = self.at_radius(s, value, radius)
                new = new[~seen[new]]
                seen[new] = True
                numbers = np.append(numbers, new)
                distances = np.append(distances, np.bitwise_count(self.codes[new] ^ query).astype(np.int64))
                # segments up to s are searched to this radius, the later ones to the one before
                covered = len(values) * radius + s
                inside = distances <= covered
                if counts[numbers[inside]].sum() >= k or seen.all():
                    keep = inside if counts[numbers[inside]].sum() >= k else np.ones(len(numbers), bool)
                    return numbers[keep], distances[keep]
        return numbers, distances


def _cells(codes: DataFrame, queries: DataFrame, n_codes: int, n_queries: int, how: Search) -> tuple[DataFrame, DataFrame]:
    """Entries and queries, each sent to all block pairs it belongs to."""
    rows, columns = -(-n_codes // how.code_block) or 1, -(-n_queries // how.query_block) or 1
    dealt = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.withColumn("row", dealt(rows)).withColumn("column", every(columns))
    right = queries.withColumn("column", dealt(columns)).withColumn("row", every(rows))
    return left, right


def nearest_codes(codes: DataFrame, queries: DataFrame, n_codes: int, n_queries: int, how: Search) -> DataFrame:
    """query code, neighbour id and distance: of each block, the k best of each query code."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            codes_ = left.column("code").to_numpy().view(np.uint64)
            lists = left.column("ids").combine_chunks()
            ids, start = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            start = start - start[0]
            index, counts = Index(codes_, how.segments), np.diff(start)
            for query in right.column("code").to_numpy().view(np.uint64):
                at, distance = index.nearest(query, counts, how.k)
                found = np.concatenate([ids[start[i] : start[i + 1]] for i in at]) if len(at) else ids[:0]
                far = np.repeat(distance, counts[at])
                best = np.lexsort((found, far))[: how.k]
                out.append((np.full(len(best), query).view(np.int64), found[best], far[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["code", "neighbor_id", "distance"])

    left, right = _cells(codes, queries, n_codes, n_queries, how)
    grouped = left.groupBy("row", "column").cogroup(right.groupBy("row", "column"))
    return grouped.applyInArrow(search, "code long, neighbor_id long, distance long")


def top_k(rows: DataFrame, is_query: Column, how: Search = Search()) -> DataFrame:
    """query_id, neighbor_id, distance, rank for all rows (id, code) for which ``is_query`` holds.

    A query's own row is a neighbour like any other.
    """
    held = rows.where("id IS NOT NULL AND code IS NOT NULL").distinct()
    order = W.partitionBy("code").orderBy("id")
    first = held.withColumn("n", F.row_number().over(order)).where(F.col("n") <= how.k)
    codes = staged(first.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = staged(held.where(is_query), "queries")
    wanted = staged(asked.select("code").distinct(), "query-codes")
    found = nearest_codes(codes, wanted, codes.count(), wanted.count(), how)
    rank = F.row_number().over(W.partitionBy("code").orderBy("distance", "neighbor_id"))
    best = found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= how.k)
    return asked.select(F.col("id").alias("query_id"), "code").join(best, "code").select(
        "query_id", "neighbor_id", "distance", "rank"
    )


def op3_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return top_k(rows, F.col("id") % 20 == 0)


#: the same by brute force
OP3_SQL = """
WITH numbers AS (
  SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings) WHERE vec_id IS NOT NULL),
codes AS (
  SELECT vec_id, bit_or(CASE WHEN v > 0 AND NOT isnan(v) THEN 1::UBIGINT << (i - 1) ELSE 0::UBIGINT END) AS code
  FROM numbers GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, bit_count(xor(q.code, c.code))::BIGINT AS distance
  FROM codes q, codes c WHERE q.vec_id % 20 = 0)
SELECT query_id, neighbor_id, distance,
       row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
FROM pairs
QUALIFY rank <= 10
"""

"""Codes of parts and centroid clusters against plain loops."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm import hilbert, partcodes
from changeloom.llm.queries import QUERIES, importable

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
])
CLASHING = ["v", "code", "error", "cluster", "distance", "place", "salt", "ids", "points", "slot"]


def vectors(n=330, length=64):
    """Clustered vectors in many copies, and rows that are dropped."""
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 0.3, (20, length))
    rows = [
        (int(i), (middles[i % 20] + rng.normal(0, 0.05, length)).astype(np.float32).tolist(), None if i % 7 == 0 else int(i % 4))
        for i in rng.permutation(n)
    ]
    common = middles[3].astype(np.float32).tolist()
    rows += [(1000 + i, common, 2) for i in range(150)]
    rows += [rows[0], rows[0], (rows[1][0], [-x for x in rows[1][1]], 1), (None, common, 2), (None, rows[5][1], None)]
    bad = [None, [], [1.0] * 7, [math.nan] + [0.0] * (length - 1), [math.inf] * length, [None] * length, [0.5] * (length - 4)]
    return rows + [(5000 + i, v, 1) for i, v in enumerate(bad)]


def frame(spark, rows, crowded=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if crowded else df


def stored(df, folder):
    df.write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def whole(v, scale):
    usable = v is not None and all(x is not None and math.isfinite(x) for x in v)
    return [math.floor(scale * x) for x in v] if usable else None


def squares(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, w, label) for i, v, label in rows if (w := whole(v, 1024)) is not None and len(w) == 64]
    first = {}
    for i, w, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, w), w)
    size = 64 // parts
    cut = lambda w, p: w[p * size : (p + 1) * size]
    books = [[list(cut(first[i], p)) for i in sorted(first)[:entries]] for p in range(parts)]

    def nearest(w, p):
        return min((squares(cut(w, p), c), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        members = [{} for _ in range(parts)]
        for p in range(parts):
            for _, w, _ in kept:
                members[p].setdefault(nearest(w, p)[1], []).append(cut(w, p))
        for p in range(parts):
            for k, held in members[p].items():
                books[p][k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, sums = [], {}
    for i, w, label in kept:
        found = [nearest(w, p) for p in range(parts)]
        error = sum(d for d, _ in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in out), key=str)


@pytest.mark.parametrize("crowded", [False, True], ids=["plain", "clashing"])
def test_codes_are_those_of_plain_loops(spark, tmp_path, crowded):
    rows = vectors()
    found = QUERIES["op11_part_codes"](spark, stored(frame(spark, rows, crowded), tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_codes(rows)


@pytest.mark.parametrize("width", [1, 37, 64, 4096])
def test_cells_never_lose_the_nearest_entry(width):
    rng = np.random.default_rng(width)
    entries = rng.integers(-90, 90, (40, 3))
    entries[7] = entries[3]  # ties go to the first
    points = rng.integers(-99, 99, (500, 3))
    for most in (4, 1 << 15):
        grid = partcodes.GridCells(entries, width, most)
        for part in np.array_split(points, 3):
            entry, distance = grid.nearest(part)
            every = ((part[:, None] - entries[None]) ** 2).sum(2)
            assert entry.tolist() == every.argmin(1).tolist()
            assert distance.tolist() == every.min(1).tolist()
        assert len(grid.kept) <= max(most, 167)


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, w) for i, v, _ in rows if v is not None and len(v) == 64 and (w := whole(v, 64)) is not None]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), w) for i, w in kept if i is not None)
    centroids = [list(w) for _, w in order[:k]]

    def nearest(w):
        return min((squares(w, c), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, w in kept:
            held.setdefault(nearest(w)[1], []).append(w)
        for j, own in held.items():
            centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *reversed(nearest(w))) for i, w in kept]
    own = {j: sum(d for _, c, d in found if c == j) for _, j, _ in found}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, own[c], sum(own.values()), digests[c]) for i, c, d in found), key=str)


@pytest.mark.parametrize("crowded", [False, True], ids=["plain", "clashing"])
def test_clusters_are_those_of_plain_loops(spark, tmp_path, crowded):
    rows = vectors()
    found = QUERIES["op12_curve_clusters"](spark, stored(frame(spark, rows, crowded), tmp_path))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_clusters(rows)


@pytest.mark.parametrize("d, bits", [(2, 3), (3, 2), (4, 2), (2, 5), (5, 1), (1, 4)])
def test_curve_goes_through_every_point_by_single_steps(d, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=d)))
    keys = [k.tobytes() for k in hilbert.curve_keys(points, bits)]
    assert len(set(keys)) == len(points)
    walk = points[sorted(range(len(points)), key=keys.__getitem__)]
    assert set(np.abs(np.diff(walk, axis=0)).sum(1).tolist()) == {1}


def test_boxes_never_lose_the_nearest_centroid():
    rng = np.random.default_rng(1)
    for _ in range(200):
        points, centroids = rng.integers(-20, 20, (30, 4)) // 4, rng.integers(-20, 20, (9, 4)) // 4
        wanted = hilbert.possible(points.min(0), points.max(0), centroids)
        best = ((points[:, None] - centroids[None]) ** 2).sum(2).argmin(1)
        assert set(best.tolist()) <= set(wanted.tolist())


def test_a_common_vector_fills_many_blocks_in_many_tasks(spark):
    importable(spark)
    rows = frame(spark, [(7, [0.25] * 64, 0)] * 3000).select("vec_id", F.transform("embedding", lambda x: x.cast("long")).alias("v"))
    blocks = hilbert.along_curve(rows, hilbert.Clusters(block=64))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the table were large
    try:
        sizes = blocks.select(F.spark_partition_id().alias("task"), F.size("ids").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) <= 64
    assert len({r.task for r in sizes}) == 2  # all there are in tests


@pytest.mark.parametrize("name", ["op11_part_codes", "op12_curve_clusters"])
@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, [0.5] * 64, None)]], ids=["empty", "no vector", "no id"])
def test_tables_without_a_start(spark, tmp_path, name, rows):
    assert QUERIES[name](spark, stored(frame(spark, rows), tmp_path)).collect() == []


def test_one_vector(spark, tmp_path):
    folder = stored(frame(spark, [(3, [0.5] * 64, None)] * 2), tmp_path)
    codes = QUERIES["op11_part_codes"](spark, folder).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in codes] == [(3, "00000000", 0, 0)] * 2
    assert [r.cluster for r in QUERIES["op12_curve_clusters"](spark, folder).collect()] == [0, 0]


@pytest.mark.parametrize("name", ["op11_part_codes", "op12_curve_clusters"])
def test_numbers_too_large_for_exact_distances_are_refused(spark, tmp_path, name):
    folder = stored(frame(spark, [(3, [1e9] + [0.0] * 63, None)]), tmp_path)
    with pytest.raises(ValueError, match="not exact"):
        QUERIES[name](spark, folder)

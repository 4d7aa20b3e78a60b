"""SimHash near-duplicates: every pair of fingerprints within a few bits is found, by tiles.

Equal fingerprints are one class, however many documents hold them. Classes are dealt into tiles by
population count: two fingerprints whose counts differ by more than the radius cannot be within it, so
such tile pairs are never formed. Each remaining pair of tiles is one exclusive-or and bit-count table
in numpy, and gives a spanning forest of its links instead of the links, at most as many rows as the
tiles have members. Components are then joined over the forests by alternating star steps, each
round written to the shared folder. Nothing but the 65 sizes of the population counts reaches the
driver.

The pipeline's stage asks for more: five-word shingle sets whose Jaccard similarity is 0.8 or more. Its
fingerprints have 128 bits, its tiles are dealt by the size of the set, which bounds the similarity, and
links are verified on the sets themselves: each tile pair gets the sets of its classes that have a candidate
and gives a forest of those alike enough.

Defined results: a null, empty or wordless text has fingerprint zero and is linked like any other; a
row without an id gets the component of its fingerprint and founds none (null if no row with an id
holds it); repeated rows are in one component; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import bounded, documents, drop_staged, narrow, raw, staged, staged_at

SEED = 42
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


@dataclass(frozen=True)
class SimHash:
    words: int = 4  # of a shingle
    radius: int = 4  # bits
    tile: int = 16_384  # classes


def fingerprint(text: bytes, width: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    finish = ends[width - 1 :] - 1 if len(words) >= width else ends[-1:] - 1
    start = np.concatenate([[0], ends])[: len(finish)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(start.tolist(), finish.tolist(), strict=True)])
    table = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    if len(table) < 1500:
        ones = np.unpackbits(table, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(table[:, i], minlength=256) @ BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(table)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""

    def run(batches):
        for batch in bounded(batches):
            found = [fingerprint(text, width) for text in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return narrow(docs).mapInArrow(run, "doc_id long, fp long")


def tiles(classes: DataFrame, size: int) -> tuple[DataFrame, dict[int, int]]:
    """Classes (fp, node) by population count and chunk, packed; and how many chunks each count has."""
    counted = classes.withColumn("ones", F.bit_count("fp"))
    chunks = {r.ones: -(-r.n // size) for r in counted.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    number = F.element_at(F.create_map(*(F.lit(x) for pair in chunks.items() for x in pair)), F.col("ones"))
    dealt = counted.withColumn("chunk", F.pmod(F.xxhash64("fp"), number).cast("int")) if chunks else counted.withColumn("chunk", F.lit(0))

    def packed(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        order = np.argsort(nodes)
        return pa.table({
            "ones": pa.array([table.column("ones")[0].as_py()], pa.int32()),
            "chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()),
            "fps": pa.array([table.column("fp").to_numpy()[order].tobytes()], pa.binary()),
            "nodes": pa.array([nodes[order].tobytes()], pa.binary()),
        })

    return dealt.groupBy("ones", "chunk").applyInArrow(packed, "ones int, chunk int, fps binary, nodes binary"), chunks


def tile_pairs(packed: DataFrame, chunks: dict[int, int], radius: int) -> DataFrame:
    """Every pair of tiles whose population counts are within the radius, each once."""
    partners = F.array(*(
        F.struct(F.lit(ones).alias("ones"), F.lit(n).alias("n")) for ones, n in sorted(chunks.items())
    ))
    near = F.filter(partners, lambda p: p["ones"].between(F.col("ones"), F.col("ones") + radius))
    left = (
        packed.select("*", F.explode(near).alias("other"))
        .select("ones", "chunk", "fps", "nodes", F.col("other.ones").alias("ones_b"),
                F.explode(F.sequence(F.lit(0), F.col("other.n") - 1)).alias("chunk_b"))
        .where("ones_b > ones OR chunk_b >= chunk")
    )
    right = packed.select(F.col("ones").alias("ones_b"), F.col("chunk").alias("chunk_b"),
                          F.col("fps").alias("fps_b"), F.col("nodes").alias("nodes_b"))
    same = (F.col("ones") == F.col("ones_b")) & (F.col("chunk") == F.col("chunk_b"))
    return left.join(right, ["ones_b", "chunk_b"]).select(same.alias("same"), "fps", "nodes", "fps_b", "nodes_b")


class Forest:
    """Union of many links at once; the smallest member is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        parent = self.parent
        while True:
            a, b = parent[a], parent[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(parent, flat := parent[parent]):
                parent[:] = flat


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int, rows: int = 128):
    """Pairs (i, j) within the radius, in parts; i < j inside one tile."""
    for start in range(0, len(a), rows):
        part = a[start : start + rows, None]
        first = start if same else 0
        i, j = np.nonzero(np.bitwise_count(part ^ b[None, first:]) <= radius)
        i, j = i + start, j + first
        yield (i[i < j], j[i < j]) if same else (i, j)


def forests(pairs: DataFrame, radius: int) -> DataFrame:
    """node, root: links that join what each tile pair joins."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[k], np.uint64) for k in ("fps", "fps_b"))
                nodes = np.frombuffer(row["nodes"], np.int64)
                if not row["same"]:
                    nodes = np.concatenate([nodes, np.frombuffer(row["nodes_b"], np.int64)])
                order = np.argsort(nodes)  # so that the smallest place is the smallest id
                place = np.empty(len(nodes), np.int64)
                place[order] = np.arange(len(nodes))
                shift = 0 if row["same"] else len(a)
                forest = Forest(len(nodes))
                for i, j in tile_links(a, b, row["same"], radius):
                    forest.join(place[i], place[j + shift])
                at = np.flatnonzero(forest.parent != np.arange(len(nodes)))
                columns = [pa.array(nodes[order[at]]), pa.array(nodes[order[forest.parent[at]]])]
                yield pa.RecordBatch.from_arrays(columns, ["node", "root"])

    return pairs.mapInArrow(run, "node long, root long")


def components(links: DataFrame) -> DataFrame:
    """node, root for every linked node: the smallest node it can reach. Links are (node, root) with root < node.

    A round's folder goes once the next one is written.
    """
    spark, path = links.sparkSession, ""
    edges, before = links.distinct(), None
    while True:
        edges, written = staged_at(edges, "links")
        drop_staged(spark, path)
        path = written
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if mark[0] == 0 or mark == before:
            return edges
        before = mark
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        # every larger neighbour is tied to the smallest of the neighbourhood, then every smaller one
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large, written = staged_at(large.where("node != root").distinct(), "large-star")
        drop_staged(spark, path)
        path = written
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        small = small.where("node != root").unionByName(least.select("node", F.col("least").alias("root")))
        edges = small.distinct()


def near_duplicates(docs: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """doc_id, fp and component_id for every row."""
    rows = staged(fingerprints(docs, how.words), "fingerprints")
    classes = staged(rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    packed, chunks = tiles(classes, how.tile)
    if not chunks:
        return rows.withColumn("component_id", F.lit(None).cast("long"))
    packed = staged(packed, "tiles")
    found = components(forests(tile_pairs(packed, chunks, how.radius), how.radius))
    known = classes.join(found, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return rows.join(known, "fp", "left")


# ---- the pipeline's stage: links are verified ---------------------------------------------------


@dataclass(frozen=True)
class Similar:
    words: int = 5  # of a shingle
    similarity: float = 0.8  # Jaccard, of shingle sets
    radius: int = 34  # of 128 bits
    half: int = 22  # of the first 64 of them
    tile: int = 16_384  # classes
    tile_bytes: int = 32 << 20  # of their sets, so that both sides of a tile pair fit a task


def shingle_set(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as sorted 64-bit hashes, and a fingerprint of 128 bits as two numbers."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(2, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    finish = ends[width - 1 :] - 1 if len(words) >= width else ends[-1:] - 1
    start = np.concatenate([[0], ends])[: len(finish)]
    digest = xxhash.xxh3_128_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(start.tolist(), finish.tolist(), strict=True)])
    held, first = np.unique(np.frombuffer(hashes, np.uint64)[::2], return_index=True)
    table = np.frombuffer(hashes, np.uint8).reshape(-1, 16)[first]
    ones = np.concatenate([np.bincount(table[:, i], minlength=256) @ BYTE_BITS for i in range(16)])
    return held, np.packbits(2 * ones > len(table)).view(np.uint64)


SET = ["near__key", "near__size", "near__fp", "near__fp2"]  # names no column of the documents has


def with_sets(docs: DataFrame, width: int) -> DataFrame:
    """The rows with the key, size and fingerprint halves of their shingle sets; equal sets have equal keys."""
    schema = docs.schema

    def run(batches):
        for batch in bounded(batches):
            found = [shingle_set(text, width) for text in raw(batch.column("text"))]
            keys = np.array([xxhash.xxh3_64_intdigest(held.tobytes()) for held, _ in found], np.uint64).view(np.int64)
            sizes = np.array([len(held) for held, _ in found], np.int64)
            prints = np.array([fp for _, fp in found], np.uint64).reshape(-1, 2).view(np.int64)
            own = map(pa.array, (keys, sizes, prints[:, 0].copy(), prints[:, 1].copy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, *SET])

    return docs.mapInArrow(run, T.StructType([*schema.fields, *[T.StructField(name, T.LongType()) for name in SET]]))


def _size_tiles(classes: DataFrame, how: Similar) -> tuple[DataFrame, dict[int, int]]:
    """Classes by size band and chunk, packed. Sets as alike as asked for are in one band or in two next to each other."""
    banded = classes.withColumn("band", F.floor(F.log(F.greatest("size", F.lit(1))) / -np.log(how.similarity)).cast("int"))
    held = banded.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("numbers"))
    # one row per band: sizes grow by a quarter from band to band
    chunks = {r.band: max(-(-r.n // how.tile), -(-8 * r.numbers // how.tile_bytes)) for r in held.collect()}
    number = F.element_at(F.create_map(*(F.lit(x) for pair in chunks.items() for x in pair)), F.col("band")) if chunks else F.lit(1)
    columns = ["key", "size", "fp", "fp2"]

    def packed(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("key").to_numpy())
        return pa.table({
            "band": pa.array([table.column("band")[0].as_py()], pa.int32()),
            "chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()),
            "data": pa.array([np.stack([table.column(c).to_numpy()[order] for c in columns]).tobytes()], pa.binary()),
        })

    dealt = banded.withColumn("chunk", F.pmod(F.xxhash64("key"), number).cast("int"))
    return dealt.groupBy("band", "chunk").applyInArrow(packed, "band int, chunk int, data binary"), chunks


def _size_tile_pairs(packed: DataFrame, chunks: dict[int, int]) -> DataFrame:
    partners = F.array(*(F.struct(F.lit(b).alias("band"), F.lit(n).alias("n")) for b, n in sorted(chunks.items())))
    near = F.filter(partners, lambda p: p["band"].between(F.col("band"), F.col("band") + 1))
    left = (
        packed.select("*", F.explode(near).alias("other"))
        .select("band", "chunk", "data", F.col("other.band").alias("band_b"),
                F.explode(F.sequence(F.lit(0), F.col("other.n") - 1)).alias("chunk_b"))
        .where("band_b > band OR chunk_b >= chunk")
    )
    right = packed.select(F.col("band").alias("band_b"), F.col("chunk").alias("chunk_b"), F.col("data").alias("data_b"))
    same = (F.col("band") == F.col("band_b")) & (F.col("chunk") == F.col("chunk_b"))
    name = F.concat_ws(":", "band", "chunk", "band_b", "chunk_b").alias("tiles")
    return left.join(right, ["band_b", "chunk_b"]).select(name, same.alias("same"), "data", "data_b")


def candidates(a: np.ndarray, b: np.ndarray, same: bool, how: Similar, rows: int = 64):
    """Places (i, j) in two tiles that may be alike by fingerprint and size, in parts; i < j inside one tile."""
    (_, size, fp, fp2), (_, size_b, fp_b, fp2_b) = a, b
    fp, fp2, fp_b, fp2_b = (x.view(np.uint64) for x in (fp, fp2, fp_b, fp2_b))
    for start in range(0, len(fp), rows):
        first = start if same else 0
        far = np.bitwise_count(fp[start : start + rows, None] ^ fp_b[None, first:])
        i, j = np.nonzero(far <= how.half)
        near = far[i, j]
        i, j = i + start, j + first
        ok = near + np.bitwise_count(fp2[i] ^ fp2_b[j]) <= how.radius
        if same:
            ok &= i < j
        i, j = i[ok], j[ok]
        ok = np.minimum(size[i], size_b[j]) >= how.similarity * np.maximum(size[i], size_b[j]) - 1e-9
        if ok.any():
            yield i[ok], j[ok]


def verified(table: pa.Table, how: Similar) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) over the keys of the classes of a tile pair: a forest of those alike enough.

    Pairs joined already are not looked at again, so a group of near copies is verified in about as many
    comparisons as it has members.
    """
    keys, first = np.unique(table.column("near__key").to_numpy(), return_index=True)
    held = table.column("held").combine_chunks()
    ends, flat = held.offsets.to_numpy(), held.values.to_numpy().view(np.uint64)
    begin, size = ends[:-1][first].astype(np.int64), np.diff(ends)[first].astype(np.int64)
    tile = np.stack([keys, size, *(table.column(c).to_numpy()[first] for c in SET[2:])])
    root = np.arange(len(keys))
    for i, j in candidates(tile, tile, True, how):
        for at, stop in zip(starts := np.flatnonzero(np.diff(i, prepend=-1)), [*starts[1:], len(i)], strict=True):
            one, others = i[at], j[at:stop]
            own = flat[begin[one] : begin[one] + size[one]]
            while len(others := others[root[others] != root[one]]):
                n = max(1, int(np.searchsorted(np.cumsum(size[others]), 1 << 21, side="right")))
                part, others = others[:n], others[n:]
                ends = np.cumsum(size[part])
                numbers = flat[np.repeat(begin[part] - ends + size[part], size[part]) + np.arange(ends[-1])]
                place = np.minimum(np.searchsorted(own, numbers), len(own) - 1)
                shared = np.add.reduceat(own[place] == numbers, ends - size[part], dtype=np.int64)
                alike = part[shared >= how.similarity * (size[one] + size[part] - shared) - 1e-9]
                joined = np.unique(root[np.append(alike, one)])
                if len(joined) > 1:
                    root[np.isin(root, joined)] = joined[0]
    at = np.flatnonzero(root != np.arange(len(keys)))
    return keys[at], keys[root[at]]


def similar_links(rows: DataFrame, classes: DataFrame, how: Similar) -> DataFrame:
    """node, root over keys of classes: components of the links whose Jaccard similarity is as asked for.

    Sets are larger than texts, so only those of classes with a candidate are made again. Each tile pair first
    names its classes that have one; then their sets are sent to it, and it answers with a forest. So
    what is written grows with the members of a group and not with its pairs.
    """
    packed, chunks = _size_tiles(classes, how)
    if not chunks:
        return classes.select(F.col("key").alias("node"), F.col("key").alias("root")).where("false")

    def named(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[k], np.int64).reshape(4, -1) for k in ("data", "data_b"))
                asked = [np.zeros(a.shape[1], bool), np.zeros(b.shape[1], bool)]
                for i, j in candidates(a, b, row["same"], how):
                    asked[0][i] = asked[1][j] = True
                keys = np.union1d(a[0][asked[0]], b[0][asked[1]])
                yield pa.RecordBatch.from_arrays([pa.array([row["tiles"]] * len(keys), pa.string()), pa.array(keys)], ["tiles", "near__key"])

    def sets(batches):
        for batch in bounded(batches):
            found = [shingle_set(text, how.words) for text in raw(batch.column("text"))]
            prints = np.array([fp for _, fp in found], np.uint64).reshape(-1, 2).view(np.int64)
            flat = np.concatenate([np.zeros(0, np.uint64), *(held for held, _ in found)]).view(np.int64)
            ends = np.cumsum([0, *(len(held) for held, _ in found)])
            columns = [batch.column("near__key"), *(pa.array(prints[:, k].copy()) for k in (0, 1))]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, ["near__key", *SET[2:], "held"])

    def forest(table: pa.Table) -> pa.Table:
        node, root = verified(table, how)
        return pa.table({"node": pa.array(node), "root": pa.array(root)})

    pairs = _size_tile_pairs(staged(packed, "size-tiles"), chunks)
    asked = staged(pairs.mapInArrow(named, "tiles string, near__key long"), "candidates")
    wanted = rows.join(asked.select("near__key").distinct(), "near__key", "left_semi")
    texts = wanted.groupBy("near__key").agg(F.min("text").alias("text"))
    made = texts.mapInArrow(sets, "near__key long, near__fp long, near__fp2 long, held array<long>")
    sent = asked.join(made, "near__key")
    return components(sent.groupBy("tiles").applyInArrow(forest, "node long, root long"))


def without_near_duplicates(docs: DataFrame, how: Similar = Similar()) -> DataFrame:
    """The rows, with all their columns, that are the first of their component of verified links.

    The first has the smallest id; rows without an id come last, and rows with one id are told apart by
    their sets and by a hash of all they hold. Of equal rows one stays. Texts without words are one group.
    """
    rows = staged(with_sets(docs, how.words), "shingle-sets")
    hashed = [f.name for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.xxhash64(*hashed).alias("row"))
    one = F.min(F.struct(*SET[1:]))
    classes = rows.groupBy("near__key").agg(one.alias("c"), F.min(place).alias("place"))
    classes = staged(classes.select(F.col("near__key").alias("key"), *[F.col(f"c.{n}").alias(n[6:]) for n in SET[1:]], "place"), "set-classes")
    found = similar_links(rows, classes, how)
    known = classes.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = known.groupBy("root").agg(F.min(F.struct("place", "key")).alias("first")).select(F.col("first.key").alias("near__key"))
    # of each set the first row, found before the shuffle in each task; then the first set of each component
    order = W.partitionBy("near__key").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64(*hashed))
    single = rows.withColumn("near__rank", F.row_number().over(order)).where("near__rank = 1")
    return single.join(first, "near__key", "left_semi").select(docs.columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")

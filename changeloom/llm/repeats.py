"""Repeated passages: what every document shares with an earlier one, by suffix arrays over buckets.

Only byte strings of ``length`` or more matter, and equal strings of that length have the same
smallest gram hash inside (their anchor). So the corpus is cut down and dealt out by anchors:

1. every document's anchors are exchanged by hash, and each block of documents learns which of its own
   also occur in another document;
2. the stretches around such anchors become segments; of equal segments only those in the first
   document go on, the others are repeats as a whole;
3. the strings around each anchor go to the anchor's bucket. There an enhanced suffix array is built:
   suffixes in order with the lengths of their common prefixes. A stack scan walks the tree of
   common-prefix intervals; an interval whose suffixes do not all follow the same byte cannot be
   widened to the left and is a maximal repeat group, given out with all its occurrences;
4. occurrences after the group's first document become spans, which are merged per document.

Blocks hold about ``block_bytes`` of text, buckets about ``bucket_anchors`` anchors; their numbers follow
the data. A hash only ever proposes; every repeat rests on equal bytes (segments: on equal digests).

Defined results: a null text is empty; a row without an id takes no part and is left whole; rows with
the same id count as one document; an empty table gives an empty table; other columns are ignored by
``remove_repeats`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import bounded, documents, narrow, raw, staged

BLOCK = "_repeats_block"
KEY_BYTES = 5  # of an anchor inside its bucket
#: odd multipliers, any would do
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


@dataclass(frozen=True)
class Repeats:
    length: int = 50
    gram: int = 24
    block_bytes: int = 8 << 20
    bucket_anchors: int = 1 << 19


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every place, by joining hashes of halves."""
    one = data.astype(np.uint64) + np.uint64(1)
    one *= np.uint64(MIX[0])
    one ^= one >> np.uint64(32)
    have, whole, size, done = one, None, 1, 0
    while size <= gram:
        if gram & size:
            if whole is None:
                whole = have
            else:
                tail = have[done:]
                whole = whole[: len(tail)] * np.uint64(MIX[1]) + tail
            done += size
        if len(have) <= size:
            break
        have = have[:-size] * np.uint64(MIX[2]) + have[size:]
        have ^= have >> np.uint64(29)
        size *= 2
    n = len(data) - gram + 1
    if n <= 0 or whole is None or done < gram:
        return np.zeros(0, np.uint64)
    whole = whole[:n] ^ (whole[:n] >> np.uint64(32))
    whole *= np.uint64(MIX[3])
    whole ^= whole >> np.uint64(29)
    whole *= np.uint64(MIX[4])
    whole ^= whole >> np.uint64(32)
    return whole


def anchors(data: np.ndarray, how: Repeats) -> np.ndarray:
    """The anchor of the ``length`` bytes from every place."""
    low, width, size = gram_hashes(data, how.gram), how.length - how.gram + 1, 1
    if len(low) < width:
        return np.zeros(0, np.uint64)
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def runs(values: np.ndarray, longest: int = 64) -> np.ndarray:
    """Where runs of equal values start; longer runs are cut."""
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    size = np.diff(start, append=len(values))
    if (size > longest).any():
        start = np.concatenate([np.arange(a, a + n, longest) for a, n in zip(start, size, strict=True)])
    return start


def text_anchors(texts: list[bytes], how: Repeats) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, run starts, run ends, anchors) for texts long enough; several texts are hashed at once."""
    group, size = [], 0
    for i, text in enumerate([*texts, None]):
        if group and (text is None or size + len(text) > 1 << 19):
            data = np.frombuffer(b"".join(texts[k] for k in group), np.uint8)
            found, at = anchors(data, how), 0
            for k in group:
                own = found[at : at + max(0, len(texts[k]) - how.length + 1)]
                at += len(texts[k])
                start = runs(own)
                yield k, start, np.append(start[1:], len(own)), own[start]
            group, size = [], 0
        if text is not None and len(text) >= how.length:
            group.append(i)
            size += len(text)


def _pack_keys(keys: np.ndarray, bits: int) -> bytes:
    """Bucket numbers are the first bits of a hash; of the rest the next ``KEY_BYTES`` bytes are kept."""
    kept = (keys << np.uint64(bits)).astype(">u8")
    return kept.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    keys = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    keys[:, 8 - KEY_BYTES :] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return keys.reshape(-1).view(">u8").astype(np.uint64)


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys << np.uint64(bits)) >> np.uint64(64 - 8 * KEY_BYTES)


def _by_bucket(keys: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket numbers and the places of their keys."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    order = np.argsort(bucket, kind="stable")
    start = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, n in zip(start, np.diff(start, append=len(order)), strict=True):
        yield int(bucket[order[a]]), order[a : a + n]


def exchange_anchors(docs: DataFrame, how: Repeats, bits: int) -> DataFrame:
    """block, bucket, keys: anchors of each block that occur in more than one document."""

    def collect(batches):
        for batch in bounded(batches):
            blocks, texts = batch.column("block").to_numpy(), raw(batch.column("text"))
            found: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, _, _, keys in text_anchors(texts, how):
                found.setdefault(int(blocks[i]), []).append(np.unique(keys))
            rows = []
            for block, own in found.items():
                keys, times = np.unique(np.concatenate(own), return_counts=True)
                for bucket, at in _by_bucket(keys, bits):
                    rows.append((bucket, block, _pack_keys(keys[at], bits), np.packbits(times[at] > 1).tobytes()))
            if rows:
                columns = list(zip(*rows, strict=True))
                types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def compare(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        own = [_unpack_keys(k) for k in table.column("keys").to_pylist()]
        twice = [
            np.unpackbits(np.frombuffer(f, np.uint8), count=len(k)).astype(bool)
            for f, k in zip(table.column("twice").to_pylist(), own, strict=True)
        ]
        every = np.concatenate(own)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        same = ordered[1:] == ordered[:-1]
        hit = np.concatenate(twice)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        per_block: dict[int, list[np.ndarray]] = {}
        for block, keys, flags in zip(blocks, own, np.split(hit, np.cumsum([len(k) for k in own])[:-1]), strict=True):
            if flags.any():
                per_block.setdefault(block, []).append(keys[flags])
        bucket = table.column("bucket")[0].as_py()
        packed = [
            np.unique(np.concatenate(k)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BYTES :].tobytes()
            for k in per_block.values()
        ]
        columns = [pa.array(list(per_block), pa.int64()), pa.array([bucket] * len(packed), pa.int32())]
        return pa.table([*columns, pa.array(packed, pa.binary())], ["block", "bucket", "keys"])

    names = ["bucket", "block", "keys", "twice"]
    sent = docs.mapInArrow(collect, "bucket int, block long, keys binary, twice binary")
    return sent.groupBy("bucket").applyInArrow(compare, "block long, bucket int, keys binary")


def packed_blocks(docs: DataFrame) -> DataFrame:
    """Documents on their way to their block, compressed: block, ids, sizes, texts."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in bounded(batches):
            blocks, ids, texts = batch.column("block").to_numpy(), batch.column("doc_id").to_numpy(), raw(batch.column("text"))
            for block in np.unique(blocks):
                at = np.flatnonzero(blocks == block)
                own = [texts[i] for i in at]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()),
                    "ids": pa.array([ids[at].astype(np.int64).tobytes()], pa.binary()),
                    "sizes": pa.array([np.array([len(t) for t in own], np.int64).tobytes()], pa.binary()),
                    "texts": pa.array([press.compress(b"".join(own))], pa.binary()),
                })

    return docs.mapInArrow(run, "block long, ids binary, sizes binary, texts binary")


def _unpacked(table: pa.Table) -> Iterator[tuple[list[int], list[bytes]]]:
    """Documents of a block, in the parts in which they were sent."""
    press = zstandard.ZstdDecompressor()
    for row in range(table.num_rows):
        ids = np.frombuffer(table.column("ids")[row].as_py(), np.int64).tolist()
        ends = np.cumsum(np.frombuffer(table.column("sizes")[row].as_py(), np.int64)).tolist()
        data = press.decompress(table.column("texts")[row].as_py(), max_output_size=max(1, ends[-1]))
        yield ids, [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def segments(docs: DataFrame, replies: DataFrame, how: Repeats, bits: int) -> DataFrame:
    """doc_id, start, digest, segment: stretches of which every window has an anchor known elsewhere."""

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {
            bucket: _unpack_keys(keys)
            for bucket, keys in zip(right.column("bucket").to_pylist(), right.column("keys").to_pylist(), strict=True)
        }
        rows = []
        for ids, texts in _unpacked(left) if known else ():
            found = list(text_anchors(texts, how))
            every = np.concatenate([f[3] for f in found]) if found else np.zeros(0, np.uint64)
            hit = np.zeros(len(every), bool)
            for bucket, at in _by_bucket(every, bits):
                if bucket in known:
                    keys, own = known[bucket], _short(every[at], bits)
                    place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    hit[at] = keys[place] == own
            done = 0
            for i, start, end, own in found:
                flags = hit[done : done + len(own)]
                done += len(own)
                edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
                for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1, strict=True):
                    part = texts[i][int(start[a]) : int(end[b]) + how.length - 1]
                    rows.append((ids[i], int(start[a]), hashlib.blake2b(part, digest_size=16).digest(), part))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "start", "digest", "segment"])

    grouped = packed_blocks(docs).groupBy("block").cogroup(replies.groupBy("block"))
    return grouped.applyInArrow(mark, "doc_id long, start long, digest binary, segment binary")


def bucketed_strings(owned: DataFrame, how: Repeats, bits: int) -> DataFrame:
    """The strings around each anchor, sent to the anchor's bucket in packed form."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in bounded(b.rename_columns(["doc_id", "start", "text"]) for b in batches):
            ids, begins, texts = batch.column("doc_id").to_numpy(), batch.column("start").to_numpy(), raw(batch.column("text"))
            keys, docs, places, strings = [], [], [], []
            for i, start, end, own in text_anchors(texts, how):
                keys.append(own)
                docs += [int(ids[i])] * len(own)
                places.append(begins[i] + start)
                strings += [texts[i][a : b + how.length - 1] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            if not keys:
                continue
            every, docs, places = np.concatenate(keys), np.array(docs, np.int64), np.concatenate(places)
            sizes = np.array([len(s) for s in strings], np.uint8)
            for bucket, at in _by_bucket(every, bits):
                parts = [docs[at].tobytes(), places[at].astype(np.int64).tobytes(), sizes[at].tobytes()]
                data = b"".join([*parts, _pack_keys(every[at], bits), *(strings[k] for k in at)])
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int32()),
                    "n": pa.array([len(at)], pa.int32()),
                    "data": pa.array([press.compress(data)], pa.binary()),
                })

    return owned.select("doc_id", "start", "segment").mapInArrow(run, "bucket int, n int, data binary")


def common_prefixes(suffixes: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it, 0 for the first."""
    found = np.zeros(len(suffixes), np.int64)
    sizes = np.array([len(s) for s in suffixes])
    for a in range(0, len(suffixes) - 1, 1 << 16):
        part = suffixes[a : a + (1 << 16) + 1]
        wide = np.array(part, f"S{max(map(len, part)) + 1}")
        grid = wide.view(np.uint8).reshape(len(part), -1)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), grid.shape[1])
        found[a + 1 : a + len(part)] = np.minimum(first, np.minimum(sizes[a + 1 : a + len(part)], sizes[a : a + len(part) - 1]))
    return found


def maximal_repeats(prefixes: list[int], before: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of suffix-array intervals that are maximal repeats of ``least`` or more.

    ``before`` is the byte before each suffix, or a number of its own from 256 where none is known. An
    interval of the tree is closed when the next common prefix is shorter; it is maximal unless every
    suffix in it follows the same byte.
    """
    stack: list[tuple[int, int, int]] = []  # length, first suffix, the byte before all so far or -1
    for i in range(1, len(before) + 1):
        shared = prefixes[i] if i < len(before) else 0
        if shared < least:
            if not stack:
                continue
            shared = 0
        first, byte = i - 1, before[i - 1]
        while stack and stack[-1][0] > shared:
            length, first, own = stack.pop()
            byte = own if own == byte else -1
            if not 0 <= byte <= 255:
                yield length, first, i - 1
        if stack and stack[-1][0] == shared:
            length, begun, own = stack[-1]
            stack[-1] = (length, begun, own if own == byte else -1)
        elif shared:
            stack.append((shared, first, byte))


def _window_hashes(strings: list[bytes], least: int) -> np.ndarray:
    """Hashes of all windows of ``least`` bytes, string by string."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    windows = np.maximum(0, sizes - least + 1)
    begin = np.cumsum(sizes) - sizes - np.cumsum(windows) + windows
    at = np.repeat(begin, windows) + np.arange(windows.sum())
    return gram_hashes(np.frombuffer(b"".join(strings), np.uint8), least)[at]


def repeat_groups(
    strings: list[bytes], least: int, most: int = 1 << 18
) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(string, offset), ...]) for each maximal repeat of the strings, all occurrences given.

    Only suffixes go into the array whose first ``least`` bytes have the hash of another's; a large set
    is sorted in shares of about ``most`` suffixes, dealt by that hash, as suffixes of one interval
    begin alike.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    windows = np.maximum(0, sizes - least + 1)
    string = np.repeat(np.arange(len(strings)), windows)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
    hashes = np.concatenate([_window_hashes(strings[a : a + 4096], least) for a in range(0, len(strings), 4096)])
    _, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[number] > 1)
    shares = -(-len(again) // most)
    for share in range(shares):
        own = again if shares == 1 else again[number[again] % shares == share]
        where = list(zip(string[own].tolist(), offset[own].tolist(), strict=True))
        suffixes = [strings[s][k:] for s, k in where]
        order = sorted(range(len(where)), key=suffixes.__getitem__)
        prefixes = common_prefixes([suffixes[i] for i in order]).tolist()
        before = [strings[s][k - 1] if k else 256 + s for s, k in map(where.__getitem__, order)]
        for length, first, last in maximal_repeats(prefixes, before, least):
            yield length, [where[order[i]] for i in range(first, last + 1)]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    done: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if done and a <= done[-1][1]:
            done[-1] = (done[-1][0], max(b, done[-1][1]))
        else:
            done.append((a, b))
    return done


def _together(anchors_: np.ndarray, most: int = 4096) -> Iterator[np.ndarray]:
    """Numbers of strings that share their anchor with another, several anchors at a time."""
    order = np.argsort(anchors_, kind="stable")
    start = np.flatnonzero(np.diff(anchors_[order].astype(np.int64), prepend=-1))
    size = np.diff(start, append=len(order))
    groups = [order[a : a + n] for a, n in zip(start[size > 1], size[size > 1], strict=True)]
    held, n = [], 0
    for group in groups:
        if held and n + len(group) > most:
            yield np.concatenate(held)
            held, n = [], 0
        held.append(group)
        n += len(group)
    if held:
        yield np.concatenate(held)


class _Numbered(dict):
    """Numbers strings as they are first asked for."""

    def __missing__(self, text: bytes) -> int:
        self[text] = number = len(self)
        return number


def _strings(table: pa.Table, number: _Numbered) -> Iterator[tuple[np.ndarray, ...]]:
    """Per packed row: documents, places, lengths, anchors and numbers of its strings."""
    press = zstandard.ZstdDecompressor()
    for n, packed in zip(table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True):
        data = press.decompress(packed)
        sizes = np.frombuffer(data, np.uint8, n, 16 * n).astype(np.int64)
        begin = (17 + KEY_BYTES) * n
        ends = begin + np.cumsum(sizes)
        texts = (data[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True))
        yield (
            np.frombuffer(data, np.int64, n),
            np.frombuffer(data, np.int64, n, 8 * n),
            sizes,
            _unpack_keys(data[17 * n : begin]),
            np.fromiter(map(number.__getitem__, texts), np.int64, n),
        )


def bucket_spans(table: pa.Table, length: int) -> pa.Table:
    """doc_id, start, finish of what the documents of a bucket repeat of earlier documents."""
    number = _Numbered()
    docs, places, sizes, keys, own = map(np.concatenate, zip(*_strings(table, number), strict=True))
    order = np.lexsort((docs, own))
    begin = np.flatnonzero(np.diff(own[order], prepend=-1))
    first = docs[order[begin]]  # the first document of each string
    # equal strings: the whole string is one repeat; its first document goes on to the suffix array
    later = docs > first[own]
    found = [(docs[later], places[later], places[later] + sizes[later])]
    order = order[~later[order]]
    stop = np.cumsum(np.bincount(own[order], minlength=len(first)))
    texts, firsts, spans = list(number), first.tolist(), []
    # only strings with a common anchor can share anything else
    for group in _together(keys[order[np.concatenate([[0], stop[:-1]])]]):
        if (first[group] == first[group[0]]).all():
            continue
        strings, owner = [texts[i] for i in group], [firsts[i] for i in group]
        earlier: dict[int, list[tuple[int, int]]] = {}
        for size, members in repeat_groups(strings, length):
            least = min(owner[s] for s, _ in members)
            for s, k in members:
                if owner[s] > least:
                    earlier.setdefault(s, []).append((k, k + size))
        for s, parts in earlier.items():
            i = int(group[s])
            at = places[order[stop[i - 1] if i else 0 : stop[i]]].tolist()
            spans += [(owner[s], place + a, place + b) for a, b in united(parts) for place in at]
    if spans:
        found.append(tuple(np.array(c, np.int64) for c in zip(*spans, strict=True)))
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["doc_id", "start", "finish"])


def repeat_spans(docs: DataFrame, how: Repeats, total: int) -> DataFrame:
    """doc_id, start, finish: stretches that some earlier document holds too; they may overlap."""
    bits = max(0, int(total / 13.5 / how.bucket_anchors)).bit_length()
    replies = exchange_anchors(docs, how, bits)
    found = staged(segments(docs, replies, how, bits), "segments")
    owners = found.groupBy("digest").agg(F.min("doc_id").alias("owner"))
    judged = found.join(owners, "digest")
    copies = judged.where("doc_id > owner").select(
        "doc_id", "start", (F.col("start") + F.octet_length("segment")).alias("finish")
    )
    sent = bucketed_strings(judged.where("doc_id = owner"), how, bits)
    spans = sent.groupBy("bucket").applyInArrow(
        lambda table: bucket_spans(table, how.length), "doc_id long, start long, finish long"
    )
    return spans.unionByName(copies)


def merged(starts: np.ndarray, finishes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans as one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(finishes[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]]) if len(starts) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return starts[at], reach[np.append(at[1:], len(starts)) - 1] if len(starts) else reach


def _blocks(docs: DataFrame, how: Repeats) -> tuple[Column, int]:
    """A document's block, from its id, so that a block has about ``block_bytes`` of text; all the text's size."""
    total, rows = docs.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    total = total or 0
    per_block = max(1, int(how.block_bytes * rows / max(total, how.block_bytes))) if rows else 1
    return F.floor(F.col("doc_id").cast("long") / per_block).cast("long").alias("block"), total


def _spans_by_doc(table: pa.Table) -> dict[int, tuple[list[int], list[int]]]:
    """Merged starts and finishes of each document of a block."""
    ids = table.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    starts, finishes = table.column("start").to_numpy()[order], table.column("finish").to_numpy()[order]
    first = np.flatnonzero(np.diff(ids[order], prepend=-1)) if len(ids) else np.zeros(0, np.int64)
    own = {}
    for a, n in zip(first, np.diff(first, append=len(ids)), strict=True):
        own[int(ids[order[a]])] = tuple(x.tolist() for x in merged(starts[a : a + n], finishes[a : a + n]))
    return own


def _cut(text: bytes, spans: tuple[list[int], list[int]]) -> tuple[bytes, list[int], list[int]]:
    starts, finishes = spans[0], [min(x, len(text)) for x in spans[1]]
    kept = b"".join(text[p:q] for p, q in zip([0, *finishes], [*starts, len(text)], strict=True))
    return kept, starts, finishes


def remove_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_bytes, kept (bytes left), starts and finishes of the removed stretches, for every row."""
    plain = narrow(docs)
    block, total = _blocks(plain, how)
    dealt = plain.where("doc_id IS NOT NULL").select("doc_id", "text", block)
    spans = repeat_spans(dealt, how, total).select("doc_id", "start", "finish", block)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        own, rows = _spans_by_doc(right), []
        for ids, texts in _unpacked(left):
            rows += [(i, len(text), *_cut(text, own.get(i, ([], [])))) for i, text in zip(ids, texts, strict=True)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names = ["doc_id", "n_bytes", "kept", "starts", "finishes"]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    schema = "doc_id long, n_bytes long, kept binary, starts array<long>, finishes array<long>"
    done = packed_blocks(dealt).groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)
    nobody = plain.where("doc_id IS NULL").select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("kept"),
        F.expr("cast(array() as array<long>)").alias("starts"),
        F.expr("cast(array() as array<long>)").alias("finishes"),
    )
    return done.unionByName(nobody)


def without_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """The same rows and columns with repeated passages gone from ``text``; a null text stays null.

    Bytes of a character that was cut through go too. Whole rows travel to their block in compressed
    form, so the texts are not joined to the table again.
    """
    plain, schema = narrow(docs), docs.schema
    block, total = _blocks(plain, how)
    dealt = plain.where("doc_id IS NOT NULL").select("doc_id", "text", block)
    spans = repeat_spans(dealt, how, total).select("doc_id", "start", "finish", block)

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in bounded(batches):
            blocks = batch.column(BLOCK).to_numpy()
            rows = batch.select(schema.names)
            for number in np.unique(blocks):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as out:
                    out.write_batch(rows.filter(pa.array(blocks == number)))
                columns = [pa.array([number], pa.int64()), pa.array([press.compress(sink.getvalue().to_pybytes())], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "rows"])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        own, parts = _spans_by_doc(right), []
        for packed in left.column("rows").to_pylist():
            part = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()
            texts, at = part.column("text").to_pylist(), part.schema.get_field_index("text")
            for i, doc_id in enumerate(part.column("doc_id").cast(pa.int64()).to_pylist()):
                if doc_id in own and texts[i] is not None:
                    texts[i] = _cut(texts[i].encode(), own[doc_id])[0].decode(errors="ignore")
            parts.append(part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type)))
        return pa.concat_tables(parts)

    sent = docs.where("doc_id IS NOT NULL").withColumn(BLOCK, block).mapInArrow(pack, "block long, rows binary")
    done = sent.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)
    return done.unionByName(docs.where("doc_id IS NULL"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(documents(spark, sf_dir))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

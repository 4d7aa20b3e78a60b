"""Language-model scoring: a word model over the whole corpus, and causal attention on subword ids.

Words are counted over all training documents. Nothing is counted row by row: every block of documents
sends its distinct words with their counts to the words' buckets, a bucket adds them up, counts the
subwords of its words on the way, and sends each block the corpus counts of the words it asked for.
The vocabulary is never in one place.

The attention model is trained by averaging. Windows are consecutive and cover every training text from
its first token to its end; equal ones are one that counts as often as it occurs. Windows are dealt into shards by a hash. Each
round, every shard is passed over once from the common weights; the mean of the results is the next
start, for an id's vector weighted by how often the shard holds the id. Only sums as long as the weights
or the subword vocabulary reach the driver.

A text is then scored in overlapping windows: each is attended to with a causal mask, and only its
last ``stride`` places are scored, so that every token is scored once and, but for the first of a text,
with at least ``window - stride`` tokens before it. The probability of a word is a mixture: ``word_share``
of its share of the training tokens, and the rest of what attention gives its subwords. So frequent words
need not be spelled out, and a word never seen still has a probability. A text's score is the sum of the
log10 probabilities of its words and its end.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased; one end follows them.
Defined results: a null or empty text has the end as its only token; a row without an id is in no
held-out part, so it is learned from; repeated rows give repeated results and are learned from each; an
empty table gives an empty table; without any training text all counts are zero and the model keeps its
first weights; other columns are ignored. Rows without an id are dealt by their text.
Scores do not depend on how rows are dealt over tasks, but for rounding.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import attention
from changeloom.llm.attention import Classes, Shape
from changeloom.llm.common import bounded, documents, drop_staged, narrow, raw, remainder, staged, staged_at
from changeloom.llm.packing import word_codes

PART = 100_000  # words of a text that are looked up at once
WINDOWS = 1 << 16  # windows of a record batch
MOST_WORDS = 500_000  # distinct words a worker remembers
END = b"\n"  # no word holds a line break, so it can stand for the end among words


@dataclass(frozen=True)
class Scoring:
    shape: Shape = Shape()
    subwords: int = 49_408
    end_id: int = 49_407
    block_bytes: int = 8 << 20
    bucket_bytes: int = 4 << 20  # of text for each bucket of words
    rounds: int = 2
    rate: float = 0.01
    train_batch: int = 128
    shard_windows: int = 1 << 15  # different windows that one task learns from in a round
    grain: int = 1 << 18  # steps of a weight to one; an id's occurrences times its steps must fit a long
    word_share: float = 0.6


def subword_ids(path: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where each word's begin.

    A word is parted where the tokeniser parts it anyway, and each part is tokenised once.
    """
    table = word_codes(path, MOST_WORDS)
    joined = b" ".join(words).lower()
    if any(t in joined for t in table.special):
        ids, sizes = table.coded([w.lower() for w in words])
        return ids.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    inside = np.searchsorted(table.parted(joined), np.cumsum(lengths + 1))
    parts = np.diff(inside, prepend=0) + (lengths > 0)
    number: dict[bytes, int] = {}
    at = np.array([number.setdefault(part, len(number)) for part in table.words(joined)], np.int64)
    ids, sizes = table.coded(list(number))
    begins, size = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.concatenate([[0], np.cumsum(size)])
    spelled = ids[np.repeat(begins[at] - ends[:-1], size) + np.arange(ends[-1])]
    return spelled.astype(np.int64), ends[np.concatenate([[0], np.cumsum(parts)])]


def _packed(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values if isinstance(values, bytes) else values.tobytes())


def _open(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _record(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


# ---- word counts -------------------------------------------------------------------------------


def word_requests(docs: DataFrame, buckets: int, how: Scoring) -> DataFrame:
    """bucket, block, words, counts: each block's distinct words with their counts in training texts."""
    names, types = ["bucket", "block", "words", "counts"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        for batch in bounded(batches, how.block_bytes):
            blocks, learn = batch.column("block").to_pylist(), batch.column("learn").to_pylist()
            found: dict[int, tuple[Counter, set]] = {}
            for block, use, text in zip(blocks, learn, raw(batch.column("text")), strict=True):
                counted, seen = found.setdefault(block, (Counter(), set()))
                if use:
                    counted.update(text.lower().split())
                    counted[END] += 1
                else:
                    seen.update(text.lower().split())
                    seen.add(END)
            for block, (counted, seen) in found.items():
                words = [*counted, *(w for w in seen if w not in counted)]
                counts = np.zeros(len(words), np.int64)
                counts[: len(counted)] = list(counted.values())
                bucket = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), np.int64, len(words))
                order = np.argsort(bucket, kind="stable")
                start = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                rows = []
                for a, n in zip(start, np.diff(start, append=len(order)), strict=True):
                    at = order[a : a + n]
                    rows.append((bucket[order[a]], block, _packed(b" ".join(words[i] for i in at)), _packed(counts[at])))
                yield _record(rows, names, types)

    return docs.mapInArrow(run, "bucket int, block long, words binary, counts binary")


def answered(requests: DataFrame, tokenizer: str, how: Scoring) -> DataFrame:
    """Replies (block, words, counts over the corpus) and, with block null, a bucket's totals.

    Totals: ``n`` training tokens, ``distinct`` of them, ``counts`` of every subword id.
    """
    names = ["block", "words", "counts", "n", "distinct"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def run(table: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        for words, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
            for w, n in zip(_open(words).split(b" "), np.frombuffer(_open(counts), np.int64).tolist(), strict=True):
                total[w] = total.get(w, 0) + n
        learned = [(w, n) for w, n in total.items() if n]
        subwords = np.zeros(how.subwords, np.int64)
        texts = [w for w, _ in learned if w != END]
        for a in range(0, len(texts), 100_000):
            ids, begin = subword_ids(tokenizer, texts[a : a + 100_000])
            times = np.array([total[w] for w in texts[a : a + 100_000]], np.int64)
            np.add.at(subwords, ids, np.repeat(times, np.diff(begin)))
        subwords[how.end_id] += total.get(END, 0)
        rows = [(None, None, _packed(subwords), sum(n for _, n in learned), len(learned))]
        for block, words in zip(table.column("block").to_pylist(), table.column("words").to_pylist(), strict=True):
            counts = np.fromiter(map(total.__getitem__, _open(words).split(b" ")), np.int64)
            rows.append((block, words, _packed(counts), None, None))
        return pa.Table.from_batches([_record(rows, names, types)])

    return requests.groupBy("bucket").applyInArrow(run, "block long, words binary, counts binary, n long, distinct long")


def subword_counts(replies: DataFrame, how: Scoring) -> np.ndarray:
    """Occurrences of each subword id in the training texts; as many rows as ids."""

    def run(batches):
        total = np.zeros(how.subwords, np.int64)
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                total += np.frombuffer(_open(counts), np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["id", "n"])

    parts = replies.where("block IS NULL").select("counts").mapInArrow(run, "id int, n long")
    table, total = parts.groupBy("id").agg(F.sum("n").alias("n")).toArrow(), np.zeros(how.subwords, np.int64)
    total[table.column("id").to_numpy()] = table.column("n").to_numpy()
    return total


# ---- training ----------------------------------------------------------------------------------


def training_windows(docs: DataFrame, tokenizer: str, start: int, how: Scoring) -> DataFrame:
    """Different windows and how often each occurs: the id before it, its ids. Every token of every training text is in one window."""
    longest = how.shape.window

    def pieces(text: bytes) -> list[bytes]:
        if len(text) <= PART:
            return [text.lower()]
        words = text.lower().split()
        return [b" ".join(words[a : a + PART]) for a in range(0, len(words), PART)]

    def run(batches):
        table, end = word_codes(tokenizer, MOST_WORDS), np.array([how.end_id], np.uint16)
        for batch in bounded(batches):
            texts = [pieces(text) for text in raw(batch.column("text"))]
            coded, held, lengths = table.encode([piece for own in texts for piece in own]), [], []
            for own in texts:
                spelled = [next(coded)[0].astype(np.uint16) for _ in own]
                held += [*spelled, end]
                lengths.append(sum(map(len, spelled)) + 1)
            ids, n = np.concatenate(held), np.array(lengths)
            parts = -(-n // longest)
            first = np.cumsum(parts) - parts
            starts = np.repeat(np.cumsum(n) - n - first * longest, parts) + np.arange(parts.sum()) * longest
            before = ids[starts - 1].astype(np.int32)
            before[first] = start
            ends = np.append(starts[1:], len(ids))
            for a in range(0, len(starts), WINDOWS):
                own, last = starts[a : a + WINDOWS], ends[a : a + WINDOWS][-1]
                places = (np.append(own, last) - own[0]).astype(np.int32) * 2  # bytes
                buffers = [None, pa.py_buffer(places), pa.py_buffer(ids[own[0] : last])]
                windows = pa.Array.from_buffers(pa.binary(), len(own), buffers)
                yield pa.RecordBatch.from_arrays([pa.array(before[a : a + WINDOWS]), windows], ["before", "ids"])

    each = docs.where("learn").mapInArrow(run, "before int, ids binary")
    return each.groupBy("before", "ids").agg(F.count("*").alias("times"))


def batches_of(table: pa.Table, how: Scoring) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of a shard in the order of their hashes, as inputs, targets and times a place counts."""
    before, times = table.column("before").to_numpy(), table.column("times").to_numpy()
    held, longest = table.column("ids").combine_chunks().cast(pa.large_binary()), how.shape.window
    places = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1] // 2  # bytes
    ids = np.frombuffer(held.buffers()[2] or b"", np.uint16)
    order = np.lexsort((before, table.column("hash").to_numpy()))
    for a in range(0, len(order), how.train_batch):
        at = order[a : a + how.train_batch]
        own = places[at, None] + np.arange(longest)
        inside = own < places[at + 1, None]
        targets = np.where(inside, ids[np.minimum(own, len(ids) - 1)], np.uint16(0))
        inputs = np.concatenate([before[at, None].astype(np.uint16), targets[:, :-1]], axis=1)
        yield inputs, targets, np.where(inside, times[at, None], 0)


def fit(windows: DataFrame, classes: Classes, how: Scoring) -> list[np.ndarray]:
    """Weights after all rounds; they depend on the windows, not on how rows are dealt over tasks.

    A window's hash says its shard and its place there. Shards are of about one size whatever the number of
    tasks. What a shard learned is added up in whole numbers, whose sum does not depend on the order.
    """
    weights, d = attention.start_weights(how.shape, classes), how.shape.width
    shards = -(-windows.count() // how.shard_windows)
    if not shards:
        return weights
    values = [f"v{i}" for i in range(d)]
    schema = ", ".join(["row int", "n long", *(f"{v} long" for v in values)])
    hash_ = F.xxhash64("before", "ids")
    # a shard is small but long to learn from, so tasks are not merged by their bytes, and few shards share one
    tasks = min(shards, 4 * int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = windows.withColumn("hash", hash_).withColumn("shard", F.pmod(hash_, F.lit(shards))).repartition(tasks, "shard")

    def learner(start: list[np.ndarray], rate: float) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            trained, seen, tokens, _ = attention.train(start, batches_of(table, how), classes, rate)
            moved = attention.as_rows(trained).astype(np.float64) - attention.as_rows(start)
            n = np.append(seen, np.full(len(moved) - len(seen), tokens))
            at = np.flatnonzero(n)
            steps = np.rint(moved[at] * how.grain).astype(np.int64) * n[at, None]
            return pa.table([pa.array(at, pa.int32()), pa.array(n[at]), *map(pa.array, steps.T)], ["row", "n", *values])

        return run

    for turn in range(how.rounds):
        learned = dealt.groupBy("shard").applyInArrow(learner(weights, how.rate / (1 + turn)), schema)
        sums = learned.groupBy("row").agg(*(F.sum(c).alias(c) for c in ["n", *values])).toArrow()
        rows, at = attention.as_rows(weights).astype(np.float64), sums.column("row").to_numpy()
        steps = np.stack([sums.column(v).to_numpy() for v in values], axis=1)
        rows[at] += steps / (sums.column("n").to_numpy()[:, None] * float(how.grain))
        weights = attention.from_rows(rows, weights)
    return weights


# ---- scoring -----------------------------------------------------------------------------------


def packed_docs(docs: DataFrame) -> DataFrame:
    """Documents on their way to their block: block, ids (-1: none), held_out flags, sizes, texts."""
    names = ["block", "ids", "null_ids", "sizes", "texts"]

    def run(batches):
        for batch in bounded(batches):
            blocks, ids, texts = batch.column("block").to_numpy(), batch.column("doc_id").to_pylist(), raw(batch.column("text"))
            rows = []
            for block in np.unique(blocks):
                own = np.flatnonzero(blocks == block).tolist()
                rows.append((
                    int(block),
                    np.array([ids[i] or 0 for i in own], np.int64).tobytes(),
                    np.array([ids[i] is None for i in own], np.uint8).tobytes(),
                    np.array([len(texts[i]) for i in own], np.int64).tobytes(),
                    _packed(b"".join(texts[i] for i in own)),
                ))
            yield _record(rows, names, [pa.int64(), *[pa.binary()] * 4])

    return docs.mapInArrow(run, "block long, ids binary, null_ids binary, sizes binary, texts binary")


def _texts(row: dict) -> tuple[list[int | None], list[bytes]]:
    ids = np.frombuffer(row["ids"], np.int64).tolist()
    none = np.frombuffer(row["null_ids"], np.uint8)
    ends = np.cumsum(np.frombuffer(row["sizes"], np.int64)).tolist()
    data = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, ends[-1]))
    return [None if n else i for i, n in zip(ids, none, strict=True)], [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def score(docs: DataFrame, held_out: Column, tokenizer: str, how: Scoring = Scoring()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score for every row."""
    plain = narrow(docs, (~held_out).alias("learn"))
    total, rows = plain.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    per_block = max(1, int(how.block_bytes * rows / max(total or 0, how.block_bytes)))
    blocks = 1 + (total or 0) // how.block_bytes
    block = F.coalesce(F.floor(F.col("doc_id") / per_block), F.pmod(F.xxhash64("text"), F.lit(blocks))).cast("long")
    dealt = plain.withColumn("block", block)
    buckets = 1 + (total or 0) // how.bucket_bytes
    replies = staged(answered(word_requests(dealt, buckets, how), tokenizer, how), "word-counts")
    n, distinct = replies.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    classes = Classes(subword_counts(replies, how), how.shape)
    windows, path = staged_at(training_windows(dealt, tokenizer, classes.start, how), "windows")
    weights = fit(windows, classes, how)
    drop_staged(docs.sparkSession, path)
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [*[pa.int64()] * 4, *[pa.float64()] * 2]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        counts: dict[bytes, int] = {}
        for words, found in zip(right.column("words").to_pylist(), right.column("counts").to_pylist(), strict=True):
            counts.update(zip(_open(words).split(b" "), np.frombuffer(_open(found), np.int64).tolist(), strict=True))
        number = {w: i for i, w in enumerate(counts)}
        times = np.fromiter(counts.values(), np.int64, len(counts))
        base = np.log10((times + 0.1) / (n + 0.1 * (distinct + 1)))
        ids, begin = subword_ids(tokenizer, [w if w != END else b"" for w in counts])
        sizes, end = np.diff(begin), number.get(END)
        known = how.word_share * times / max(1, n)
        out = []
        for row in left.to_pylist():
            doc_ids, texts = _texts(row)
            for a in range(0, len(texts), 64):
                held, words = [], []
                for text in texts[a : a + 64]:
                    at = np.fromiter(map(number.__getitem__, text.lower().split()), np.int64)
                    size = sizes[at]
                    place = np.repeat(begin[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    held.append(np.append(ids[place], how.end_id))
                    words.append(np.append(at, end))
                logs = attention.log10_scores(weights, held, classes, how.shape)
                every = np.concatenate(words)
                width = np.where(every == end, 1, sizes[every])
                attended = np.where(width > 0, np.add.reduceat(logs, np.cumsum(width) - width), 0)
                mixed = np.log10(known[every] + (1 - how.word_share) * 10.0 ** np.maximum(attended, -300))
                first = np.cumsum([0, *map(len, words)])[:-1]
                columns = (np.add.reduceat(base[every], first), np.add.reduceat(mixed, first), np.add.reduceat((times[every] > 0).astype(np.int64), first))
                for doc_id, own, b, m, k in zip(doc_ids[a : a + 64], words, *(c.tolist() for c in columns), strict=True):
                    out.append((doc_id, len(own), k, n, b, m))
        return pa.Table.from_batches([_record(out, names, types)])

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    asked = replies.where("block IS NOT NULL").select("block", "words", "counts")
    return packed_docs(dealt).groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(run, schema)


def op8_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    held_out = remainder(F.col("doc_id"), 10) == 0
    scored = score(documents(spark, sf_dir), held_out, public_tokenizers.path("word_bpe_49k.json"))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

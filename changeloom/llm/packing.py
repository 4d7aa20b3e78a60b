"""Packing: documents in their stored order, cut into sequences of at most ``capacity`` tokens.

Every task takes its documents as one stream of tokens and chooses the cuts by dynamic programming.
A cut may lie after a document (free), after a sentence, or, inside a sentence of unusual length, every
``stride`` tokens; a window costs its padding and the penalty of the cut at its end. With boundaries
p(0) < p(1) < ... the cost f(j) = penalty(j) + capacity - p(j) + min(f(i) + p(i)) over p(j) - p(i) <= capacity, and
since the range of i only moves forward, a queue kept monotone gives each minimum in constant time.
What is left of a block goes into the next one. The end of a task's stream is cut into powers of two,
which need no padding, if that costs less than padding it.

Words between ASCII white space are tokenised apart, for white space is dropped anyway, and each
distinct word once while it is remembered; a text that spells a special token is looked up as it is
written, for only the exact spelling is one. Memory is bounded by the remembered words, one block of
tokens and the longest document.

Defined results: a null or empty text is a document of the end id alone; repeated rows are packed
each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from changeloom.llm.common import bounded, documents, narrow, raw

SENTENCE_ENDS = (b".", b"!", b"?", b".'", b'."', b"!\"", b"?\"")
#: a letter before one of these marks is parted from it, as the tokeniser does
IS_MARK = np.isin(np.arange(256), list(b".,;:!?"))
IS_LETTER = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz"))
WORD_END = "</w>"  # of the last token of a word, in the tokeniser's own spelling
TOGETHER = 500  # words of nothing but letters that are tokenised as one text


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    end_id: int = 2
    block: int = 1 << 20  # tokens planned at once
    sentence_penalty: int = 4
    hard_penalty: int = 16
    stride: int = 16  # between cuts inside a sentence longer than four strides
    most_words: int = 1_000_000  # distinct words remembered


class _Numbered(dict):
    """Numbers words as they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class WordCodes:
    """Token ids of texts, by way of a table of the words seen so far.

    The tokeniser lower-cases A-Z anyway and parts a letter from a mark behind it, so words are lower-cased
    and parted before they are looked up: a word is tokenised once in all its spellings.
    """

    def __init__(self, path: str, most_words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for every core
        self.tokenizer, self.most = Tokenizer.from_file(path), most_words
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith(WORD_END)
        self.known, self.seen = _Numbered(), np.zeros(0, np.int32)
        self.flat, self.starts = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)
        self.ends_sentence = np.zeros(0, bool)

    def forget(self) -> None:
        """Keep the words seen most often, half of the most that are remembered."""
        keep = np.sort(np.argsort(-self.seen, kind="stable")[: self.most // 2])
        n, begins = np.diff(self.starts)[keep], self.starts[:-1][keep]
        self.starts = np.concatenate([[0], np.cumsum(n)])
        self.flat = self.flat[np.repeat(begins - self.starts[:-1], n) + np.arange(self.starts[-1])]
        words = list(self.known)
        self.known = _Numbered(zip((words[i] for i in keep.tolist()), range(len(keep))))
        self.ends_sentence, self.seen = self.ends_sentence[keep], np.zeros(len(keep), np.int32)

    def words(self, text: bytes) -> list[bytes]:
        """What of a text is looked up, in order; white space is dropped."""
        low = text.lower()
        if any(t in low for t in self.special):  # only its exact spelling is a special token
            return text.split()
        at = self.parted(low)
        return (np.insert(np.frombuffer(low, np.uint8), at, 32).tobytes() if len(at) else low).split()

    def parted(self, low: bytes) -> np.ndarray:
        """Places of the marks that follow a letter."""
        letters = np.frombuffer(low, np.uint8)
        return np.flatnonzero(IS_MARK[letters[1:]] & IS_LETTER[letters[:-1]]) + 1

    def coded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        texts = [w.decode() for w in words]
        plain = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        lengths = np.zeros(len(texts), np.int64)
        own: dict[int, np.ndarray] = {}
        joined, at = [], np.flatnonzero(plain)
        for part in (at[i : i + TOGETHER] for i in range(0, len(at), TOGETHER)):
            ids = self._ids([" ".join([texts[i] for i in part])])[0]
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                lengths[part] = np.diff(ends, prepend=0)
                joined.append(ids)
            else:  # a letter whose lower case is more than a letter
                plain[part] = False
        other = np.flatnonzero(~plain)
        own = dict(zip(other.tolist(), self._ids([texts[i] for i in other]), strict=True))
        lengths[other] = [len(ids) for ids in own.values()]
        out = np.zeros(int(lengths.sum()), np.uint32)
        begins = np.cumsum(lengths) - lengths
        if joined:
            n = lengths[plain]
            skipped = np.repeat(begins[plain] - np.cumsum(n) + n, n)
            out[skipped + np.arange(len(skipped))] = np.concatenate(joined)
        for i, ids in own.items():
            out[begins[i] : begins[i] + len(ids)] = ids
        return out, lengths

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, np.uint32) for c in coded]

    def learn(self, words: list[bytes]) -> None:
        new, lengths = self.coded(words)
        used = int(self.starts[-1])
        if used + len(new) > len(self.flat):
            grown = np.zeros(2 * (used + len(new)), np.uint32)
            grown[:used] = self.flat[:used]
            self.flat = grown
        self.flat[used : used + len(new)] = new
        self.starts = np.concatenate([self.starts, used + np.cumsum(lengths)])
        self.ends_sentence = np.concatenate([self.ends_sentence, [w.endswith(SENTENCE_ENDS) for w in words]])

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids, and after how many of them a sentence ends."""
        if len(self.known) > self.most:
            self.forget()
        before = len(self.known)
        number = self.known.__getitem__
        numbered = [np.fromiter(map(number, self.words(text)), np.int32) for text in texts]
        if len(self.known) > before:
            self.learn(list(islice(self.known, before, None)))
        self.seen = np.append(self.seen, np.zeros(len(self.known) - before, np.int32))
        self.seen += np.bincount(np.concatenate(numbered), minlength=len(self.known)).astype(np.int32)
        lengths = np.diff(self.starts)
        for at in numbered:
            n = lengths[at]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(n) else 0
            ids = self.flat[np.repeat(self.starts[at] - ends + n, n) + np.arange(total)]
            yield ids, ends[self.ends_sentence[at]]


@lru_cache(maxsize=1)
def word_codes(path: str, most_words: int) -> WordCodes:
    """One table for each Python worker, kept from task to task."""
    return WordCodes(path, most_words)


def boundaries(lengths: list[int], sentences: list[np.ndarray], p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream of documents may be cut, first 0 and last its end, and what each cut costs."""
    at, cost, begin = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
    for n, inside in zip(lengths, sentences, strict=True):
        own = np.unique(np.append(inside[(inside > 0) & (inside < n)], n))
        gaps = np.diff(own, prepend=0)
        price = np.full(len(own), p.sentence_penalty)
        if (long := np.flatnonzero(gaps > 4 * p.stride)).size:
            extra = np.concatenate([np.arange(own[i] - gaps[i] + p.stride, own[i], p.stride) for i in long])
            order = np.argsort(both := np.append(own, extra), kind="stable")
            price = np.append(price, np.full(len(extra), p.hard_penalty))[order]
            own = both[order]
        price[-1] = 0
        at.append(begin + own)
        cost.append(price)
        begin += n
    return np.concatenate(at), np.concatenate(cost)


def tail(length: int, p: Packing) -> tuple[int, list[int]]:
    """Cheapest way to end a stream: its cost, and the lengths of the last sequences."""
    bits = [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]
    padded, split = p.capacity - length, p.hard_penalty * (len(bits) - 1)
    return (split, bits) if split <= padded else (padded, [length])


def cuts(at: np.ndarray, cost: np.ndarray, p: Packing, last: bool) -> list[int]:
    """Ends of the windows. Unless it is the last block, the windows may end before the stream does."""
    pos, price, n = at.tolist(), cost.tolist(), len(at)
    total, before = [0] * n, [0] * n
    queue: deque[int] = deque()
    low = [0] * n  # total + position
    for j in range(1, n):
        i = j - 1
        key = low[i]
        while queue and low[queue[-1]] >= key:
            queue.pop()
        queue.append(i)
        floor = pos[j] - p.capacity
        while pos[queue[0]] < floor:
            queue.popleft()
        best = queue[0]
        before[j] = best
        total[j] = price[j] + p.capacity - pos[j] + low[best]
        low[j] = total[j] + pos[j]
    end = pos[-1]
    near = int(np.searchsorted(at, end - p.capacity))
    if last:
        open_at = [j for j in range(near, n - 1)] or [n - 1]
        j = min(open_at, key=lambda k: total[k] + (tail(end - pos[k], p)[0] if pos[k] < end else 0))
        rest = tail(end - pos[j], p)[1] if pos[j] < end else []
        found = (pos[j] + np.cumsum(rest)).tolist()
    else:
        j = min(range(near, n), key=lambda k: total[k] + pos[k])
        found = []
    path = []
    while j:
        path.append(pos[j])
        j = before[j]
    return path[::-1] + found


class Packer:
    """Takes documents in order, gives pieces: (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, p: Packing, first_sequence: int):
        self.p, self.sequence = p, first_sequence
        self.docs: list[tuple[int | None, np.ndarray, np.ndarray, int]] = []  # id, ids left, sentence ends, start
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, np.append(ids, np.uint32(self.p.end_id)), sentences, 0))
        self.size += len(ids) + 1
        if self.size >= self.p.block:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        lengths = [len(ids) - start for _, ids, _, start in self.docs]
        at, cost = boundaries(lengths, [s - start for _, _, s, start in self.docs], self.p)
        begins = np.cumsum([0, *lengths]).tolist()
        k = done = 0
        for end in cuts(at, cost, self.p, last):
            opened = done
            while done < end:
                doc_id, ids, _, start = self.docs[k]
                stop, a = min(end, begins[k + 1]), start + done - begins[k]
                yield doc_id, a, ids[a : a + stop - done], len(ids), self.sequence, done - opened
                done = stop
                k += done == begins[k + 1]
            self.sequence += 1
        left = self.docs[k:]
        if left:
            doc_id, ids, sentences, start = left[0]
            left[0] = (doc_id, ids, sentences, start + done - begins[k])
        self.docs, self.size = left, self.size - done


def pack(docs: DataFrame, tokenizer_file: str, packing: Packing = Packing(), with_ids: bool = True) -> DataFrame:
    """One row per piece; ``ids`` are its tokens. A sequence is all pieces with its ``sequence_id``."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches):
        codes = word_codes(tokenizer_file, packing.most_words)
        packer = Packer(packing, TaskContext.get().partitionId() << 40)

        def table(rows):
            columns = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([len(r[2]) for r in rows], pa.int64()),
                pa.array([zlib.crc32(r[2].astype("<u4").tobytes()) for r in rows], pa.int64()),
                *(pa.array([r[i] for r in rows], pa.int64()) for i in (3, 4, 5)),
            ]
            if with_ids:
                columns.append(pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in bounded(batches):
            coded = codes.encode(raw(batch.column("text")))
            rows = [
                piece
                for doc_id, (ids, ends) in zip(batch.column("doc_id").to_pylist(), coded, strict=True)
                for piece in packer.add(doc_id, ids, ends)
            ]
            if rows:
                yield table(rows)
        if rows := list(packer.flush(True)):
            yield table(rows)

    types = ["long"] * 7 + ["array<int>"] * with_ids
    return narrow(docs).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)

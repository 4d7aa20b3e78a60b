"""Quality rules: counts, and divergence from what text of a known language looks like.

For every language (``lang``, not null) the whole corpus gives two references: the shares of character
classes, and the shares of its most common words with one share for all others. A document is held
against each language's references by Jensen-Shannon distance and judged by the nearest one, so
its own label is never needed. A histogram of a short document says little: below the minimum
lengths it isn't judged. What fails a base rule isn't kept; the rest is kept unless it is too far away.

Words are runs of bytes other than ASCII white space; letters A-Z count as a-z in common words.

Defined results: a null or empty text has zero counts, fails the base rule on length and is not
kept; repeated rows give repeated results; an empty table gives an empty table; if no row names a
language there is no reference and only the base rules decide; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import bounded, documents, narrow, raw, staged

SYMBOLS = b"#*$%&|<>"
CLASSES = 8
MOST_KEYS = 300_000  # words held by one task before it hands its counts on


@dataclass(frozen=True)
class Limits:
    common_words: int = 64  # per language
    least_chars: int = 200
    least_words: int = 80
    most_char_distance: float = 0.30
    most_word_distance: float = 0.50


def _class_table() -> np.ndarray:
    """Class of each byte of UTF-8: other, a-z, A-Z, digit, white space, sentence mark, symbol, above ASCII.

    Bytes that continue a character get ``CLASSES`` and are not counted.
    """
    table = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            table[b] = 7
        elif b >= 0x80:
            table[b] = CLASSES
        elif c.isalpha():
            table[b] = 1 if c.islower() else 2
        elif c.isdigit():
            table[b] = 3
        elif c in " \t\n\v\f\r":
            table[b] = 4
        elif c in ".,;:!?'\"()-":
            table[b] = 5
        elif b > 32:
            table[b] = 6
    return table


CLASS_OF = _class_table()
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def char_classes(text: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=CLASSES + 1)[:CLASSES]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.zeros(n, bool)
    at = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, len(windows)))
    hit[at] = hit[at + 1] = hit[at + 2] = True
    return int(hit.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    return len(lines) - len(set(lines))


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, duplicate lines, repeated words."""
    data = np.frombuffer(text, np.uint8)
    characters = int(((data & 0xC0) != 0x80).sum()) - int(np.isin(data, (32, 9, 10, 11, 12, 13)).sum())
    return len(words), characters, int(_SYMBOL[data].sum()), duplicate_lines(text), repeated_words(words)


def language_counts(docs: DataFrame) -> DataFrame:
    """lang, kind ('class' or 'word'), key, n: over every document that names its language."""

    def run(batches):
        names = ["lang", "kind", "key", "n"]
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def emit():
            for lang, histogram in classes.items():
                yield part(lang, "class", [b"%d" % k for k in range(CLASSES)], histogram.tolist())
            classes.clear()
            while words:
                lang, counted = words.popitem()
                pairs = iter(counted.items())
                while some := list(islice(pairs, 50_000)):
                    yield part(lang, "word", *map(list, zip(*some, strict=True)))

        def part(lang, kind, keys, counts):
            same = [pa.array([value] * len(keys), pa.string()) for value in (lang, kind)]
            return pa.RecordBatch.from_arrays([*same, pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], names)

        for batch in bounded(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), raw(batch.column("text")), strict=True):
                words.setdefault(lang, Counter()).update(text.lower().split())
                classes[lang] = classes.get(lang, 0) + char_classes(text)
            if sum(map(len, words.values())) > MOST_KEYS:
                yield from emit()
        yield from emit()

    known = narrow(docs, F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL")
    parts = known.mapInArrow(run, "lang string, kind string, key binary, n long")
    return parts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, limits: Limits) -> list[tuple[str, np.ndarray, dict[bytes, int], np.ndarray]]:
    """Per language: class shares, index of each common word, word shares with the rest last.

    Only class counts, common words and totals reach the driver, ``common_words + CLASSES`` rows a
    language.
    """
    counts = staged(language_counts(docs), "language-counts")
    words = counts.where("kind = 'word'")
    order = W.partitionBy("lang").orderBy(F.desc("n"), "key")
    # the rank limit is applied in every task before the shuffle, so few rows of a language meet
    common = words.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limits.common_words)
    totals = {r.lang: r.total for r in words.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    rows = counts.where("kind = 'class'").unionByName(common.drop("rank")).collect()
    found = []
    for lang in sorted({r.lang for r in rows}):
        classes, common, everything = np.zeros(CLASSES), {}, totals.get(lang, 0)
        for r in rows:
            if r.lang == lang and r.kind == "class":
                classes[int(r.key)] = r.n
            elif r.lang == lang:
                common[bytes(r.key)] = r.n
        ordered = sorted(common, key=lambda w: (-common[w], w))
        shares = np.array([common[w] for w in ordered] + [everything - sum(common.values())], float)
        if classes.sum() and shares.sum():
            found.append((lang, classes / classes.sum(), {w: i for i, w in enumerate(ordered)}, shares / shares.sum()))
    return found


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log2(np.where(x > 0, x, 1))


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance (root of the divergence to base 2), from 0 to 1, along the last axis."""
    inside = (_x_log_x(p) + _x_log_x(q)) / 2 - _x_log_x((p + q) / 2)
    return np.sqrt(np.maximum(0, inside.sum(axis=-1)))


class Nearest:
    """Distances of a text to the nearest language; 0 where the text is too short to judge."""

    def __init__(self, known, limits: Limits):
        self.limits, self.known = limits, bool(known)
        if known:
            self.classes = np.stack([ref for _, ref, _, _ in known])
            self.words = sorted({w for _, _, index, _ in known for w in index})
            width = max(len(ref) for *_, ref in known)
            self.shares = np.zeros((len(known), width))
            # where a language has fewer common words, its spare places point at a count that stays 0
            self.at = np.full((len(known), width - 1), len(self.words))
            place = {w: i for i, w in enumerate(self.words)}
            for row, (_, _, index, ref) in enumerate(known):
                self.at[row, : len(index)] = [place[w] for w in sorted(index, key=index.get)]
                self.shares[row, : len(index)], self.shares[row, -1] = ref[:-1], ref[-1]

    def __call__(self, text: bytes, words: list[bytes]) -> tuple[float, float]:
        by_class = by_word = 0.0
        classes = char_classes(text)
        if self.known and (n := classes.sum()) >= self.limits.least_chars:
            by_class = float(jensen_shannon(classes / n, self.classes).min())
        if self.known and len(words) >= self.limits.least_words:
            times = Counter(words)
            counts = np.array([times.get(w, 0) for w in self.words] + [0]) / len(words)
            found = counts[self.at]
            found = np.concatenate([found, 1 - found.sum(axis=1, keepdims=True)], axis=1)
            by_word = float(jensen_shannon(found, self.shares).min())
        return by_class, by_word


def _verdict(text: bytes, nearest: Nearest, limits: Limits) -> tuple:
    """The base counts, both distances, base_failed and kept."""
    words = text.split()
    base = base_counts(text, words)
    failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
    by_class, by_word = nearest(text, text.lower().split())
    far = by_class > limits.most_char_distance or by_word > limits.most_word_distance
    return *base, by_class, by_word, failed, not failed and not far


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the base counts, both distances, base_failed and kept, for every row."""
    nearest = Nearest(references(docs, limits), limits)
    kinds = [pa.int64()] * 6 + [pa.float64()] * 2 + [pa.bool_()] * 2
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names += ["char_distance", "word_distance", "base_failed", "kept"]

    def run(batches):
        for batch in bounded(batches):
            ids, texts = batch.column("doc_id").to_pylist(), raw(batch.column("text"))
            rows = [(i, *_verdict(text, nearest, limits)) for i, text in zip(ids, texts, strict=True)]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    types = ["long"] * 6 + ["double"] * 2 + ["boolean"] * 2
    return narrow(docs).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))


def good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows, with all their columns, that the rules keep; judged where they are, without a join."""
    nearest = Nearest(references(docs, limits), limits)

    def run(batches):
        for batch in bounded(batches):
            kept = [_verdict(text, nearest, limits)[-1] for text in raw(batch.column("text"))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).drop("char_distance", "word_distance")

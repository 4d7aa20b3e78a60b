"""Best-fit packing, and the words both packings look up."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from changeloom.llm.bestfit import BestFit, Bins, best_fit, fitted
from changeloom.llm.packing import WordCodes
from changeloom.llm.queries import QUERIES, importable
from tests.llm import cases

WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_bins(sizes, capacity, most):
    """The same by a scan over a list of the open bins: [number, free]."""
    opened, out, number = [], [], 0
    for size in sizes:
        closed = []
        fitting = [b for b in opened if b[1] >= size]
        if fitting:
            bin_ = min(fitting, key=lambda b: b[1])
        else:
            if len(opened) == most:
                full = min(opened, key=lambda b: b[1])
                opened.remove(full)
                closed.append(full[0])
            bin_ = [number, capacity]
            opened.append(bin_)
            number += 1
        out.append((bin_[0], capacity - bin_[1], closed))
        opened.remove(bin_)  # the last to get this free space
        bin_[1] -= size
        if bin_[1]:
            opened.append(bin_)
        else:
            closed.append(bin_[0])
    return out


@pytest.mark.parametrize("most", [1, 3, 64])
def test_bins_are_those_of_a_scan(most):
    rng = random.Random(most)
    for _ in range(50):
        sizes = [rng.choice([1, 2, 3, 7, 20, 40, rng.randint(1, 64)]) for _ in range(200)]
        bins = Bins(64, most)
        assert [bins.place(n) for n in sizes] == plain_bins(sizes, 64, most)


def test_open_rows_are_bounded():
    fit, rng = BestFit(capacity=50, open_bins=4), random.Random(2)
    docs = [(i, np.arange(rng.randint(1, 120), dtype=np.uint32)) for i in range(500)]
    held, most = set(), 0
    for *_, number, _, left_open in fitted(iter(docs), fit, 0):
        held.add(number) if left_open else held.discard(number)
        most = max(most, len(held))
    assert most <= 4


def check(pieces, wanted, capacity, end_id):
    """Rows with ids against the ids of each document, as a multiset of (id, ids)."""
    by_sequence = {}
    for r in pieces:
        assert r.length == len(r.ids) >= 1
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.start == r.piece * capacity
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    parts = Counter()
    for doc_id, ids in wanted:
        ids = [*ids, end_id]
        parts.update((doc_id, i // capacity, tuple(ids[i : i + capacity])) for i in range(0, len(ids), capacity))
    assert Counter((r.doc_id, r.piece, tuple(r.ids)) for r in pieces) == parts
    return len(by_sequence)


@cases.both
def test_every_id_lies_in_one_piece(spark, shape):
    importable(spark)
    plain = Tokenizer.from_file(WORDS)
    wanted = [(r[0], plain.encode(r[1] or "", add_special_tokens=False).ids) for r in cases.ROWS]
    for fit in (BestFit(), BestFit(capacity=64, open_bins=2, together=1)):
        pieces = best_fit(shape(cases.documents(spark)), WORDS, fit).collect()
        check(pieces, wanted, fit.capacity, fit.end_id)


def test_little_is_wasted_over_many_tasks(spark, sf_dir):
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plain = Tokenizer.from_file(WORDS)
    wanted = [(r.doc_id, plain.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    pieces = best_fit(docs.repartition(24), WORDS).collect()
    used = check(pieces, wanted, 4096, 1)
    tokens = sum(len(ids) + 1 for _, ids in wanted)
    assert used <= 1.05 * tokens / 4096 + 2


def test_query_and_empty_table(spark, sf_dir, tmp_path):
    found = QUERIES["op13_best_fit"](spark, sf_dir)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.where("length > 4096 OR offset + length > 4096").count() == 0
    folder = cases.write(cases.documents(spark, []), tmp_path)
    assert QUERIES["op13_best_fit"](spark, folder).collect() == []


ODD = [
    "<|ENDOFTEXT|> a", "x<|endoftext|>y.Z", "<|StartOfText|>", "İstanbul. İx ŉ ǰ ſt ß ΑΣ ΟΔΟΣ", "a.b,c;d:e!f?g", "...a...b", "é.É.x",
    "don't. it's, 're", "Å.á.", "a\x1cb\x85c d.e", "1.2,3", "½ ² Ⅷ", "ﬁ.ﬂ,", "a.̸b", "x;̸", "K.Å", "", " ",
]


@pytest.mark.parametrize("most", [4, 1_000_000])
def test_words_have_the_ids_the_tokeniser_gives(most):
    rng = random.Random(1)
    alphabet = "aAbZ.,;:!?'\" \n\t1é—́İ<|>\x1d sStTrReElLdDmM"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]
    plain, codes = Tokenizer.from_file(WORDS), WordCodes(WORDS, most)
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        for text, (ids, ends) in zip(part, codes.encode([t.encode() for t in part]), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text
            assert all(0 < e <= len(ids) for e in ends)

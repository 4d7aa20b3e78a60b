"""Operators whose result depends on the whole table, held against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.llm import attention, exponents, hamming, repeats, scoring, shards, simhash
from changeloom.llm.common import remainder
from tests.llm.cases import ROWS, both, documents

WORDS = public_tokenizers.path("word_bpe_49k.json")


# near duplicates


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("abC \n"), max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 4) % 2**64 == brute_fingerprint(text)


def test_fingerprint_of_a_long_text():
    text = ROWS[6][1]
    assert simhash.fingerprint(text.encode(), 4) % 2**64 == brute_fingerprint(text)


def brute_components(codes, radius):
    ids = sorted(codes)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            least = min(root[j] for j in ids if (codes[i] ^ codes[j]).bit_count() <= radius)
            changed |= least != root[i]
            root[i] = least
    return root


def test_components_over_chains_and_copies(spark):
    draw = random.Random(5)
    codes, n = {}, 0
    for _ in range(12):  # chains: each code two bits from the one before
        code = draw.getrandbits(64)
        for _ in range(draw.randint(1, 9)):
            n += 1
            codes[n * 7 % 1009] = code
            code ^= 1 << draw.randrange(64) | 1 << draw.randrange(64)
    codes[2000] = codes[7]
    signed = [(i, c - 2**64 if c >> 63 else c) for i, c in codes.items()]
    classes = spark.createDataFrame(signed, "node long, fp long").groupBy("fp").agg(F.min("node").alias("node"))
    packed, chunks = simhash.tiles(classes, 5)  # many small tiles
    found = simhash.components(simhash.forests(simhash.tile_pairs(packed, chunks, 4), 4))
    linked = {r.node: r.root for r in found.collect()}
    wanted = brute_components(codes, 4)
    for row in classes.collect():
        assert linked.get(row.node, row.node) == wanted[row.node]


@both
def test_near_duplicates(spark, shape):
    rows = simhash.near_duplicates(shape(documents(spark))).collect()
    found = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(ROWS)
    assert found[1] == found[4] == 1 and found[2] == found[3] == found[9] == 2 and found[6] == 6
    kept = simhash.without_near_duplicates(shape(documents(spark)))
    assert kept.columns == shape(documents(spark)).columns
    ids = [r.doc_id for r in kept.collect()]
    # the row without an id is 0.8 like the first
    assert len(ids) == len(set(ids)) and {1, 2, 6} <= set(ids) and not {4, 3, 9, None} & set(ids)


def test_no_documents(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    only = documents(spark, [(None, "a b c", "en", "a", 0)])
    assert [r.component_id for r in simhash.near_duplicates(only).collect()] == [None]


# top k


def brute_top(codes, queries, k):
    return {q: sorted(((codes[q] ^ c).bit_count(), i) for i, c in codes.items())[:k] for q in queries}


@pytest.mark.parametrize("how", [hamming.Search(k=5), hamming.Search(k=5, code_block=16, query_block=4), hamming.Search(k=3, segments=8)])
def test_top_k_is_exact(spark, how):
    draw = random.Random(8)
    centres = [draw.getrandbits(64) for _ in range(4)]
    codes = {i: draw.choice(centres) ^ sum(1 << draw.randrange(64) for _ in range(i % 9)) % 2**64 for i in range(120)}
    codes |= {i: centres[0] for i in range(200, 230)}  # one common code
    rows = [(i, c - 2**64 if c >> 63 else c) for i, c in codes.items()]
    df = spark.createDataFrame([*rows, rows[3], (None, 5), (999, None)], "id long, code long")
    found = {}
    for r in hamming.top_k(df, F.col("id") % 20 == 0, how).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.distance, r.neighbor_id))
    wanted = brute_top(codes, [i for i in codes if i % 20 == 0], how.k)
    assert {q: [(d, i) for _, d, i in sorted(v)] for q, v in found.items()} == wanted


def test_sign_codes_and_few_rows(spark):
    rows = [(0, [1.0, -1.0, 2.0]), (1, [float("nan"), None, 1.0]), (2, []), (3, None), (20, [1.0, -1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>").select("id", hamming.sign_code(F.col("v")).alias("code"))
    assert {r.id: r.code for r in df.collect()} == {0: 5, 1: 4, 2: None, 3: None, 20: 5}
    found = hamming.top_k(df, F.col("id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.neighbor_id, r.distance) for r in found) == [
        (0, 1, 0, 0), (0, 2, 20, 0), (0, 3, 1, 1), (20, 1, 0, 0), (20, 2, 20, 0), (20, 3, 1, 1)
    ]
    assert hamming.top_k(df.where("false"), F.col("id") % 20 == 0).count() == 0


# repeats


def brute_kept(rows, length):
    first = {}
    for doc_id, text in sorted(r for r in rows if r[0] is not None):
        for k in range(len(text) - length + 1):
            first.setdefault(text[k : k + length], doc_id)
    kept = []
    for doc_id, text in rows:
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1) if doc_id is not None else ():
            if first[text[k : k + length]] < doc_id:
                gone[k : k + length] = b"\1" * length
        kept.append((doc_id, bytes(c for c, g in zip(text, gone, strict=True) if not g), len(bytes(gone).split(b"\0")) and sum(1 for p in bytes(gone).split(b"\0") if p)))
    return Counter(kept)


def test_repeats_are_those_of_brute_force(spark):
    draw = random.Random(4)
    passages = [bytes(draw.choice(b"abcde ") for _ in range(draw.randint(40, 130))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [bytes(draw.choice(b"abcdefgh ") for _ in range(draw.randint(0, 60))) for _ in range(4)]
        parts += draw.sample(passages, draw.randint(0, 3))
        draw.shuffle(parts)
        rows.append((i * 37 % 101, b"".join(parts)))
    rows += [(500, rows[5][1]), (501, b"ab" * 200), (502, b"ab" * 150), (503, b"a" * 49), (504, b"x" * 3000), (505, b"x" * 60)]
    docs = documents(spark, [(i, t.decode(), "en", "a", 0) for i, t in rows])
    for how in (repeats.Repeats(), repeats.Repeats(block_bytes=4000, bucket_anchors=16)):
        found = Counter((r.doc_id, bytes(r.kept), len(r.starts)) for r in repeats.remove_repeats(docs, how).collect())
        assert found == brute_kept(rows, 50)


@both
def test_repeats_of_odd_rows(spark, shape):
    docs = shape(documents(spark))
    rows = [(i, (t or "").encode()) for i, t, *_ in ROWS]
    found = Counter((r.doc_id, bytes(r.kept), len(r.starts)) for r in repeats.remove_repeats(docs).collect())
    assert found == brute_kept(rows, 50)
    left = repeats.without_repeats(docs)
    assert left.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    wanted = sorted(((i, t if t is None else k.decode(errors="ignore")) for (i, t, *_), k in zip(
        ROWS, [next(k for d, k, _ in brute_kept(rows, 50) if d == i) for i, *_ in ROWS], strict=True)), key=str)
    assert texts == wanted


def test_no_repeats_in_an_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).count() == 0


def test_maximal_repeat_groups_have_all_occurrences():
    strings = [b"xabcdey", b"zabcdew", b"qbcdeab"]
    groups = {(n, frozenset(g)) for n, g in repeats.repeat_groups(strings, 2)}
    assert (5, frozenset({(0, 1), (1, 1)})) in groups  # abcde
    assert (4, frozenset({(0, 2), (1, 2), (2, 1)})) in groups  # bcde, before it a and q
    assert (2, frozenset({(0, 1), (1, 1), (2, 5)})) in groups  # ab
    assert not any(n == 3 and (0, 3) in g for n, g in groups)  # cde always follows b
    assert {(n, frozenset(g)) for n, g in repeats.repeat_groups(strings, 2, most=4)} == groups


# sharding


@both
def test_shards(spark, shape):
    draw = random.Random(2)
    docs = shape(documents(spark, [*ROWS, *((100 + i, "x" * draw.randint(0, 400), "en", "a", 0) for i in range(300))]))
    placed, versions = shards.shard(docs, 4)
    rows = placed.collect()
    assert len(rows) == len(ROWS) + 300
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    for part in by_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    for r in rows:
        text = dict((i, t) for i, t, *_ in ROWS).get(r.doc_id, "" if r.doc_id is None else None)
        if r.doc_id in (1, 5, 7):
            assert r.size == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
    slots = {r.virtual_slot: r.shard for r in versions.where("version = 1").collect()}
    assert len(slots) == shards.SLOTS and versions.count() == 2 * shards.SLOTS
    assert all(slots[r.virtual_slot] == r.shard for r in rows)


def test_rebalancing_evens_bytes_and_moves_little(spark):
    draw = random.Random(6)
    loads = [(s, 5000 if s % 4 == 0 and s < 40 else draw.randint(0, 20), 1) for s in range(shards.SLOTS)]
    loads_df = spark.createDataFrame(loads, "virtual_slot int, bytes long, rows long")
    old = shards.first_map(spark, 4)
    new = {r.virtual_slot: r.shard for r in shards.rebalance(old, loads_df, 4).collect()}
    filled = Counter()
    for s, n, _ in loads:
        filled[new[s]] += n
    assert len(new) == shards.SLOTS and max(filled.values()) - min(filled.values()) <= 20
    assert sum(new[s] != s % 4 for s in new) < shards.SLOTS * 0.6
    grown = {r.virtual_slot: r.shard for r in shards.rebalance(old, loads_df, 5).collect()}
    assert set(grown.values()) == {0, 1, 2, 3, 4}


def test_nothing_to_shard(spark):
    assert shards.shard(documents(spark, []), 4)[0].count() == 0


# language-model scores


SMALL = attention.Shape(own=3, members=4, width=4, window=6, stride=4, batch=3)
FEW = attention.Classes(np.array([5, 0, 9, 1, 1, 7, 2, 3, 0]), SMALL)


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    weights = [w.astype(np.float64) for w in attention.start_weights(SMALL, FEW)]
    inputs, targets = draw.integers(0, 10, (3, 6)), draw.integers(0, 9, (3, 6))
    times, mask = draw.integers(0, 4, (3, 6)), attention.causal(6)
    loss = lambda: attention.gradients(weights, inputs, targets, times, FEW, mask)[0]
    _, grads, touched = attention.gradients(weights, inputs, targets, times, FEW, mask)
    assert set(np.flatnonzero(np.abs(grads[0]).sum(axis=1))) <= set(touched)
    for w, g in zip(weights, grads, strict=True):
        for at in [tuple(draw.integers(0, n) for n in w.shape) for _ in range(6)]:
            kept, eps = w[at], 1e-5
            w[at] = kept + eps
            more = loss()
            w[at] = kept - eps
            less = loss()
            w[at] = kept
            assert g[at] == pytest.approx((more - less) / (2 * eps), rel=1e-3, abs=1e-6)


def test_a_place_that_counts_twice_is_two_places():
    draw = np.random.default_rng(2)
    weights = [w.astype(np.float64) for w in attention.start_weights(SMALL, FEW)]
    inputs, targets = draw.integers(0, 10, (2, 6)), draw.integers(0, 9, (2, 6))
    twice = np.ones((2, 6), np.int64) * [[2], [1]]
    one = attention.gradients(weights, inputs, targets, twice, FEW, attention.causal(6))
    again = [np.concatenate([v, v[:1]]) for v in (inputs, targets)]
    two = attention.gradients(weights, *again, np.ones((3, 6), np.int64), FEW, attention.causal(6))
    assert one[0] == pytest.approx(two[0])
    for g, h in zip(one[1], two[1], strict=True):
        assert g == pytest.approx(h)


def plain_log10(weights, classes, shape, ids):
    """log10 probability of each id from a loop over its window and one softmax over all ids."""
    table, context, out = weights[0], shape.window - shape.stride, []
    before = np.concatenate([[classes.start], ids[:-1]]).astype(int)
    for t, target in enumerate(ids):
        scored = t // shape.stride * shape.stride
        first = max(0, scored - context)
        own = [table, weights[1][first - scored + context :], *weights[2:]]
        hidden, _ = attention.attend(own, before[None, first : t + 1], attention.causal(t + 1 - first))
        of_class = np.exp((hidden[0, -1] @ weights[4] + weights[5]).astype(float))
        among = np.exp((table[:-1] @ hidden[0, -1] + classes.share).astype(float))
        mass = np.bincount(classes.of, among, classes.n)
        single = classes.of < classes.own
        inside = np.where(classes.equal < 0, np.exp(classes.equal), among / mass[classes.of])
        each = of_class[classes.of] / of_class.sum() * np.where(single, 1, inside)
        assert each.sum() == pytest.approx(1)
        out.append(math.log10(each[target]))
    return out


def test_every_token_is_scored_once_from_what_is_before_it():
    draw = np.random.default_rng(1)
    weights = attention.start_weights(SMALL, FEW)
    texts = [draw.integers(0, 9, n) for n in (1, 4, 5, 17)]
    got = attention.log10_scores(weights, texts, FEW, SMALL)
    wanted = [v for text in texts for v in plain_log10(weights, FEW, SMALL, text)]
    assert got == pytest.approx(np.array(wanted), abs=1e-4)


@pytest.mark.parametrize("height", [0, 70, 500])
def test_probabilities_of_all_ids_sum_to_one(height):
    weights = attention.start_weights(SMALL, FEW)
    weights[5][3], weights[5][4] = height, height - 2
    weights[0][:] *= 1 + height
    each = np.concatenate([attention.log10_scores(weights, [np.array([c])], FEW, SMALL) for c in range(9)])
    assert (10**each).sum() == pytest.approx(1, abs=1e-4) and each.max() <= 1e-6


def test_ids_of_one_class_are_told_apart():
    """Which of two rare ids comes next is learned from which of two others came before."""
    shape = attention.Shape(own=1, members=8, width=8, window=4, stride=2)
    classes = attention.Classes(np.ones(9), shape)
    rows = np.array([[1, 2, 1, 2], [3, 4, 3, 4], [5, 6, 5, 6], [7, 8, 7, 8]] * 16)
    assert len(set(classes.of[rows].ravel())) == 1
    inputs = np.concatenate([np.full((64, 1), classes.start), rows[:, :-1]], axis=1)
    batch = (inputs, rows, np.ones(rows.shape, np.int64))
    trained, seen, tokens, _ = attention.train(attention.start_weights(shape, classes), iter([batch] * 300), classes, 0.02)
    assert tokens == 300 * 256 and seen[classes.start] == 300 * 64 and not seen[0]
    after = attention.log10_scores(trained, [np.array([1, 2]), np.array([3, 4]), np.array([1, 4])], classes, shape)
    assert 10 ** after[1] > 0.8 and 10 ** after[3] > 0.8 and 10 ** after[5] < 0.1


def test_steps_run_over_stretches_of_ids(monkeypatch):
    """While it trains, ids of a class lie side by side; what comes out is what steps id by id give."""
    draw = np.random.default_rng(4)
    start, passed, plain = attention.start_weights(SMALL, FEW), [], attention.gradients
    targets = draw.choice([0, 2, 3, 4, 5, 6, 7], (5, 3, 6))
    inputs = np.concatenate([np.full((5, 3, 1), FEW.start), targets[:, :, :-1]], axis=2)
    batches = [(i, t, draw.integers(0, 4, (3, 6))) for i, t in zip(inputs, targets, strict=True)]

    def kept(*own):
        passed.append(own[4])
        return plain(*own)

    monkeypatch.setattr(attention, "gradients", kept)
    trained, seen, tokens, _ = attention.train(start, iter(batches), FEW, 0.02)
    assert len(passed) == 5 and all(isinstance(ids, slice) for classes in passed for ids in classes.members)
    wanted, power, mean, square = [w.copy() for w in start], 0, [0] * 5, [0] * 5
    for step, batch in enumerate(batches, 1):
        g, *others = plain(wanted, *batch, FEW, attention.causal(6))[1]
        power = power + g * g
        wanted[0] -= 0.1 * g / (np.sqrt(power) + 1e-8)
        for i, h in enumerate(others):
            mean[i], square[i] = 0.9 * mean[i] + 0.1 * h, 0.99 * square[i] + 0.01 * h * h
            wanted[i + 1] -= 0.02 * mean[i] / (1 - 0.9**step) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
    for got, w in zip(trained, wanted, strict=True):
        assert got == pytest.approx(w, abs=2e-4)
    times = np.stack([t for *_, t in batches])
    assert tokens == times.sum() and seen[FEW.start] == times[:, :, 0].sum()
    assert seen[2] == times[inputs == 2].sum() + times[targets == 2].sum() and not seen[1]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 300])
def test_products_by_groups_of_rows(n):
    rows, right = np.arange(n * 5.0).reshape(n, 5), np.arange(n * 3.0).reshape(n, 3)
    assert np.array_equal(attention._product(rows, np.ones((5, 3))), rows @ np.ones((5, 3)))
    assert np.allclose(attention._crossed(rows, right), rows.T @ right)


@pytest.mark.parametrize("most", [30, 300])
def test_classes_side_by_side_are_each_a_softmax(most, monkeypatch):
    """Rows of several classes go through one block; without a large logit no row's largest is looked for."""
    monkeypatch.setattr(attention, "PIECE", 40)
    monkeypatch.setattr(attention, "GROUP", 2)
    draw = np.random.default_rng(5)
    vectors, shift, hidden = draw.normal(size=(10, 4)), draw.normal(size=10), draw.normal(size=(23, 4))
    stretches = [(slice(0, 15), slice(0, 4)), (slice(15, 16), slice(4, 8)), (slice(16, 23), slice(8, 10))]
    target = np.concatenate([draw.integers(c.start, c.stop, r.stop - r.start) for r, c in stretches])
    softmax, each, d_hidden = attention.Softmax(vectors, shift, most), draw.random(23), np.empty((23, 4))
    assert softmax.held == (most == 30) and attention._longest(np.array([[3.0, 4.0], [0.0, 4.9]])) == pytest.approx(5)
    wanted, d_vectors, d_rows = np.empty(23), np.zeros((10, 4)), np.empty((23, 4))
    for rows, columns in stretches:
        logits = hidden[rows] @ vectors[columns].T + shift[columns]
        share, at = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True), np.arange(rows.stop - rows.start)
        wanted[rows] = np.log(share[at, target[rows] - columns.start])
        share[at, target[rows] - columns.start] -= 1
        d_vectors[columns] += (share * each[rows, None]).T @ hidden[rows]
        d_rows[rows] = share * each[rows, None] @ vectors[columns]
    log, d = attention._missed(hidden, softmax, stretches, target, each, d_hidden)
    assert log == pytest.approx(wanted) and d == pytest.approx(d_vectors) and d_hidden == pytest.approx(d_rows)
    assert attention._log_picked(hidden, softmax, stretches, target) == pytest.approx(wanted)


def test_exp_of_many_numbers_is_exact_to_the_last_bits(monkeypatch):
    """numpy's own, where there is no AVX-512, is wrong by up to 2e-7 of a value."""
    pytest.importorskip("onnxruntime")
    draw = np.random.default_rng(6)
    for shape in ((exponents.LARGE + 5,), (300, 7, 31)):
        given = draw.uniform(-80, 80, shape).astype(np.float32)
        got, wanted = given.copy(), np.exp(given.astype(np.float64))
        exponents.exp(got)
        assert got.dtype == np.float32 and np.abs(got / wanted - 1).max() < 1.2e-7
    ends = np.full(exponents.LARGE, -500, np.float32)
    ends[::3] = 0
    exponents.exp(ends)
    assert (ends[::3] == 1).all() and np.delete(ends, np.s_[::3]).max() < 1e-44
    passed, plain = [], np.exp
    monkeypatch.setattr(exponents.np, "exp", lambda own, **more: passed.append(own.size) or plain(own, **more))
    many = draw.random((exponents.LARGE, 2))
    for own in (many, many.astype(np.float32)[:, 0], many.astype(np.float32)[:9]):  # another type, with gaps, few
        got = own.copy() if own.flags.c_contiguous else own
        wanted = plain(own)
        exponents.exp(got)
        assert got == pytest.approx(wanted)
    assert passed == [2 * exponents.LARGE, exponents.LARGE, 18]


def test_a_large_step_is_the_same_without_the_faster_exp(monkeypatch):
    """Training and scoring take exp of whole blocks at once by the faster kernel, if there is one."""
    pytest.importorskip("onnxruntime")
    draw, shape = np.random.default_rng(7), attention.Shape(own=40, members=64)
    classes = attention.Classes(draw.integers(0, 50, 3000), shape)
    targets = draw.choice(np.flatnonzero(classes.counts), (2, 128, 32))
    inputs = np.concatenate([np.full((2, 128, 1), classes.start), targets[:, :, :-1]], axis=2)
    batches = [(i, t, np.ones(t.shape, np.int64)) for i, t in zip(inputs, targets, strict=True)]
    found, kernel, taken = [], exponents._kernel(), []
    for own in (lambda values: taken.append(values.size) or kernel(values), None):
        monkeypatch.setattr(exponents, "_kernel", lambda own=own: own)
        weights, *_ = attention.train(attention.start_weights(shape, classes), iter(batches), classes, 0.02)
        found.append((weights, attention.log10_scores(weights, list(targets[0]), classes, shape)))
    assert len(taken) > 6 and min(taken) >= exponents.LARGE
    (weights, scores), (again, plain) = found
    assert scores == pytest.approx(plain, abs=1e-4)
    for w, v in zip(weights, again, strict=True):
        assert w == pytest.approx(v, abs=2e-4)


def test_batches_of_a_part_of_a_table():
    how = scoring.Scoring(shape=SMALL, train_batch=2)
    ids = [[1, 2, 3, 4, 5, 6], [7], [3, 3], [9, 8, 7], [5]]
    held = pa.chunked_array([pa.array([np.array(own, np.uint16).tobytes() for own in part], pa.binary()) for part in (ids[:2], ids[2:])])
    table = pa.table({"before": pa.array([9, 1, 2, 3, 4], pa.int32()), "ids": held, "times": [1, 2, 3, 4, 5], "hash": [5, 3, 1, 4, 2]})
    got = [row for batch in scoring.batches_of(table.slice(1), how) for row in zip(*(v.tolist() for v in batch), strict=True)]
    wanted = [([n, *own[:-1]], own, times) for n, own, times in ((2, [3, 3], 3), (4, [5], 5), (1, [7], 2), (3, [9, 8, 7], 4))]
    for (inputs, targets, times), (first, own, each) in zip(got, wanted, strict=True):
        n = len(own)
        assert (inputs[:n], targets[:n], times) == (first, own, [each] * n + [0] * (6 - n))


@both
def test_scores(spark, shape):
    docs = [*ROWS[:4], *ROWS[5:]]
    how = scoring.Scoring(rounds=1, block_bytes=20_000, bucket_bytes=10_000)
    found = scoring.score(shape(documents(spark, docs)), remainder(F.col("doc_id"), 3) == 0, WORDS, how).collect()
    words = {i: (t or "").encode().lower().split() + [b"\n"] for i, t, *_ in docs}
    learn = [i for i in words if i is None or zlib.crc32(str(i).encode()) % 3]
    counts = Counter(w for i in learn for w in words[i])
    n, distinct = counts.total(), len(counts)
    assert len(found) == len(docs) and 0 < len(learn) < len(docs)
    for r in found:
        own = words[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (distinct + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base) and r.score <= 0


def test_training_windows_cover_every_token(spark, monkeypatch):
    monkeypatch.setattr(scoring, "PART", 50)
    how = scoring.Scoring()
    docs = documents(spark).where("doc_id in (1, 2, 6, 8)").withColumn("learn", F.lit(True)).coalesce(1)
    rows = scoring.training_windows(docs, WORDS, how.subwords, how).collect()
    wanted = Counter()
    for _, text, *_ in (row for row in ROWS if row[0] in (1, 2, 6, 8)):
        own = np.append(scoring.subword_ids(WORDS, (text or "").encode().lower().split())[0], how.end_id).tolist()
        before = [how.subwords, *own]
        wanted.update((before[k], tuple(own[k : k + how.shape.window])) for k in range(0, len(own), how.shape.window))
    got = {(r.before, tuple(np.frombuffer(r.ids, np.uint16).tolist())): r.times for r in rows}
    assert got == wanted and sum(len(ids) * n for (_, ids), n in got.items()) > 30_000


def test_a_part_of_a_word_is_tokenised_once(monkeypatch):
    words = [b"the", b"end.", b"", b"end", b"don't!?", b"x.y,", b"\xc3\xa9a.", b"b<|endoftext|>"] * 50
    table, looked_up = scoring.word_codes(WORDS, scoring.MOST_WORDS), []
    coded = table.coded
    each = [coded([w])[0].tolist() for w in words]
    monkeypatch.setattr(table, "coded", lambda own: looked_up.append(len(own)) or coded(own))
    for n in (7, 8):  # without and with one that spells a special token
        own = [i for i in range(len(words)) if i % 8 < n]
        ids, begin = scoring.subword_ids(WORDS, [words[i] for i in own])
        assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [each[i] for i in own]
    assert looked_up[0] < 12


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    how = scoring.Scoring(shard_windows=40, train_batch=8)
    docs = documents(spark, [*ROWS, *ROWS[:3]])
    found = [
        sorted((r.doc_id or 0, r.n_tokens, r.score) for r in scoring.score(dealt, F.col("doc_id") == 3, WORDS, how).collect())
        for dealt in (docs.coalesce(1), docs.repartition(7, F.rand(3)))
    ]
    assert [r[:2] for r in found[0]] == [r[:2] for r in found[1]]
    assert [r[2] for r in found[0]] == pytest.approx([r[2] for r in found[1]], rel=1e-6)


def test_score_is_that_of_a_plain_loop(spark, monkeypatch):
    """0.6 of a word's share of the training tokens, 0.4 of what attention gives its subwords, by a loop over windows."""
    held, fit = [], scoring.fit

    def kept(windows, classes, how):
        held.append((fit(windows, classes, how), classes))
        return held[0][0]

    monkeypatch.setattr(scoring, "fit", kept)
    texts = [(1, "the cat sat on the mat " * 9), (2, "Unseenly quixotic zebras, THE cat"), (3, None), (4, "the dog ate the cat")]
    docs = documents(spark, [(i, t, "en", "a", 0) for i, t in texts])
    how = scoring.Scoring()
    found = {r.doc_id: r.score for r in scoring.score(docs, F.col("doc_id") == 2, WORDS, how).collect()}
    weights, classes = held[0]
    split = {i: [*(t or "").encode().lower().split(), b""] for i, t in texts}
    counts = Counter(w for i, words in split.items() if i != 2 for w in words)
    for i, words in split.items():
        spelled = [scoring.subword_ids(WORDS, [w])[0].tolist() if w else [how.end_id] for w in words]
        logs, wanted = iter(plain_log10(weights, classes, how.shape, [x for ids in spelled for x in ids])), 0.0
        for word, ids in zip(words, spelled, strict=True):
            attended = 10 ** sum(next(logs) for _ in ids)
            wanted += math.log10(0.6 * counts[word] / counts.total() + 0.4 * attended)
        assert found[i] == pytest.approx(wanted, abs=1e-3)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a b", "en", "a", 0)])
    row = scoring.score(docs, F.lit(True), WORDS).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score < 0
    assert scoring.score(documents(spark, []), F.lit(False), WORDS).count() == 0


def test_digests_of_what_is_left(spark, tmp_path):
    from tests.llm.cases import write

    rows = {r.doc_id: r for r in repeats.op9_repeats(spark, write(documents(spark, ROWS[:4]), tmp_path)).collect()}
    assert rows[4].kept_sha256 == hashlib.sha256(b"").hexdigest() and rows[4].n_spans == 1
    assert rows[1].n_removed == 0 and rows[2].n_bytes == 0

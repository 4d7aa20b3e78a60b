"""A small causal self-attention model over subword ids, in numpy: one head, one layer.

Every id has a vector of its own, which it shows to the places after it and by which it is told apart
from the others of its class. The model gives the next id from up to ``window`` ids before it in two steps:
the id's class, then the id among the class. The most frequent ids are a class each; the others are
dealt by rank of their count into classes of ``members``, so that no softmax is wide. Ids that the training
texts never hold are one class with equal shares. So every text has a proper probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from changeloom.llm.exponents import exp


GROUP = 128  # rows of a product: the kernels for small matrices take half the time a row
MOST = 75  # float32 holds its exp, and a sum of many
PIECE = 1 << 18  # logits that are held at once, so that they stay in a core's cache


@dataclass(frozen=True)
class Shape:
    own: int = 112  # ids with a class of their own
    members: int = 256  # ids of any other class
    width: int = 16
    window: int = 32
    stride: int = 24  # tokens of a window that are scored; the others are context only
    batch: int = 256  # windows at once


class Classes:
    """Class of every id, the ids of every class, and the log share of an id in its class."""

    def __init__(self, counts: np.ndarray, shape: Shape):
        self.ids, seen = len(counts), int((counts > 0).sum())
        own = min(shape.own, seen)
        self.start = self.ids  # stands before the first token; it has a vector and is never predicted
        self.counts, self.shape, self.order = counts, shape, np.lexsort((np.arange(self.ids), -counts))
        self.rank = rank = np.empty(self.ids, np.int64)
        rank[self.order] = np.arange(self.ids)
        self.of = np.where(rank < own, rank, own + (rank - own) // shape.members)
        self.place = np.where(rank < own, 0, (rank - own) % shape.members)
        rest = self.order[own:seen]
        self.own, self.members = own, [_rows(rest[a : a + shape.members]) for a in range(0, len(rest), shape.members)]
        self.several = _rows(rest)  # ids that share a class and are told apart
        unseen = counts == 0
        self.of[unseen], self.n = own + len(self.members), own + len(self.members) + int(unseen.any())
        total = np.bincount(self.of, weights=counts + 0.1, minlength=self.n)
        self.share = np.log((counts + 0.1) / total[self.of]).astype(np.float32)
        self.equal = np.where(unseen, self.share, np.float32(0))  # log share of an id that nothing tells apart from others
        self.prior = np.log(total / total.sum()).astype(np.float32)

    def ranked(self) -> Classes:
        """The same classes of ids numbered by rank, so that those of a class lie side by side."""
        return Classes(self.counts[self.order], self.shape)

    def shared(self, targets: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, slice]]]:
        """Places whose valid target is in a class of several ids, class by class; each such class's stretch of them and of ``several``."""
        of = self.of[targets]
        at = np.flatnonzero(valid & (of >= self.own) & (of < self.own + len(self.members)))
        at = at[_stable_order(of[at], self.n)]
        of = of[at]
        first, width = _begins(of), self.shape.members
        ends, begins = np.append(first[1:], len(at)).tolist(), ((of[first] - self.own) * width).tolist()
        last = self.rank[self.several].max(initial=-1) + 1 - self.own
        return at, [(slice(a, b), slice(c, min(c + width, last))) for a, b, c in zip(first.tolist(), ends, begins, strict=False)]


def _rows(ids: np.ndarray) -> np.ndarray | slice:
    """The ids as an index; a slice, which copies nothing, if they lie side by side."""
    return slice(int(ids[0]), int(ids[-1]) + 1) if len(ids) and (np.diff(ids) == 1).all() else ids


def _stable_order(values: np.ndarray, n: int) -> np.ndarray:
    """Stable order of whole numbers below n; numpy sorts short ones by radix."""
    return np.argsort(values.astype(np.uint16) if n <= 1 << 16 else values, kind="stable")


def _begins(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


def _product(rows: np.ndarray, matrix: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``rows @ matrix``, by groups of rows."""
    if out is None:
        out = np.empty((len(rows), matrix.shape[1]), rows.dtype)
    whole = len(rows) // GROUP * GROUP
    if whole:
        np.matmul(rows[:whole].reshape(-1, GROUP, rows.shape[1]), matrix, out=out[:whole].reshape(-1, GROUP, out.shape[1]))
    if whole < len(rows):
        np.matmul(rows[whole:], matrix, out=out[whole:])
    return out


def _crossed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left.T @ right``, by groups of rows."""
    whole = len(left) // GROUP * GROUP if len(left) >= 4 * GROUP else 0
    total = left[whole:].T @ right[whole:]
    if whole:
        grouped = left[:whole].reshape(-1, GROUP, left.shape[1]).transpose(0, 2, 1)
        total += (grouped @ right[:whole].reshape(-1, GROUP, right.shape[1])).sum(axis=0)
    return total


def start_weights(shape: Shape, classes: Classes, seed: int = 7) -> list[np.ndarray]:
    """Vectors of the ids and of the start, of places, of queries, keys and values, of the way out, and of classes."""
    draw, d = np.random.default_rng(seed), shape.width
    small = lambda *size: (draw.standard_normal(size) * 0.3 / np.sqrt(d)).astype(np.float32)
    shapes = [(classes.ids + 1, d), (shape.window, d), (d, 3 * d), (d, d), (d, classes.n)]
    return [*(small(*s) for s in shapes), classes.prior.copy()]


def as_rows(weights: list[np.ndarray]) -> np.ndarray:
    """All weights as rows as wide as a vector, those of the ids first; the last row may end in zeros."""
    d = weights[0].shape[1]
    values = np.concatenate([w.ravel() for w in weights])
    return np.append(values, np.zeros(-len(values) % d, values.dtype)).reshape(-1, d)


def from_rows(rows: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([w.size for w in like])
    parts = np.split(rows.ravel()[: ends[-1]], ends[:-1])
    return [part.reshape(w.shape).astype(w.dtype) for part, w in zip(parts, like, strict=True)]


def _scaled(projection: np.ndarray) -> np.ndarray:
    """With the queries' part scaled, so that their products with keys need not be."""
    d, scaled = len(projection), projection.copy()
    scaled[:, :d] *= np.float32(d**-0.5)
    return scaled


def _shares(q: np.ndarray, k: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each place gives to those it may see, and the sum of that; queries are scaled."""
    given = q @ k.transpose(0, 2, 1)
    np.clip(given, -40, 40, out=given)
    exp(given)
    given *= mask
    return given, given @ np.ones((given.shape[2], 1), given.dtype)


def attend(weights, inputs: np.ndarray, mask: np.ndarray):
    """Hidden states (windows, places, width), and what the way back needs."""
    table, places, projection, out, _, _ = weights
    d = table.shape[1]
    x = table.take(inputs, axis=0)
    x += places[: inputs.shape[1]]
    q, k, v = np.split(_product(x.reshape(-1, d), _scaled(projection)).reshape(*inputs.shape, 3 * d), 3, axis=2)
    share, total = _shares(q, k, mask)
    share /= total
    mixed = share @ v
    return x + _product(mixed.reshape(-1, d), out).reshape(x.shape), (x, q, k, v, share, mixed)


def causal(n: int) -> np.ndarray:
    return np.tril(np.ones((n, n), np.float32))


def _longest(rows: np.ndarray) -> float:
    """Length of the longest row."""
    return float(np.einsum("ij,ij->i", rows, rows).max(initial=0)) ** 0.5


class Softmax:
    """Softmax of the products of rows with vectors, a shift added to each vector's.

    exp(shift) is a factor of a vector, so it is taken once and not for each row. Only where exp might not hold
    the products, shifts are added and a row's largest logit is taken away first; that changes no probability.
    """

    def __init__(self, vectors: np.ndarray, shift: np.ndarray, most: float):
        """``most`` is as long as the longest row times the longest vector."""
        self.vectors, self.across = vectors, np.ascontiguousarray(vectors.T)  # faster in a product than a transposed view
        low, high = (shift.min(), shift.max()) if len(shift) else (0, 0)
        self.shift, none = shift - (low + high) / shift.dtype.type(2), np.zeros_like(shift)
        self.held = most + high - low < MOST
        self.shift_held = self.shift if self.held else none  # what no logit holds
        self.factor = np.exp(self.shift_held)
        self.scaled = vectors * self.factor[:, None]

    def logits(self, hidden: np.ndarray, group: list[tuple[slice, slice]], target: np.ndarray):
        """The rows of a group, a block of logits for each stretch, all blocks as one, and where in it each row's target is."""
        rows, widths = [at.stop - at.start for at, _ in group], [c.stop - c.start for _, c in group]
        own = slice(group[0][0].start, group[-1][0].stop)
        ends = np.cumsum(np.multiply(rows, widths)).tolist()
        flat, blocks = np.empty(ends[-1], hidden.dtype), []
        for (at, columns), a, b, width in zip(group, [0, *ends], ends, widths, strict=False):
            block = flat[a:b].reshape(-1, width)
            _product(hidden[at], self.across[:, columns], block)
            if not self.held:
                block += self.shift[columns]
                block -= block.max(axis=1, keepdims=True)
            blocks.append(block)
        before = np.repeat(widths, rows)
        before = np.cumsum(before) - before - np.repeat([c.start for _, c in group], rows)
        return own, blocks, flat, before + target[own]

    def sums(self, group: list[tuple[slice, slice]], blocks: list[np.ndarray]) -> np.ndarray:
        """Of each row of a group, the sum of what its exps stand for."""
        return np.concatenate([block @ self.factor[columns] for (_, columns), block in zip(group, blocks, strict=True)])


def _sums(values: np.ndarray) -> np.ndarray:
    """Sum of each row, as a product: far faster than a sum over rows this short."""
    return values @ np.ones(values.shape[1], values.dtype)


def _pieces(stretches: list[tuple[slice, slice]]) -> Iterator[list[tuple[slice, slice]]]:
    """Stretches of rows and of vectors, long ones parted, by as many as have logits that stay in a core's cache."""
    group, held = [], 0
    for rows, columns in stretches:
        width = columns.stop - columns.start
        most = max(GROUP, PIECE // width // GROUP * GROUP)
        for a in range(rows.start, rows.stop, most):
            part = slice(a, min(a + most, rows.stop))
            if group and held + (part.stop - a) * width > PIECE:
                yield group
                group, held = [], 0
            group.append((part, columns))
            held += (part.stop - a) * width
    if group:
        yield group


def _whole(rows: np.ndarray, vectors: np.ndarray) -> list[tuple[slice, slice]]:
    """One stretch, of all rows and all vectors."""
    return [(slice(0, len(rows)), slice(0, len(vectors)))]


def _log_picked(hidden: np.ndarray, softmax: Softmax, stretches: list[tuple[slice, slice]], target: np.ndarray) -> np.ndarray:
    """Log probability of each row's target among the vectors of its stretch."""
    log = np.empty(len(target))
    for group in _pieces(stretches):
        own, blocks, logits, picks = softmax.logits(hidden, group, target)
        log[own] = logits[picks] + softmax.shift_held[target[own]]
        exp(logits)
        log[own] -= np.log(softmax.sums(group, blocks))
    return log


def _missed(hidden: np.ndarray, softmax: Softmax, stretches, target: np.ndarray, each: np.ndarray, d_hidden: np.ndarray, d_shift=None):
    """Each row's log probability of its target, and the gradients of the vectors; a row counts ``each`` times.

    Those of the rows are put into ``d_hidden``, those of the shifts into ``d_shift``, which holds zeros. They come from the probabilities
    less the target's one. What a row is divided by and counts goes to its short side, a vector's factor to its own.
    """
    share, d_vectors, factor = np.empty_like(each), np.zeros_like(softmax.vectors), softmax.factor
    for group in _pieces(stretches):
        own, blocks, p, picks = softmax.logits(hidden, group, target)
        exp(p)
        total, by_target, picked = softmax.sums(group, blocks), factor[target[own]], p[picks]
        share[own] = picked * by_target / total
        p[picks] = picked - total / by_target
        by = each[own] / total
        rows = hidden[own] * by[:, None]
        for (at, columns), block in zip(group, blocks, strict=True):
            inside = slice(at.start - own.start, at.stop - own.start)
            d_vectors[columns] += _crossed(block, rows[inside])
            if d_shift is not None:
                d_shift[columns] += by[inside] @ block
            _product(block, softmax.scaled[columns], d_hidden[at])
        d_hidden[own] *= by[:, None]
    d_vectors *= factor[:, None]
    if d_shift is not None:
        d_shift *= factor
    return np.log(share + 1e-30), d_vectors


def log10_scores(weights, texts: list[np.ndarray], classes: Classes, shape: Shape) -> np.ndarray:
    """log10 probability of every id of the texts, in order, each scored once, in batches of windows.

    A window is ``window - stride`` places of context and then ``stride`` that are scored. Only these ask;
    all up to the one that asks are attended to. Before the start of a text there is nothing to see.
    """
    table, places, projection, out, u, bias = weights
    d, context = table.shape[1], shape.window - shape.stride
    lengths = np.array([len(t) for t in texts], np.int64)
    parts = -(-lengths // shape.stride)
    if not parts.sum():
        return np.zeros(0)
    base = np.cumsum(lengths) - lengths
    after = np.concatenate([*texts, np.zeros(shape.stride, np.int64)])
    before = np.concatenate([[classes.start], after[:-1]])
    before[base[lengths > 0]] = classes.start
    owner = np.repeat(np.arange(len(texts)), parts)
    scored = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * shape.stride
    causal_ = np.tril(np.ones((shape.stride, shape.window), np.float32), context)
    place, place_scored, scores = np.arange(shape.window), np.arange(shape.stride), []
    several, own_shift = table[classes.several], classes.share[classes.several]
    farthest, wide = _longest(several), _longest(u.T)
    projection = _scaled(projection)
    for a in range(0, len(owner), shape.batch):
        own, first = owner[a : a + shape.batch], scored[a : a + shape.batch]
        at = (base[own] + first - context)[:, None] + place
        x = table.take(before.take(at, mode="clip"), axis=0)
        x += places
        asking = np.ascontiguousarray(x[:, context:])
        q = _product(asking.reshape(-1, d), projection[:, :d]).reshape(asking.shape)
        k, v = np.split(_product(x.reshape(-1, d), projection[:, d:]).reshape(*at.shape, 2 * d), 2, axis=2)
        share, total = _shares(q, k, causal_)
        opening = np.flatnonzero(first == 0)
        share[opening, :, :context] = 0
        total[opening] = share[opening].sum(axis=2, keepdims=True)
        mixed = share @ v
        mixed /= total
        asking += _product(mixed.reshape(-1, d), out).reshape(asking.shape)
        valid = (first[:, None] + place_scored < lengths[own][:, None]).ravel()
        valid = np.flatnonzero(valid)
        hidden = asking.reshape(-1, d).take(valid, axis=0)
        target, longest = after.take(at[:, context:].ravel().take(valid)), _longest(hidden)
        softmax = Softmax(u.T, bias, longest * wide)
        picked = _log_picked(hidden, softmax, _whole(hidden, u.T), classes.of[target]) + classes.equal[target]
        asked, stretches = classes.shared(target, np.ones(len(target), bool))
        softmax = Softmax(several, own_shift, longest * farthest)
        picked[asked] += _log_picked(hidden.take(asked, axis=0), softmax, stretches, classes.rank[target[asked]] - classes.own)
        scores.append(picked)
    return np.concatenate(scores) / np.log(10)


def gradients(
    weights, inputs: np.ndarray, targets: np.ndarray, times: np.ndarray, classes: Classes, mask: np.ndarray, d_table=None
):
    """Mean loss a token, its gradients, and the ids whose vectors have one; a place counts ``times`` times.

    ``d_table`` takes the gradients of the ids' vectors, if given; it must hold zeros.
    """
    table, places, projection, out, u, bias = weights
    n, d, flat_inputs, flat_targets = max(1.0, float(times.sum())), table.shape[1], inputs.ravel(), targets.ravel()
    x, (embedded, q, k, v, share, mixed) = attend(weights, inputs, mask)
    hidden, d_bias = x.reshape(-1, d), np.zeros_like(bias)
    longest, d_flat = _longest(hidden), np.empty_like(hidden)
    each = (times.ravel() / n).astype(table.dtype)
    softmax = Softmax(u.T, bias, longest * _longest(u.T))
    log, d_across = _missed(hidden, softmax, _whole(hidden, u.T), classes.of[flat_targets], each, d_flat, d_bias)
    loss = -float(((log + classes.equal[flat_targets]) * each).sum())
    if d_table is None:
        d_table = np.zeros_like(table)
    asked, stretches = classes.shared(flat_targets, each > 0)
    rows, own_each, several = hidden.take(asked, axis=0), each[asked], table[classes.several]
    d_rows, softmax = np.empty_like(rows), Softmax(several, classes.share[classes.several], longest * _longest(several))
    log, d_table[classes.several] = _missed(rows, softmax, stretches, classes.rank[flat_targets[asked]] - classes.own, own_each, d_rows)
    loss -= float(log @ own_each)
    d_flat[asked] += d_rows
    d_hidden = d_flat.reshape(x.shape)
    d_out = _crossed(mixed.reshape(-1, d), d_flat)
    d_mixed = _product(d_flat, np.ascontiguousarray(out.T)).reshape(x.shape)
    d_score = d_mixed @ v.transpose(0, 2, 1)
    d_score -= _sums((d_mixed * mixed).reshape(-1, d)).reshape(*inputs.shape, 1)  # what the shares' sum takes away
    d_score *= share
    joint = np.empty((*inputs.shape, 3 * d), table.dtype)
    np.matmul(d_score, k, out=joint[:, :, :d])
    np.matmul(d_score.transpose(0, 2, 1), q, out=joint[:, :, d : 2 * d])
    np.matmul(share.transpose(0, 2, 1), d_mixed, out=joint[:, :, 2 * d :])
    joint = joint.reshape(-1, 3 * d)
    d_x = _product(joint, np.ascontiguousarray(_scaled(projection).T)).reshape(x.shape)
    d_x += d_hidden
    order = _stable_order(flat_inputs, len(table))
    ordered = flat_inputs[order]
    first = _begins(ordered)
    d_table[ordered[first]] += np.add.reduceat(d_x.reshape(-1, d).take(order, axis=0), first, axis=0)
    d_places = np.zeros_like(places)
    d_places[: inputs.shape[1]] = d_x.sum(axis=0)
    grads = [d_table, d_places, _scaled(_crossed(embedded.reshape(-1, d), joint)), d_out, d_across.T, d_bias]
    touched = np.zeros(len(table), bool)
    touched[flat_inputs] = True
    for _, columns in stretches:
        touched[classes.order[classes.own + columns.start : classes.own + columns.stop]] = True
    return loss, grads, np.flatnonzero(touched)


def train(weights: list[np.ndarray], batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], classes: Classes, rate: float):
    """One pass over batches of (inputs, targets, times): weights, occurrences of each id, tokens, mean loss.

    Vectors of ids take steps by Adagrad, all other weights by Adam. Meanwhile ids are numbered by rank: those of a
    class lie side by side and those that occur come first, so that steps run over whole stretches; without a gradient a step is none.
    """
    order, ranked = np.append(classes.order, classes.start), classes.ranked()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    table, ends = weights[0][order], np.cumsum([w.size for w in weights[1:]])
    flat = np.concatenate([w.ravel() for w in weights[1:]])
    others = [part.reshape(w.shape) for part, w in zip(np.split(flat, ends[:-1]), weights[1:], strict=True)]  # views
    power, d_table = np.zeros_like(table), np.zeros_like(table)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    seen, tokens, losses, mask = np.zeros(len(table), np.int64), 0, 0.0, causal(len(others[0]))
    for step, (inputs, targets, times) in enumerate(batches, 1):
        inputs, targets = number[inputs], number[targets]
        loss, (_, *grads), touched = gradients([table, *others], inputs, targets, times, ranked, mask, d_table)
        last = touched[touched < classes.start].max(initial=-1)
        for own in (slice(0, int(last) + 1), slice(classes.start, None)):
            g = d_table[own]
            power[own] += g * g
            table[own] -= np.float32(5 * rate) * g / (np.sqrt(power[own]) + np.float32(1e-8))
            g[:] = 0
        g = np.concatenate([grad.ravel() for grad in grads])
        mean += np.float32(0.1) * (g - mean)
        square += np.float32(0.01) * (g * g - square)
        flat -= np.float32(rate) * (mean / np.float32(1 - 0.9**step)) / (np.sqrt(square / np.float32(1 - 0.99**step)) + np.float32(1e-8))
        n = int(times.sum())
        for ids in (inputs, targets):
            np.add.at(seen, ids.ravel(), times.ravel())
        tokens += n
        losses += loss * n
    return [table[number], *others], seen[number], tokens, losses / max(1, tokens)

"""A gated recurrent language model in numpy.

One gate per unit decides how much of the state is replaced: ``f = sigmoid(..)``, ``h = h + f * (tanh(..) - h)``. The
input of a symbol is its row of a learned table, so the only product on the way is that of state and gates. The softmax
over symbols has two factors, the class of the symbol and the symbol within its class; classes hold equally many
symbols, the most frequent ones first. Fresh biases are the logarithms of the counts, so an untrained model is the
unigram model and training starts from there.

Documents run side by side in lanes, one after the other in a lane. The state begins at zero with every document and is
carried from window to window until it ends; gradients are cut at the start of a window (truncated backpropagation).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np

UNITS, STEPS, LANES, RATE = 24, 32, 192, 0.06
CALM = 1e-6  # what squared gradients begin at
SMALL = 1 << 17  # multiplications
SAFE = 75.0  # e to this power, a few hundred times, is a float
TINY = np.float32(1e-37)
PAD = np.float32(-1e9)  # bias of places in the last class that no symbol has


@dataclass
class Weights:
    inputs: np.ndarray  # symbol -> gate and candidate, 2 * UNITS
    turn: np.ndarray  # UNITS, 2 * UNITS
    classes: np.ndarray  # UNITS, classes
    class_bias: np.ndarray
    words: np.ndarray  # class, UNITS, places
    word_bias: np.ndarray  # class, places

    @classmethod
    def fresh(cls, counts: np.ndarray, units: int = UNITS, seed: int = 13) -> Weights:
        """For symbols in falling order of their counts; the state is open a little at first."""
        rng = np.random.default_rng(seed)
        n = len(counts)
        places = int(np.ceil(np.sqrt(n)))
        kinds = -(-n // places)
        mass = np.zeros(kinds * places)
        mass[:n] = counts + 1.0
        mass = mass.reshape(kinds, places)
        with np.errstate(divide="ignore"):
            word_bias = np.maximum(np.log(mass / mass.sum(1, keepdims=True)), PAD)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        inputs = draw(n, 2 * units, scale=0.5)
        inputs[:, :units] -= 1
        return cls(
            inputs, draw(units, 2 * units, scale=0.5 / np.sqrt(units)), draw(units, kinds, scale=0.05),
            np.log(mass.sum(1) / mass.sum()).astype(np.float32), draw(kinds, units, places, scale=0.05), word_bias.astype(np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, flat: np.ndarray) -> Weights:
        """Weights of this shape with the given values."""
        ends = np.cumsum([a.size for a in self.arrays()])[:-1]
        return Weights(*(part.reshape(a.shape) for part, a in zip(np.split(flat, ends), self.arrays(), strict=True)))

    @property
    def places(self) -> int:
        return self.word_bias.shape[1]

    @property
    def units(self) -> int:
        return len(self.turn)

    def uses(self, seen: np.ndarray) -> np.ndarray:
        """How often each value took part where the symbols occurred so often, in the order of ``flat``."""
        by_place = np.zeros(self.word_bias.size, np.float32)
        by_place[: len(seen)] = seen
        by_class = by_place.reshape(self.word_bias.shape).sum(1)
        per = [
            np.repeat(seen, 2 * self.units), np.full(self.turn.size, seen.sum()), np.full(self.classes.size, seen.sum()),
            np.full(self.class_bias.size, seen.sum()), np.repeat(by_class, self.units * self.places), np.repeat(by_class, self.places),
        ]
        return np.concatenate(per).astype(np.float32)


def in_lanes(sizes: np.ndarray, lanes: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lane of every document and where in it the document starts; in the given order, each to the shortest lane."""
    heap = [(0, k) for k in range(max(1, min(lanes, len(sizes))))]
    lane, start = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for d in order.tolist():
        load, k = heap[0]
        lane[d], start[d] = k, load
        heapq.heapreplace(heap, (load + int(sizes[d]), k))
    loads = np.zeros(len(heap), np.int64)
    np.maximum.at(loads, lane, start + sizes)
    place = np.empty(len(heap), np.int64)
    place[np.argsort(-loads, kind="stable")] = np.arange(len(heap))  # long lanes first: running ones are the first ones
    return place[lane], start


@dataclass
class Batch:
    """Documents in lanes; ``symbol[t, lane]`` is read after ``before[t, lane]``."""

    symbol: np.ndarray
    owner: np.ndarray  # document of each place, -1 past the end of a lane
    start: np.ndarray

    @classmethod
    def of(cls, documents: list[np.ndarray], lanes: int, seed: int | None = None) -> Batch:
        """The longest documents first, so that lanes end together; in a random order with a seed."""
        sizes = np.array([len(d) for d in documents], np.int64)
        order = np.argsort(-sizes, kind="stable") if seed is None else np.random.default_rng(seed).permutation(len(sizes))
        lane, start = in_lanes(sizes, lanes, order)
        width = int(lane.max(initial=0)) + 1
        depth = int((start + sizes).max(initial=0))
        symbol, owner = np.zeros((width, depth), np.uint16), np.full((width, depth), -1, np.int32)
        first = np.zeros((width, depth), bool)
        for d, (k, at) in enumerate(zip(lane.tolist(), start.tolist(), strict=True)):
            symbol[k, at : at + sizes[d]] = documents[d]
            owner[k, at : at + sizes[d]] = d
            first[k, at] = True
        return cls(np.ascontiguousarray(symbol.T), np.ascontiguousarray(owner.T), np.ascontiguousarray(first.T))

    def windows(self, steps: int) -> Iterator[tuple[slice, int]]:
        running = (self.owner >= 0).sum(1)
        for at in range(0, len(running), steps):
            yield slice(at, min(at + steps, len(running))), int(running[at])


@dataclass
class Window:
    """What one window's pass leaves for the pass back."""

    before: np.ndarray
    state: np.ndarray  # steps + 1, lanes, units: as each step found it, zero where a document starts
    gate: np.ndarray
    candidate: np.ndarray
    out: np.ndarray  # steps, lanes, units
    keep: np.ndarray  # steps, lanes, 1: 0 where a document starts


def run_window(w: Weights, batch: Batch, span: slice, lanes: int, end: int, carried: np.ndarray) -> Window:
    """The states after every symbol that a prediction is made from."""
    symbol, first = batch.symbol[span, :lanes], batch.start[span, :lanes]
    steps, units = len(symbol), w.units
    before = np.empty((steps, lanes), np.int64)
    before[1:] = symbol[:-1]
    before[0] = batch.symbol[span.start - 1, :lanes] if span.start else end
    before[first] = end
    keep = (~first).astype(np.float32)[:, :, None]
    moves = w.inputs.take(before, 0)
    gate, candidate, found, out = (np.empty((steps, lanes, units), np.float32) for _ in range(4))
    h = carried[:lanes]
    for t in range(steps):
        h = np.multiply(h, keep[t], out=found[t])
        a = moves[t]
        a += h @ w.turn
        f, g = gate[t], candidate[t]
        np.tanh(a[:, :units] * np.float32(0.5), out=f)
        f *= np.float32(0.5)
        f += np.float32(0.5)
        np.tanh(a[:, units:], out=g)
        o = np.subtract(g, h, out=out[t])
        o *= f
        o += h
        h = o
    return Window(before, found, gate, candidate, out, keep)


def product(a: np.ndarray, b: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``a @ b`` in slices too small for BLAS to share out among threads, whose waiting costs more than they save."""
    rows = max(1, SMALL // b.size)
    whole = len(a) - len(a) % rows
    out = np.empty((len(a), b.shape[1]), a.dtype) if out is None else out
    if whole:
        np.matmul(a[:whole].reshape(-1, rows, a.shape[1]), b, out=out[:whole].reshape(-1, rows, b.shape[1]))
    if whole < len(a):
        np.matmul(a[whole:], b, out=out[whole:])
    return out


def crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` in such slices."""
    rows = max(1, SMALL // (a.shape[1] * b.shape[1]))
    whole = len(a) - len(a) % rows
    total = a[whole:].T @ b[whole:]
    if whole:
        total += np.matmul(a[:whole].reshape(-1, rows, a.shape[1]).transpose(0, 2, 1), b[:whole].reshape(-1, rows, b.shape[1])).sum(0)
    return total


def softmax_parts(x: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of each row and their sums, in place; of what is below the row's largest value if the bound could overflow."""
    if bound > SAFE:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return x, x.sum(1)


def largest(factors: np.ndarray, bias: np.ndarray) -> float:
    """No value of states between -1 and 1 is further from zero, but for places without a symbol."""
    return float((np.abs(factors).sum(-2) + np.where(bias > PAD, np.abs(bias), 0)).max())


def pulls(parts: np.ndarray, sums: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Gradients of the log probabilities at the given places with respect to the values, in place."""
    parts *= (-1 / sums)[:, None]
    parts[at] += 1
    return parts


def predict(w: Weights, states: np.ndarray, symbols: np.ndarray, back: Weights | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each row's symbol; with ``back``, gradients of their sum are put there and the states' returned."""
    kinds, places = np.divmod(symbols, w.places)
    order = np.argsort(kinds.astype(np.uint16), kind="stable")  # rows of a class follow each other
    states, kinds, places = states[order], kinds[order], places[order]
    ends = np.cumsum(np.bincount(kinds, minlength=len(w.words))).tolist()
    blocks = [(k, slice(at, to)) for k, (at, to) in enumerate(zip([0, *ends], ends, strict=False)) if to > at]
    rows = np.arange(len(states))
    values = product(states, w.classes)
    values += w.class_bias
    parts, sums = softmax_parts(values, largest(w.classes, w.class_bias))
    p = parts[rows, kinds] / sums
    inside = np.empty((len(states), w.places), np.float32)
    for k, span in blocks:
        product(states[span], w.words[k], inside[span])
        inside[span] += w.word_bias[k]
    inside, inner = softmax_parts(inside, largest(w.words, w.word_bias))
    q = inside[rows, places] / inner
    logp = np.empty(len(states), np.float32)
    logp[order] = np.log(np.maximum(p, TINY)) + np.log(np.maximum(q, TINY))
    if back is None:
        return logp, None
    d = pulls(parts, sums, (rows, kinds))
    back.classes[:] = crossed(states, d)
    back.class_bias[:] = d.sum(0)
    pull = product(d, w.classes.T)
    d = pulls(inside, inner, (rows, places))
    for k, span in blocks:
        back.words[k] = crossed(states[span], d[span])
        back.word_bias[k] = d[span].sum(0)
        pull[span] += product(d[span], w.words[k].T)
    found = np.empty_like(pull)
    found[order] = pull
    return logp, found


def rows_summed(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    start = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    return index[start], np.add.reduceat(rows[order], start, axis=0)


def gradients(w: Weights, batch: Batch, span: slice, lanes: int, end: int, carried: np.ndarray, back: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fills ``back`` (all but ``inputs``) for one window; returns the last state, and symbols and gradients of used inputs."""
    win = run_window(w, batch, span, lanes, end, carried)
    steps, units = len(win.out), w.units
    here = batch.owner[span, :lanes].ravel() >= 0
    for a in (back.words, back.word_bias):
        a[:] = 0
    flat = win.out.reshape(-1, units)
    _, part = predict(w, flat[here], batch.symbol[span, :lanes].ravel()[here].astype(np.int64), back)
    pull = np.zeros_like(flat)
    pull[here] = part
    pull = pull.reshape(steps, lanes, units)
    moves = np.empty((steps, lanes, 2 * units), np.float32)
    turned, dh = w.turn.T.copy(), np.zeros((lanes, units), np.float32)
    for t in reversed(range(steps)):
        dh += pull[t]
        f, g = win.gate[t], win.candidate[t]
        da = moves[t]
        da[:, :units] = dh * (g - win.state[t]) * f * (1 - f)
        da[:, units:] = dh * f * (1 - g * g)
        dh *= 1 - f
        dh += da @ turned
        dh *= win.keep[t]
    rows = moves.reshape(-1, 2 * units)
    back.turn[:] = crossed(win.state.reshape(-1, units), rows)
    return win.out[-1], *rows_summed(win.before.ravel(), rows)


def train(w: Weights, documents: list[np.ndarray], end: int, lanes: int = LANES, steps: int = STEPS, rate: float = RATE) -> Weights:
    """New weights after one pass over the documents, by Adagrad on every window's mean gradient, with a falling rate."""
    w = w.like(w.flat())
    w = Weights(*(a.copy() for a in w.arrays()))
    if not documents:
        return w
    batch = Batch.of(documents, lanes, seed=17)
    back = Weights(*(np.zeros_like(a) for a in w.arrays()))
    power = [np.full(a.shape, CALM, np.float32) for a in w.arrays()]
    h = np.zeros((batch.symbol.shape[1], w.units), np.float32)
    depth = len(batch.symbol)
    share = np.float32(1 / (steps * batch.symbol.shape[1]))  # where few lanes still run, they count for less
    for span, running in batch.windows(steps):
        now = np.float32(rate * (1 - span.start / depth))
        last, used, pull = gradients(w, batch, span, running, end, h, back)
        h[:running] = last
        pull *= share
        power[0][used] += pull * pull
        w.inputs[used] += now * pull / np.sqrt(power[0][used])
        for a, s, g in list(zip(w.arrays(), power, back.arrays(), strict=True))[1:]:
            g *= share
            s += g * g
            a += now * g / np.sqrt(s)
    return w


def log_likelihoods(w: Weights, documents: list[np.ndarray], end: int, lanes: int = LANES, steps: int = STEPS) -> np.ndarray:
    """Natural log probability of each whole document."""
    total = np.zeros(len(documents))
    if not documents:
        return total
    batch = Batch.of(documents, lanes)
    h = np.zeros((batch.symbol.shape[1], w.units), np.float32)
    for span, running in batch.windows(steps):
        win = run_window(w, batch, span, running, end, h)
        h[:running] = win.out[-1]
        owner = batch.owner[span, :running].ravel()
        here = owner >= 0
        logp, _ = predict(w, win.out.reshape(-1, w.units)[here], batch.symbol[span, :running].ravel()[here].astype(np.int64))
        total += np.bincount(owner[here], logp, len(documents))
    return total

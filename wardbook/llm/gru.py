"""A small gated recurrent language model in numpy, with a class-factored output.

Words ``0..n_words-1`` are a shortlist, and one more id stands for all others, the tail. A step
predicts a class, then the word within it; the tail is the last class and has no words here.
Many classes are put in groups; then a step predicts a group, a class within it, and the word.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

FLOAT = np.float32
#: Words whose probabilities are looked up together, so that a class of rare words has some of them.
SCORED_AT_ONCE = 131_072
#: Logits, about, that are worked on at a time, so that they stay in the cache.
CHOICES_AT_ONCE = 65_536
#: Sums of powers that are taken as they are.
SUMS = (1e-30, 1e30)


@dataclass(frozen=True)
class Shape:
    """``class_starts``: first word of each class and, last, the number of words.

    ``group_starts``: first class of each group and, last, the number of classes, the tail among them; empty: no groups.
    """

    class_starts: tuple[int, ...]
    hidden: int
    group_starts: tuple[int, ...] = ()

    @property
    def n_words(self) -> int:
        return self.class_starts[-1]

    @property
    def n_classes(self) -> int:
        return len(self.class_starts)  # the last one is the tail

    def sizes(self) -> list[tuple[str, tuple[int, ...]]]:
        h, words, classes = self.hidden, self.n_words, self.n_classes
        out = [
            ("inputs", (words + 1, 3 * h)), ("recur", (h, 3 * h)), ("to_class", (h, classes)), ("class_bias", (classes,)),
            ("to_word", (words, h)), ("word_bias", (words,)),
        ]
        if self.group_starts:
            groups = len(self.group_starts) - 1
            out += [("to_group", (h, groups)), ("group_bias", (groups,))]
        return out

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parameters as views into one array."""
        out, at = {}, 0
        for name, size in self.sizes():
            n = int(np.prod(size))
            out[name] = flat[at : at + n].reshape(size)
            at += n
        return out

    def length(self) -> int:
        return sum(int(np.prod(size)) for _, size in self.sizes())


def equal_mass_classes(counts: np.ndarray, n: int) -> tuple[int, ...]:
    """Cuts of words in falling order of count into ``n`` classes of like square-root mass at most."""
    mass = np.cumsum(np.sqrt(counts + 1.0))
    of = np.minimum((mass / mass[-1] * n).astype(int), n - 1)
    return (*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(counts))


def class_counts(class_starts: Sequence[int], counts: np.ndarray, tail: int) -> np.ndarray:
    """Tokens of each class, the tail's last."""
    return np.array([*(counts[a:b].sum() for a, b in zip(class_starts, class_starts[1:])), tail], dtype=float)


def initial(shape: Shape, counts: np.ndarray, tail: int, seed: int) -> np.ndarray:
    """Small random weights; biases that start from the words' frequencies."""
    flat = np.random.default_rng(seed).normal(0, 0.1, shape.length()).astype(FLOAT)
    p = shape.views(flat)
    p["word_bias"][:] = np.log(counts + 1.0)
    sums = class_counts(shape.class_starts, counts, tail)
    p["class_bias"][:] = np.log(sums + 1.0)
    p["class_bias"] -= p["class_bias"].max()
    if shape.group_starts:
        groups = np.add.reduceat(sums, shape.group_starts[:-1])
        p["group_bias"][:] = np.log(groups + 1.0) - np.log(groups.max() + 1.0)
    return flat


def packed(texts: Sequence[np.ndarray], lanes: int) -> list[list[int]]:
    """Texts dealt to lanes, longest first, each to the lane that is shortest so far."""
    heap = [(0, i) for i in range(lanes)]
    out: list[list[int]] = [[] for _ in range(lanes)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        length, lane = heapq.heappop(heap)
        out[lane].append(i)
        heapq.heappush(heap, (length + len(texts[i]), lane))
    return [lane for lane in out if lane]


def windows(texts: Sequence[np.ndarray], start: int, lanes: int, steps: int) -> Iterator[tuple]:
    """``(x, y, owner, fresh)`` of shape (steps, lanes) each, over all words of all texts.

    ``x`` is the word before ``y``, ``start`` at a text's beginning, where ``fresh`` is set.
    ``owner`` is the text's index, -1 beyond a lane's end. Lanes are in falling order of length,
    and those at their end are left out of later windows.
    """
    dealt = sorted(packed(texts, lanes), key=lambda lane: -sum(len(texts[i]) for i in lane))
    order = [i for lane in dealt for i in lane]
    lengths = np.array([sum(len(texts[i]) for i in lane) for lane in dealt])
    # All lanes one after the other, and what stands for positions beyond a lane's end.
    begins = np.cumsum([0] + [len(texts[i]) for i in order])
    y = np.concatenate([*(texts[i] for i in order), [start]]).astype(np.int32)
    x = np.roll(y, 1)
    x[begins] = start
    owner = np.append(np.repeat(np.array(order, dtype=np.int32), np.diff(begins)), np.int32(-1))
    fresh = np.zeros(len(y), dtype=bool)
    fresh[begins[:-1]] = True
    first = np.cumsum(lengths) - lengths
    for low in range(0, int(lengths[0]), steps):
        live = int(np.searchsorted(-lengths, -low))
        step = low + np.arange(min(steps, int(lengths[0]) - low))[:, None]
        at = np.where(step < lengths[:live], first[:live] + step, len(y) - 1)
        yield x[at], y[at], owner[at], fresh[at]


def stream(texts: Sequence[np.ndarray], start: int, lanes: int, steps: int) -> Iterator[tuple]:
    """Windows over all texts one after the other, cut into ``lanes`` of one length.

    As ``windows``, but all windows are full up to the last: no few long texts make steps of their
    own. A lane that begins within a text reads on from its last word with an empty state.
    """
    y = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    fresh = np.diff(owner, prepend=-1) != 0
    x = np.where(fresh, start, np.roll(y, 1))
    length = -(-len(y) // lanes)

    def lanes_of(a: np.ndarray, rest: int) -> np.ndarray:
        return np.append(a, np.full(lanes * length - len(a), rest, dtype=a.dtype)).reshape(lanes, length).T

    x, y, owner, fresh = lanes_of(x, start), lanes_of(y, start), lanes_of(owner, -1), lanes_of(fresh, False)
    for low in range(0, length, steps):
        yield tuple(np.ascontiguousarray(a[low : low + steps]) for a in (x, y, owner, fresh))


class Model:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat
        self.p = shape.views(flat)
        self.class_of = np.full(shape.n_words + 1, shape.n_classes - 1, dtype=np.int64)
        for c, (a, b) in enumerate(zip(shape.class_starts, shape.class_starts[1:])):
            self.class_of[a:b] = c
        # Levels above the words: the choice of each word, names of the parameters, and the parts that are one softmax
        # each, as their first word, the next part's and their choices. Words: the same of each class.
        starts, groups = [*shape.class_starts, shape.n_words + 1], shape.group_starts
        self.levels: list[tuple] = []
        if groups:
            group_of = np.repeat(np.arange(len(groups) - 1), np.diff(groups))[self.class_of]
            self.levels.append((group_of, "to_group", "group_bias", [(0, shape.n_words + 1, 0, len(groups) - 1)]))
        parts = [(starts[a], starts[b], a, b) for a, b in zip(groups, groups[1:])] or [(0, shape.n_words + 1, 0, shape.n_classes)]
        self.levels.append((self.class_of, "to_class", "class_bias", [part for part in parts if part[3] - part[2] > 1]))
        self.inner = [(a, b) for a, b in zip(starts, starts[1:-1]) if b - a > 1]

    def run(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States after each step, and the last one. ``trace`` gets what going back needs."""
        n, recur = self.shape.hidden, self.p["recur"].copy()
        states = np.empty((*x.shape, n), dtype=FLOAT)
        drive = self.p["inputs"].take(x, axis=0)
        # A sigmoid is a hyperbolic tangent of half the argument.
        recur[:, : 2 * n] *= 0.5
        drive[..., : 2 * n] *= 0.5
        begun = fresh.any(axis=1).tolist()
        for t in range(len(x)):
            if begun[t]:
                h = h * ~fresh[t][:, None]
            pull = h @ recur
            gates = drive[t, :, : 2 * n] + pull[:, : 2 * n]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :n], gates[:, n:]
            new = r * pull[:, 2 * n :]
            new += drive[t, :, 2 * n :]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((h, z, r, new, pull[:, 2 * n :]))
            h = h - new
            h *= z
            h += new
            states[t] = h
        return states, h

    def log_prob(self, states: np.ndarray, y: np.ndarray, grads: dict | None = None, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each ``y`` (tail: of its class), and the states' gradient.

        Targets are put in order of their classes, so that each class has its states side by side.
        """
        order = np.argsort(y, kind="stable")
        h, words = states[order], y[order]
        with np.errstate(over="ignore", invalid="ignore"):
            found, back, sums = self._choices(h, words, grads, scale, shift=False)
            if not ((sums > SUMS[0]) & (sums < SUMS[1])).all():
                found, back, _ = self._choices(h, words, grads, scale, shift=True)
        out = np.empty_like(found)
        out[order] = found
        if back is None:
            return out, None
        unsorted = np.empty_like(back)
        unsorted[order] = back
        return out, unsorted

    def _choices(self, h: np.ndarray, words: np.ndarray, grads: dict | None, scale: float, shift: bool) -> tuple:
        """Log-probabilities of ``words``, which are in order, the states' gradients, and all sums of powers.

        One pass of exponentials serves all. ``shift``: a row's largest logit is taken off it.
        """
        size, p = len(words), self.p
        back, terms = None if grads is None else np.zeros_like(h), np.empty_like(h)
        ones, rows, found, sums = np.ones(size + self.shape.n_words, dtype=h.dtype), np.arange(size), [], []

        def softmax(low: int, high: int, at: np.ndarray, weights: np.ndarray, bias: np.ndarray, chosen: np.ndarray,
                    total: np.ndarray) -> tuple:
            """Powers, in units of which the gradient is to be taken ``scale / total`` times."""
            powers = h[low:high] @ weights
            powers += bias
            if shift:
                powers -= powers.max(axis=1)[:, None]
            width, flat = len(bias), powers.reshape(-1)
            cells = rows[: high - low] * width + at[low:high]
            flat.take(cells, out=chosen[low:high])
            np.exp(powers, out=powers)
            np.dot(powers, ones[:width], out=total[low:high])
            if grads is None:
                return powers, None
            flat[cells] -= total[low:high]
            np.dot(powers, weights.T, out=terms[low:high])
            return powers, scale / total[low:high]

        for of, to, to_bias, parts in self.levels:
            of, chosen, total = of[words], np.zeros(size, dtype=h.dtype), np.ones(size, dtype=h.dtype)
            terms[:] = 0
            if grads is not None:
                grads[to][:], grads[to_bias][:] = 0, 0
            cuts = np.searchsorted(words, [part[:2] for part in parts]).reshape(-1, 2).tolist()
            for (begin, end), (_, _, a, b) in zip(cuts, parts):
                at_once = max(1, CHOICES_AT_ONCE // (b - a))
                for low in range(begin, end, at_once):
                    high = min(end, low + at_once)
                    powers, share = softmax(low, high, of - a, p[to][:, a:b], p[to_bias][a:b], chosen, total)
                    if grads is not None:
                        grads[to][:, a:b] += (h[low:high] * share[:, None]).T @ powers
                        grads[to_bias][a:b] += share @ powers
            found.append(chosen), sums.append(total)
            if back is not None:
                back += terms * (scale / total)[:, None]

        chosen, total, at = np.zeros(size, dtype=h.dtype), np.ones(size, dtype=h.dtype), words.copy()
        terms[:] = 0
        cuts = np.searchsorted(words, self.inner).reshape(-1, 2).tolist()
        for (low, high), (a, b) in zip(cuts, self.inner):
            if low == high:
                continue
            at[low:high] -= a
            powers, share = softmax(low, high, at, p["to_word"][a:b].T, p["word_bias"][a:b], chosen, total)
            if grads is not None:
                # A class comes once per call: what an earlier call left of it is overwritten.
                np.dot(powers.T, h[low:high] * share[:, None], out=grads["to_word"][a:b])
                np.dot(share, powers, out=grads["word_bias"][a:b])
        found.append(chosen), sums.append(total)
        if back is not None:
            back += terms * (scale / total)[:, None]
        return sum(found) - sum(map(np.log, sums)), back, np.concatenate(sums)

    def back(self, x: np.ndarray, fresh: np.ndarray, trace: list, above: np.ndarray, grads: dict) -> None:
        """Truncated backpropagation through one window."""
        n, recur = self.shape.hidden, self.p["recur"].T.copy()
        h, z, r, new, pull = (np.stack(part) for part in zip(*trace))
        begun = fresh.any(axis=1).tolist()
        by_new, by_z, by_r = (1 - z) * (1 - new * new), (h - new) * z * (1 - z), pull * r * (1 - r)
        dh = np.zeros_like(above[0])
        d_drive, d_pull = np.empty((2, *x.shape, 3 * n), dtype=FLOAT)
        for t in range(len(x) - 1, -1, -1):
            dh = dh + above[t]
            d, e = d_drive[t], d_pull[t]
            d_new = np.multiply(dh, by_new[t], out=d[:, 2 * n :])
            np.multiply(dh, by_z[t], out=d[:, :n])
            np.multiply(d_new, by_r[t], out=d[:, n : 2 * n])
            e[:, : 2 * n] = d[:, : 2 * n]
            np.multiply(d_new, r[t], out=e[:, 2 * n :])
            dh *= z[t]
            dh += e @ recur
            if begun[t]:
                dh *= ~fresh[t][:, None]
        grads["recur"] += h.reshape(-1, n).T @ d_pull.reshape(-1, 3 * n)
        words, at = np.unique(x, return_inverse=True)
        cells = (at.reshape(-1, 1) * (3 * n) + np.arange(3 * n)).ravel()
        sums = np.bincount(cells, weights=d_drive.ravel(), minlength=len(words) * 3 * n)
        grads["inputs"] = (words, sums.reshape(-1, 3 * n).astype(FLOAT))


def scores(model: Model, texts: Sequence[np.ndarray], start: int, lanes: int, steps: int) -> np.ndarray:
    """Log-probability (natural) of each text; the state is carried from window to window."""
    total = np.zeros(len(texts))
    h, held, size = None, [], 0

    def add() -> None:
        states, y, owner = (np.concatenate(part) for part in zip(*held))
        total[:] += np.bincount(owner, weights=model.log_prob(states, y)[0], minlength=len(texts))

    for x, y, owner, fresh in windows(texts, start, lanes, steps):
        h = np.zeros((x.shape[1], model.shape.hidden), dtype=FLOAT) if h is None else h[: x.shape[1]]
        states, h = model.run(x, fresh, h)
        real = (owner >= 0).ravel()
        held.append((states.reshape(-1, model.shape.hidden)[real], y.ravel()[real], owner.ravel()[real]))
        size += len(held[-1][1])
        if size >= SCORED_AT_ONCE:
            add()
            held, size = [], 0
    if held:
        add()
    return total


class Trainer:
    """Adagrad over windows of ``steps`` words in each lane, each word of one weight; ``seen`` are its sums of squares so far."""

    def __init__(self, model: Model, rate: float, seen: np.ndarray | None = None):
        self.model, self.rate = model, rate
        self.seen = np.full(len(model.flat), 0.1, dtype=FLOAT) if seen is None else seen
        self.seen_views = model.shape.views(self.seen)

    def _step(self, name: str, grad: np.ndarray, at=slice(None)) -> None:
        np.clip(grad, -5, 5, out=grad)
        seen = self.seen_views[name]
        power = grad * grad
        seen[at] += power
        np.sqrt(seen[at], out=power)
        np.divide(grad, power, out=power)
        power *= self.rate
        self.model.p[name][at] -= power

    def learn(self, texts: Sequence[np.ndarray], start: int, lanes: int, steps: int) -> None:
        model, h, n = self.model, None, self.model.shape.hidden
        words = {k: np.zeros_like(model.p[k]) for k in ("to_word", "word_bias")}
        for x, y, owner, fresh in stream(texts, start, lanes, steps):
            h = np.zeros((x.shape[1], n), dtype=FLOAT) if h is None else h
            trace: list = []
            states, h = model.run(x, fresh, h, trace)
            real = np.flatnonzero(owner.ravel() >= 0)
            grads = {k: np.zeros_like(v) for k, v in model.p.items() if k != "inputs" and k not in words} | words
            _, d = model.log_prob(states.reshape(-1, n)[real], y.ravel()[real], grads, 16.0 / (lanes * steps))
            above = np.zeros((x.size, n), dtype=FLOAT)
            above[real] = d
            model.back(x, fresh, trace, above.reshape(states.shape), grads)
            rows, rows_grad = grads.pop("inputs")
            self._step("inputs", rows_grad, rows)
            for name in grads.keys() - words.keys():
                self._step(name, grads[name])
            for a, b in self._met(y.ravel()[real]):
                for name, grad in words.items():
                    self._step(name, grad[a:b], slice(a, b))

    def _met(self, y: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of the words whose classes occur in ``y``; only these have gradients."""
        starts = self.model.shape.class_starts
        met = np.bincount(self.model.class_of[y], minlength=len(starts))[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], met, [False]]).astype(np.int8)))
        return [(starts[a], starts[b]) for a, b in zip(edges[::2], edges[1::2])]

"""A gated recurrent language model in numpy, with a class-factored output.

Tokens are numbers: words of the head, each in one of ``classes`` classes, then tail classes.  The output
softmax first chooses a class, a head class or a tail class, then the word within a head class.  Each
word has its own input vector for the gates.  Documents run through lanes, one behind the other; the
state is carried from window to window and starts from zero with each document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

HIDDEN = 24
#: Lanes side by side at most, and steps of a window: in training, where gradients end, and in scoring.
LANES, TRAIN_STEPS, SCORE_STEPS = 512, 32, 64
RATE, CLIP = 0.01, 1.0


@dataclass
class Shape:
    """Token numbers: the head's words, then the tail's classes."""

    head: int
    classes: int
    tail: int
    hidden: int = HIDDEN

    @property
    def per_class(self) -> int:
        return -(-self.head // self.classes)

    def parts(self) -> dict[str, tuple[int, ...]]:
        h, rows = self.hidden, self.per_class * self.classes
        return {
            "input": (self.head + self.tail, 3 * h),
            "gates": (h, 2 * h),
            "candidate": (h, h),
            "choice": (h, self.classes + self.tail),
            "choice_bias": (self.classes + self.tail,),
            "word": (rows, h),
            "word_bias": (rows,),
        }


def initial(shape: Shape, frequencies: np.ndarray | None = None, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights; the biases are those of the tokens' frequencies, if given."""
    random = np.random.default_rng(seed)
    made = {}
    for name, size in shape.parts().items():
        scale = 0.0 if name.endswith("bias") else 0.08 if name in ("input", "word") else 1 / np.sqrt(size[0])
        made[name] = (random.standard_normal(size) * scale).astype(np.float32)
    if frequencies is not None:
        logs = np.log(np.asarray(frequencies) + 1.0)
        head = np.arange(shape.head)
        made["word_bias"][head % shape.classes * shape.per_class + head // shape.classes] = logs[: shape.head]
        sums = np.bincount(head % shape.classes, np.exp(logs[: shape.head]), shape.classes)
        made["choice_bias"][:] = np.concatenate([np.log(np.maximum(sums, 1e-9)), logs[shape.head :]])
        made["choice_bias"] -= made["choice_bias"].max()
        made["word_bias"] -= made["word_bias"].max()
    # a class that holds fewer words than others leaves places that no word has
    at = np.arange(shape.per_class * shape.classes)
    made["word_bias"][at % shape.per_class * shape.classes + at // shape.per_class >= shape.head] = -1e4
    return made


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unflat(shape: Shape, values: np.ndarray) -> dict[str, np.ndarray]:
    made, at = {}, 0
    for name, size in shape.parts().items():
        count = int(np.prod(size))
        made[name] = values[at : at + count].reshape(size).astype(np.float32)
        at += count
    return made


@dataclass
class Lanes:
    """Documents laid out in lanes: at each step and lane the token read, the token to tell (-1:
    nothing), the document (by place in the list) and whether one begins."""

    read: np.ndarray
    told: np.ndarray
    document: np.ndarray
    begins: np.ndarray


def lay_out(documents: list[np.ndarray], start: int, lanes: int = LANES) -> Lanes:
    """The longest documents first, each into the lane with the fewest tokens.  Lanes are ordered by
    length, the longest first."""
    sizes = np.array([len(d) for d in documents])
    total, longest = int(sizes.sum()), int(sizes.max())
    lanes = int(np.clip(2 * total // longest, 1, min(lanes, len(documents))))
    lengths = np.zeros(lanes, np.int64)
    held: list[list[int]] = [[] for _ in range(lanes)]
    for n in np.argsort(-sizes, kind="stable"):
        lane = int(lengths.argmin())
        held[lane].append(int(n))
        lengths[lane] += sizes[n]
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max())
    read, told = np.zeros((steps, lanes), np.int32), np.full((steps, lanes), -1, np.int32)
    document, begins = np.zeros((steps, lanes), np.int32), np.zeros((steps, lanes), bool)
    for lane, source in enumerate(order):
        at = 0
        for n in held[source]:
            ids = documents[n]
            end = at + len(ids)
            told[at:end, lane] = ids
            read[at, lane] = start
            read[at + 1 : end, lane] = ids[:-1]
            document[at:end, lane] = n
            begins[at, lane] = True
            at = end
    return Lanes(read, told, document, begins)


def windows(lanes: Lanes, steps: int) -> Iterator[tuple[slice, int]]:
    """Runs of steps and the number of lanes that are still busy in them."""
    busy = (lanes.told >= 0).sum(axis=0)
    for at in range(0, len(lanes.told), steps):
        yield slice(at, min(at + steps, len(lanes.told))), int((busy > at).sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _softmax(logits: np.ndarray, bias: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of one place in each row, and all probabilities."""
    logits += bias
    if logits.size and logits.max() > 60:  # else no sum overflows
        logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[np.arange(len(at)), at]
    odds = np.exp(logits, out=logits)
    sums = odds @ np.ones(odds.shape[1], odds.dtype)
    odds *= (1 / sums)[:, None]
    return chosen - np.log(sums), odds


class Network:
    def __init__(self, shape: Shape, weights: dict[str, np.ndarray]) -> None:
        self.shape, self.w = shape, weights

    def _run(self, read: np.ndarray, begins: np.ndarray, state: np.ndarray, keep: bool) -> tuple:
        """States of a window after each step; with ``keep`` also what the gradients need."""
        h = self.shape.hidden
        given = self.w["input"][read]
        states = np.empty((*read.shape, h), np.float32)
        trail = tuple(np.empty_like(states) for _ in range(4)) if keep else None
        going = ~begins
        for t in range(len(read)):
            before = state * going[t][:, None]
            gates = _sigmoid(given[t, :, : 2 * h] + before @ self.w["gates"])
            update, reset = gates[:, :h], gates[:, h:]
            made = np.tanh(given[t, :, 2 * h :] + (reset * before) @ self.w["candidate"])
            state = before + update * (made - before)
            states[t] = state
            if trail:
                for held, value in zip(trail, (before, update, reset, made), strict=True):
                    held[t] = value
        return states, state, trail

    def _choices(self, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each token, and the place of a head word in its class."""
        head = told < self.shape.head
        choice = np.where(head, told % self.shape.classes, told - self.shape.head + self.shape.classes)
        return choice, np.where(head, told // self.shape.classes, -1)

    def _outputs(self, states: np.ndarray, told: np.ndarray, grads: dict | None) -> tuple:
        """Log probability of each token from its state; with ``grads`` these are added to, for the
        mean over the tokens, and the states' gradients are given."""
        choice, place = self._choices(told)
        order = np.argsort(choice, kind="stable")
        choice, place, states = choice[order], place[order], states[order]
        logs, odds = _softmax(states @ self.w["choice"], self.w["choice_bias"], choice)
        logs = logs.astype(np.float64)
        if grads is not None:
            odds[np.arange(len(odds)), choice] -= 1
            odds *= np.float32(1 / len(told))
            grads["choice"] += states.T @ odds
            grads["choice_bias"] += odds.sum(axis=0)
            back = odds @ self.w["choice"].T
        size = self.shape.per_class
        starts = np.searchsorted(choice, np.arange(self.shape.classes + 1))
        for n in np.flatnonzero(np.diff(starts)):
            own, part = slice(starts[n], starts[n + 1]), slice(n * size, (n + 1) * size)
            word, seen = self.w["word"][part], states[own]
            more, odds = _softmax(seen @ word.T, self.w["word_bias"][part], place[own])
            logs[own] += more
            if grads is not None:
                odds[np.arange(len(odds)), place[own]] -= 1
                odds *= np.float32(1 / len(told))
                grads["word"][part] += odds.T @ seen
                grads["word_bias"][part] += odds.sum(axis=0)
                back[own] += odds @ word
        given = np.empty_like(logs)
        given[order] = logs
        if grads is None:
            return given, None
        whole = np.empty_like(back)
        whole[order] = back
        return given, whole

    def scores(self, documents: list[np.ndarray], start: int = 0) -> np.ndarray:
        """Natural log probability of each document, all of its tokens."""
        totals = np.zeros(len(documents))
        if not documents:
            return totals
        lanes = lay_out(documents, start)
        state = np.zeros((lanes.read.shape[1], self.shape.hidden), np.float32)
        for steps, busy in windows(lanes, SCORE_STEPS):
            states, state, _ = self._run(lanes.read[steps, :busy], lanes.begins[steps, :busy], state[:busy], False)
            told = lanes.told[steps, :busy]
            there = told >= 0
            logs, _ = self._outputs(states[there], told[there], None)
            totals += np.bincount(lanes.document[steps, :busy][there], logs, len(documents))
        return totals

    def gradients(self, read: np.ndarray, told: np.ndarray, begins: np.ndarray, state: np.ndarray) -> tuple:
        """Of the mean negative log probability of a window's tokens, back to the window's start."""
        h = self.shape.hidden
        grads = {name: np.zeros_like(w) for name, w in self.w.items()}
        states, state, (before, update, reset, made) = self._run(read, begins, state, True)
        there = told >= 0
        logs, back = self._outputs(states[there], told[there], grads)
        coming = np.zeros_like(states)
        coming[there] = back
        inner = np.empty((*read.shape, 3 * h), np.float32)
        behind = np.zeros_like(state)
        for t in range(len(read) - 1, -1, -1):
            d = coming[t] + behind
            d_made = d * update[t] * (1 - made[t] ** 2)
            d_held = d_made @ self.w["candidate"].T
            inner[t, :, :h] = d * (made[t] - before[t]) * update[t] * (1 - update[t])
            inner[t, :, h : 2 * h] = d_held * before[t] * reset[t] * (1 - reset[t])
            inner[t, :, 2 * h :] = d_made
            behind = d * (1 - update[t]) + d_held * reset[t] + inner[t, :, : 2 * h] @ self.w["gates"].T
            behind *= ~begins[t][:, None]
        flat_inner, flat_before = inner.reshape(-1, 3 * h), before.reshape(-1, h)
        grads["gates"] += flat_before.T @ flat_inner[:, : 2 * h]
        grads["candidate"] += (reset.reshape(-1, h) * flat_before).T @ flat_inner[:, 2 * h :]
        order = np.argsort(read, axis=None, kind="stable")
        ids, firsts = np.unique(read.ravel()[order], return_index=True)
        grads["input"][ids] += np.add.reduceat(flat_inner[order], firsts, axis=0)
        return grads, state, -logs.sum()

    def train(self, documents: list[np.ndarray], adam: Adam, start: int = 0) -> tuple[float, int]:
        """One pass over the documents; the sum of negative log probabilities on the way, and tokens."""
        lanes = lay_out(documents, start)
        state = np.zeros((lanes.read.shape[1], self.shape.hidden), np.float32)
        loss, tokens = 0.0, 0
        for steps, busy in windows(lanes, TRAIN_STEPS):
            told = lanes.told[steps, :busy]
            grads, state, more = self.gradients(lanes.read[steps, :busy], told, lanes.begins[steps, :busy], state[:busy])
            count = int((told >= 0).sum())
            adam.step(self.w, grads, min(1.0, count / 1024))
            loss, tokens = loss + more, tokens + count
        return loss, tokens


class Adam:
    """Adaptive steps; a window of few tokens takes shorter ones."""

    def __init__(self, rate: float = RATE) -> None:
        self.rate, self.count = rate, 0
        self.first: dict[str, np.ndarray] = {}
        self.second: dict[str, np.ndarray] = {}

    def step(self, weights: dict[str, np.ndarray], grads: dict[str, np.ndarray], share: float) -> None:
        self.count += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        scale = np.float32(min(1.0, CLIP / max(norm, 1e-12)))
        rate = self.rate * share * np.sqrt(1 - 0.999**self.count) / (1 - 0.9**self.count)
        for name, grad in grads.items():
            grad *= scale
            first = self.first.setdefault(name, np.zeros_like(grad))
            second = self.second.setdefault(name, np.zeros_like(grad))
            first += np.float32(0.1) * (grad - first)
            second += np.float32(0.001) * (grad * grad - second)
            weights[name] -= np.float32(rate) * first / (np.sqrt(second) + np.float32(1e-8))

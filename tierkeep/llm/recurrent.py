"""A gated recurrent language model in numpy, with a softmax factored into classes.

A token is predicted from the state before it: first its class, then the token within the class. Token
0 stands for all tokens outside the vocabulary and is a class of its own. Documents lie one behind the
other in lanes that are worked off side by side in windows; the state is carried from window to window
and cleared where a document begins, so a document is scored whole. In training the same windows are
used, and gradients stop at a window's start (truncated backpropagation through time).
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np

#: Components of the state; lanes side by side; steps of a window; classes of the vocabulary.
HIDDEN, LANES, WINDOW, CLASSES = 16, 512, 16, 16

#: Tokens of a piece in training: longer documents are cut into pieces, so that lanes are about equally long.
PIECE = 1024

#: Step size of the updates (Adagrad), and the largest norm of a gradient.
RATE, CLIP = 0.1, 5.0

PARTS = ("inputs", "state", "classes", "class_bias", "outputs", "output_bias")


def class_bounds(counts: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """First token of each class, and the end; class 0 is token 0.

    ``counts`` are those of tokens 0, 1, ..., the most frequent first from 1 on. Classes have about
    equal sums of the root of their counts, so frequent tokens have small classes.
    """
    if len(counts) < 2:
        return np.array([0, len(counts)], np.int64)
    sums = np.cumsum(np.sqrt(np.maximum(counts[1:], 1)))
    number = np.minimum((sums - sums[0]) / sums[-1] * (classes - 1), classes - 2).astype(np.int64)
    return np.concatenate([[0], 1 + np.flatnonzero(np.diff(number, prepend=-1)), [len(counts)]])


class Lanes:
    """Documents dealt over lanes of about equal length, the longest lane first."""

    def __init__(self, documents: Sequence[np.ndarray], width: int = LANES):
        sizes = np.array([len(d) for d in documents], np.int64)
        width = max(1, min(width, len(documents)))
        loads, members = [(0, i) for i in range(width)], [[] for _ in range(width)]
        for doc in np.argsort(-sizes, kind="stable"):
            load, lane = heapq.heappop(loads)
            members[lane].append(doc)
            heapq.heappush(loads, (load + int(sizes[doc]), lane))
        members.sort(key=lambda docs: -sizes[docs].sum())
        order = np.array([d for docs in members for d in docs], np.int64)
        self.order = order
        self.flat = np.concatenate([documents[d] for d in order]) if len(order) else np.empty(0, np.uint16)
        self.begins = np.cumsum(sizes[order]) - sizes[order]
        self.lengths = np.array([sizes[docs].sum() for docs in members], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._first = np.zeros(len(self.flat), bool)
        self._first[self.begins[sizes[order] > 0]] = True

    def windows(self, steps: int = WINDOW):
        """(places in ``flat``, which of them are real, where documents begin), each steps x active lanes."""
        for begin in range(0, int(self.lengths[0]) if len(self.flat) else 0, steps):
            active = int(np.searchsorted(-self.lengths, -begin, "left"))
            at = begin + np.arange(min(steps, int(self.lengths[0]) - begin))[:, None]
            real = at < self.lengths[None, :active]
            places = np.where(real, self.starts[None, :active] + at, 0)
            yield places, real, self._first[places] & real

    def by_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per token, in the order in which the documents were given."""
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        ends = np.append(self.begins[1:], len(self.flat))
        out = np.empty(len(self.order))
        out[self.order] = sums[ends] - sums[self.begins]
        return out


class Model:
    """Weights of the model; ``bounds`` are the classes' first tokens and the end."""

    def __init__(self, bounds: np.ndarray, weights: dict[str, np.ndarray]):
        self.bounds, self.weights = bounds, weights
        self.hidden = weights["state"].shape[0]
        self.class_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.uint8)

    @classmethod
    def fresh(cls, counts: np.ndarray, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 7) -> Model:
        """A model that predicts tokens by their share in ``counts``, whatever came before."""
        bounds = class_bounds(counts, classes)
        rng, size, k = np.random.default_rng(seed), len(counts), len(bounds) - 1
        smooth = counts.astype(np.float64) + 1
        sums = np.add.reduceat(smooth, bounds[:-1])
        weights = {
            "inputs": rng.normal(0, 0.3, (size, 3 * hidden)),
            "state": rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden)),
            "classes": np.zeros((hidden, k)),
            "class_bias": np.log(sums / sums.sum()),
            "outputs": np.zeros((size, hidden)),
            "output_bias": np.log(smooth / np.repeat(sums, np.diff(bounds))),
        }
        return cls(bounds, {n: w.astype(np.float32) for n, w in weights.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in PARTS])

    def filled(self, flat: np.ndarray) -> Model:
        """The same model with other weights."""
        weights, at = {}, 0
        for n in PARTS:
            shape = self.weights[n].shape
            size = int(np.prod(shape))
            weights[n] = flat[at : at + size].reshape(shape).astype(np.float32)
            at += size
        return Model(self.bounds, weights)

    def log_likelihoods(self, documents: Sequence[np.ndarray]) -> np.ndarray:
        """Natural logarithm of each whole document's probability."""
        lanes = Lanes(documents)
        found = np.zeros(len(lanes.flat), np.float32)
        state = np.zeros((self.hidden, len(lanes.lengths)), np.float32)
        for places, real, first in lanes.windows():
            tokens = lanes.flat[places]
            run = _Run(self, tokens, first, state[:, : places.shape[1]], keep=False)
            logs, _ = run.predict(tokens, real, learn=False)
            found[places[real]] = logs
            state = run.last
        return lanes.by_document(found)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Softmax of the columns, in place; returns the logarithms of the sums that were divided by, shift included."""
    top = logits.max(0)
    np.subtract(logits, top, out=logits)
    np.exp(logits, out=logits)
    total = logits.sum(0)
    np.divide(logits, total, out=logits)
    return np.log(total) + top


class _Run:
    """One window: the states before every token, and what going back needs. Lanes lie in the last dimension."""

    def __init__(self, model: Model, tokens: np.ndarray, first: np.ndarray, state: np.ndarray, keep: bool):
        weights, h = model.weights, model.hidden
        steps, width = tokens.shape
        self.model, self.first, self._cleared = model, first, first.any(1)
        self.states = np.empty((steps, h, width), np.float32)
        self.inner = []
        drive = np.ascontiguousarray(weights["inputs"][tokens].transpose(0, 2, 1))
        matrix = np.ascontiguousarray(weights["state"].T)
        mixed, fresh = np.empty((3 * h, width), np.float32), np.empty((h, width), np.float32)
        for t in range(steps):
            now = self.states[t]
            np.copyto(now, state)
            if self._cleared[t]:
                now[:, first[t]] = 0
            if keep:
                mixed, fresh = np.empty_like(mixed), np.empty_like(fresh)
            np.matmul(matrix, now, out=mixed)
            gates = drive[t, : 2 * h]
            gates += mixed[: 2 * h]
            gates *= 0.5  # the logistic function by way of tanh
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            np.multiply(gates[h:], mixed[2 * h :], out=fresh)
            fresh += drive[t, 2 * h :]
            np.tanh(fresh, out=fresh)
            state = now - fresh
            state *= gates[:h]
            state += fresh
            if keep:
                self.inner.append((gates, fresh, mixed[2 * h :]))
        self.last = state

    def predict(self, tokens: np.ndarray, real: np.ndarray, learn: bool):
        """Log-likelihood of every real token in order of place, and with ``learn`` the gradients of the outputs.

        Tokens are put in order of their class, so every class is one product of matrices.
        """
        model, weights, h = self.model, self.model.weights, self.model.hidden
        where = np.flatnonzero(real.ravel())
        wanted = tokens.ravel()[where]
        kinds = model.class_of[wanted]
        order = np.argsort(kinds, kind="stable")
        wanted, kinds, where = wanted[order], kinds[order].astype(np.int64), where[order]
        states = self.states.transpose(1, 0, 2).reshape(h, -1)[:, where]
        rows = np.arange(len(wanted))
        logits = weights["classes"].T @ states
        logits += weights["class_bias"][:, None]
        hit = logits[kinds, rows]
        logs = hit - _softmax(logits)
        grads: dict[str, np.ndarray] = {}
        if learn:
            logits[kinds, rows] -= 1
            grads["classes"], grads["class_bias"] = states @ logits.T, logits.sum(1)
            back = weights["classes"] @ logits
            grads["outputs"] = np.zeros_like(weights["outputs"])
            grads["output_bias"] = np.zeros_like(weights["output_bias"])
        cuts = np.searchsorted(kinds, np.arange(len(model.bounds)))
        for k in range(len(model.bounds) - 1):
            a, b, low, high = cuts[k], cuts[k + 1], model.bounds[k], model.bounds[k + 1]
            if a == b or high - low == 1:
                continue
            own, at = states[:, a:b], wanted[a:b].astype(np.int64) - low
            inside = weights["outputs"][low:high] @ own
            inside += weights["output_bias"][low:high, None]
            some = rows[: b - a]
            hit = inside[at, some]
            logs[a:b] += hit - _softmax(inside)
            if learn:
                inside[at, some] -= 1
                np.matmul(inside, own.T, out=grads["outputs"][low:high])
                grads["output_bias"][low:high] = inside.sum(1)
                back[:, a:b] += weights["outputs"][low:high].T @ inside
        found = np.empty(len(logs), np.float32)
        found[order] = logs
        if learn:
            spread = np.zeros((h, real.size), np.float32)
            spread[:, where] = back
            grads["_states"] = spread.reshape(h, *real.shape)
        return found, grads

    def back(self, from_outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the drives (3 hidden, steps x lanes) and of the state's matrix."""
        h, matrix = self.model.hidden, self.model.weights["state"]
        steps, width = self.first.shape
        drives = np.empty((3 * h, steps, width), np.float32)
        mixes = np.empty((3 * h, steps, width), np.float32)
        ahead = np.zeros((h, width), np.float32)
        mix = np.empty((3 * h, width), np.float32)
        for t in range(steps - 1, -1, -1):
            gates, fresh, mixed = self.inner[t]
            z, r = gates[:h], gates[h:]
            inner = fresh * fresh
            np.subtract(1, inner, out=inner)
            slope = 1 - gates
            inner *= slope[:h]
            inner *= ahead
            slope *= gates
            np.subtract(self.states[t], fresh, out=mix[:h])
            mix[:h] *= ahead
            np.multiply(inner, mixed, out=mix[h : 2 * h])
            mix[: 2 * h] *= slope
            np.multiply(inner, r, out=mix[2 * h :])
            drives[: 2 * h, t], drives[2 * h :, t] = mix[: 2 * h], inner
            mixes[:, t] = mix
            ahead = ahead * z
            ahead += matrix @ mix
            ahead += from_outputs[:, t]
            if self._cleared[t]:
                ahead[:, self.first[t]] = 0
        flat = self.states.transpose(1, 0, 2).reshape(h, -1)
        return drives.reshape(3 * h, -1), flat @ mixes.reshape(3 * h, -1).T


class Learner:
    """Updates a model window by window; one lot of documents after the other. Every token is learnt from."""

    def __init__(self, model: Model, rate: float = RATE):
        self.model, self.rate, self.tokens = model, rate, 0
        self._squares = {n: np.full(w.shape, 1e-4, np.float32) for n, w in model.weights.items()}

    def learn(self, documents: Sequence[np.ndarray]) -> None:
        lanes = Lanes([d[i : i + PIECE] for d in documents for i in range(0, len(d), PIECE)])
        self.tokens += len(lanes.flat)
        state = np.zeros((self.model.hidden, len(lanes.lengths)), np.float32)
        for places, real, first in lanes.windows():
            tokens = lanes.flat[places]
            run = _Run(self.model, tokens, first, state[:, : places.shape[1]], keep=True)
            _, grads = run.predict(tokens, real, learn=True)
            drives, grads["state"] = run.back(grads.pop("_states"))
            self._step(grads, tokens, drives, int(real.sum()))
            state = run.last

    def _step(self, grads: dict[str, np.ndarray], tokens: np.ndarray, drives: np.ndarray, real: int) -> None:
        flat = tokens.ravel()
        order = np.argsort(flat, kind="stable")
        kinds = flat[order]
        starts = np.flatnonzero(np.diff(kinds.astype(np.int64), prepend=-1))
        named = kinds[starts]
        rows = np.add.reduceat(np.take(drives, order, axis=1), starts, axis=1).T
        # a window of few tokens counts less than a full one
        share = np.float32(1 / max(real, LANES))
        norm = np.sqrt(sum(float((g * g).sum()) for g in (*grads.values(), rows))) * share
        share *= np.float32(min(1.0, CLIP / max(norm, 1e-12)))
        for name, grad in grads.items():
            grad *= share
            self._squares[name] += grad * grad
            self.model.weights[name] -= self.rate * grad / np.sqrt(self._squares[name])
        rows *= share
        squares = self._squares["inputs"][named] + rows * rows
        self._squares["inputs"][named] = squares
        self.model.weights["inputs"][named] -= self.rate * rows / np.sqrt(squares)

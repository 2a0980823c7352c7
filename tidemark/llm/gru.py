"""A small gated recurrent language model in numpy.

One layer of gated units reads words; a class-factored softmax predicts the next one: first its
class, then the word within the class. Frequent words have outputs of their own. Classes of the
rest end there, and a fixed distribution finishes. Training is Adam over windows of a few steps;
gradients stop at a window's start (truncated backpropagation), the state does not. Many documents run
side by side in lanes.
"""

from __future__ import annotations

import heapq
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAMES = ("read", "recur", "bias", "out", "out_bias", "word", "word_bias")


@dataclass
class Layout:
    """Words ``0 .. n_words - 1`` lie class by class: class ``k`` has ``starts[k] : starts[k + 1]``.

    Classes from ``len(starts) - 1`` up to ``n_classes`` hold words without outputs. Inputs are the words,
    then those classes, then the start of a document.
    """

    starts: np.ndarray
    n_classes: int
    hidden: int

    @property
    def n_words(self) -> int:
        return int(self.starts[-1])

    @property
    def n_inputs(self) -> int:
        return self.n_words + self.n_classes - (len(self.starts) - 1) + 1

    def shapes(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {
            "read": (self.n_inputs, 3 * h),
            "recur": (h, 3 * h),
            "bias": (3 * h,),
            "out": (h, self.n_classes),
            "out_bias": (self.n_classes,),
            "word": (h, self.n_words),
            "word_bias": (self.n_words,),
        }


def initial(layout: Layout, class_share: np.ndarray, word_share: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights with which the model predicts plain frequencies."""
    r = np.random.default_rng(seed)
    p = {name: (r.standard_normal(s) * 0.1).astype(np.float32) for name, s in layout.shapes().items()}
    p["bias"][:] = 0
    p["recur"] /= np.float32(np.sqrt(layout.hidden) * 0.1)
    p["recur"] *= np.float32(0.5)
    for name in ("out", "word"):
        p[name] *= np.float32(0.1)
    p["out_bias"][:] = np.log(np.maximum(class_share, 1e-9))
    p["word_bias"][:] = np.log(np.maximum(word_share, 1e-9))
    return p


def pack(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(p[n], np.float32).tobytes() for n in NAMES)


def unpack(layout: Layout, flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name in NAMES:
        shape = layout.shapes()[name]
        size = int(np.prod(shape))
        out[name] = np.array(flat[at : at + size], np.float32).reshape(shape)
        at += size
    return out


def lanes(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of tokens by step and lane, -1 where a lane has ended, and where documents start.

    Documents go, longest first, to the lane with the fewest tokens; lanes are in order of length.
    There are no more lanes than the longest document leaves filled, so the table is about as large as the texts.
    """
    full = -(-int(lengths.sum()) // max(int(lengths.max(initial=1)), 1))
    n = max(1, min(most, len(lengths), full))
    heap = [(0, k) for k in range(n)]
    rows: list[list[int]] = [[] for _ in range(n)]
    for d in np.argsort(-lengths, kind="stable"):
        size, k = heapq.heappop(heap)
        rows[k].append(int(d))
        heapq.heappush(heap, (size + int(lengths[d]), k))
    total = np.array([sum(int(lengths[d]) for d in r) for r in rows])
    order = np.argsort(-total, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    place = np.full((int(total.max(initial=0)), n), -1, np.int64)
    first = np.zeros(place.shape, bool)
    for lane, k in enumerate(order):
        at = 0
        for d in rows[k]:
            place[at : at + lengths[d], lane] = np.arange(offsets[d], offsets[d + 1])
            first[at, lane] = True
            at += int(lengths[d])
    return place, first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, np.float32(60), out=x), out=x)
    x += np.float32(1)
    return np.reciprocal(x, out=x)


class Model:
    def __init__(self, layout: Layout, p: dict[str, np.ndarray]):
        self.layout, self.p = layout, p

    def _window(self, inputs: np.ndarray, first: np.ndarray, state: np.ndarray, keep: bool):
        """States after each step of a window, and what the way back needs."""
        p, h = self.p, self.layout.hidden
        steps, n = inputs.shape
        states = np.empty((steps, n, h), np.float32)
        saved = []
        read = p["read"][inputs] + p["bias"]
        for t in range(steps):
            if first[t].any():
                state = np.where(first[t][:, None], np.float32(0), state)
            back = state @ p["recur"]
            x = read[t]
            gates = _sigmoid(x[:, : 2 * h] + back[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * back[:, 2 * h :])
            after = new + z * (state - new)
            if keep:
                saved.append((state, z, r, new, back[:, 2 * h :]))
            states[t] = state = after
        return states, state, saved

    def log_likelihood(self, states: np.ndarray, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural logarithm per token, of its class and, where it has an output, its word."""
        p = self.p
        scores = states @ p["out"] + p["out_bias"]
        top = scores.max(1)
        result = scores[np.arange(len(classes)), classes] - top
        scores -= top[:, None]
        result -= np.log(np.exp(scores, out=scores).sum(1))
        for a, b, rows in self._by_class(classes):
            if b - a > 1:
                s = states[rows] @ p["word"][:, a:b] + p["word_bias"][a:b]
                s -= s.max(1)[:, None]
                own = s[np.arange(len(rows)), words[rows] - a]
                result[rows] += own - np.log(np.exp(s, out=s).sum(1))
        return result

    def _by_class(self, classes: np.ndarray):
        order = np.argsort(classes, kind="stable")
        starts = self.layout.starts
        edges = np.searchsorted(classes[order], np.arange(len(starts)))
        for k in range(len(starts) - 1):
            if edges[k + 1] > edges[k]:
                yield int(starts[k]), int(starts[k + 1]), order[edges[k] : edges[k + 1]]

    def score(self, inputs, classes, words, place, first, window: int = 64) -> np.ndarray:
        """Log-likelihood of each token; ``place`` and ``first`` are of :func:`lanes`."""
        result = np.zeros(len(classes), np.float64)
        active = (place >= 0).sum(1)
        state = np.zeros((place.shape[1], self.layout.hidden), np.float32)
        for a in range(0, len(place), window):
            part = place[a : a + window]
            n = int(active[a])
            part = part[:, :n]
            safe = np.maximum(part, 0)
            states, state, _ = self._window(inputs[safe], first[a : a + window, :n], state[:n], False)
            rows = part >= 0
            at = part[rows]
            result[at] = self.log_likelihood(states[rows], classes[at], words[at])
        return result

    def train(self, adam: Adam, inputs, classes, words, place, first, window: int = 16) -> None:
        """One pass over the lanes, an update per window."""
        active = (place >= 0).sum(1)
        state = np.zeros((place.shape[1], self.layout.hidden), np.float32)
        for a in range(0, len(place), window):
            n = int(active[a])
            part = place[a : a + window, :n]
            starts = first[a : a + window, :n]
            read = inputs[np.maximum(part, 0)]
            states, state, saved = self._window(read, starts, state[:n], True)
            rows = part >= 0
            at = part[rows]
            slopes, back = self._output_slopes(states[rows], classes[at], words[at])
            into = np.zeros(states.shape, np.float32)
            into[rows] = back
            self._recurrent_slopes(slopes, into, read, starts, saved)
            adam.step(self.p, slopes, len(at))

    def _output_slopes(self, states, classes, words):
        p = self.p
        scores = states @ p["out"] + p["out_bias"]
        scores -= scores.max(1)[:, None]
        np.exp(scores, out=scores)
        scores /= scores.sum(1)[:, None]
        scores[np.arange(len(classes)), classes] -= 1
        slopes = {"out": states.T @ scores, "out_bias": scores.sum(0)}
        back = scores @ p["out"].T
        slopes["word"] = np.zeros_like(p["word"])
        slopes["word_bias"] = np.zeros_like(p["word_bias"])
        for a, b, rows in self._by_class(classes):
            if b - a > 1:
                own = states[rows]
                s = own @ p["word"][:, a:b] + p["word_bias"][a:b]
                s -= s.max(1)[:, None]
                np.exp(s, out=s)
                s /= s.sum(1)[:, None]
                s[np.arange(len(rows)), words[rows] - a] -= 1
                slopes["word"][:, a:b] = own.T @ s
                slopes["word_bias"][a:b] = s.sum(0)
                back[rows] += s @ p["word"][:, a:b].T
        return slopes, back

    def _recurrent_slopes(self, slopes, into, read, starts, saved) -> None:
        p, h = self.p, self.layout.hidden
        steps, n = read.shape
        gate_slopes = np.empty((steps, n, 3 * h), np.float32)
        throughs = np.empty((steps, n, 3 * h), np.float32)
        later = np.zeros((n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            state, z, r, new, back = saved[t]
            d = into[t] + later
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (state - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            g = gate_slopes[t]
            g[:, :h], g[:, h : 2 * h], g[:, 2 * h :] = d_z, d_r, d_new
            through = throughs[t]
            through[:, :h], through[:, h : 2 * h], through[:, 2 * h :] = d_z, d_r, d_new * r
            later = d * z + through @ p["recur"].T
            if starts[t].any():
                later[starts[t]] = 0
        before = np.stack([state for state, *_ in saved]).reshape(-1, h)
        slopes["recur"] = before.T @ throughs.reshape(-1, 3 * h)
        flat = gate_slopes.reshape(-1, 3 * h)
        slopes["bias"] = flat.sum(0)
        ids = read.ravel()
        order = np.argsort(ids, kind="stable")
        kinds, edges = np.unique(ids[order], return_index=True)
        slopes["read"] = np.zeros_like(p["read"])
        slopes["read"][kinds] = np.add.reduceat(flat[order], edges, 0)


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.rate, self.t = rate, 0
        self.mean = {n: np.zeros_like(v) for n, v in p.items()}
        self.square = {n: np.zeros_like(v) for n, v in p.items()}

    def step(self, p: dict[str, np.ndarray], slopes: dict[str, np.ndarray], n: int) -> None:
        if not n:
            return
        self.t += 1
        scale = np.float32(self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for name, slope in slopes.items():
            slope *= np.float32(1 / n)
            np.clip(slope, -1, 1, out=slope)
            m, v = self.mean[name], self.square[name]
            m += np.float32(0.1) * (slope - m)
            v += np.float32(0.001) * (slope * slope - v)
            p[name] -= scale * m / (np.sqrt(v) + np.float32(1e-7))

"""A gated recurrent language model in numpy: windows forward and back, documents laid out in parallel streams."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CLASS = 64  # words in one class of the frequent words


@dataclass(frozen=True)
class Shape:
    """Units 0 to ``head`` - 1 are words of their own, in classes of CLASS; each further unit is a class of many words."""

    head: int
    tails: int
    hidden: int

    @property
    def head_classes(self) -> int:
        return -(-self.head // CLASS)

    @property
    def parts(self) -> dict[str, tuple[int, ...]]:
        h, classes = self.hidden, self.head_classes + self.tails
        return {"input": (self.head + self.tails, 3 * h), "state": (h, 3 * h), "to_class": (h, classes), "class_bias": (classes,),
                "to_word": (h, self.head), "word_bias": (self.head,)}

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts.values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def start(self, word_mass: np.ndarray, tail_mass: np.ndarray, seed: int) -> np.ndarray:
        """Weights that give every word its own frequency until they learn."""
        rng, flat = np.random.default_rng(seed), np.zeros(self.size, np.float32)
        v = self.views(flat)
        v["input"][:] = rng.normal(0, 0.3, v["input"].shape)
        v["state"][:] = rng.normal(0, 0.5 / np.sqrt(self.hidden), v["state"].shape)
        v["to_class"][:] = rng.normal(0, 0.02, v["to_class"].shape)
        v["to_word"][:] = rng.normal(0, 0.02, v["to_word"].shape)
        v["word_bias"][:] = np.log(word_mass)
        by_class = np.add.reduceat(word_mass, np.arange(0, self.head, CLASS))
        v["class_bias"][:] = np.log(np.concatenate([by_class, tail_mass]))
        return flat


class Streams:
    """Documents laid end to end in at most ``n`` streams of nearly equal length, longest stream first; none is cut.

    What is held grows with the tokens, not with the longest stream; only a
    window at a time is laid out in steps x streams.
    """

    def __init__(self, docs: list[np.ndarray], end: int, n: int, first: list[int] | None = None):
        heap = [(0, i) for i in range(min(n, len(docs)))]
        lanes: list[list[int]] = [[] for _ in heap]
        for d in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            size, lane = heapq.heappop(heap)
            lanes[lane].append(d)
            heapq.heappush(heap, (size + len(docs[d]), lane))
        lanes.sort(key=lambda ds: -sum(len(docs[d]) for d in ds))
        order = [d for ds in lanes for d in ds]
        sizes = np.array([len(docs[d]) for d in order], np.int64)
        starts = np.cumsum(sizes) - sizes
        self.end, self.length = end, np.array([sum(len(docs[d]) for d in ds) for ds in lanes], np.int64)
        self._begin = np.cumsum(self.length) - self.length
        self._targets = np.concatenate([docs[d] for d in order]).astype(np.int32)
        self._inputs = np.concatenate([[end], self._targets[:-1]]).astype(np.int32)
        self._fresh = np.zeros(len(self._targets), bool)
        some = sizes > 0
        self._fresh[starts[some]] = True
        self._inputs[starts[some]] = np.array([first[d] for d in order], np.int32)[some] if first else end
        self._number = np.repeat(np.array(order, np.int32), sizes)

    @property
    def n(self) -> int:
        return len(self.length)

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(inputs, targets, fresh, document), each steps x streams that have not ended.

        The unit before each target (``first``, or the end, before a
        document's own), the target or -1 past the end, whether a document
        begins, and its number.
        """
        for t in range(0, int(self.length.max(initial=0)), size):
            live = int((self.length > t).sum())  # streams end from the right
            step = np.arange(t, min(t + size, int(self.length[0])))[:, None]
            there = step < self.length[:live]
            at = np.where(there, self._begin[:live] + step, 0)
            yield (
                np.where(there, self._inputs[at], self.end).astype(np.int32), np.where(there, self._targets[at], -1).astype(np.int32),
                there & self._fresh[at], np.where(there, self._number[at], 0).astype(np.int32),
            )


class Network:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat
        self.w = shape.views(flat)
        self._class_of = np.concatenate([np.arange(shape.head) // CLASS, shape.head_classes + np.arange(shape.tails)])

    def _forward(self, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        k = self.shape.hidden
        steps, lanes = inputs.shape
        from_input = self.w["input"][inputs]
        keep = (~fresh).astype(np.float32)[:, :, None]
        before, after = np.empty((2, steps, lanes, k), np.float32)
        gates, new, from_state = np.empty((steps, lanes, 2 * k), np.float32), np.empty((steps, lanes, k), np.float32), np.empty((steps, lanes, k), np.float32)
        for t in range(steps):
            h = np.multiply(h, keep[t], out=before[t])
            u = h @ self.w["state"]
            g = gates[t]
            np.add(from_input[t, :, : 2 * k], u[:, : 2 * k], out=g)
            g *= 0.5
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            from_state[t] = u[:, 2 * k :]
            n = new[t]
            np.multiply(g[:, k:], from_state[t], out=n)
            n += from_input[t, :, 2 * k :]
            np.tanh(n, out=n)
            a = after[t]
            np.subtract(h, n, out=a)
            a *= g[:, :k]
            a += n
            h = a
        return before, gates, new, from_state, after

    def _outputs(self, h: np.ndarray, y: np.ndarray, grads: dict[str, np.ndarray] | None, scale: float) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target's class and, for a frequent word, of the word; gradient by state."""
        w, cls = self.w, self._class_of[y]
        logits = h @ w["to_class"]
        logits += w["class_bias"]
        logits -= logits.max(1, keepdims=True)
        rows = np.arange(len(y))
        out = logits[rows, cls].astype(np.float64)
        np.exp(logits, out=logits)
        total = logits.sum(1)
        out -= np.log(total)
        back = None
        if grads is not None:
            logits *= (scale / total)[:, None]
            logits[rows, cls] -= scale
            grads["to_class"] += h.T @ logits
            grads["class_bias"] += logits.sum(0)
            back = logits @ w["to_class"].T
        head = np.flatnonzero(y < self.shape.head)
        head = head[np.argsort(cls[head], kind="stable")]
        if len(head):
            cuts = np.flatnonzero(np.diff(cls[head], prepend=-1))
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(head)]):
                at = head[s:e]
                lo = int(cls[at[0]]) * CLASS
                hi = min(lo + CLASS, self.shape.head)
                own, word = h[at], y[at] - lo
                scores = own @ w["to_word"][:, lo:hi]
                scores += w["word_bias"][lo:hi]
                scores -= scores.max(1, keepdims=True)
                r = np.arange(len(at))
                found = scores[r, word].astype(np.float64)
                np.exp(scores, out=scores)
                total = scores.sum(1)
                out[at] += found - np.log(total)
                if grads is not None:
                    scores *= (scale / total)[:, None]
                    scores[r, word] -= scale
                    grads["to_word"][:, lo:hi] += own.T @ scores
                    grads["word_bias"][lo:hi] += scores.sum(0)
                    back[at] += scores @ w["to_word"][:, lo:hi].T
        return out, back

    def score(self, docs: list[np.ndarray], end: int, lanes: int, window: int) -> np.ndarray:
        """Natural log-probability of every document; the state is carried from window to window to its end."""
        laid = Streams(docs, end, lanes)
        out, h = np.zeros(len(docs)), np.zeros((laid.n, self.shape.hidden), np.float32)
        for inputs, targets, fresh, number in laid.windows(window):
            *_, after = self._forward(inputs, fresh, h[: inputs.shape[1]])
            h = after[-1]
            real = targets >= 0
            found, _ = self._outputs(after[real], targets[real], None, 0.0)
            out += np.bincount(number[real], found, len(docs))
        return out

    def train(self, docs: list[np.ndarray], end: int, lanes: int, window: int, rate: float, squares: np.ndarray, stretch: int = 1024) -> int:
        """One pass over all tokens by truncated backpropagation, with steps scaled by past gradients; tokens seen.

        Gradients stop at the beginning of a window; its state is that of the
        window before.  A document of more than ``stretch`` tokens is learned
        from in stretches side by side, which begin with the unit before them
        and without state, so that one long document does not hold up a batch.
        """
        k, w = self.shape.hidden, self.w
        cuts = [(d, s) for d in docs for s in range(0, len(d), stretch)]
        laid = Streams([d[s : s + stretch] for d, s in cuts], end, lanes, [int(d[s - 1]) if s else end for d, s in cuts])
        flat = np.zeros_like(self.flat)
        grads, held = self.shape.views(flat), self.shape.views(squares)
        seen, h = 0, np.zeros((laid.n, k), np.float32)
        scale = 1 / (window * max(laid.n, 1))
        dense = int(np.prod(self.shape.parts["input"]))
        for x, targets, fresh, _ in laid.windows(window):
            live = x.shape[1]
            before, gates, new, from_state, after = self._forward(x, fresh, h[:live])
            h = after[-1]
            real = targets >= 0
            flat[dense:] = 0
            _, back = self._outputs(after[real], targets[real], grads, scale)
            seen += int(real.sum())
            by_state = np.zeros(after.shape, np.float32)
            by_state[real] = back
            to_input, to_state = np.empty((*after.shape[:2], 3 * k), np.float32), np.empty((*after.shape[:2], 3 * k), np.float32)
            keep, carried = (~fresh).astype(np.float32)[:, :, None], np.zeros((live, k), np.float32)
            transposed = w["state"].T.copy()
            for s in range(len(after) - 1, -1, -1):
                d, z, r, n = by_state[s] + carried, gates[s, :, :k], gates[s, :, k:], new[s]
                to_n = d * (1 - z) * (1 - n * n)
                a, u = to_input[s], to_state[s]
                a[:, :k] = d * (before[s] - n) * (z * (1 - z))
                a[:, k : 2 * k] = to_n * from_state[s] * (r * (1 - r))
                a[:, 2 * k :] = to_n
                u[:, : 2 * k] = a[:, : 2 * k]
                np.multiply(to_n, r, out=u[:, 2 * k :])
                carried = (d * z + u @ transposed) * keep[s]
            grads["state"] += before.reshape(-1, k).T @ to_state.reshape(-1, 3 * k)
            units, order = x.ravel(), np.argsort(x.ravel(), kind="stable")
            first = np.flatnonzero(np.diff(units[order], prepend=-1))
            rows, change = units[order[first]], np.add.reduceat(to_input.reshape(-1, 3 * k)[order], first, axis=0)
            held["input"][rows] += change * change
            w["input"][rows] -= rate * change / (np.sqrt(held["input"][rows]) + 1e-7)
            g = flat[dense:]
            squares[dense:] += g * g
            self.flat[dense:] -= rate * g / (np.sqrt(squares[dense:]) + 1e-7)
        return seen

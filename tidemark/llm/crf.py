"""A linear-chain conditional random field in numpy, over word-shape features."""

from __future__ import annotations

import re

import numpy as np

TOKEN = re.compile("[A-Za-zÀ-ɏ]+|[0-9]+|[^\\sA-Za-zÀ-ɏ0-9]")
WEIGHTS = 1 << 13
ROUNDS, RATE, SHRINK = 80, 0.5, 1e-3

#: Words that are features by themselves; all others only by their shape.
CONTEXT = frozenset(
    "at dot phone tel telephone mobile fax call ring text mail email contact write ip host"
    " server address card visa account iban number page version section chapter line id"
    " order room price eur usd year".split()
)


def shape(token: str) -> str:
    """Letters as x and X, digits as d with their number, other characters as they are."""
    if token.isdigit():
        return f"d{min(len(token), 6)}"
    if token[0].isalpha():
        word = token.lower()
        if word in CONTEXT:
            return word
        case = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        return f"{case}{min(len(token), 4)}"
    return token


def tokens_of(text: str, low: int, high: int) -> tuple[list[int], list[int], list[str]]:
    """Starts, ends and shapes of the tokens of text[low:high]; a space before is a `_`."""
    starts, ends, shapes = [], [], []
    for m in TOKEN.finditer(text, low, high):
        a, b = m.span()
        apart = "_" if a and text[a - 1].isspace() else ""
        starts.append(a)
        ends.append(b)
        shapes.append(apart + shape(m.group()))
    return starts, ends, shapes


class Crf:
    """Labels, weights of hashed features and of label changes."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        self.weights = np.zeros((WEIGHTS, len(labels)))
        self.moves = np.zeros((len(labels), len(labels)))
        self.codes: dict[str, int] = {}

    def features(self, sequences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Feature places (sequences x tokens x features) and lengths."""
        length = np.array([len(s) for s in sequences])
        width = int(length.max(initial=1))
        codes = np.zeros((len(sequences), width + 4), dtype=np.int64)
        for row, sequence in zip(codes, sequences, strict=True):
            row[2 : 2 + len(sequence)] = [self._code(s) for s in sequence]
        around = [codes[:, k : k + width] for k in range(5)]
        b2, b1, own, a1, a2 = around
        pairs = [(own, 0), (b1, 0), (a1, 0), (b2, 0), (a2, 0), (b1, own), (own, a1), (b1, a1)]
        places = [
            ((x * 1_000_003 + y * 8_191 + k * 131) * 2_654_435_761 >> 7) % WEIGHTS
            for k, (x, y) in enumerate(pairs)
        ]
        return np.stack(places, axis=-1), length

    def _code(self, token: str) -> int:
        if token not in self.codes:
            value = 0
            for byte in token.encode():
                value = (value * 257 + byte + 1) % 1_000_000_007
            self.codes[token] = value
        return self.codes[token]

    def fit(self, sequences: list[list[str]], answers: list[list[int]]) -> None:
        """Maximum likelihood by AdaGrad; forward and backward over all sequences at once."""
        places, length = self.features(sequences)
        n, width, _ = places.shape
        n_labels = len(self.labels)
        inside = np.arange(width) < length[:, None]
        wanted = np.zeros((n, width, n_labels))
        for i, answer in enumerate(answers):
            wanted[i, np.arange(len(answer)), answer] = 1
        moved = np.einsum("nti,ntj->ij", wanted[:, :-1], wanted[:, 1:])
        seen_w, seen_m = np.full_like(self.weights, 1e-6), np.full_like(self.moves, 1e-6)
        for _ in range(ROUNDS):
            score = self.weights[places].sum(axis=2)
            ahead, behind = np.zeros_like(score), np.zeros_like(score)
            ahead[:, 0] = score[:, 0]
            for t in range(1, width):
                step = _log_sum(ahead[:, t - 1, :, None] + self.moves, 1) + score[:, t]
                ahead[:, t] = np.where(inside[:, t, None], step, ahead[:, t - 1])
            for t in range(width - 2, -1, -1):
                step = _log_sum(self.moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
                behind[:, t] = np.where(inside[:, t + 1, None], step, 0)
            total = _log_sum(ahead[:, -1], 1)[:, None, None]
            chance = np.exp(ahead + behind - total) * inside[..., None]
            pair = np.exp(
                ahead[:, :-1, :, None]
                + self.moves
                + (score[:, 1:] + behind[:, 1:])[:, :, None, :]
                - total[..., None]
            )
            pair = (pair * inside[:, 1:, None, None]).sum(axis=(0, 1))
            grad = np.zeros_like(self.weights)
            off = wanted - chance
            for k in range(places.shape[2]):
                np.add.at(grad, places[..., k][inside], off[inside])
            grad -= SHRINK * self.weights
            grad_m = moved - pair - SHRINK * self.moves
            seen_w += grad**2
            seen_m += grad_m**2
            self.weights += RATE * grad / np.sqrt(seen_w)
            self.moves += RATE * grad_m / np.sqrt(seen_m)

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each sequence, by Viterbi over padded batches of like length."""
        out: list[np.ndarray] = [np.empty(0, dtype=int)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            longest = len(sequences[order[at]]) * 2 + 8
            stop = at
            while stop < len(order) and stop - at < 512 and len(sequences[order[stop]]) <= longest:
                stop += 1
            part = order[at:stop]
            for i, path in zip(part, self._paths([sequences[i] for i in part]), strict=True):
                out[i] = path
            at = stop
        return out

    def _paths(self, sequences: list[list[str]]) -> list[np.ndarray]:
        places, length = self.features(sequences)
        score = self.weights[places].sum(axis=2)
        n, width, n_labels = score.shape
        came = np.zeros((n, width, n_labels), dtype=np.int8)
        best = score[:, 0]
        for t in range(1, width):
            ways = best[:, :, None] + self.moves
            came[:, t] = ways.argmax(axis=1)
            step = ways.max(axis=1) + score[:, t]
            best = np.where((t < length)[:, None], step, best)
        last = best.argmax(axis=1)
        paths = np.zeros((n, width), dtype=np.int64)
        rows = np.arange(n)
        for t in range(width - 1, -1, -1):
            paths[:, t] = last
            back = came[rows, t, last]
            last = np.where(t < length, back, last)
        return [path[:size] for path, size in zip(paths, length, strict=True)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

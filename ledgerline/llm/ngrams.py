"""Hashed n-gram features of whole texts, and linear models over them.

Features of a text: its byte trigrams (case kept), its words and its word
pairs, each hashed into a fixed number of buckets and divided by how many the
text has. A pair of equal words has a bucket of its own, so that stuttering is
seen whatever the word. Texts are taken in pieces of at most ``PIECE`` bytes, so
that memory doesn't grow with them. What a cut goes through is carried over: the
last two bytes, the word that is open and the word before it. So the features of
a text don't depend on where it is cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHAR_BUCKETS = 1 << 11
WORD_BUCKETS = 1 << 11
REPEATED_PAIR = CHAR_BUCKETS + WORD_BUCKETS       # the pair of equal words
WIDTH = REPEATED_PAIR + 1
PIECE = 256 << 10

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2**64."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = tuple(np.cumprod(np.full(size, x, dtype=np.uint64)) for x in (_STEP, _BACK))
    return _POWERS[size]


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)


@dataclass
class Carry:
    """What stands before the rest of a row that was cut."""

    tail: bytes = b""                       # its last two bytes
    open: tuple[int, int] | None = None     # hash and length of a word without an end so far
    word: int | None = None                 # the last whole word


def pieces(texts: list[str | None]):
    """Lists of (row, bytes) of at most PIECE bytes, over all texts in order, and whether
    the last row of the list goes on in the next one."""
    held, size = [], 0
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while at < len(raw):
            end = min(len(raw), at + PIECE - size)
            held.append((row, raw[at:end]))
            size += end - at
            at = end
            if size >= PIECE:
                yield held, at < len(raw)
                held, size = [], 0
    if held:
        yield held, False


_ALL = (1 << 64) - 1


def _joined(begun: tuple[int, int], rest: int, length: int) -> tuple[int, int]:
    """Hash and length of a word from those of its two parts."""
    h, n = begun
    return (h + pow(int(_STEP), n, 1 << 64) * rest) & _ALL, n + length


def _words(data: np.ndarray, piece: np.ndarray, carry: Carry, goes_on: bool) -> tuple[np.ndarray, np.ndarray, Carry]:
    """Hash and piece of each whole word in order, and what is left for the next list."""
    solid = ~_BLANK[data]
    new = np.ones(len(data), dtype=bool)
    new[1:] = piece[1:] != piece[:-1]
    starts = np.flatnonzero(solid & (new | np.append(True, ~solid[:-1])))
    ends = np.flatnonzero(solid & (np.append(new[1:], True) | np.append(~solid[1:], True))) + 1
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    words, of = (sums[ends] - sums[starts]) * down[starts], piece[starts]
    last = int(ends[-1] - starts[-1]) if len(words) else 0
    if carry.open:
        if solid[0]:
            h, n = _joined(carry.open, int(words[0]), int(ends[0] - starts[0]))
            words[0] = h
            last = n if len(words) == 1 else last
        else:
            words, of = np.append(np.uint64(carry.open[0]), words), np.append(piece[:1], of)
    left = Carry()
    if goes_on:
        if solid[-1]:
            left.open = (int(words[-1]), last)
            words, of = words[:-1], of[:-1]
        same = of == piece[-1]
        left.word = int(words[-1]) if same.any() else carry.word if piece[-1] == piece[0] else None
    return words, of, left


def hashed(held: list[tuple[int, bytes]], carry: Carry, goes_on: bool
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Carry]:
    """(row, bucket) of each byte trigram and (row, bucket) of each word and pair; what
    is carried over to the next list."""
    data = np.frombuffer(b"".join(x for _, x in held), dtype=np.uint8)
    piece = np.repeat(np.arange(len(held)), [len(x) for _, x in held])
    row = np.array([r for r, _ in held])

    before = np.frombuffer(carry.tail, dtype=np.uint8)
    wide = np.concatenate([before, data]).astype(np.uint64)
    place = np.concatenate([np.zeros(len(before), dtype=piece.dtype), piece])
    inside = place[:-2] == place[2:]
    codes = wide[:-2] | (wide[1:-1] << np.uint64(8)) | (wide[2:] << np.uint64(16))
    chars = _bucket((codes[inside] + np.uint64(1)) * _STEP, CHAR_BUCKETS)
    char_row = row[place[:-2][inside]]

    words, of, left = _words(data, piece, carry, goes_on)
    if goes_on:
        left.tail = (carry.tail * (len(held) == 1) + held[-1][1])[-2:]
    known = words if carry.word is None else np.append(np.uint64(carry.word), words)
    known_of = of if carry.word is None else np.append(piece[:1], of)
    next_to = known_of[:-1] == known_of[1:]
    first, second = known[:-1][next_to], known[1:][next_to]
    pair = _bucket(first * np.uint64(31) + (second ^ (second >> np.uint64(31))) * _STEP, WORD_BUCKETS)
    pair = np.where(first == second, WORD_BUCKETS, pair)
    buckets = CHAR_BUCKETS + np.concatenate([_bucket(words, WORD_BUCKETS), pair])
    return char_row, chars, row[np.concatenate([of, known_of[:-1][next_to]])], buckets, left


def _kinds(texts: list[str | None]):
    carry = Carry()
    for held, goes_on in pieces(texts):
        char_row, chars, word_row, words, carry = hashed(held, carry, goes_on)
        yield char_row, chars, 0
        yield word_row, words, 1


def vectors(texts: list[str | None]) -> np.ndarray:
    """Feature rows (float32, WIDTH wide); zero for a text without n-grams."""
    out = np.zeros((len(texts), WIDTH), dtype=np.float32)
    for rows, buckets, _ in _kinds(texts):
        lo, hi = (rows.min(), rows.max() + 1) if len(rows) else (0, 0)
        out[lo:hi] += np.bincount((rows - lo) * WIDTH + buckets,
                                  minlength=(hi - lo) * WIDTH).reshape(-1, WIDTH)
    for a, b in ((0, CHAR_BUCKETS), (CHAR_BUCKETS, WIDTH)):
        out[:, a:b] /= np.maximum(out[:, a:b].sum(axis=1, keepdims=True), 1)
    return out


@dataclass
class LinearModel:
    weights: np.ndarray      # over the features above
    bias: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """bias + weights . features, without making the feature rows."""
        n = len(texts)
        total, count = np.zeros((2, n)), np.zeros((2, n))
        for rows, buckets, kind in _kinds(texts):
            total[kind] += np.bincount(rows, weights=self.weights[buckets], minlength=n)
            count[kind] += np.bincount(rows, minlength=n)
        return (total / np.maximum(count, 1)).sum(axis=0) + self.bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def minimise(gradient, features: np.ndarray, bias: float, rounds: int, rate: float,
             decay: float) -> LinearModel:
    """Full-batch Adam over features brought to unit total spread by one common
    factor: what differs most between texts weighs most. ``gradient(logits)``
    gives dRisk/dlogit of each row; ``decay`` is the L2 weight."""
    mean = features.mean(axis=0, dtype=np.float64)
    power = float(np.einsum("ij,ij->", features, features, dtype=np.float64)) / max(1, len(features))
    scale = 1 / max(1e-9, float(np.sqrt(max(0.0, power - float(mean @ mean)))))
    centre = mean * scale
    # features * scale - centre is never made: the sample is held once
    w = np.zeros(features.shape[1] + 1, dtype=np.float64)
    w[-1] = bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        pull = gradient(features @ (w[:-1] * scale).astype(np.float32) + (w[-1] - centre @ w[:-1]))
        g = np.append((pull.astype(np.float32) @ features) * scale - centre * pull.sum()
                      + decay * w[:-1], pull.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (1 - (k - 1) / rounds)        # ever smaller, so that the end is settled
        w -= step * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return LinearModel(w[:-1] * scale, float(w[-1] - w[:-1] @ centre))


def fit_logistic(features: np.ndarray, label: np.ndarray, rounds: int = 400, rate: float = 1.0,
                 decay: float = 1e-5) -> LinearModel:
    """Logistic regression. With one class only (or no rows) it is the constant
    of the smoothed share of ones."""
    share = (label.sum() + 1) / (len(label) + 2)
    start = float(np.log(share / (1 - share)))
    if len(np.unique(label)) < 2:
        return LinearModel(np.zeros(WIDTH), start)
    return minimise(lambda z: (sigmoid(z) - label) / len(label), features, start, rounds, rate, decay)


def fit_platt(logits: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) such that sigmoid(a * logit + b) is calibrated on these rows:
    Platt's smoothed targets, Newton steps. Identity with one class only."""
    ones, zeros = label.sum(), len(label) - label.sum()
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    spread = max(float(logits.std()), 1e-9)
    x = np.stack([logits / spread, np.ones(len(logits))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * w)
        w -= step * min(1, 4 / max(1e-9, np.abs(step).max()))
    return float(w[0] / spread), float(w[1])

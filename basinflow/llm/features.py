"""Hashed text features and the logistic model that the classifiers share, in numpy alone."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Odd 64-bit multipliers for hashing; any would do.
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (in place on a copy)."""
    h = h ^ (h >> np.uint64(29))
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse powers modulo 2**64, i < n, grown on demand and kept."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _POWERS = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[0][:n], _POWERS[1][:n]


_POWERS: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of byte ranges, taken from prefix sums; a range's place does not matter."""
    up, _ = powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE[raw] * up, out=total[1:])
    _, down = powers(len(raw) + 1)
    return mixed((total[ends] - total[starts]) * down[starts])


class Bytes:
    """Texts of a batch end to end, each followed by a line end."""

    def __init__(self, texts: list[bytes]) -> None:
        self.buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes) - 1
        self.starts = self.ends - sizes + 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; for batches that are small as a whole."""
        return range_hashes(self.buf, starts, ends)

    def parts(self, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
        """Ranges of the bytes of about ``size`` that end at white space, so that no word is split."""
        start, end = 0, 0
        while start < len(self.buf):
            end = min(start + size, len(self.buf))
            while end < len(self.buf):  # the last byte of all is a line end
                space = np.flatnonzero(SPACE[self.buf[end : end + size]])
                end += int(space[0]) + 1 if len(space) else size
                if len(space):
                    break
            end = min(end, len(self.buf))
            yield start, end
            start = end

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, first word of each text, first word after each text)."""
        starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for a, b in self.parts():
            raw = self.buf[a:b]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[raw], [True]]).astype(np.int8)))
            starts.append(a + edge[0::2])
            hashes.append(range_hashes(raw, edge[0::2], edge[1::2]))
        first = np.concatenate(starts)
        return np.concatenate(hashes), np.searchsorted(first, self.starts), np.searchsorted(first, self.ends)


def slices(texts: list[bytes], limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each: arrays over their bytes stay small whatever a batch holds."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            out.append((start, i + 1))
            start, size = i + 1, 0
    return out + [(start, len(texts))] * (start < len(texts))


def sums(values: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Sums of values[first:after] for each range, in double precision."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, dtype=np.float64, out=total[1:])
    after = np.maximum(after, first)
    return total[after] - total[first]


@dataclass
class Rows:
    """A sparse matrix by rows; ``values`` None: ones."""

    starts: np.ndarray  # len(rows) + 1
    cols: np.ndarray
    values: np.ndarray | None
    width: int

    def chunks(self, size: int = 1 << 20):
        """Ranges of rows with about ``size`` entries each, which bounds the memory for products."""
        first = 0
        while first < len(self.starts) - 1:
            after = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + size, "right")) - 1)
            yield first, after, slice(self.starts[first], self.starts[after])
            first = after

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.starts) - 1)
        for a, b, part in self.chunks():
            got = w[self.cols[part]] if self.values is None else w[self.cols[part]] * self.values[part]
            at = self.starts[a : b + 1] - self.starts[a]
            out[a:b] = sums(got, at[:-1], at[1:])
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        for a, b, part in self.chunks():
            each = np.repeat(r[a:b], np.diff(self.starts[a : b + 1]))
            out += np.bincount(self.cols[part], each if self.values is None else each * self.values[part], self.width)
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(dot, back, width: int, y: np.ndarray, l2: float, steps: int, rate: float, extra=None) -> tuple[np.ndarray, float]:
    """Adam on the mean log loss plus ``l2`` |w|^2; ``extra(w)`` gives the gradient of a further penalty."""
    w, b = np.zeros(width), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for t in range(1, steps + 1):
        r = (sigmoid(dot(w) + b) - y) / len(y)
        g, gb = back(r) + l2 * w, float(r.sum())
        if extra is not None:
            g += extra(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        scale = rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= scale * m / (np.sqrt(v) + 1e-8)
        b -= scale * mb / (np.sqrt(vb) + 1e-8)
    return w, b


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) for which sigmoid(a z + b) is the calibrated probability: Newton steps with Platt's smoothed targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    centre, spread = z.mean(), z.std() + 1e-9
    x = np.stack([(z - centre) / spread, np.ones(len(z))], 1)
    c = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ c)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - t) + 1e-3 * c)
        c -= step
        if abs(step).max() < 1e-8:
            break
    a = max(c[0] / spread, 1e-9)
    return float(a), float(c[1] - c[0] * centre / spread)


#: Bytes of a text that can be fitted on; with the number of rows this bounds what the driver gathers.
SAMPLE_TEXT = 65_536


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, where=None) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``rows`` labelled documents: those with the smallest hashes of their ids.

    Rows without a label are left out, and texts of more than SAMPLE_TEXT bytes are not fitted on; of several
    labels of a document the largest counts, and of several texts the smallest.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if where is not None:
        known = known.where(where)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    short = docs.select("doc_id", "text").where(F.octet_length("text") <= SAMPLE_TEXT)
    got = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y").toArrow().to_pydict()
    order = np.argsort(np.array(got["doc_id"], dtype=object), kind="stable") if got["doc_id"] else np.zeros(0, int)
    return [got["text"][i] for i in order], np.array([got["y"][i] for i in order], float)

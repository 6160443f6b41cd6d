"""Quality rules: a logistic model over hashed word and character n-grams beside fixed base rules.

The model is fitted on at most ``sample_rows`` labelled documents (those with the smallest hashes of
their ids), calibrated on every fifth of them, and applied to whole texts in Arrow batches.  A text's
features are the shares of its hashed n-grams of each kind, so its length does not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, release, texts_of, tidy
from .features import Bytes, Rows, fit_logistic, labelled_sample, mixed, platt, sigmoid, slices, sums

BITS = 17
SAMPLE_ROWS = 4000
#: Positions whose features are in memory at once.
PIECE = 1 << 19
CHAR_ORDERS = (2, 4)
WORD_ORDERS = (1, 2)
#: A document is kept when its calibrated probability of good quality is at least this.
KEEP_FROM = 0.5
#: Base rules, fixed values: fewest words, and the most words in repeated five-word windows in percent.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"


def grams(batch: Bytes, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, feature of each position, each text's range of positions), a bounded piece of the batch at a time."""
    shift = np.uint64(64 - BITS)
    for at in range(0, len(batch.buf), PIECE):
        raw = batch.buf[at : at + PIECE + max(CHAR_ORDERS) - 1]
        wide = raw.astype(np.uint64)
        wide[(raw >= 65) & (raw <= 90)] += np.uint64(32)
        for kind, n in enumerate(CHAR_ORDERS):
            size = min(PIECE, len(wide) - n + 1)
            if size < 1:
                continue
            h = wide[:size].copy()
            for k in range(1, n):
                h <<= np.uint64(8)
                h |= wide[k : k + size]
            h += np.uint64(n << 56)
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            yield kind, (h >> shift).astype(np.int32), np.clip(batch.starts - at, 0, size), np.clip(batch.ends - n + 1 - at, 0, size)
    hashes, first, after = words
    for at in range(0, len(hashes), PIECE):
        for kind, n in enumerate(WORD_ORDERS, len(CHAR_ORDERS)):
            size = min(PIECE, len(hashes) - n + 1 - at)
            if size < 1:
                continue
            g = hashes[at : at + size].copy()
            for k in range(1, n):
                g *= np.uint64(0xD6E8FEB86659FD93)
                g += hashes[at + k : at + k + size]
            yield kind, (mixed(g + np.uint64(n)) >> shift).astype(np.int32), np.clip(first - at, 0, size), np.clip(after - n + 1 - at, 0, size)


KINDS = len(CHAR_ORDERS) + len(WORD_ORDERS)


@dataclass
class QualityModel:
    weights: np.ndarray  # by kind and feature
    bias: float
    scale: float
    shift: float

    def logits(self, batch: Bytes, words) -> np.ndarray:
        total, count = np.zeros((2, KINDS, len(batch.starts)))
        for kind, cols, first, after in grams(batch, words):
            total[kind] += sums(self.weights[kind][cols], first, after)
            count[kind] += np.maximum(after - first, 0)
        return self.bias + (total / np.maximum(count, 1)).sum(0)

    def probabilities(self, batch: Bytes, words) -> np.ndarray:
        return sigmoid(self.scale * self.logits(batch, words) + self.shift)


def matrix(texts: list[str]) -> Rows:
    """The training rows: shares of each feature, one block of columns for each kind."""
    starts, cols, values = [0], [], []
    for text in texts:
        batch = Bytes([text.encode()])
        parts: list[list[np.ndarray]] = [[] for _ in range(KINDS)]
        for kind, c, first, after in grams(batch, batch.words()):
            parts[kind].append(c[first[0] : max(first[0], after[0])])
        size = 0
        for kind, found in enumerate(parts):
            u, n = np.unique(np.concatenate([np.zeros(0, np.int32), *found]), return_counts=True)
            cols.append((u + (kind << BITS)).astype(np.int32))
            values.append((n / max(n.sum(), 1)).astype(np.float32))
            size += len(u)
        starts.append(starts[-1] + size)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return Rows(np.array(starts), join(cols, np.int32), join(values, np.float32), KINDS << BITS)


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, steps: int = 80) -> QualityModel:
    """Fit and calibrate; without labels of both classes the model keeps every document."""
    texts, y = labelled_sample(docs, labels, "quality", sample_rows)
    if len(y) < 10 or not 0 < y.sum() < len(y):
        return QualityModel(np.zeros((KINDS, 1 << BITS), np.float32), 0.0, 1.0, 5.0)
    fold = np.arange(len(y)) % 5 == 4
    held = [t for t, f in zip(texts, fold) if f]
    rows = matrix([t for t, f in zip(texts, fold) if not f])
    w, b = fit_logistic(rows.dot, rows.back, rows.width, y[~fold], 1e-6, steps, 0.5)
    model = QualityModel(w.reshape(KINDS, 1 << BITS).astype(np.float32), b, 1.0, 0.0)
    z = []
    for at in range(0, len(held), 64):
        batch = Bytes([t.encode() for t in held[at : at + 64]])
        z.append(model.logits(batch, batch.words()))
    model.scale, model.shift = platt(np.concatenate(z), y[fold])
    del rows, texts, held, batch
    release()  # the driver lives on
    return model


def repeated_words(words: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a five-word window found twice or more in that text."""
    n = len(words) - WINDOW + 1
    out = np.zeros(len(first), np.int64)
    if n < 1:
        return out
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h *= np.uint64(0xD6E8FEB86659FD93)
        h += words[k : k + n]
    text = np.repeat(np.arange(len(first)), after - first)
    inside = text[:n] == text[WINDOW - 1 :]
    key = mixed(h + text[:n].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))[inside]
    at = np.flatnonzero(inside)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, at[hit], 1)
    np.add.at(step, at[hit] + WINDOW, -1)
    covered = np.cumsum(step)[:-1] > 0
    return sums(covered, first, after).astype(np.int64)


def base_counts(texts: list[str], raw: list[bytes], batch: Bytes, words) -> dict[str, np.ndarray]:
    _, first, after = words
    long = lambda values: np.fromiter(values, np.int64, len(raw))

    def duplicate_lines(b: bytes) -> int:
        lines = [x for x in b.split(b"\n") if x.strip(BLANKS)]
        return len(lines) - len(set(lines))

    return {
        "n_words": (after - first).astype(np.int64),
        "word_chars": long(len(t) - len(b) + len(b.translate(None, BLANKS)) for t, b in zip(texts, raw)),
        "n_symbols": long(len(b) - len(b.translate(None, SYMBOLS)) for b in raw),
        "n_dup_lines": long(map(duplicate_lines, raw)),
        "n_repeat_words": repeated_words(*words),
    }


def judged(texts: list[str], raw: list[bytes], model: QualityModel, keep_from: float) -> dict[str, np.ndarray]:
    """The base counts and verdicts of some texts."""
    batch = Bytes(raw)
    words = batch.words()
    out = base_counts(texts, raw, batch, words)
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    p = model.probabilities(batch, words)
    return out | {"base_failed": failed, "quality": p, "kept": ~failed & (p >= keep_from)}


def score_quality(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of ``docs``: the base counts, base_failed, quality (calibrated probability) and kept.

    Words are runs of characters other than space and \\t\\n\\v\\f\\r.  A null or empty text has no
    words and fails the base rules.  Repeated rows are scored each; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = texts_of(docs)
    send = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = send.value
        for b in batches:
            texts = b.column(1).to_pylist()
            raw = [t.encode() for t in texts]
            for start, end in slices(raw):
                out = judged(texts[start:end], raw[start:end], model, keep_from)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, end - start), *map(pa.array, out.values())], ["doc_id", *out])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that :func:`quality_rules` keeps, with all their columns.

    Null and empty texts fail the base rules and go; of repeated rows each is judged and kept by itself.
    An empty table stays empty, and without labels of both classes only the base rules count.
    """
    prepare(docs.sparkSession)
    send = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, sample_rows))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = send.value
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            raw = [t.encode() for t in texts]
            for start, end in slices(raw):
                kept = judged(texts[start:end], raw[start:end], model, keep_from)["kept"]
                yield b.slice(start, end - start).filter(pa.array(kept))

    return docs.mapInArrow(tidy(run), docs.schema)


def quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """Fit on labelled rows of ``docs`` and score all of them."""
    return score_quality(docs, fit_quality(docs, labels, sample_rows), keep_from)

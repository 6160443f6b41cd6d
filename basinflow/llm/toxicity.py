"""Counterfactual-regularised toxicity classifier.

A logistic model over the distinct words of a text; a word's features are hashed character n-grams
with its bounds and the word itself.  For labelled sentences, identity terms are swapped (or, where a
sentence names none, a neutral mention is put in), and the squared change of the score is a penalty,
so the mention of a group by itself moves no score.  The model is fitted on at most ``sample_rows``
labelled documents and calibrated on every fifth of them.  Features whose presence does not go with
the label beyond chance are left out, and of near-equal training documents one counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, release, texts_of, tidy
from .features import Bytes, Rows, fit_logistic, labelled_sample, mixed, platt, sigmoid, sums

BITS = 20
SAMPLE_ROWS = 8000
ORDERS = (3, 4, 5, 6, 7)
#: A feature takes part when its presence goes with the label beyond chance: likelihood-ratio statistic
#: of at least this, over this many documents.
LEAST_G2, LEAST_DOCS = 12.0, 4
TOXIC_FROM = 0.3
#: Identity terms by group; terms of a group are exchanged for each other.
IDENTITY = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly"),
)
GROUP_OF = {w: g for g in IDENTITY for w in g}
WORD = re.compile(r"[^\W\d_]+")
#: Words whose scores a worker keeps.
CACHE = 400_000


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def word_rows(words: list[str], chunk: int = 32_768) -> Rows:
    """Features of each word: the hashed n-grams of the bounded word, and the whole word."""
    if len(words) > chunk:  # bounds the memory for intermediate arrays
        parts = [word_rows(words[i : i + chunk]) for i in range(0, len(words), chunk)]
        sizes = np.concatenate([np.diff(p.starts) for p in parts])
        return Rows(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([p.cols for p in parts]), None, 1 << BITS)
    batch = Bytes([b"\x02" + w.encode() + b"\x03" for w in words])
    shift = np.uint64(64 - BITS)
    sizes = batch.ends - batch.starts
    counts = sum((np.maximum(sizes - n + 1, 0) for n in ORDERS), np.ones(len(words), np.int64))
    starts = np.concatenate([[0], np.cumsum(counts)])
    cols = np.empty(starts[-1], np.int32)
    at = starts[:-1].copy()
    cols[at] = mixed(batch.hashes(batch.starts, batch.ends) + np.uint64(99)) >> shift
    at += 1
    for n in ORDERS:
        k = np.maximum(sizes - n + 1, 0)
        inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        first = np.repeat(batch.starts, k) + inner
        cols[np.repeat(at, k) + inner] = mixed(batch.hashes(first, first + n)) >> shift
        at += k
    return Rows(starts, cols, None, 1 << BITS)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def logits(self, texts: list[str]) -> np.ndarray:
        sets = [words_of(t) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        new = list(set().union(*sets).difference(self.known)) if sets else []
        if new:
            self.known.update(zip(new, word_rows(new).dot(self.weights).tolist()))
        get = self.known.__getitem__
        return np.array([self.bias + fsum(map(get, s)) for s in sets])

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.scale * self.logits(texts) + self.shift)


def counterfactuals(named: list[list[str]], seed: int = 7) -> list[dict[str, float]]:
    """For each text, given the identity terms that it names, what a swap changes: words that come (1) and go (-1).

    A text that names none gets a neutral mention of some group.
    """
    rng = np.random.default_rng(seed)
    out = []
    for words in named:
        if words:
            swap = [(w, str(rng.choice([x for x in GROUP_OF[w] if x != w]))) for w in words]
            new = {x for _, x in swap} - set(words)
            out.append({w: -1.0 for w in words if w not in {x for _, x in swap}} | {x: 1.0 for x in sorted(new)})
        else:
            terms = IDENTITY[rng.integers(len(IDENTITY))]
            out.append({str(rng.choice(terms)): 1.0})
    return out


def word_hashes(words: list[str]) -> np.ndarray:
    batch = Bytes([w.encode() for w in words])
    return batch.hashes(batch.starts, batch.ends)


def telling(grams: Rows, ids: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Which features' presence in a document goes with the label: by the likelihood-ratio statistic."""
    seen = np.zeros((2, grams.width))
    for words, label in zip(ids, y):
        if len(words):
            cols = np.concatenate([grams.cols[grams.starts[i] : grams.starts[i + 1]] for i in words.tolist()])
            seen[int(label), np.unique(cols)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)[:, None]
    total, rate = seen.sum(0), seen.sum(0) / n.sum()
    g2 = np.zeros(grams.width)
    for have, expected in ((seen, n * rate), (n - seen, n * (1 - rate))):
        with np.errstate(divide="ignore", invalid="ignore"):
            g2 += 2 * np.where(have > 0, have * np.log(have / expected), 0).sum(0)
    return (g2 >= LEAST_G2) & (total >= LEAST_DOCS)


def restricted(rows: Rows, keep: np.ndarray) -> Rows:
    """The matrix with only the columns to keep."""
    taken = keep[rows.cols]
    return Rows(np.concatenate([[0], np.cumsum(taken)])[rows.starts], rows.cols[taken], None, rows.width)


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, where: Column | None = None, penalty: float = 1.0, steps: int = 60) -> ToxicityModel:
    """Fit on labelled rows (those that ``where`` lets through, a condition on labels' columns)."""
    texts, y = labelled_sample(docs, labels, "toxic", sample_rows, where)
    if len(y) < 10 or not 0 < y.sum() < len(y):
        return ToxicityModel(np.zeros(1 << BITS), -3.0)
    index: dict[str, int] = {}
    ids, named = [], []
    for t in texts:
        words = sorted(words_of(t))
        ids.append(np.array([index.setdefault(w, len(index)) for w in words], np.int32))
        named.append([w for w in words if w in GROUP_OF])
    # near-equal documents have the same few smallest word hashes
    hashes = word_hashes(list(index))
    marks = [tuple(np.sort(hashes[i])[:4].tolist()) for i in ids]
    first = np.array(sorted({m: i for i, m in reversed(list(enumerate(marks)))}.values()))
    texts, ids, named, y = [texts[i] for i in first], [ids[i] for i in first], [named[i] for i in first], y[first]
    fold = np.arange(len(y)) % 5 == 4
    if not 0 < y[~fold].sum() < len(y[~fold]):
        return ToxicityModel(np.zeros(1 << BITS), -3.0)
    held = [t for t, f in zip(texts, fold) if f]
    ids = [i for i, f in zip(ids, fold) if not f]
    changes = [
        (np.array([index.setdefault(w, len(index)) for w in c], np.int32), np.array(list(c.values())))
        for c in counterfactuals([w for w, f in zip(named, fold) if not f])
    ]
    grams = word_rows(list(index))
    grams = restricted(grams, telling(grams, ids, y[~fold]))
    rows = Rows(np.cumsum([0, *map(len, ids)]), np.concatenate([*ids, np.zeros(0, np.int32)]), None, len(index))
    change = Rows(np.cumsum([0, *(len(c) for c, _ in changes)]), np.concatenate([c for c, _ in changes]), np.concatenate([v for _, v in changes]), len(index))

    def unfair(w: np.ndarray) -> np.ndarray:
        return penalty * grams.back(change.back(change.dot(grams.dot(w)) / len(changes)))

    w, b = fit_logistic(lambda w: rows.dot(grams.dot(w)), lambda r: grams.back(rows.back(r)), grams.width, y[~fold], 1e-4, steps, 0.05, unfair)
    model = ToxicityModel(w.astype(np.float32), b)
    model.scale, model.shift = platt(model.logits(held), y[fold])
    model.known = {}
    del rows, grams, change, texts, held, index, ids
    release()  # the driver lives on
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1) and predicted (1 from ``toxic_from`` on).

    A null or empty text has the score of a text without words.  Repeated rows are scored each;
    only the text is read for the score.
    """
    prepare(docs.sparkSession)
    rows = texts_of(docs)
    send = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = send.value
        for b in batches:
            p = model.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= toxic_from).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label may be learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on labelled rows that are not held out, score all: doc_id, held_out, score, predicted."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, sample_rows, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")

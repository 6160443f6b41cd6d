"""Exact n-gram Jaccard join with set-relation skipping.

A document's set is that of the hashes of its shingles; documents with equal sets are a class, and
classes are joined.  Two exact filters come first.

1. A set with a partner misses at most D of its own shingles there.  Of the first D + L shingles in
   hash order at least L must then occur in another document of about the same size, which rules out
   nearly all documents without a partner.  Map tasks resolve what their own batch shares and send
   each shingle once for each size class.
2. Among the sets left, shingles are put in order of document frequency, and sets that can be linked
   share one of their first D + 1.  Sets that share such a shingle, directly or over others, form a
   candidate component; components of links lie inside these.

The join itself runs in each candidate component, in blocks of it where it is large: a block's sets are joined
first, then one set of each group so found with those of other blocks, round by round, until a component's
groups no longer merge.  What is left are pairs of sets of different groups; they are joined in pairs of
blocks, but for two blocks of the largest group, and only sets with a prefix shingle of several groups
take part.  So n copies of each other cost about n, not n^2.

Index lists of prefix shingles are kept in order of set size in blocks that note their smallest
position, so blocks whose sets are too small or whose positions leave too little overlap are skipped
whole.  A set's candidates are derived from those of the previous set that is highly similar:
only shingles that the other lacks are looked up.  Sets already in one component are not compared.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, release, tidy
from .components import connected_components
from .features import Bytes, mixed, slices

#: Sets that one call of the join gets at most, about; larger candidate components are joined by blocks.
TASK_SETS = 200
#: Sampled shingles that a task of the first filter takes, about.
TASK_SHINGLES = 1_000_000
#: Text hashes of documents to read again that are broadcast (8 bytes each); beyond it they are joined by shuffle.
BROADCAST_TEXTS = 1_000_000
#: The name of an own column beside those of a caller's table.
OWN_TH = "__jaccard_th"
MANY = 65535
TIMES = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes): each text's distinct shingle hashes in ascending order.

    A-Z are lower-cased; words are separated by space and \\t\\n\\v\\f\\r.  A text with fewer than k
    words has one shingle, its whole word sequence; one without words has none.
    """
    raw = [t.encode().lower() for t in texts]
    parts = [hashed_shingles(raw[a:b], k) for a, b in slices(raw)]
    counts = np.concatenate([np.zeros(1, np.int64), *(np.diff(starts) for starts, _ in parts)])
    return np.cumsum(counts), np.concatenate([np.zeros(0, np.uint64), *(h for _, h in parts)])


def hashed_shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    batch = Bytes(texts)
    words, first, after = batch.words()
    counts = after - first
    n = max(len(words) - k + 1, 0)
    h = np.full(n, np.uint64(k))
    for i in range(k):
        h = mixed(h * TIMES + words[i : i + n])
    text = np.repeat(np.arange(len(texts)), counts)
    inside = text[:n] == text[k - 1 :] if n else np.zeros(0, bool)
    h, text = h[inside], text[:n][inside]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j, i in enumerate(short.tolist()):
            x = np.array([1000 + counts[i]], np.uint64)
            for w in words[first[i] : after[i]]:
                x = mixed(x * TIMES + w)
            extra[j] = x[0]
        h, text = np.concatenate([h, extra]), np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]), h


def class_of(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def most_missing(n, percent: int):
    """Most shingles of a set of n that a set linked to it can lack."""
    return n - (percent * n + 99) // 100


def size_class(n: np.ndarray, percent: int) -> np.ndarray:
    """Linked sets are in the same or in neighbouring classes: a class spans a factor of 100 / percent and a little more."""
    return np.floor(np.log(np.maximum(n, 1)) / (np.log(100 / percent) + 1e-9) if percent < 100 else n).astype(np.int64) % 65_536


def first_pass(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """A row for each document, and rows that send its batch's sampled shingles to buckets.

    Documents: th (hash of the text), cls, n, batch, ref (its number in the batch), known (sampled
    shingles that the batch shares), needed.  Shingles: bucket, batch, toks (8 bytes each), classes (2
    bytes each), refs (2 bytes each; 65535: several documents of the batch).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "th", "cls", "n", "batch", "ref", "known", "needed", "bucket", "toks", "classes", "refs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            starts, toks = shingle_sets(b.column(1).to_pylist(), k)
            n = np.diff(starts)
            missing = most_missing(n, percent)
            sampled = np.minimum(n, missing + np.maximum(1, (missing + 1) // 2))
            doc = np.repeat(np.arange(len(n)), n)
            take = np.arange(len(toks)) - starts[:-1][doc] < sampled[doc]
            tok, doc = toks[take], doc[take]
            classes = size_class(n, percent)[doc]
            order = np.lexsort((classes, tok))
            tok, doc, classes = tok[order], doc[order], classes[order]
            at = np.flatnonzero(np.concatenate([[True], (tok[1:] != tok[:-1]) | (classes[1:] != classes[:-1])])) if len(tok) else np.zeros(0, int)
            count = np.diff(np.append(at, len(tok)))
            known = np.bincount(doc, np.repeat(count, count) > 1, len(n)).astype(np.int32)
            unique, classes = tok[at], classes[at].astype(np.uint16)
            cls = pa.array([class_of(toks[starts[i] : starts[i + 1]]) if n[i] else None for i in range(len(n))], pa.int64())
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), cls, pa.array(n.astype(np.int32)), pa.array(np.full(size, number)), pa.array(np.arange(size, dtype=np.int32)), pa.array(known), pa.array((sampled - missing).astype(np.int32)), pa.nulls(size, pa.int32()), *[pa.nulls(size, pa.binary())] * 3],
                names,
            )
            bucket = ((unique >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            refs = np.where(count == 1, doc[at], MANY).astype(np.uint16)[order]
            unique, bucket, classes = unique[order], bucket[order], classes[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            if len(unique):
                parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                size = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(size, b.column(0).type), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int32()), pa.array(np.full(size, number)), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.array(bucket[edges[:-1]]), *(pa.array([x[s:e].tobytes() for s, e in parts], pa.binary()) for x in (unique, classes, refs))],
                    names,
                )
            number += 1

    return docs.mapInArrow(tidy(run), f"doc_id {kind}, th long, cls long, n int, batch long, ref int, known int, needed int, bucket int, toks binary, classes binary, refs binary")


def shared_in_bucket(rows: pa.Table) -> pa.Table:
    """How many of each document's shingles here occur in other batches at about its size.

    A row for each batch: refs (2 bytes each) and hits (4 bytes each).
    """
    toks = [np.frombuffer(x, np.uint64) for x in rows.column("toks").to_pylist()]
    classes, refs = (np.concatenate([np.frombuffer(x, np.uint16) for x in rows.column(c).to_pylist()]) for c in ("classes", "refs"))
    source = np.repeat(np.arange(len(toks), dtype=np.int32), [len(x) for x in toks])
    tok = np.concatenate(toks)
    order = np.lexsort((classes, tok))
    tok, classes, refs, source = tok[order], classes[order].astype(np.int32), refs[order], source[order]
    near = (tok[1:] == tok[:-1]) & (classes[1:] - classes[:-1] <= 1)
    shared = np.zeros(len(tok), bool)
    shared[1:] |= near
    shared[:-1] |= near
    keep = shared & (refs != MANY)
    pair, hits = np.unique(source[keep].astype(np.int64) * 65536 + refs[keep], return_counts=True)
    own = pair // 65536
    edges = np.flatnonzero(np.diff(own, prepend=-1, append=-1))
    parts = list(zip(edges[:-1].tolist(), edges[1:].tolist())) if len(own) else []
    batch = rows.column("batch").to_numpy()
    small, many = (pair % 65536).astype(np.uint16), hits.astype(np.uint32)
    out = pa.table({
        "batch": pa.array([batch[own[s]] for s, _ in parts], pa.int64()),
        "refs": pa.array([small[s:e].tobytes() for s, e in parts], pa.binary()), "hits": pa.array([many[s:e].tobytes() for s, e in parts], pa.binary()),
    })
    release()
    return out


def summed_hits(rows: pa.Table) -> pa.Table:
    """batch, ref, hits of each document of a batch that has any."""
    total = np.zeros(65536, np.int64)
    for refs, hits in zip(rows.column("refs").to_pylist(), rows.column("hits").to_pylist()):
        total[np.frombuffer(refs, np.uint16)] += np.frombuffer(hits, np.uint32)
    ref = np.flatnonzero(total)
    return pa.table({"batch": pa.array(np.full(len(ref), rows.column("batch")[0].as_py(), np.int64)), "ref": pa.array(ref.astype(np.int32)), "hits": pa.array(total[ref])})


def pieces_by(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[list[bytes]]]:
    """Each distinct key, and what each column has for it, as bytes; the order within a key stays."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    edges = np.flatnonzero(np.diff(keys, prepend=-1, append=-1)) if len(keys) else np.zeros(1, int)
    parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    return keys[edges[:-1]], [[x[s:e].tobytes() for s, e in parts] for x in (c[order] for c in columns)]


SENT = {"batch": pa.int64(), "bucket": pa.int32(), "toks": pa.binary(), "refs": pa.binary(), "counts": pa.binary(), "cls": pa.binary(), "sizes": pa.binary()}


def sent_sets(texts: DataFrame, k: int, buckets: int) -> DataFrame:
    """Batches of sets: a row that stays with the batch (bucket -1), and rows that send its shingles to buckets.

    The first has cls (8 bytes each) and sizes (4 bytes each) of the sets, and toks and refs (numbers of sets, 2 bytes
    each) of shingles that several sets of the batch have.  The others have each shingle of the batch once: toks,
    refs (65535: several) and counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            starts, toks = shingle_sets(b.column(0).to_pylist(), k)
            n = np.diff(starts)
            cls = np.array([class_of(toks[s:e]) for s, e in zip(starts[:-1], starts[1:])], np.int64)
            order = np.argsort(toks, kind="stable")
            tok, ref = toks[order], np.repeat(np.arange(len(n)), n)[order].astype(np.uint16)
            at = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]])) if len(tok) else np.zeros(0, int)
            count = np.diff(np.append(at, len(tok)))
            several = np.repeat(count, count) > 1
            unique = tok[at]
            bucket, blobs = pieces_by(((unique >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32), [unique, np.where(count == 1, ref[at], MANY).astype(np.uint16), count.astype(np.uint16)])
            size = len(bucket) + 1
            rows = [[number] * size, [-1, *bucket.tolist()], [tok[several].tobytes(), *blobs[0]], [ref[several].tobytes(), *blobs[1]], [None, *blobs[2]], [cls.tobytes()] + [None] * (size - 1), [n.astype(np.int32).tobytes()] + [None] * (size - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, SENT.values())], list(SENT))
            number += 1

    return texts.mapInArrow(tidy(run), "batch long, bucket int, toks binary, refs binary, counts binary, cls binary, sizes binary")


def frequencies(rows: pa.Table) -> pa.Table:
    """Of the shingles in some buckets those that more than one set has, back to their batches: toks, refs and dfs (4 bytes each)."""
    each = [np.frombuffer(x, np.uint64) for x in rows.column("toks").to_pylist()]
    refs, counts = (np.concatenate([np.frombuffer(x, np.uint16) for x in rows.column(c).to_pylist()]) for c in ("refs", "counts"))
    source = np.repeat(np.arange(len(each), dtype=np.int32), [len(x) for x in each])
    tok = np.concatenate(each)
    del each
    order = np.argsort(tok, kind="stable")
    tok, refs, counts, source = tok[order], refs[order], counts[order], source[order]
    at = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
    df = np.repeat(np.add.reduceat(counts.astype(np.int64), at), np.diff(np.append(at, len(tok))))
    keep = df > 1
    own, blobs = pieces_by(source[keep], [tok[keep], refs[keep], df[keep].astype(np.uint32)])
    batch = rows.column("batch").to_numpy()
    out = pa.table({"batch": pa.array(batch[own]), **{n: pa.array(x, pa.binary()) for n, x in zip(("toks", "refs", "dfs"), blobs)}})
    release()
    return out


def assembled(percent: int):
    """The sets of a batch whose prefix is not empty: cls, n, toks (those that several sets have, the rarest first) and prefix."""

    def run(rows: pa.Table) -> pa.Table:
        def column(name: str, kind, keep: list[bool]) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x, k in zip(rows.column(name).to_pylist(), keep) if k)])

        home = [x is not None for x in rows.column("cls").to_pylist()]
        sent = [not x for x in home]
        cls, n = column("cls", np.int64, home), column("sizes", np.int32, home).astype(np.int64)
        tok, ref, df = column("toks", np.uint64, sent), column("refs", np.uint16, sent), column("dfs", np.uint32, sent)
        many, many_ref = column("toks", np.uint64, home), column("refs", np.uint16, home)
        shared = ref == MANY
        order = np.argsort(tok[shared], kind="stable")
        known, known_df = tok[shared][order], df[shared][order]
        tok, ref = np.concatenate([tok[~shared], many]), np.concatenate([ref[~shared], many_ref])
        df = np.concatenate([df[~shared], known_df[np.searchsorted(known, many)]])
        order = np.lexsort((tok, df, ref))
        tok, ref = tok[order], ref[order]
        size = np.bincount(ref, minlength=len(cls))
        prefix = most_missing(n, percent) + 1 - (n - size)
        able = prefix > 0
        flat = tok[able[ref]].view(np.int64)
        offsets = np.concatenate([[0], np.cumsum(size[able])]).astype(np.int32)
        out = pa.table({"cls": pa.array(cls[able]), "n": pa.array(n[able].astype(np.int32)), "toks": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), "prefix": pa.array(prefix[able].astype(np.int32))})
        release()
        return out

    return run


def ordered_sets(texts: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """cls, n, toks and prefix of the set of each of ``texts(text)``, which have sets of their own each."""
    sent = cut(sent_sets(texts, k, buckets), "sent")
    out = sent.where("bucket >= 0")
    tasks = int((out.agg(F.sum(F.octet_length("toks"))).first()[0] or 0) // (8 * TASK_SHINGLES)) + 1
    back = out.withColumn("task", F.col("bucket") % tasks).groupBy("task").applyInArrow(frequencies, "batch long, toks binary, refs binary, dfs binary")
    rows = sent.where("bucket < 0").select("batch", "toks", "refs", F.lit(None).cast("binary").alias("dfs"), "cls", "sizes")
    rows = rows.unionByName(back, allowMissingColumns=True)
    return rows.groupBy("batch").applyInArrow(assembled(percent), "cls long, n int, toks array<long>, prefix int")


class Lists:
    """Index lists of prefix shingles: sets in order of size, in blocks with their range of positions."""

    BLOCK = 32

    def __init__(self) -> None:
        self.lists: dict[int, tuple[list[int], list[int], list[int], list[list[int]]]] = {}

    def add(self, tok: int, size: int, position: int, member: int) -> None:
        """Members come in order of size; ``member`` numbers them in that order."""
        sizes, positions, members, ranges = self.lists.setdefault(tok, ([], [], [], []))
        if len(members) % self.BLOCK == 0:
            ranges.append([position, position])
        else:
            ranges[-1] = [min(ranges[-1][0], position), max(ranges[-1][1], position)]
        sizes.append(size)
        positions.append(position)
        members.append(member)

    def find(self, tok: int, size: int, position: int, percent: int) -> list[int]:
        """Members that can still be linked to a set of this size with the shingle at this position.

        Sets in the lists are no larger than the one that asks.  With the shingle at position j of a
        set of m, at most min(j, position) + min(m - j, size - position) shingles are shared.
        """
        got = self.lists.get(tok)
        if got is None:
            return []
        sizes, positions, members, ranges = got
        out = []
        at = bisect_left(sizes, (percent * size + 99) // 100)
        while at < len(members):
            block = at // self.BLOCK
            end = min(len(members), (block + 1) * self.BLOCK)
            low, high = ranges[block]
            bound = min(high, position) + min(sizes[end - 1] - low, size - position)
            if (100 + percent) * bound >= percent * (sizes[at] + size):
                for i in range(at, end):
                    m, j = sizes[i], positions[i]
                    if (100 + percent) * (min(j, position) + min(m - j, size - position)) >= percent * (m + size):
                        out.append(members[i])
            at = end
        return out

    def every(self, tok: int, size: int, percent: int, since: int = 0) -> list[int]:
        """All members of a list that are large enough, from number ``since`` on, whatever their positions."""
        got = self.lists.get(tok)
        if got is None:
            return []
        sizes, _, members, _ = got
        return members[max(bisect_left(sizes, (percent * size + 99) // 100), bisect_left(members, since)) :]


def linked(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (size_a + size_b - shared)


def join_sets(sets: list[np.ndarray], sizes: list[int], percent: int, similar: float = 0.8) -> list[int]:
    """Each set's root (the number of one member) by the links of the sets.

    ``sets`` hold, in one global order, the shingles that more than one set has; ``sizes`` count all,
    those of a single set coming first.
    """
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = sorted(range(len(sets)), key=lambda i: (sizes[i], i))
    lists = Lists()
    ascending = [np.sort(s) for s in sets]
    prefixes: list[dict[int, int]] = []  # of each number in that order: shingle and position
    latest: dict[int, int] = {}  # the last number whose prefix has a shingle
    answers: list[tuple[int, set[int]] | None] = []  # of each number: all that share a prefix shingle, up to a number
    for number, i in enumerate(order):
        size = sizes[i]
        lone = size - len(sets[i])
        head = sets[i][: max(0, most_missing(size, percent) + 1 - lone)].tolist()
        prefix = {t: lone + p for p, t in enumerate(head)}
        model = max((latest[t] for t in head if t in latest), default=None)
        answers.append(None)
        if model is not None and len(prefix.keys() & prefixes[model].keys()) >= similar * len(prefix):
            # the model is no larger, so whatever is large enough for this set is among its answers
            if answers[model] is None:
                answers[model] = (number, {m for t in prefixes[model] for m in lists.every(t, sizes[order[model]], percent)})
            upto, found = answers[model]
            found = set(found)
            for t in prefix:
                found.update(lists.every(t, size, percent, upto if t in prefixes[model] else 0))
            answers[number] = (number, found)
        else:
            found = {m for t, p in prefix.items() for m in lists.find(t, size, p, percent)}
        for m in sorted(found, reverse=True):
            c = order[m]
            a, b = find(i), find(c)
            if a != b and linked(ascending[i], ascending[c], size, sizes[c], percent):
                root[max(a, b)] = min(a, b)
        prefixes.append(prefix)
        for t, p in prefix.items():
            lists.add(t, size, p, number)
            latest[t] = number
    return [find(i) for i in range(len(sets))]


def join_block(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        cls = rows.column("cls").to_pylist()
        flat = rows.column("toks").combine_chunks()
        offsets, values = flat.offsets.to_numpy(), flat.values.to_numpy()
        sets = [values[offsets[i] : offsets[i + 1]] for i in range(len(cls))]
        roots = join_sets(sets, rows.column("n").to_pylist(), percent)
        pairs = [(cls[i], cls[r]) for i, r in enumerate(roots) if i != r]
        release()
        return pa.table({"u": pa.array([a for a, _ in pairs], pa.int64()), "v": pa.array([b for _, b in pairs], pa.int64())})

    return run


def joined(ordered: DataFrame, placed: DataFrame, by: list[str], percent: int) -> DataFrame:
    """Links (u, v) that connect what is linked in each group of ``placed(cls, *by)``."""
    return cut(placed.join(ordered, "cls").groupBy(*by).applyInArrow(join_block(percent), "u long, v long"), "links")


def blocks_of(rows: DataFrame, by: str, name: str, size: int, seed: int) -> DataFrame:
    """``rows(cls, by, ...)`` with a block number for each row, so that blocks of a group have about ``size`` rows."""
    counts = rows.groupBy(by).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    return rows.join(counts, by).withColumn(name, F.pmod(F.xxhash64("cls", F.lit(seed)), F.col("blocks")).cast("int")).drop("blocks")


def starred(links: DataFrame) -> DataFrame:
    """(node, root) of links (u, root) that each go straight to a component's root."""
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def joined_components(ordered: DataFrame, candidates: DataFrame, percent: int, task_sets: int) -> DataFrame:
    """(node, root) of the components of links among ``ordered(cls, n, toks, prefix)``; ``candidates(node, root)`` are where links lie."""
    sets = candidates.select(F.col("node").alias("cls"), F.col("root").alias("home"))
    sets = cut(sets.join(sets.groupBy("home").agg(F.count("*").alias("members")), "home"), "members")
    whole = starred(joined(ordered, sets.where(F.col("members") <= task_sets).select("cls", "home"), ["home"], percent))
    # groups of a large component merge round by round, each by one of its sets
    large = sets.where(F.col("members") > task_sets).select("cls", "home")
    group, ahead, left, seed = large.withColumn("grp", F.col("cls")), large, large.count(), 0
    if not left:
        return whole
    while left:
        seed += 1
        found = joined(ordered, blocks_of(ahead, "home", "block", task_sets, seed).select("cls", "home", "block"), ["home", "block"], percent)
        group = group.join(found.select(F.col("u").alias("grp"), "v"), "grp", "left").select("cls", "home", F.coalesce("v", "grp").alias("grp"))
        ahead = cut(ahead.join(found.select(F.col("u").alias("cls")), "cls", "left_anti"), "ahead")
        before, left = left, ahead.count()
        if left > before * 0.8:
            break
    group = cut(group, "group")
    grouped = group.select(F.col("cls").alias("node"), F.col("grp").alias("root"))
    # pairs of different groups: only sets that share a prefix shingle with another group's
    heads = group.join(ordered, "cls").select("cls", "grp", F.explode(F.slice("toks", F.lit(1), F.col("prefix"))).alias("tok"))
    heads = cut(heads, "heads")
    mixed = cut(heads.groupBy("tok").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a != b").select("tok"), "mixed")
    open_ = cut(group.join(heads.join(mixed, "tok", "left_semi").select("cls").distinct(), "cls", "left_semi"), "open")
    if not open_.count():
        return whole.unionByName(grouped)
    counts = open_.groupBy("home", "grp").agg(F.count("*").alias("n"))
    most = counts.groupBy("home").agg(F.max(F.struct("n", "grp"))["grp"].alias("most"))
    sided = cut(open_.join(most, "home").select("cls", "home", (F.col("grp") == F.col("most")).alias("main")), "sided")
    half = max(1, task_sets // 2)
    main = blocks_of(sided.where("main"), "home", "own", half, 0)
    rest = cut(blocks_of(sided.where("NOT main"), "home", "own", half, 0), "rest")
    ranges = rest.groupBy("home").agg((F.max("own") + 1).alias("rests"))
    bounds = cut(ranges.join(main.groupBy("home").agg((F.max("own") + 1).alias("mains")), "home"), "bounds")
    own, each = F.col("own"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = (
        rest.join(bounds, "home").withColumn("other", each("rests")).select("cls", "home", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        .unionByName(rest.join(bounds, "home").withColumn("b", each("mains")).select("cls", "home", own.alias("a"), (-1 - F.col("b")).alias("b")))
        .unionByName(main.join(bounds, "home").withColumn("a", each("rests")).select("cls", "home", "a", (-1 - own).alias("b")))
    )
    more = joined(ordered, placed, ["home", "a", "b"], percent)
    of = lambda end: group.select(F.col("cls").alias(end), F.col("grp").alias(f"group_{end}"))
    between = more.join(of("u"), "u").join(of("v"), "v").select(F.col("group_u").alias("u"), F.col("group_v").alias("v")).distinct()
    merged = cut(connected_components(between), "merged").select(F.col("node").alias("root"), F.col("root").alias("last"))
    return whole.unionByName(grouped.join(merged, "root", "left").select("node", F.coalesce("last", "root").alias("root")))


def linked_documents(docs: DataFrame, k: int, percent: int, task_sets: int = TASK_SETS) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n, grp (the component; null without shingles) and component_id."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th"))
    buckets = 4 * max(8, rows.rdd.getNumPartitions())
    first = cut(first_pass(rows, k, percent, buckets), "first")
    sets = first.where(F.col("bucket").isNull()).select("doc_id", "th", "cls", "n", "batch", "ref", "known", "needed")
    sent = first.where(F.col("bucket").isNotNull()).select("bucket", "batch", "toks", "classes", "refs")
    tasks = int((sent.agg(F.sum(F.octet_length("toks"))).first()[0] or 0) // (8 * TASK_SHINGLES)) + 1
    hits = sent.withColumn("task", F.col("bucket") % tasks).groupBy("task").applyInArrow(shared_in_bucket, "batch long, refs binary, hits binary")
    hits = hits.groupBy("batch").applyInArrow(summed_hits, "batch long, ref int, hits long")
    able = sets.where("cls IS NOT NULL").join(hits, ["batch", "ref"], "left").where(F.coalesce("hits", F.lit(0)) + F.col("known") >= F.col("needed"))
    # one text stands for a class
    able = cut(able.groupBy("cls").agg(F.min("th").alias("th")), "able")
    again = able.select("th").distinct()
    if able.count() <= BROADCAST_TEXTS:
        again = F.broadcast(again)
    texts = rows.join(again, "th", "left_semi").select("text", "th").dropDuplicates(["th"]).select("text")

    ordered = cut(ordered_sets(texts, k, percent, buckets), "ordered")
    heads = ordered.select("cls", F.explode(F.slice("toks", F.lit(1), F.col("prefix"))).alias("tok"))
    leaders = cut(heads.groupBy("tok").agg(F.min("cls").alias("v"), F.count("*").alias("m")).where("m > 1").select("tok", "v"), "leaders")
    near = heads.join(leaders, "tok").select(F.col("cls").alias("u"), "v").where("u != v").distinct()
    candidates = cut(connected_components(near), "candidates")
    labels = cut(joined_components(ordered, candidates, percent, task_sets), "labels")
    smallest = sets.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    grouped = smallest.join(labels.withColumnRenamed("node", "cls"), "cls", "left").where("root IS NOT NULL OR copies > 1").withColumn("root", F.coalesce("root", "cls"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(ids, "root").select("cls", "root", "component_id")
    return sets.join(named, "cls", "left").select("doc_id", "th", "n", F.coalesce("root", "cls").alias("grp"), F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, task_sets: int = TASK_SETS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id that links reach).

    Two documents link when 100 * shared >= percent * all distinct shingles.  A text without words, or
    null, has no shingle, links with nothing and is its own component.  Equal documents link.  Rows
    with the same id are documents of their own.  A null id sorts after all others.  Shingles and
    sets are told apart by 64-bit hashes.  Other columns are ignored.
    """
    return linked_documents(docs, k, percent, task_sets).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, task_sets: int = TASK_SETS) -> DataFrame:
    """``docs`` with one row of each component of near copies, that with the smallest doc_id; all columns stay.

    Rows without words stay.  Of rows with the same id and text one stays.
    """
    rows = cut(linked_documents(docs, k, percent, task_sets).where("grp IS NOT NULL").select("grp", "doc_id", "th"), "rows")
    groups = rows.groupBy("grp").agg(F.min(F.struct("doc_id", "th")).alias("one"), F.count("*").alias("n")).where("n > 1").select("grp", "one")
    groups = cut(groups, "groups")
    members = rows.join(groups, "grp").withColumn("is_one", F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("th") == F.col("one.th")))
    gone = members.groupBy("doc_id", "th").agg(F.max("is_one").alias("is_one"), F.count("*").alias("n")).where("NOT is_one OR n > 1")
    gone = cut(gone.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "is_one"), "gone")
    few = gone.count() <= BROADCAST_TEXTS
    marked = docs.withColumn(OWN_TH, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(OWN_TH) == F.col("__th"))
    once = gone.where("is_one")
    rest = marked.join(F.broadcast(gone) if few else gone, same, "left_anti")
    back = marked.join(F.broadcast(once) if few else once, same, "left_semi").dropDuplicates(["doc_id", OWN_TH])
    return rest.unionByName(back).select(*docs.columns)

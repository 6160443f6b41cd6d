"""Removal of byte strings that repeat, by a distributed difference-cover suffix array.

A byte goes when it lies in a string of ``length`` bytes that starts anywhere else as well.  Whether
a window of that length repeats is read from suffix arrays: windows that are equal stand next to each
other in suffix order, and neighbours' prefixes are compared.

The suffixes are dealt to tasks so that equal windows meet.  Each window's anchor is the leftmost
smallest hash among its 64-byte strings, so equal windows have equal anchors at equal places.  A run
of windows with the same anchor is a context: the bytes that these windows cover.

* An anchor string that occurs once has no equal window anywhere: its context is left out.
* If all contexts of an anchor string are equal (named by a digest), every window in them repeats.
* The distinct contexts of the other anchor strings go to tasks of bounded size.  There each context
  is cut down to the windows that can be equal to another's: windows at nearly the same distance from
  the anchor have most bytes in common, and only where that common part recurs can they be equal.
  What is left is laid end to end; the difference-cover algorithm sorts its suffixes (triples sorted and
  named, names sorted by recursion, remaining suffixes merged), and equal windows are neighbours.
* An anchor string with more than ``task_contexts`` distinct contexts would not fit a task; its windows are
  named by 128-bit digests and counted instead, which any number of tasks can share.

Passages of words are found in the same way: each word stands as a code of a fixed number of bytes, and
of the windows that repeat those that start with a word count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, release, tidy
from .features import BYTE, SPACE, Bytes, mixed, powers, slices
from .suffixes import equal_prefixes, suffix_array

GRAM = 64
#: Bytes hashed at once, and bytes of contexts in a task, about.
PIECE, TASK_BYTES = 1 << 19, 1 << 20
TASK_CONTEXTS = 6000
#: Groups of neighbouring windows of a context that are ruled out together.
CELLS = 8
#: Text hashes that are broadcast (8 bytes each); beyond it texts are joined by shuffle.
BROADCAST_TEXTS = 1_000_000
#: Bytes of a word's hash.  Passages of many words are compared, so about 2**-48 holds for a pair that differs in one word.
WORD_CODE = 6
#: Names of own columns beside those of a caller's table.
OWN_TH, OWN_SPANS, OWN_PASSAGES = "__repeat_th", "__repeat_spans", "__repeat_passages"


def encoded(texts: list[str]) -> list[bytes]:
    return [t.encode() for t in texts]


def word_codes(texts: list[str]) -> list[bytes]:
    """The codes of each text's words, end to end.  Words are separated by space and \\t\\n\\v\\f\\r."""
    raws, out = encoded(texts), []
    for a, b in slices(raws):
        words, first, after = Bytes(raws[a:b]).words()
        codes = words.view(np.uint8).reshape(-1, 8)[:, :WORD_CODE].tobytes()
        out += [codes[WORD_CODE * i : WORD_CODE * j] for i, j in zip(first.tolist(), after.tolist())]
    return out


def passage_ranges(raw: bytes, spans: list[dict], words: int) -> list[dict]:
    """Byte ranges of the passages of ``words`` words or more in spans of word codes."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[np.frombuffer(raw, np.uint8)], [True]]).astype(np.int8))).tolist()
    whole = [(-(-s["start"] // WORD_CODE), s["end"] // WORD_CODE) for s in spans]
    return [{"start": edge[2 * a], "end": edge[2 * b - 1]} for a, b in whole if b - a >= words]


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text, offset, bytes) of bounded size that hold every window of the texts once."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) - length + 1, PIECE):
            part = t[at : at + PIECE + length - 1]
            group.append((i, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def contexts(group: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, context digest, first window, last window, anchor) of each context; places are in the text."""
    buf = b"".join(p for _, _, p in group)
    raw = np.frombuffer(buf, np.uint8)
    sizes = np.array([len(p) for _, _, p in group])
    starts = np.cumsum(sizes) - sizes
    n = len(raw) - GRAM + 1
    up, down = powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE[raw] * up, out=total[1:])
    grams = mixed((total[GRAM:] - total[:-GRAM]) * down[:n])
    value = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    span = length - GRAM + 1
    blocks = -(-n // span) + 1
    table = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    table[:n] = value
    table = table.reshape(blocks, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    counts = sizes - length + 1
    window = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    anchor = (np.minimum(behind[window], ahead[window + span - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.diff(anchor, prepend=-1, append=-1))
    low, high, at = window[edge[:-1]], window[edge[1:] - 1], anchor[edge[:-1]]
    digest = np.fromiter(
        (xxhash.xxh3_64_intdigest(buf[a : b + length], c - a) for a, b, c in zip(low.tolist(), high.tolist(), at.tolist())), np.uint64, len(low)
    )
    which = np.searchsorted(starts, low, "right") - 1
    shift = np.array([o for _, o, _ in group]) - starts
    text = np.array([i for i, _, _ in group])[which]
    return text, grams[at].view(np.int64), digest.view(np.int64), low + shift[which], high + shift[which], at + shift[which]


def context_table(texts: DataFrame, length: int, code: Callable[[list[str]], list[bytes]] = encoded) -> DataFrame:
    """th, akey, ckey, low, high, at of each context of ``texts(th, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            th = b.column(0).to_numpy()
            for group in pieces(code(b.column(1).to_pylist()), length):
                text, *columns = contexts(group, length)
                yield pa.RecordBatch.from_arrays([pa.array(th[text]), *map(pa.array, columns)], ["th", "akey", "ckey", "low", "high", "at"])

    return texts.mapInArrow(tidy(run), "th long, akey long, ckey long, low long, high long, at long")


def cut_out(rows: DataFrame, code: Callable[[list[str]], list[bytes]] = encoded) -> DataFrame:
    """``rows(text, wanted: array of structs)``: akey, ckey, the anchor's place in the context, and its bytes, of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = code([text])[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[c] for w in wanted], pa.int64()) for c in ("akey", "ckey", "anchor")] + [pa.array([raw[w["low"] : w["end"]] for w in wanted], pa.binary())],
                    ["akey", "ckey", "anchor", "bytes"],
                )

    return rows.mapInArrow(tidy(run), "akey long, ckey long, anchor long, bytes binary")


def hopeful(parts: list[bytes], akeys: list[int], anchors: list[int], length: int) -> list[tuple[int, int]]:
    """For each context the first window, and the first after the last one, that may occur in another context.

    Windows whose distance from the anchor is in one of a few ranges share the bytes between the
    range's last start and its first end.  Equal windows have equal anchors and distances, so these
    bytes recur too; ranges where they do not are left out at both ends.
    """
    span = length - GRAM
    width = -(-(span + 1) // CELLS)
    cells: list[list[tuple[int, int, int]]] = []
    seen: dict[int, int] = {}
    for part, akey, anchor in zip(parts, akeys, anchors):
        n = len(part) - length + 1
        own = []
        for j in range(CELLS):
            first = anchor - span + j * width
            last = first + width - 1
            if last >= 0 and first < n:
                name = xxhash.xxh3_64_intdigest(part[last : first + length], (akey * CELLS + j) & 0xFFFFFFFFFFFFFFFF)
                seen[name] = seen.get(name, 0) + 1
                own.append((name, first, last))
        cells.append(own)
    out = []
    for part, own in zip(parts, cells):
        kept = [(first, last) for name, first, last in own if seen[name] > 1]
        out.append((max(0, kept[0][0]), min(len(part) - length, kept[-1][1]) + 1) if kept else (0, 0))
    return out


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true flags."""
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2] - 1


def repeated_windows(parts: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each context, the runs (first, last window) of its windows that occur in the parts again."""
    buf = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes) - sizes
    is_window = np.ones(len(buf), bool)
    for s, n in zip(starts.tolist(), sizes.tolist()):
        is_window[s + max(0, n - length + 1) : s + n] = False
    order = suffix_array(buf)
    order = order[is_window[order]]
    same = equal_prefixes(buf, order, length)
    again = np.zeros(len(buf), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return [runs_of(again[s : s + n]) for s, n in zip(starts.tolist(), sizes.tolist())]


def sort_task(length: int):
    def run(rows: pa.Table) -> pa.Table:
        parts = rows.column("bytes").to_pylist()
        ranges = hopeful(parts, rows.column("akey").to_pylist(), rows.column("anchor").to_pylist(), length)
        which = [i for i, (a, b) in enumerate(ranges) if a < b]
        found = repeated_windows([parts[i][ranges[i][0] : ranges[i][1] + length - 1] for i in which], length) if which else []
        index = np.repeat(np.array(which, np.int64), [len(a) for a, _ in found])
        join = lambda k: np.concatenate([np.zeros(0, np.int64), *(f[k] + ranges[i][0] for i, f in zip(which, found))])
        akey, ckey = (rows.column(c).to_numpy()[index] for c in ("akey", "ckey"))
        release()
        return pa.table({"akey": pa.array(akey), "ckey": pa.array(ckey), "first": pa.array(join(0).astype(np.int64)), "last": pa.array(join(1).astype(np.int64))})

    return run


def window_names(contexts_: DataFrame, length: int) -> DataFrame:
    """akey, ckey, place and a 128-bit digest of every window of the contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for akey, ckey, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, akey)), pa.array(np.full(n, ckey)), pa.array(np.arange(n)), pa.array([xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(n)], pa.binary())],
                    ["akey", "ckey", "place", "name"],
                )

    return contexts_.mapInArrow(tidy(run), "akey long, ckey long, place long, name binary")


def texts_with(docs: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """Documents whose text hash is (left_semi) or is not (left_anti) in the one column of ``wanted``, which are distinct."""
    if wanted.count() <= BROADCAST_TEXTS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, wanted.columns, how)


def repeated_spans(texts: DataFrame, length: int, task_contexts: int = TASK_CONTEXTS, code: Callable[[list[str]], list[bytes]] = encoded) -> DataFrame:
    """th and spans: the byte ranges (start, end), possibly overlapping, that repeated windows cover in each text.

    ``texts(th, text)`` has a row for each document; equal texts have equal th.  The bytes are those that ``code`` gives.
    """
    found = cut(context_table(texts, length, code), "contexts")
    anchors = found.groupBy("akey").agg(F.count("*").alias("n"), F.min("ckey").alias("a"), F.max("ckey").alias("b")).where("n > 1")
    # written first: a join with a written table can be split where one key is hot
    anchors = cut(anchors.select("akey", (F.col("a") == F.col("b")).alias("alike")), "anchors")
    # by shuffle at every size, so that small tables show how large ones behave
    shared = cut(found.join(anchors.hint("merge"), "akey"), "shared")
    whole = shared.where("alike").select("th", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    # distinct contexts, each with one place to read it
    kinds = shared.where("NOT alike").groupBy("akey", "ckey").agg(F.count("*").alias("copies"), F.min(F.struct("th", "low", F.expr(f"high + {length} AS end"), F.expr("at - low AS anchor"))).alias("one"))
    kinds = cut(kinds.select("akey", "ckey", "copies", "one.*"), "kinds")
    crowds = cut(kinds.groupBy("akey").agg(F.count("*").alias("n")).where(F.col("n") > task_contexts).select("akey"), "crowds")
    lists = kinds.groupBy("th").agg(F.collect_list(F.struct("akey", "ckey", "anchor", "low", "end")).alias("wanted"))
    sources = texts_with(texts, kinds.select("th").distinct(), "left_semi").dropDuplicates(["th"])
    parts = cut(cut_out(sources.join(lists, "th").select("text", "wanted"), code), "parts")
    total = kinds.agg(F.sum(F.col("end") - F.col("low"))).first()[0] or 0
    tasks = int(total // TASK_BYTES) + 1
    plain = parts.join(crowds, "akey", "left_anti").withColumn("task", F.pmod(F.xxhash64("akey"), F.lit(tasks)))
    runs = plain.groupBy("task").applyInArrow(sort_task(length), "akey long, ckey long, first long, last long")
    if crowds.count():
        names = cut(window_names(parts.join(crowds, "akey", "left_semi").select("akey", "ckey", "bytes"), length), "names")
        twice = cut(names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "twice")
        runs = runs.unionByName(names.join(twice, "name").select("akey", "ckey", F.col("place").alias("first"), F.col("place").alias("last")))
    copied = kinds.where("copies > 1").select("akey", "ckey", F.lit(0).cast("long").alias("first"), (F.col("end") - F.col("low") - length).alias("last"))
    runs = runs.unionByName(copied)
    spread = shared.where("NOT alike").select("th", "akey", "ckey", "low").distinct().join(runs, ["akey", "ckey"])
    spread = spread.select("th", (F.col("low") + F.col("first")).alias("start"), (F.col("low") + F.col("last") + length).alias("end"))
    spans = whole.unionByName(spread).distinct()
    return spans.groupBy("th").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def united(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of sorted ranges."""
    out: list[list[int]] = []
    for s in spans:
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [(a, b) for a, b in out]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with text not null, and th: a hash of the text."""
    return docs.withColumn("text", F.coalesce(F.col("text"), F.lit(""))).withColumn("th", F.xxhash64("text"))


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    Texts are their UTF-8 bytes, and null is empty; windows never cross documents, and every row is
    a document of its own, so a repeated row of ``length`` bytes or more is removed whole, each time.
    Shorter texts stay.  Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = keyed(docs.select("doc_id", "text"))
    spans = cut(repeated_spans(rows.select("th", "text"), length), "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw, runs = text.encode(), united(found)
                for o, v in zip(out, (len(raw), sum(e - s for s, e in runs), len(runs), hashlib.sha256(without(raw, runs)).hexdigest())):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    hit = texts_with(rows, spans.select("th"), "left_semi").join(spans, "th").select("doc_id", "text", "spans")
    hit = hit.mapInArrow(tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    rest = texts_with(rows, spans.select("th"), "left_anti")
    zero = F.lit(0).cast("long")
    return hit.unionByName(rest.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")))


def strip_repeats(docs: DataFrame, length: int = 400, words: int | None = None) -> DataFrame:
    """``docs(doc_id, text, ...)`` with repeated bytes removed from ``text``; other columns and null texts stay.

    With ``words``, passages of that many words that start anywhere else as well are removed too, whatever
    their bytes and the white space between the words; both kinds are looked for in the texts as given.
    A range that starts or ends inside a character takes the whole character with it.  Every row is a
    document of its own, so repeated rows with texts that are long enough lose them, each; an empty table
    stays empty.
    """
    prepare(docs.sparkSession)
    rows = keyed(docs.select("text")).where("text != ''").select("th", "text")
    spans = cut(repeated_spans(rows, length), "spans").withColumnsRenamed({"th": OWN_TH, "spans": OWN_SPANS})
    if words is None:
        spans = spans.withColumn(OWN_PASSAGES, F.lit(None).cast(spans.schema[OWN_SPANS].dataType))
    else:
        passages = cut(repeated_spans(rows, words * WORD_CODE, code=word_codes), "passages").withColumnsRenamed({"th": OWN_TH, "spans": OWN_PASSAGES})
        spans = cut(spans.join(passages, OWN_TH, "full_outer").select(OWN_TH, OWN_SPANS, OWN_PASSAGES), "both")
    marked = docs.withColumn(OWN_TH, F.xxhash64(F.coalesce("text", F.lit(""))))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for text, found, more in zip(*(b.column(i).to_pylist() for i in (at, b.num_columns - 2, b.num_columns - 1))):
                raw = text.encode()
                ranges = (found or []) + (passage_ranges(raw, more, words) if more else [])
                new.append(without(raw, united(sorted(ranges, key=lambda r: r["start"]))).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at else b.column(i) for i in range(b.num_columns - 2)], b.schema.names[:-2])

    hit = texts_with(marked, spans.select(OWN_TH), "left_semi").join(spans, OWN_TH).select(*docs.columns, OWN_SPANS, OWN_PASSAGES).mapInArrow(tidy(run), docs.schema)
    return hit.unionByName(texts_with(marked, spans.select(OWN_TH), "left_anti").select(*docs.columns))

"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

Documents of up to ``giant`` characters are encoded by the library in Arrow batches.  Larger ones are
split into chunks of characters that tasks handle apart.

A token sequence is the byte-pair encoding of its text if and only if each two neighbouring tokens
are that of theirs.  So the encoding is the one path of score 0 through the tokens that match the
text, where a step between neighbours scores 0 if they are the encoding of what they spell, and minus
infinity if not.  A chunk's states are the tokens that can cover the character before its start, and
those that can cover its last one.  Its transfer matrix holds the best score between both; matrices
combine by the associative max-plus product (scores are 0 or minus infinity, so an entry is there or
not).  Neighbouring matrices are combined round by round, a few to a task, until a document has one;
going back down, the states at the ends of a product give those between its factors.  Then each chunk
is backtraced by itself between its states.  No task holds more than a few matrices or chunks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, tidy

#: Rows whose ids are in memory at once as Python numbers.
ROWS = 128
#: Characters from which a document is split, and of a chunk.
GIANT, CHUNK = 65_536, 8_192
#: Matrices that a task combines to one.
FAN = 16


class Pieces:
    """The vocabulary of a model, with merging by score."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        self.bytes = {int(self.model.id_to_piece(i)[3:5], 16): i for i in range(size) if self.model.is_byte(i)}
        plain = [i for i in range(size) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))]
        self.ids = {self.model.id_to_piece(i): i for i in plain}
        self.scores = {p: self.model.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.starts = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.fits = lru_cache(maxsize=1 << 20)(self._fits)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best-scoring neighbours are merged first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: str, right: str) -> bool:
        return self.merged(left + right) == [left, right]

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes.get(b, self.model.unk_id()) for b in piece.encode()]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def id_lists(lists: list[list[int]]) -> pa.ListArray:
    """Lists of ids as Arrow lists, by way of one flat array."""
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))))


def normalised(model: Pieces, text: str) -> str:
    """The text as the model sees it: normalised, with spaces as symbols and one in front."""
    return model.model.normalize(text) if text else ""


def tokens_at(model: Pieces, text: str, at: int) -> list[int]:
    """Ends of the tokens that can start here: any piece that matches, or the one character."""
    ends, starts, ids = [at + 1], model.starts, model.ids
    for end in range(at + 2, min(len(text), at + model.longest) + 1):
        part = text[at:end]
        if part not in starts:
            break
        if part in ids:
            ends.append(end)
    return ends


def covering(model: Pieces, text: str, at: int) -> list[tuple[int, int]]:
    """Tokens (start, end) that cover the character before ``at``."""
    return [(s, e) for s in range(max(0, at - model.longest), at) for e in tokens_at(model, text, s) if e >= at]


def advance(model: Pieces, text: str, entries: dict[tuple[int, int], int], stop: int) -> list[dict[tuple[int, int], int]]:
    """For each place the tokens that end there, with the set (bits) of entry states of which each can be reached.

    ``entries`` gives the bits of the states to start from; tokens that start before ``stop`` are followed.
    """
    places: list[dict[tuple[int, int], int]] = [{} for _ in range(len(text) + 1)]
    for (s, e), bits in entries.items():
        places[e][(s, e)] = places[e].get((s, e), 0) | bits
    fits = model.fits
    for at in range(min(stop, len(text))):
        if places[at]:
            live = [(text[s:e], bits) for (s, e), bits in places[at].items()]
            for end in tokens_at(model, text, at):
                right = text[at:end]
                got = 0
                for left, bits in live:
                    if bits & ~got and (not left or fits(left, right)):
                        got |= bits
                if got:
                    places[end][(at, end)] = places[end].get((at, end), 0) | got
    return places


def transfer(model: Pieces, text: str, start: int, stop: int) -> list[tuple[int, int, int, int]]:
    """The finite entries of a chunk's matrix: (entry start, entry end, exit start, exit end), places in ``text``.

    ``start`` and ``stop`` bound the chunk; the text has the characters around it that tokens may reach into.
    """
    states = covering(model, text, start) if start else [(0, 0)]
    places = advance(model, text, {s: 1 << i for i, s in enumerate(states)}, stop)
    out = []
    for end in range(stop, len(text) + 1):
        for (s, e), bits in places[end].items():
            if s < stop:
                out += [(*states[i], s, e) for i in range(bits.bit_length()) if bits >> i & 1]
    return out


def backtrace(model: Pieces, text: str, entry: tuple[int, int], leave: tuple[int, int], stop: int) -> list[str]:
    """The tokens after ``entry`` up to and with ``leave``."""
    places = advance(model, text, {entry: 1}, stop)
    out, token = [], leave
    while token != entry:
        out.append(text[token[0] : token[1]])
        token = next(t for t in places[token[0]] if t == entry or t[0] == t[1] or model.fits(text[t[0] : t[1]], out[-1]))
    return out[::-1]


Matrix = list[tuple[int, int, int, int]]


def combined(first: Matrix, second: Matrix) -> Matrix:
    """The max-plus product of two neighbouring matrices: states that a path of score 0 joins."""
    ahead: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b, c, d in second:
        ahead.setdefault((a, b), []).append((c, d))
    return sorted({(a, b, *leave) for a, b, c, d in first for leave in ahead.get((c, d), ())})


def product(matrices: list[Matrix]) -> Matrix:
    """Neighbours combined in pairs until one matrix is left; the order of combination does not matter."""
    while len(matrices) > 1:
        matrices = [combined(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0]


def path_of(matrices: list[Matrix], entry: tuple[int, int], leave: tuple[int, int]) -> list[tuple[int, int]]:
    """The states at all bounds of neighbouring matrices on a path between two states."""
    reached = [{entry}]
    for m in matrices:
        reached.append({(c, d) for a, b, c, d in m if (a, b) in reached[-1]})
    out, state = [leave], leave
    for m, before in zip(matrices[::-1], reached[-2::-1]):
        state = next((a, b) for a, b, c, d in m if (c, d) == state and (a, b) in before)
        out.append(state)
    return out[::-1]


def unflat(entries: list[int]) -> Matrix:
    return [tuple(entries[i : i + 4]) for i in range(0, len(entries), 4)]


def state_at_bounds(matrices: DataFrame, fan: int = FAN) -> DataFrame:
    """th, number, and the entry (a, b) and exit (c, d) of each of ``matrices(th, number, size, entries)`` on the path of its document."""

    def up(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        whole = product([unflat(x) for x in rows.column("entries").to_pylist()])
        one = rows.slice(0, 1)
        return pa.table({"th": one.column("th"), "number": one.column("parent"), "size": one.column("size"), "entries": pa.array([[v for x in whole for v in x]], pa.list_(pa.int64()))})

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [next(x for x in unflat(e) if x[:2] == (0, 0) and x[3] == n) for e, n in zip(b.column(3).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([x[i] for x in ends], pa.int64()) for i in range(4))], ["th", "number", *"abcd"])

    def down(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        a, b, c, d = (rows.column(x)[0].as_py() for x in "abcd")
        path = path_of([unflat(x) for x in rows.column("entries").to_pylist()], (a, b), (c, d))
        columns = [[x[i] for x in part] for part in (path[:-1], path[1:]) for i in range(2)]
        return pa.table({"th": rows.column("th"), "number": rows.column("number"), **{n: pa.array(x, pa.int64()) for n, x in zip("abcd", columns)}})

    parent = F.floor(F.col("number") / fan).alias("parent")
    bounds = "th long, number long, a long, b long, c long, d long"
    levels, count = [matrices], matrices.agg(F.max("number")).first()[0] or 0
    while count:
        above = levels[-1].select("*", parent).groupBy("th", "parent").applyInArrow(up, "th long, number long, size long, entries array<long>")
        levels.append(cut(above, "products"))
        count //= fan
    states = levels[-1].select("th", "number", "size", "entries").mapInArrow(tidy(root), bounds)
    for below in levels[-2::-1]:
        ends = cut(states, "states").withColumnRenamed("number", "parent")
        states = below.select("th", "number", "entries", parent).join(ends, ["th", "parent"]).groupBy("th", "parent").applyInArrow(down, bounds)
    return states


def chunk_rows(rows: DataFrame, path: str, chunk: int) -> DataFrame:
    """th, number, base (place of ``text`` in the document), text, start and stop in it, size of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for b in batches:
            for th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                whole = normalised(model, text)
                for number, start in enumerate(range(0, len(whole), chunk)):
                    base, stop = max(0, start - model.longest), min(len(whole), start + chunk)
                    part = whole[base : stop + model.longest]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([th]), pa.array([number]), pa.array([base]), pa.array([part]), pa.array([start - base]), pa.array([stop - base]), pa.array([len(whole)])],
                        ["th", "number", "base", "text", "start", "stop", "size"],
                    )

    return rows.mapInArrow(tidy(run), "th long, number long, base long, text string, start long, stop long, size long")


def encode_giant(rows: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """th and ids of each text of ``rows(th, text)``, by the scan."""
    spark = rows.sparkSession
    parts = cut(chunk_rows(rows, path, chunk), "chunks")
    parts = parts.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "th", "number")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for b in batches:
            for r in b.to_pylist():
                m = transfer(model, r["text"], r["start"], r["stop"])
                flat = [v + r["base"] for x in m for v in x]
                yield pa.RecordBatch.from_arrays([pa.array([r["th"]]), pa.array([r["number"]]), pa.array([r["size"]]), pa.array([flat], pa.list_(pa.int64()))], ["th", "number", "size", "entries"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for b in batches:
            for r in b.to_pylist():
                base = r["base"]
                got = backtrace(model, r["text"], (r["a"] - base, r["b"] - base), (r["c"] - base, r["d"] - base), r["stop"])
                yield pa.RecordBatch.from_arrays([pa.array([r["th"]]), pa.array([r["number"]]), pa.array([[i for p in got for i in model.ids_of(p)]], pa.list_(pa.int32()))], ["th", "number", "ids"])

    matrix = cut(parts.mapInArrow(tidy(matrices), "th long, number long, size long, entries array<long>"), "matrices")
    bounds = state_at_bounds(matrix)
    ids = parts.join(bounds, ["th", "number"]).select("th", "number", "base", "text", "stop", "a", "b", "c", "d").mapInArrow(tidy(traced), "th long, number long, ids array<int>")
    joined = F.array_sort(F.collect_list(F.struct("number", "ids")))
    return ids.groupBy("th").agg(F.flatten(F.transform(joined, lambda x: x["ids"])).alias("ids"))


def encode_documents(docs: DataFrame, path: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """doc_id and ids (array<int>) of each row of ``docs``, as the library encodes its text.

    A null or empty text has no ids.  Repeated rows are encoded each.  Other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path).model
        for b in batches:
            for at in range(0, b.num_rows, ROWS):  # ids as Python numbers are many times the text's size
                part = b.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), id_lists(model.encode(part.column(1).to_pylist(), num_threads=1))], ["doc_id", "ids"])

    small = rows.where(F.length("text") <= giant).mapInArrow(tidy(run), f"doc_id {kind}, ids array<int>")
    large = rows.where(F.length("text") > giant).withColumn("th", F.xxhash64("text"))
    found = encode_giant(large.select("th", "text").dropDuplicates(["th"]), path, chunk)
    return small.unionByName(large.select("doc_id", "th").join(found, "th").select("doc_id", "ids"))


def decoded(model, ids: pa.ListScalar) -> str:
    return model.decode(ids.values.to_numpy().tolist()) if ids.values is not None and len(ids.values) else ""


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row of ``encoded(doc_id, ids)``; null ids give an empty text."""
    prepare(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path).model
        for b in batches:
            texts = [decoded(model, ids) for ids in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {kind}, text string")


def encoding_digest(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids) and decoded_sha256 of each row of ``encoded``."""
    prepare(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path).model
        for b in batches:
            ids = [np.zeros(0, np.int32) if x.values is None else x.values.to_numpy() for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4")) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(decoded(model, x).encode()).hexdigest() for x in b.column(1)], pa.string()),
                ],
                ["doc_id", "n_ids", "ids_crc32", "decoded_sha256"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_sha256 string")

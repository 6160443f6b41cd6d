"""Concatenate-and-cut packing of tokenised documents.

The token streams of all documents are laid end to end and cut every ``window`` tokens.  Two passes
give the global offsets: the first tokenises each scan partition, keeps the ids with each document's
offset inside its partition and writes both; the totals of the partitions are then summed in order,
and the second pass adds a partition's base to its documents' offsets and cuts at the window bounds.
Only the last sequence is short.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, prepare, texts_of, tidy

#: Partition totals are broadcast up to this many rows (16 bytes each); beyond it they are joined by shuffle.
BROADCAST_TOTALS = 1_000_000
#: White space in one run from which the slower tokenizer is used: the faster one's pattern recurses over such a run.
LONG_BLANKS = 10_000
BLANKS = re.compile(r"\s\s+")


@lru_cache(maxsize=2)
def tokenizer(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@lru_cache(maxsize=2)
def special_strings(json_path: str) -> tuple[str, ...]:
    with open(json_path, "rb") as f:
        return tuple(t["content"] for t in json.load(f).get("added_tokens", []))


@lru_cache(maxsize=2)
def ranked(rank_path: str):
    """The vocabulary as ranks."""
    import public_tokenizers
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def long_blanks(text: str) -> bool:
    return len(text) >= LONG_BLANKS and any(m.end() - m.start() >= LONG_BLANKS for m in BLANKS.finditer(text))


def encode(text: str, json_path: str, rank_path: str | None) -> list[int]:
    """Token ids of a text as ``tokenizers`` gives them.

    The same vocabulary as ranks gives the same ids for texts without the strings of special tokens
    and is several times faster, so it is used for those, and ``tokenizers`` is loaded only for others:
    those, and texts with a very long run of white space, on which the faster one fails.
    """
    if rank_path is None or any(s in text for s in special_strings(json_path)) or long_blanks(text):
        return tokenizer(json_path).encode(text, add_special_tokens=False).ids
    return ranked(rank_path).encode_ordinary(text)


def token_table(docs: DataFrame, json_path: str, rank_path: str | None = None, end_id: int = 0) -> DataFrame:
    """doc_id, part, local (tokens before it in its partition), n, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = [np.array([*encode(t, json_path, rank_path), end_id], "<u4") for t in b.column(1).to_pylist()]
            n = np.array([len(x) for x in ids], "i8")
            before = local + np.cumsum(n) - n
            local += int(n.sum())
            packed = [x.astype("<u2").tobytes() if x.max() < 65536 else b"\0" + x.tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(n), part, "i4")), pa.array(before), pa.array(n), pa.array(packed, pa.binary())],
                ["doc_id", "part", "local", "n", "ids"],
            )

    prepare(docs.sparkSession)
    rows = texts_of(docs)
    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, part int, local long, n long, ids binary")


def unpack(packed: bytes) -> np.ndarray:
    """Ids of two bytes each; an odd length marks four-byte ids after one byte."""
    return np.frombuffer(packed, "<u2").astype("<u4") if len(packed) % 2 == 0 else np.frombuffer(packed, "<u4", offset=1)


def pack_documents(docs: DataFrame, json_path: str, rank_path: str | None = None, window: int = 1024, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens.

    Returns per piece doc_id, start, length, ids_crc32 (little-endian unsigned 32-bit ids),
    doc_tokens, sequence_id, offset, and ids (array<int>) with ``keep_ids``.  A null or empty text
    is the end id alone.  Repeated rows are packed each.  An empty table gives no piece.  Other
    columns are ignored.
    """
    tokens = cut(token_table(docs, json_path, rank_path, end_id), "tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the scan
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    totals = cut(totals.coalesce(1), "totals")
    if totals.count() <= BROADCAST_TOTALS:
        totals = F.broadcast(totals)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = b.column(1).to_numpy()
            out: list[list] = [[] for _ in range(7)]
            kept: list[np.ndarray] = []
            for i, (at, packed) in enumerate(zip(first.tolist(), b.column(2).to_pylist())):
                ids, start = unpack(packed), 0
                while start < len(ids):
                    seq, off = divmod(at + start, window)
                    length = min(window - off, len(ids) - start)
                    piece = ids[start : start + length]
                    for o, v in zip(out, (i, start, length, zlib.crc32(piece), len(ids), seq, off)):
                        o.append(v)
                    if keep_ids:
                        kept.append(piece.astype("i4"))
                    start += length
            cols = [b.column(0).take(pa.array(out[0], pa.int32())), *(pa.array(x, pa.int64()) for x in out[1:])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    placed = tokens.join(totals, "part").select("doc_id", (F.col("base") + F.col("local")).alias("at"), "ids")
    return placed.mapInArrow(
        tidy(run),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids,
    )

"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its
inner s-mers lies at its first or last s-mer: whether it is chosen depends on
its own k characters only, so a passage keeps its anchors wherever it stands.
The fingerprint holds all anchors (each distinct hash once), in the order of
their first places in the text, as 8 hex digits each, and so grows with it: to about
two thirds of the characters.

``likeness`` of two fingerprints matches anchors by position: the longest run
of shared anchors in the same order (not necessarily adjacent), divided by the
number of anchors of both.

Defined results: an empty text has the empty fingerprint; a text shorter than
k has one anchor, its whole; two empty fingerprints have likeness 1, one
empty one 0.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import ddl_of, packed, stable

#: One place in (K - S + 1) / 2 = 12 is an anchor, whatever the rest of the text.
K, S = 28, 5
ROWS = 1000                    # documents whose fingerprints a task holds at once
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive codes."""
    n = len(codes) - width + 1
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = h * _A + codes[i:n + i]
    return _mix(h)


def anchors(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of the closed syncmers."""
    if len(codes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    if len(codes) < k:
        return np.zeros(1, np.int64), (_windows(codes, len(codes)) >> np.uint64(32)).astype(np.uint32)
    inner = _windows(codes, s)
    w = k - s + 1                              # s-mers in a k-mer
    low, span = inner, 1
    while span * 2 <= w:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    low = np.minimum(low[:len(inner) - w + 1], low[w - span:])
    at = np.flatnonzero((inner[:len(low)] == low) | (inner[w - 1:] == low))
    if len(at) == 0:                           # no k-mer is closed: the whole text is the anchor
        return np.zeros(1, np.int64), (_windows(codes, len(codes)) >> np.uint64(32)).astype(np.uint32)
    h = np.zeros(len(at), np.uint64)
    for i in range(k):
        h = h * _A + codes[at + i]
    return at, (_mix(h) >> np.uint64(32)).astype(np.uint32)


def sketch(codes: np.ndarray) -> np.ndarray:
    """The fingerprint as an array of 32-bit hashes in text order."""
    _, h = anchors(codes)
    return h[np.sort(np.unique(h, return_index=True)[1])]


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 or len(b) == 0:
        return 1.0 if len(a) == len(b) else 0.0
    _, at, place = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    tails: list[int] = []                      # longest increasing run of places
    for p in place[np.argsort(at)].tolist():
        i = bisect_left(tails, p)
        tails[i:i + 1] = [p]
    return len(tails) / (len(a) + len(b) - len(place))


def fingerprint_string(f: np.ndarray) -> str:
    return f.astype("<u4").tobytes().hex()


def fingerprint_docs(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole text (null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            got = [fingerprint_string(sketch(codes_of(t.as_py() or ""))) for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], [*b.schema.names, out])

    docs = docs.drop(out)
    return docs.mapInArrow(run, f"{ddl_of(docs.schema.fields)}, `{out}` string")


# -- a document against its edited text and its successor --------------------

_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, print binary, edited_print binary, "
           "near_edited double, near_next double")


def _unpack(z: bytes) -> str:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(z).decode("utf-8", "surrogatepass")


def _compare(doc_id, text: str, own: np.ndarray, after: str, after_print: np.ndarray) -> tuple:
    import hashlib
    n = len(text)
    edited = text[:n - n // 2] + after[:n // 2]
    ep = sketch(codes_of(edited))
    return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            own.tobytes(), ep.tobytes(), likeness(own, ep), likeness(own, after_print))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has the last floor(n/2) code points replaced by the first
    as many (or all) of the next document in ascending id order (after the
    last: the first; null ids come first; equal ids by text hash and text).

    Whole documents, compressed, are shuffled once, by ranges of (id, text hash), and
    written; the fingerprints never are.  Each task walks its
    sorted rows; the last document of a range meets the first of the next range
    in a second, small join over two rows per range.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ranged = (packed(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h")), "text", level=3)
              .repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("h"))
              .sortWithinPartitions(F.asc_nulls_first("doc_id"), "h", "text")
              .withColumn("part", F.spark_partition_id()))
    ranged = stable(ranged.select("doc_id", "text", "part"))
    cols = ["doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            for at in range(0, len(b), ROWS):
                out, some = [], b.iloc[at:at + ROWS]
                for doc_id, z in zip(some["doc_id"].astype("Int64"), some["text"], strict=True):
                    t = _unpack(z)
                    own = sketch(codes_of(t))
                    if held is not None:
                        out.append(_compare(*held, t, own))
                    held = (None if doc_id is pd.NA else int(doc_id), t, own)
                yield pd.DataFrame(out, columns=cols).astype({"doc_id": "Int64", "n_chars": "Int64"})

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(b: pa.RecordBatch, side: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*b.columns, pa.array([side], pa.int32())], [*b.schema.names, "side"])

        last = None
        for b in batches:
            if b.num_rows:
                if last is None:
                    yield row(b.slice(0, 1), 0)
                last = b.slice(b.num_rows - 1, 1)
        if last is not None:
            yield row(last, 1)

    done = ranged.select("doc_id", "text").mapInPandas(walk, _RESULT)
    edges = stable(ranged.mapInArrow(ends, "doc_id bigint, text binary, part int, side int"))
    parts = edges.filter("side = 0").select("part")                  # one number per range
    ring = (parts.withColumn("n", F.lead("part").over(Window.orderBy("part")))
            .withColumn("n", F.coalesce("n", F.min("part").over(Window.partitionBy()))))
    last = edges.filter("side = 1").select("doc_id", "part", "text")
    first = edges.filter("side = 0").select(F.col("part").alias("n"), F.col("text").alias("after"))
    pairs = last.join(ring, "part").join(first, "n").select("doc_id", "text", "after")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, t, after in zip(b["doc_id"].astype("Int64"), map(_unpack, b["text"]), map(_unpack, b["after"]), strict=True):
                out.append(_compare(None if doc_id is pd.NA else int(doc_id), t, sketch(codes_of(t)),
                                    after, sketch(codes_of(after))))
            yield pd.DataFrame(out, columns=cols[:7]).astype({"doc_id": "Int64", "n_chars": "Int64"})

    def hexed(c: str):          # little-endian words -> the string's digits
        return F.lower(F.hex(F.col(c)))

    out = done.unionByName(pairs.mapInPandas(close, _RESULT))
    return out.select("doc_id", "n_chars", "edited_sha256", hexed("print").alias("fingerprint"),
                      hexed("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")

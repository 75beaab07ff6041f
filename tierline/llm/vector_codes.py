"""Vector code compression with per-dimension value dictionaries.

Vectors are put on the integer grid ``floor(scale * c)`` and cut into equal
consecutive parts; every part position has a codebook, and a part becomes the
number of its nearest entry (squared distance, ties to the lower number).

Blocks.  The rows are packed once into blocks of at most ``BLOCK`` vectors: per
dimension the sorted distinct integers of the block (its dictionary) and a
16-bit code per vector.  Every round then tabulates, per dimension, the squared
differences of the dictionary's integers to all entries, and the distances of
the parts are gathers from these tables by code, added up over the part's
dimensions: no vector is multiplied or subtracted again.  Dictionaries are
bounded by the block, not by the data, and nothing is broadcast but the
codebooks.

Training.  The codebooks start as the parts of the vectors with the smallest
ids.  Each round assigns all parts and replaces each entry by the componentwise
floor of its parts' mean; entries without parts stay.  Tasks send counts and
sums per entry and dimension (exact integers), which a shuffle adds up; the
codebooks themselves (entries x dimensions) pass through the driver.

Integers are exact throughout: int64 where that is proven to hold the sums, else
Python integers.

Defined results: rows whose vector is null or empty, or holds a null, NaN or
infinite entry, go; vectors of different lengths, or of a length the parts do
not divide, are an error; null ids come last; rows with one id start the
codebooks in the order of their vectors; with fewer rows than entries, the
codebooks have as many entries as rows; ``error`` is null beyond a long.  Other
columns stay; those named like an output are replaced.
"""

from __future__ import annotations

import decimal
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import ddl_of, fresh, stable
from tierline.llm.vectors import grid_vectors, matrix

BLOCK = 10_000
#: Up to this magnitude a part's squared distances and a block's sums fit int64.
NARROW = 1 << 26
LONG = (1 << 63) - 1
#: Groups whose summed errors are broadcast (under 10 MB); more are salted.
FEW_GROUPS = 100_000
SALTS = 32


class Codebooks:
    """``entries``: entry x dimension, Python integers; parts are equal
    stretches of the dimensions."""

    def __init__(self, entries: np.ndarray, parts: int) -> None:
        self.entries, self.parts = entries, parts

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position in the part."""
        d = self.entries.shape[1] if self.entries.size else 0
        w = d // self.parts
        text = ",".join(str(int(v)) for p in range(self.parts) for e in self.entries for v in e[p * w:(p + 1) * w])
        return hashlib.sha256(text.encode()).hexdigest()


def blocks_of(rows: DataFrame, keep, x: str) -> DataFrame:
    """Packs vectors into (rows, values, sizes, codes): the other columns, the
    dictionaries one after another, their sizes, and 16-bit codes by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = None
        for whole in batches:
            for at in range(0, len(whole), BLOCK):
                b = whole.slice(at, BLOCK)
                m = matrix(b.column(len(keep)), width)
                width = m.shape[1]
                found = [np.unique(m[:, j], return_inverse=True) for j in range(width)]
                values = np.concatenate([v for v, _ in found])
                codes = np.concatenate([c.reshape(-1).astype(np.uint16) for _, c in found])
                row = pa.StructArray.from_arrays(b.columns[:len(keep)], names=[f"c{i}" for i in range(len(keep))])
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(b)], pa.int32()), row), pa.array([values.astype(np.int64).tobytes()]),
                     pa.array([np.array([len(v) for v, _ in found], np.int32).tobytes()]), pa.array([codes.tobytes()])],
                    ["rows", "values", "sizes", "codes"])

    inner = ", ".join(f"c{i}: {f.dataType.simpleString()}" for i, f in enumerate(keep))
    return (rows.select(*[f"`{f.name}`" for f in keep], x)
            .mapInArrow(run, f"rows array<struct<{inner}>>, values binary, sizes binary, codes binary"))


def _unpack(values: bytes, sizes: bytes, codes: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    cuts = np.cumsum(np.frombuffer(sizes, np.int32))
    dictionaries = np.split(np.frombuffer(values, np.int64), cuts[:-1])
    return dictionaries, np.frombuffer(codes, np.uint16).reshape(len(cuts), -1)


def assign(dictionaries: list[np.ndarray], codes: np.ndarray, entries: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part x vector) nearest entry and its squared distance, from tables of
    squared differences."""
    d, m = codes.shape
    wide = max(int(np.abs(entries.astype(float)).max()), *(int(np.abs(v.astype(float)).max()) for v in dictionaries)) >= NARROW
    kind = object if wide else np.int64
    entries = entries.astype(kind)
    best, least = np.empty((parts, m), np.int64), np.empty((parts, m), kind)
    w = d // parts
    for p in range(parts):
        distance = np.zeros((m, len(entries)), kind)
        for j in range(p * w, (p + 1) * w):
            table = (dictionaries[j].astype(kind)[:, None] - entries[None, :, j]) ** 2
            distance += table[codes[j]]
        best[p] = distance.argmin(axis=1)
        least[p] = distance[np.arange(m), best[p]]
    return best, least


def _moments(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(entry, dim, n, s): parts assigned to each entry and their sums."""
    entries, parts = books.entries, books.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = entries.shape
        n, s = np.zeros((k, d), np.int64), np.zeros((k, d), object)
        for b in batches:
            for values, sizes, codes in zip(*(b.column(i) for i in range(3)), strict=True):
                dictionaries, c = _unpack(values.as_py(), sizes.as_py(), codes.as_py())
                best, _ = assign(dictionaries, c, entries, parts)
                for j in range(d):
                    # how often each entry took each distinct integer
                    size = len(dictionaries[j])
                    took = np.bincount(best[j * parts // d] * size + c[j], minlength=k * size).reshape(k, size)
                    n[:, j] += took.sum(axis=1)
                    narrow = np.abs(dictionaries[j].astype(float)).max() < NARROW
                    s[:, j] += (took @ dictionaries[j]).astype(object) if narrow else took.astype(object) @ dictionaries[j].astype(object)
        at = np.argwhere(n > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)), pa.array(n[n > 0]),
             pa.array([decimal.Decimal(int(v)) for v in s[n > 0]], pa.decimal128(38, 0))], ["entry", "dim", "n", "s"])

    return (blocks.select("values", "sizes", "codes").mapInArrow(run, "entry int, dim int, n bigint, s decimal(38,0)")
            .groupBy("entry", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))


def _first_vectors(rows: DataFrame, id_col: str, x: str, entries: int) -> np.ndarray:
    got = rows.orderBy(F.col(id_col).asc_nulls_last(), F.col(x).asc()).select(x).limit(entries).collect()
    if len({len(r[0]) for r in got}) > 1:
        raise ValueError("vectors of different lengths")
    return np.array([[int(v) for v in r[0]] for r in got], object)


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = 8, entries: int = 16,
             rounds: int = 6, scale: int = 4096, code_col: str = "code", error_col: str = "error") -> tuple[DataFrame, Codebooks]:
    """The rows with a whole vector, without the vector, with ``code_col``
    (array<int>: one entry number per part) and ``error_col`` (bigint: the
    squared distance to the coded vector); and the codebooks."""
    x = fresh("x", df)
    rows = grid_vectors(df, vec_col, scale, x)
    keep = [f for f in df.schema.fields if f.name not in (vec_col, code_col, error_col)]
    first = _first_vectors(rows, id_col, x, entries)
    if first.size and first.shape[1] % parts:
        raise ValueError(f"{parts} parts do not divide {first.shape[1]} dimensions")
    books = Codebooks(first if first.size else np.zeros((0, 0), object), parts)
    blocks = stable(blocks_of(rows, keep, x))
    for _ in range(rounds if first.size else 0):
        new = books.entries.copy()
        for r in _moments(blocks, books).collect():             # entries x dimensions rows at most
            new[r["entry"], r["dim"]] = int(r["s"]) // int(r["n"])
        books = Codebooks(new, parts)
    final = books.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lists, values, sizes, codes in zip(*(b.column(i) for i in range(4)), strict=True):
                dictionaries, c = _unpack(values.as_py(), sizes.as_py(), codes.as_py())
                best, least = assign(dictionaries, c, final, parts)
                total = least.astype(object).sum(axis=0) if least.dtype == object else least.sum(axis=0)
                error = pa.array([int(v) if v <= LONG else None for v in total], pa.int64())
                code = pa.ListArray.from_arrays(pa.array(np.arange(c.shape[1] + 1, dtype=np.int32) * parts),
                                                pa.array(best.T.astype(np.int32).reshape(-1)))
                row = lists.values
                yield pa.RecordBatch.from_arrays([*row.flatten(), code, error], [*(f.name for f in keep), code_col, error_col])

    made = f"`{code_col}` array<int>, `{error_col}` bigint"
    return blocks.mapInArrow(run, ", ".join(filter(None, [ddl_of(keep), made]))), books


def with_group_sum(df: DataFrame, group_col: str, value_col: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value_col`` over the rows of equal
    ``group_col``, nulls together (null beyond a long, or if a value is null).
    Sums are combined map-side and joined back; no group is gathered.  Up to ``FEW_GROUPS`` sums
    are broadcast, more are joined over salted rows, so that a hot group is
    spread over ``SALTS`` keys."""
    df = df.drop(out)
    g, salt = fresh("__g", df), fresh("__salt", df)
    total = F.expr(f"if(count(*) = count(`{value_col}`), try_cast(sum(cast(`{value_col}` as decimal(38,0))) as bigint), null)")
    sums = stable(df.groupBy(F.col(group_col).alias(g)).agg(total.alias(out)))
    same = F.col(group_col).eqNullSafe(F.col(g))
    if sums.count() <= FEW_GROUPS:
        return df.join(F.broadcast(sums), same).drop(g)
    other = fresh("__other", df)
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(SALTS)).cast("int"))
    spread = sums.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, same & (F.col(salt) == F.col(other))).drop(g, salt, other)

"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits over the word shingles of a text, a bit being 1 if it is
set in over half of the shingles' XXH64 (repeats count).  Two fingerprints
link at ``radius`` or fewer differing bits.

Covering tables.  Every bit position gets a non-zero vector of radius + 1
bits.  For each non-zero vector ``v`` a table keeps the positions whose vector
has an odd inner product with ``v`` and masks the others.  The vectors of up
to ``radius`` differing positions span at most ``radius`` dimensions, so some
``v`` is orthogonal to all of them: its table masks every difference, and the
pair collides there.  2^(radius + 1) - 1 tables (31 for radius 4) thus miss no
pair, and each compares about half of the bits.

Only distinct fingerprints enter the tables.  A bucket's members are compared
row by row and leave one edge per joined member, never all pairs.  A bucket
that a 1/64 sample of its members shows to be large is not sent to one task:
its members are hashed again by the same construction over the masked bits,
which fixes about half of the rest, and so on; at the last level eight free
bits hold 256 fingerprints at most.  Both ways are exact; the sample only chooses.

Defined results: a text with fewer words than a shingle is one shingle; null
or wordless text has fingerprint zero and links like any other.  Rows with a
null id get a component only through others (a null is no smallest id; if
nobody else is in it, component_id is null).  Repeated rows link as copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import fresh, stable
from tierline.llm.components import components

SAMPLE, HEAVY = 64, 32


def simhash(text: str | None, shingle: int) -> int:
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()      # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    w = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    got = b"".join([digest(flat[a:b], 42) for a, b in zip(starts[:len(words) - w + 1].tolist(), ends[w - 1:].tolist(), strict=True)])
    octets = np.frombuffer(got, np.uint8).reshape(-1, 8)                        # big-endian
    n = len(octets)
    # How often each value stands in each of the eight octets, then the bits.
    seen = np.bincount((octets + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
    return int.from_bytes(np.packbits((seen @ bits) * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str, out: str, shingle: int = 4) -> DataFrame:
    """``docs`` without the text, with ``out``: the fingerprint as a signed
    64-bit integer."""
    rest = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            got = np.array([simhash(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in rest), pa.array(got)],
                                             [*(f.name for f in rest), out])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"`{out}` bigint"])
    return docs.select(*[f.name for f in rest], text_col).mapInArrow(run, ddl)


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """The masks of the positions that each table compares.  The unit vectors
    come first, so that with ``radius + 1`` positions or more every table
    compares at least one."""
    vectors = 2 ** (radius + 1) - 1
    units = [1 << i for i in range(radius + 1)]
    order = units + [v for v in range(vectors, 0, -1) if v not in units]
    mapped = [(b, order[i % vectors]) for i, b in enumerate(bits)]
    return [sum(1 << b for b, m in mapped if (m & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _joined(fps: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """A spanning forest of the members that links join: each member is
    compared with those not yet reached, and is reached once."""
    rest = np.arange(len(fps))
    while len(rest):
        reached, rest = [int(rest[0])], rest[1:]
        while reached and len(rest):
            i = reached.pop()
            close = np.bitwise_count(fps[rest] ^ fps[i]) <= radius
            if close.any():
                found, rest = rest[close], rest[~close]
                reached.extend(found.tolist())
                yield i, found


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Distinct fingerprints (fp: bigint) -> edges (a, b) that connect exactly
    the fingerprints that links of at most ``radius`` bits connect."""
    masks = covering_masks(list(range(64)), radius)
    rows = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("m"))
                                                 for i, m in enumerate(masks)])).alias("x"))
    rows = rows.select("fp", F.col("x.m").alias("mask"), F.xxhash64("x.t", F.col("fp").bitwiseAND(F.col("x.m"))).alias("key"))
    found = None
    while True:
        free = F.bit_count(F.bitwise_not(F.col("mask")))
        heavy = stable(rows.filter((F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(SAMPLE)) == 0) & (free > 8))
                       .groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HEAVY).select("key"))
        light = rows.join(heavy, "key", "left_anti")
        edges = _bucket_edges(light, radius)
        found = edges if found is None else found.unionByName(edges)
        if heavy.isEmpty():
            return found
        rows = stable(_refined(rows.join(heavy, "key", "left_semi"), radius))


def _refined(rows: DataFrame, radius: int) -> DataFrame:
    """The members of large buckets under the tables over their free bits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, np.ndarray] = {}
        for b in batches:
            masks, which = np.unique(b["mask"].to_numpy(np.int64), return_inverse=True)
            for m in masks.tolist():
                if m not in tables:
                    free = [i for i in range(64) if not m >> i & 1]
                    tables[m] = np.array([x | m & (2 ** 64 - 1) for x in covering_masks(free, radius)], np.uint64)
            for lo in range(0, len(b), 4096):
                part = slice(lo, lo + 4096)
                x = np.stack([tables[m] for m in masks.tolist()])[which[part]]         # rows x tables
                fp = b["fp"].to_numpy(np.int64)[part]
                n = x.shape[1]
                yield pd.DataFrame({"fp": np.repeat(fp, n), "mask": x.ravel().view(np.int64),
                                    "key": np.repeat(b["key"].to_numpy()[part], n), "t": np.tile(np.arange(n, dtype=np.int32), len(fp)),
                                    "kept": (fp.view(np.uint64)[:, None] & x).ravel().view(np.int64)})

    return (rows.select("fp", "mask", "key").mapInPandas(run, "fp bigint, mask bigint, key bigint, t int, kept bigint")
            .select("fp", "mask", F.xxhash64("key", "t", "kept").alias("key")))


def _bucket_edges(rows: DataFrame, radius: int) -> DataFrame:
    buckets = rows.groupBy("key").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(0)
            off = col.offsets.to_numpy()
            flat = col.values.to_numpy().view(np.uint64)
            a, c = [], []
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                fps = np.sort(flat[lo:hi])
                if hi - lo == 2:
                    if int(fps[0] ^ fps[1]).bit_count() <= radius:
                        a.append(fps[0])
                        c.append(fps[1])
                    continue
                for i, found in _joined(fps, radius):
                    a.extend([fps[i]] * len(found))
                    c.extend(fps[found])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.uint64).view(np.int64)),
                                              pa.array(np.array(c, np.uint64).view(np.int64))], ["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def _classes(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root): every distinct fingerprint and its component's smallest."""
    fps = stable(rows.select("fp").distinct())
    roots = components(links(fps, radius))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: ``id_col, fingerprint`` (16 hex digits),
    ``component_id`` (the smallest id reachable over links)."""
    rows = stable(fingerprints(docs.select(id_col, text_col), text_col, "fp", shingle))
    classes = stable(_classes(rows, radius))
    lowest = rows.groupBy("fp").agg(F.min(id_col).alias("low"))                 # copies collapse here
    smallest = lowest.join(classes, "fp").groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(smallest, "root").select("fp", "component_id")
    return (rows.join(named, "fp")
            .select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the smallest id (null
    ids last), among equal ids the smallest text hash; of rows equal in both,
    one stays."""
    d_id, d_h = fresh("__id", docs), fresh("__h", docs)
    keyed = docs.withColumns({d_id: F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)),
                              d_h: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    rows = stable(fingerprints(keyed.select(d_id, d_h, text_col), text_col, "fp", shingle))
    place = F.struct(F.col(d_id).alias("id"), F.col(d_h).alias("h"))
    first = (rows.groupBy("fp").agg(F.min(place).alias("place")).join(_classes(rows, radius), "fp")
             .groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.id").alias(d_id), F.col("place.h").alias(d_h)))
    one = F.row_number().over(Window.partitionBy(d_id, d_h).orderBy(d_id))
    n = fresh("__n", docs)
    return (keyed.withColumn(n, one).filter(F.col(n) == 1).drop(n)
            .join(stable(first), [d_id, d_h], "left_semi").drop(d_id, d_h))

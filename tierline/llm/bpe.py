"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Encoding:

1. each task splits its texts by the tokenizer's pattern and packs about
   ``pack_chars`` characters of documents into one row: per document the
   positions as a list of numbers into the pack's distinct pre-tokens, and
   the pre-tokens themselves, dealt by a checksum into ``parts`` lists (so
   repeats inside a pack are counted together before anything is shuffled,
   and a list's words share their row's overhead and compression);
2. the lists are exploded and shuffled by part: every pre-token of the corpus
   meets its copies from other packs in one task and is encoded once;
3. the ids are gathered per pack (whose size is bounded), joined back, and
   each document is put together by its positions.

Packs are a table in the shared checkpoint folder, bucketed by pack number:
the join back does not shuffle the documents, and pack numbers stay what they
are when an executor is lost.  A frequent word is one entry per pack, and each
part has about as many words as any other.

Decoding is a map-side join with the token-byte table (one row per token, a
few hundred kB whatever the corpus): ids are looked up by position and the
bytes joined.

Defined results: null and empty texts have no ids and decode to no bytes;
repeated rows are encoded each; the other columns are kept.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import ddl_of, shuffle_partitions
from tierline.session import scratch_path

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """A rank file: one ``base64(token) rank`` per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encode_word(word: bytes, ranks: Ranks) -> list[int]:
    """The ids of one pre-token: the adjacent pair of least rank is merged,
    leftmost first, until no pair has a rank (heap and links: n log n)."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    if n <= 40:
        parts = [word[i:i + 1] for i in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]
    end = list(range(1, n + 1))                # part i is word[i:end[i]]
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != stop:           # one of the parts has changed since
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def _squeeze(x: np.ndarray) -> bytes:
    """Non-negative numbers below 2^32, compressed byte plane by byte plane."""
    import zstandard
    z = zstandard.ZstdCompressor(level=3).compress
    planes = [z((x >> np.uint32(8 * i)).astype(np.uint8).tobytes()) for i in range(4)]
    return np.array([len(x), *map(len, planes)], np.uint32).tobytes() + b"".join(planes)


def _loosen(raw: bytes) -> np.ndarray:
    import zstandard
    unpack = zstandard.ZstdDecompressor().decompress
    n, *sizes = np.frombuffer(raw[:20], np.uint32).tolist()
    out, at = np.zeros(n, np.uint32), 20
    for i, k in enumerate(sizes):
        out |= np.frombuffer(unpack(raw[at:at + k], max_output_size=n), np.uint8).astype(np.uint32) << np.uint32(8 * i)
        at += k
    return out


def _packs(docs: DataFrame, text_col: str, pattern: str, pack_chars: int, parts: int) -> DataFrame:
    """Packed documents: (rows, places, lengths, order, words)."""
    at = docs.columns.index(text_col)
    other = [n for n in docs.columns if n != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import zstandard
        find, z = regex.compile(pattern).findall, zstandard.ZstdCompressor(level=3).compress
        number: dict[str, int] = {}
        rows, positions, lengths, size = [], [], [], 0

        def pack():
            kept = pa.Table.from_batches(rows).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept.schema) as w:
                w.write_table(kept)
            words = [w.encode("utf-8", "surrogatepass") for w in number]
            places = np.concatenate(positions)
            # Frequent words get small numbers; ``order`` leads from the words
            # as dealt to these.
            rank = np.empty(len(words), np.uint32)
            rank[np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")] = np.arange(len(words))
            part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
            dealt = np.argsort(part, kind="stable")
            lists = []
            for some in np.split(dealt, np.flatnonzero(np.diff(part[dealt])) + 1) if len(words) else []:
                mine = [words[i] for i in some.tolist()]
                lists.append({"part": int(part[some[0]]), "sizes": _squeeze(np.array([len(w) for w in mine], np.uint32)),
                              "words": z(b"".join(mine))})
            return pa.RecordBatch.from_arrays(
                [pa.array([z(sink.getvalue().to_pybytes())], pa.binary()), pa.array([_squeeze(rank[places])], pa.binary()),
                 pa.array([_squeeze(np.array(lengths, np.uint32))], pa.binary()), pa.array([_squeeze(rank[dealt])], pa.binary()),
                 pa.array([lists], pa.list_(pa.struct([("part", pa.int32()), ("sizes", pa.binary()), ("words", pa.binary())])))],
                ["rows", "places", "lengths", "order", "lists"])

        for b in batches:
            rest = b.select(other)
            begun = 0
            for i, t in enumerate(b.column(at)):
                text = t.as_py() or ""
                tokens = find(text)
                positions.append(np.fromiter((number.setdefault(w, len(number)) for w in tokens), np.uint32, len(tokens)))
                lengths.append(len(tokens))
                size += len(text)
                if size >= pack_chars:
                    rows.append(rest.slice(begun, i + 1 - begun))
                    yield pack()
                    begun = i + 1
                    number, rows, positions, lengths, size = {}, [], [], [], 0
            if begun < b.num_rows:
                rows.append(rest.slice(begun))
        if lengths:
            yield pack()

    return docs.mapInArrow(run, "rows binary, places binary, lengths binary, order binary, "
                                "lists array<struct<part: int, sizes: binary, words: binary>>")


def _bucketed(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by ``key``.  Only the
    files stay: the catalog's entry is dropped once the table is resolved."""
    spark = df.sparkSession
    path = scratch_path(spark, "packs")
    name = path.rpartition("/")[2].replace("-", "_")
    df.write.format("parquet").option("path", path).option("compression", "uncompressed").bucketBy(n, key).saveAsTable(name)
    out = spark.table(name)
    out.schema
    spark.sql(f"DROP TABLE {name}")
    return out


def encode(docs: DataFrame, ranks: Ranks, pattern: str, text_col: str = "text", ids_col: str = "ids",
           pack_chars: int = 4_000_000, parts: int | None = None) -> DataFrame:
    """``docs`` without the text, with ``ids_col``: array<int>."""
    docs = docs.drop(ids_col)
    spark = docs.sparkSession
    parts = parts or shuffle_partitions(spark)
    table = spark.sparkContext.broadcast(ranks)         # the vocabulary: bounded, not by the corpus
    packs = _bucketed(_packs(docs, text_col, pattern, pack_chars, parts).withColumn("pack", F.monotonically_increasing_id()),
                      "pack", parts)
    lists = (packs.select("pack", F.explode("lists").alias("x")).select("pack", "x.*")
             .repartition(parts, "part").sortWithinPartitions("part"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        known, coded, now = table.value, {}, None
        for b in batches:
            sizes, flat = [], []
            for part, n, words in zip(*(b.column(b.schema.names.index(c)) for c in ("part", "sizes", "words")), strict=True):
                if part != now:
                    coded, now = {}, part                # a part's words: each is encoded once
                ends = np.cumsum(_loosen(n.as_py()))
                words = unpack(words.as_py())
                got = []
                for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    w = words[lo:hi]
                    ids = coded.get(w)
                    if ids is None:
                        ids = coded[w] = encode_word(w, known)
                    got.append(ids)
                sizes.append(_squeeze(np.array([len(x) for x in got], np.uint32)))
                flat.append(_squeeze(np.fromiter(itertools.chain.from_iterable(got), np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.names.index("pack")), b.column(b.schema.names.index("part")),
                 pa.array(sizes, pa.binary()), pa.array(flat, pa.binary())], ["pack", "part", "sizes", "ids"])

    back = (lists.mapInArrow(each, "pack bigint, part int, sizes binary, ids binary").groupBy("pack")
            .agg(F.sort_array(F.collect_list(F.struct("part", "sizes", "ids"))).alias("coded")))
    whole = packs.select("pack", "rows", "places", "lengths", "order").join(back, "pack", "left").select(
        "rows", "places", "lengths", "order", F.col("coded.sizes").alias("sizes"), F.col("coded.ids").alias("ids"))
    rest = [f for f in docs.schema.fields if f.name != text_col]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for i in range(b.num_rows):
                packed, places, lengths, order, sizes, ids = (b.column(k)[i].as_py() for k in range(6))
                with pa.ipc.open_stream(unpack(packed)) as r:
                    kept = r.read_all()
                size = np.concatenate([_loosen(x) for x in sizes or []] or [np.zeros(0, np.uint32)]).astype(np.int64)
                flat = np.concatenate([_loosen(x) for x in ids or []] or [np.zeros(0, np.uint32)])
                order = _loosen(order)
                start = np.empty(len(order), np.int64)
                start[order] = np.cumsum(size) - size    # by the numbers that the places use
                by_rank = np.empty(len(order), np.int64)
                by_rank[order] = size
                places = _loosen(places)
                ends = np.concatenate([[0], np.cumsum(_loosen(lengths).astype(np.int64))])
                step = 500                               # documents at a time
                for lo in range(0, len(ends) - 1, step):
                    hi = min(lo + step, len(ends) - 1)
                    p = places[ends[lo]:ends[hi]]
                    n = by_rank[p]
                    token_ends = np.concatenate([[0], np.cumsum(n)])
                    src = np.repeat(start[p] - token_ends[:-1], n) + np.arange(token_ends[-1])
                    offsets = token_ends[ends[lo:hi + 1] - ends[lo]]
                    out = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat[src].astype(np.int32)))
                    cols = [c.combine_chunks() for c in kept.slice(lo, hi - lo).columns]
                    yield pa.RecordBatch.from_arrays([*cols, out], [*kept.column_names, ids_col])

    return whole.mapInArrow(build, ", ".join([*filter(None, [ddl_of(rest)]), f"`{ids_col}` array<int>"]))


def decode(coded: DataFrame, ranks: Ranks, ids_col: str = "ids", out: str = "decoded", digest: bool = False) -> DataFrame:
    """``coded`` with ``out``: the bytes of the ids.  With ``digest`` the ids
    give way to ``n_tokens`` and ``ids_sha256`` (ids as little-endian 32-bit)."""
    size = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    for t, r in ranks.items():
        size[r] = len(t)
    tokens = b"".join(t for t, _ in sorted(ranks.items(), key=lambda x: x[1]))
    table = coded.sparkSession.sparkContext.broadcast((tokens, size))
    made = {out: "binary"} | ({"n_tokens": "bigint", "ids_sha256": "string"} if digest else {})
    rest = [f for f in coded.schema.fields if f.name not in made and not (digest and f.name == ids_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        flat, size = table.value
        flat, start = np.frombuffer(flat, np.uint8), np.cumsum(size) - size
        for b in batches:
            col = b.column(b.schema.get_field_index(ids_col))
            off = col.offsets.to_numpy().astype(np.int64)
            ids = col.values.to_numpy()
            texts, shas = [], []
            for lo, hi in itertools.pairwise(off.tolist()):
                x = ids[lo:hi]
                n = size[x]
                ends = np.cumsum(n)
                texts.append(flat[np.repeat(start[x] - (ends - n), n) + np.arange(ends[-1] if len(x) else 0)].tobytes())
                if digest:
                    shas.append(hashlib.sha256(x.astype("<u4").tobytes()).hexdigest())
            new = [pa.array(texts, pa.binary())] + ([pa.array(np.diff(off)), pa.array(shas, pa.string())] if digest else [])
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in rest), *new],
                                             [*(f.name for f in rest), *made])

    ddl = ", ".join([*filter(None, [ddl_of(rest)]), *(f"`{c}` {k}" for c, k in made.items())])
    return coded.mapInArrow(run, ddl)

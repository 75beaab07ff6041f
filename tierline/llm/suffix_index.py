"""Removal of repeated byte strings with a logarithmic family of suffix indexes.

A byte goes if it lies in a string of ``min_match`` (W) bytes that also starts
at another place of the corpus (same document included).  Strings are judged
on the input; matches never cross documents.

Sparse suffix arrays.  In every W-byte string one place is chosen by content:
of its first D places (D = 16/25 W) the one whose 32-byte word has the
smallest hash.  Equal strings choose the same place, so only suffixes at
chosen places are indexed (about 2/D of all), each for the run of consecutive
strings that choose it.  A suffix is ordered by the fingerprint of the
``core``, its first W - D + 1 bytes, which all strings of its run contain, and
then of the whole run's bytes, its ``context``: any order that keeps equal
prefixes adjacent finds the same matches, and fingerprints keep the entries
at 24 bytes where 400-byte suffixes would be shuffled otherwise.

The index family (``SuffixIndex``) holds sorted levels.  A new batch of
documents gets its suffix array, which is merge-scanned by core against every
level there is: a core that stands in both, or twice in the batch, is a long
match.  Then two levels of equal size are merged into one of twice the size, so
every entry is merged log2(batches) times.  Only the suffixes of matched cores
are looked at again:

* a context that occurs twice settles its run: all its strings repeat;
* a core that occurs twice with different contexts is resolved exactly: the
  members of the core's group, one row per context, compare the fingerprints
  of their strings at equal distance from the chosen place.
  A context that occurs often is reduced to one of its places first, map-side
  and then by context, so that a group is as large as its contexts are many,
  whatever the number of tasks;
* groups with over ``WIDE`` contexts do the same as one row per string and a
  count per (core, distance, string), combined map-side, so that no group is
  ever gathered whole.

Strings count as equal when two independent 64-bit fingerprints agree (core
and context, or core and string).

Shuffles: entries once per level they come to and chosen places once (numbers
only), whole documents once,
compressed (the plan's second use of them reuses the exchange), and the bytes
around chosen places whose core repeats in different contexts.

Defined results: null text has no bytes; documents equal in id and text are
copies of each other and lose what they share; a cut may split a character,
so the kept bytes are a binary column.  Null ids are ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import ddl_of, drop_written, packed, shuffle_partitions, stable
from tierline.session import scratch_path

#: Bytes that are hashed at a time, and so what a Python worker holds (about 20 MB).
WORD, CHUNK = 32, 1 << 18
#: Entries counted, and rows passed on, at a time.
ENTRIES, ROWS = 1 << 16, 1000
#: Contexts of one core that a task may gather: about 10 MB.
WIDE = 20_000
NO_ID = -(1 << 63)
_CACHE: dict[str, tuple] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _tables(n: int) -> tuple:
    """Two byte tables and the powers of two odd bases and of their inverses."""
    if "t" not in _CACHE or len(_CACHE["t"][1]) < n:
        rng = np.random.default_rng(12345)
        size = CHUNK + (1 << 13)
        size = size if n <= size else 1 << (n - 1).bit_length()
        out = []
        for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
            for b in (base, pow(base, -1, 1 << 64)):
                p, k = np.ones(size, np.uint64), 1
                while k < size:
                    m = min(k, size - k)
                    p[k:k + m] = p[:m] * np.uint64(pow(b, k, 1 << 64))
                    k += m
                out.append(p)
            out.append(byte)
        _CACHE["t"] = tuple(out)
    return _CACHE["t"]


def prefix_hashes(data: np.ndarray, which: int) -> np.ndarray:
    power, _, byte = _tables(len(data) + 1)[3 * which:3 * which + 3]
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * power[:len(data)], out=h[1:])
    return h


def span_hash(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, which: int) -> np.ndarray:
    """The hash of data[lo:hi], wherever it stands."""
    return (h[hi] - h[lo]) * _tables(len(h))[3 * which + 1][lo]


def chosen_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, window: int) -> tuple:
    """For documents data[starts:ends]: (core, context, place, first, last)
    of every chosen place; first..last are the starts of its strings."""
    n, none = len(data), np.zeros(0, np.int64)
    ok = ends - starts >= width
    if not ok.any():
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    a, b = prefix_hashes(data, 0), prefix_hashes(data, 1)
    word = np.arange(n - WORD + 1)
    key = _mix(span_hash(b, word, word + WORD, 1)) & np.uint64(0xFFFFFFFF00000000) | word.astype(np.uint64)
    low, span = key, 1
    while span * 2 <= window:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    if span < window:
        low = np.minimum(low[:len(low) - (window - span)], low[window - span:])
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts[ok], 1)
    np.add.at(edge, ends[ok] - width + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:n]) > 0)
    place = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)]))
    first, last, place = at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])], place[new]
    core = _mix(span_hash(b, place, place + width - window + 1, 1))
    context = _mix(span_hash(a, first, last + width, 0) + _mix((place - first).astype(np.uint64) * np.uint64(1 << 20)
                                                               + (last - first).astype(np.uint64)))
    return core, context, place, first, last


def _pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Cuts a batch's byte offsets into stretches of about ``CHUNK`` bytes:
    (from, to, document, start, end).  A longer document is cut into stretches
    of string starts, which overlap by width - 1 bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        if j == i + 1 and hi - lo > CHUNK:
            for a in range(lo, hi, CHUNK):
                b = min(hi, a + CHUNK + width - 1)
                yield a, b, np.array([i]), np.array([0]), np.array([b - a])
        else:
            yield lo, hi, np.arange(i, j), offsets[i:j] - lo, offsets[i + 1:j + 1] - lo
        i = j


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that only a part of it is unpacked at a time."""
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _counted(core: np.ndarray, context: np.ndarray) -> pa.RecordBatch:
    """Each (core, context) once, with its count: what a batch repeats is
    combined before it is shuffled."""
    order = np.lexsort((context, core))
    core, context = core[order], context[order]
    new = np.flatnonzero(np.concatenate([[True], (core[1:] != core[:-1]) | (context[1:] != context[:-1])])) if len(core) else np.zeros(0, np.int64)
    n = np.diff(np.append(new, len(core)))
    return pa.RecordBatch.from_arrays([pa.array(core[new]), pa.array(context[new]), pa.array(n)], ["core", "context", "n"])


def suffixes(docs: DataFrame, text_col: str, width: int, window: int, places: bool) -> DataFrame:
    """(k_id, k_h, text) -> ``core, context`` and ``n``, their number in the
    batch; or with ``places`` each place's ``k_id, k_h, pos``: start of the first
    string, the number of further ones and the chosen place's distance, packed
    into one number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            if texts.null_count:
                texts = texts.fill_null("")
            texts = texts.cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            ids, hashes = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("k_id", "k_h"))
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi, doc, starts, ends in _pieces(offsets, width):
                core, context, place, first, last = chosen_places(data[lo:hi], starts, ends, width, window)
                core, context = core.view(np.int64), context.view(np.int64)
                if not places:
                    waiting.append((core, context))
                    if sum(len(c) for c, _ in waiting) >= ENTRIES:
                        yield _counted(*map(np.concatenate, zip(*waiting, strict=True)))
                        waiting = []
                    continue
                d = np.searchsorted(starts, first, side="right") - 1
                begin = first + lo - offsets[doc[d]]
                pos = begin << 24 | (last - first) << 12 | (place - first)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (core, context, ids[doc[d]], hashes[doc[d]], pos)],
                                                 ["core", "context", "k_id", "k_h", "pos"])
            if waiting:
                yield _counted(*map(np.concatenate, zip(*waiting, strict=True)))

    ddl = "core bigint, context bigint, " + ("k_id bigint, k_h bigint, pos bigint" if places else "n bigint")
    return docs.select("k_id", "k_h", text_col).mapInArrow(run, ddl)


class SuffixIndex:
    """A logarithmic family of sorted suffix levels: (core, context, n).

    Each level is a table in the shared folder, bucketed by core and sorted by
    (core, context): the scans of a batch against the levels, and all counting by
    core, join and group the files as they lie, without a shuffle."""

    def __init__(self, buckets: int = 16) -> None:
        self.buckets = buckets
        self.levels: list[tuple[int, DataFrame]] = []         # (batches in it, entries)
        self.paths: list[str] = []                            # of the levels' files
        self.matches: list[DataFrame] = []                    # per batch: its matched cores

    def _level(self, entries: DataFrame) -> tuple[DataFrame, str]:
        spark = entries.sparkSession
        path = scratch_path(spark, "suffixes")
        name = path.rpartition("/")[2].replace("-", "_")
        whole = entries.repartition(self.buckets, "core").groupBy("core", "context").agg(F.sum("n").alias("n"))
        (whole.write.format("parquet").option("path", path).bucketBy(self.buckets, "core").sortBy("core", "context").saveAsTable(name))
        out = spark.table(name)
        out.schema                                            # resolved: the catalog's entry can go
        spark.sql(f"DROP TABLE {name}")
        return out, path

    def add(self, batch: DataFrame) -> DataFrame:
        """Indexes a batch of suffixes (core, context, n) and returns the cores
        that it holds twice or shares with earlier batches."""
        level, path = self._level(batch)
        cores = level.groupBy("core").agg(F.sum("n").alias("n"))
        found = cores.filter("n > 1").select("core")
        for _, older in self.levels:
            found = found.unionByName(cores.select("core").join(older.select("core"), "core", "left_semi"))
        found = stable(found.distinct())
        self.matches.append(found)
        size = 1
        while self.levels and self.levels[-1][0] == size:
            merged, at = self._level(self.levels.pop()[1].unionByName(level))
            for p in (self.paths.pop(), path):
                drop_written(batch.sparkSession, p)
            level, path, size = merged, at, size * 2
        self.levels.append((size, level))
        self.paths.append(path)
        return found

    def repeats(self) -> DataFrame:
        """(core, context, status) of the matched cores: 0 all of the core's
        places have this one context (twice or more); 1 the context repeats, the
        core has others too; 2 the context stands once, the core more often.
        From 4 on: the same, in a group of over ``WIDE`` contexts."""
        matched = self.matches[0]
        for m in self.matches[1:]:
            matched = matched.unionByName(m)
        matched = stable(matched.distinct())
        entries = None
        for _, e in self.levels:
            e = e.join(matched, "core", "left_semi")
            entries = e if entries is None else entries.unionByName(e)
        entries = stable(entries.groupBy("core", "context").agg(F.sum("n").alias("n")))
        cores = entries.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
        status = (F.when(F.col("kinds") == 1, 0).when(F.col("n") > 1, 1).otherwise(2)
                  + F.when(F.col("kinds") > WIDE, 4).otherwise(0))
        return entries.join(cores, "core").select("core", "context", status.alias("status"))

    def drop(self) -> None:
        """Deletes the levels' files."""
        for (_, level), path in zip(self.levels, self.paths, strict=True):
            drop_written(level.sparkSession, path)
        self.levels, self.paths = [], []


def _runs(marked: DataFrame, text_col: str, width: int, window: int, wide: bool) -> DataFrame:
    """Documents with their marked places -> rows to compare.  Narrow groups:
    (core, context, k_id, k_h, pos, status, around: the bytes of the run); wide ones:
    (core, string, k_id, k_h, at) per string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        sent: set[tuple[int, int]] = set()
        for b in (part for whole in batches for part in _slices(whole)):
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            rows: list[tuple] = []
            for i, marks in enumerate(col["marks"]):
                if not marks.is_valid:
                    continue
                m = np.unique(marks.values.to_numpy())
                m = m[(m & 3 > 0) & ((m & 4 > 0) == wide)]
                if not len(m):
                    continue
                data = np.frombuffer(unpack(col[text_col][i].as_py()), np.uint8)
                key = col["k_id"][i].as_py(), col["k_h"][i].as_py()
                pos, status = m >> 3, m & 3
                first, extra, dist = pos >> 24, pos >> 12 & 4095, pos & 4095
                h = prefix_hashes(data, 1)
                g = prefix_hashes(data, 0)
                core = _mix(span_hash(h, first + dist, first + dist + width - window + 1, 1)).view(np.int64)
                whole = span_hash(g, first, first + extra + width, 0).view(np.int64)
                for j in range(len(m)):
                    if status[j] == 1:                  # copies of a context: one is enough
                        one = int(core[j]), int(whole[j])
                        if one in sent:
                            continue
                        if len(sent) > 100_000:
                            sent.clear()
                        sent.add(one)
                    lo, n = int(first[j]), int(extra[j])
                    if wide:
                        at = np.arange(lo, lo + n + 1)
                        s = span_hash(g, at, at + width, 0) + _mix((lo + int(dist[j]) - at).astype(np.uint64))
                        rows.extend((int(core[j]), x, *key, int(y)) for x, y in zip(_mix(s).view(np.int64).tolist(), at.tolist(), strict=True))
                    else:
                        rows.append((int(core[j]), int(whole[j]), *key, int(pos[j]), int(status[j]), pack(data[lo:lo + n + width].tobytes())))
            names = ["core", "string", "k_id", "k_h", "at"] if wide else ["core", "context", "k_id", "k_h", "pos", "status", "around"]
            kinds = [pa.int64()] * 5 if wide else [pa.int64()] * 5 + [pa.int32(), pa.binary()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return marked.mapInArrow(run, "core bigint, string bigint, k_id bigint, k_h bigint, at bigint" if wide else
                             "core bigint, context bigint, k_id bigint, k_h bigint, pos bigint, status int, around binary")


def members(runs: DataFrame) -> DataFrame:
    """(core, members): the places to compare, one per context.  Copies of a
    context (one per task by now) are reduced to one row by core and context
    before any list is made."""
    row = F.struct("k_id", "k_h", "pos", "status", "around")
    one = runs.groupBy("core", "context").agg(F.min_by(row, F.struct("k_id", "k_h", "pos")).alias("m"))
    return one.groupBy("core").agg(F.collect_list("m").alias("members"))


def _resolved(groups: DataFrame, width: int) -> DataFrame:
    """Groups of one core's members -> (k_id, k_h, lo, hi): repeated bytes of
    the members whose context stands once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            owner = np.repeat(b.column(0).to_numpy(), sizes)
            ids, hashes, pos, status = (flat.field(k).to_numpy() for k in range(4))
            out = [[], [], [], []]
            step, few = 2000, max(1, CHUNK // (3 * width))   # members at a time: in all, and to hash
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            lo = 0
            while lo < len(sizes):                       # whole groups, about so many members
                hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + step, side="right")) - 1)
                w = slice(int(cuts[lo]), int(cuts[hi]))
                p = pos[w]
                n = (p >> 12 & 4095) + 1                  # strings of each member
                member = np.repeat(np.arange(len(p)), n)
                k = np.arange(len(member)) - np.repeat(np.cumsum(n) - n, n)
                code = np.empty(len(member), np.uint64)
                upto = np.concatenate([[0], np.cumsum(n)])
                for i in range(0, len(p), few):
                    j = min(i + few, len(p))
                    around = [unpack(x.as_py()) for x in flat.field(4)[w.start + i:w.start + j]]
                    ends = np.cumsum([len(x) for x in around])
                    begin = ends - np.array([len(x) for x in around])
                    h = prefix_hashes(np.frombuffer(b"".join(around), np.uint8), 0)
                    some = slice(int(upto[i]), int(upto[j]))
                    at = begin[member[some] - i] + k[some]
                    code[some] = span_hash(h, at, at + width, 0)
                distance = ((p & 4095)[member] - k).astype(np.int64).astype(np.uint64)
                code = _mix(code + _mix(distance * np.uint64(0x9E3779B97F4A7C15) + owner[w][member].view(np.uint64)))
                _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
                keep = np.flatnonzero((count[inverse] > 1) & (status[w][member] == 2))
                if len(keep):
                    start = np.flatnonzero(np.concatenate([[True], (np.diff(member[keep]) != 0) | (np.diff(k[keep]) != 1)]))
                    stop = np.concatenate([start[1:] - 1, [len(keep) - 1]])
                    m = member[keep[start]]
                    base = p[m] >> 24
                    for c, x in zip(out, (ids[w][m], hashes[w][m], base + k[keep[start]], base + k[keep[stop]] + width), strict=True):
                        c.append(x)
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out],
                                             ["k_id", "k_h", "lo", "hi"])

    return groups.mapInArrow(run, "k_id bigint, k_h bigint, lo bigint, hi bigint")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_match: int = 400,
                   batches: int = 3, kept_col: str = "kept") -> DataFrame:
    """``docs`` without the text, with ``kept_col`` (binary: the remaining
    bytes), ``n_bytes, n_removed, n_spans``.  ``batches``: the documents enter
    the index in so many batches (by a hash of id and text)."""
    width, window = min_match, max(1, min_match * 16 // 25)
    if not WORD + 8 <= width <= 4000:
        raise ValueError("min_match must be from 40 to 4000")
    window = min(window, width - WORD + 1)
    text = F.coalesce(F.col(text_col), F.lit(""))
    made = (kept_col, "n_bytes", "n_removed", "n_spans")
    rest = [f"`{c}`" for c in docs.columns if c != text_col and c not in made]
    # The other columns travel as one, so that no name of theirs can clash.
    keyed = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("k_id"),
                        F.xxhash64(text).alias("k_h"), F.col(text_col).alias("text"))
    index = SuffixIndex(shuffle_partitions(docs.sparkSession))
    for i in range(batches):
        part = keyed.filter(F.pmod(F.xxhash64("k_id", "k_h"), F.lit(batches)) == i) if batches > 1 else keyed
        index.add(suffixes(part, "text", width, window, places=False))
    repeats = stable(index.repeats())
    index.drop()
    found = (suffixes(keyed, "text", width, window, places=True).join(repeats, ["core", "context"])
             .select("k_id", "k_h", (F.shiftleft("pos", 3).bitwiseOR(F.col("status").cast("bigint"))).alias("mark")))
    marks = stable(found.groupBy("k_id", "k_h").agg(F.collect_list("mark").alias("marks")))
    marked = packed(keyed, "text").join(marks, ["k_id", "k_h"], "left")

    groups = members(_runs(marked, "text", width, window, wide=False))
    strings = _runs(marked, "text", width, window, wide=True)
    again = strings.groupBy("core", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core", "string")
    spans = _resolved(groups, width).unionByName(
        strings.join(again, ["core", "string"]).select("k_id", "k_h", F.col("at").alias("lo"), (F.col("at") + width).alias("hi")))
    spans = spans.groupBy("k_id", "k_h").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    whole = marked.join(spans, ["k_id", "k_h"], "left")
    row = keyed.schema["row"]

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for b in (part for batch in rows for part in _slices(batch)):
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            kept, counts = [], []
            for z, marks, more in zip(col["text"], col["marks"], col["spans"], strict=True):
                data = unpack(z.as_py())
                lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if marks.is_valid:
                    m = marks.values.to_numpy()
                    m = m[m & 3 < 2] >> 3                # settled by their context
                    lo, hi = m >> 24, (m >> 24) + (m >> 12 & 4095) + width
                if more.is_valid:
                    lo = np.concatenate([lo, more.values.field(0).to_numpy()])
                    hi = np.concatenate([hi, more.values.field(1).to_numpy()])
                if len(lo):
                    depth = np.zeros(len(data) + 1, np.int64)
                    np.add.at(depth, lo, 1)
                    np.add.at(depth, hi, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                    counts.append((len(data), int(gone.sum()), runs))
                else:
                    kept.append(data)
                    counts.append((len(data), 0, 0))
            yield pa.RecordBatch.from_arrays(
                [col["row"], pa.array(kept, pa.binary()), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3))],
                ["row", *made])

    out = whole.mapInArrow(cut, ddl_of([row]) + f", `{kept_col}` binary, n_bytes bigint, n_removed bigint, n_spans bigint")
    return out.select("row.*", *made)

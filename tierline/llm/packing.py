"""Variable-capacity best-fit packing of documents into sequences.

A document of n words has n + 1 places (its words and an end mark); one
longer than the largest permitted length is cut into pieces of that length
and a rest.  Pieces are packed by decreasing length, each into the fullest
open bin it fits.  Where none fits, the bin size with the least cost per
place that can be filled is opened (counting equal pieces and the shorter
ones still to come); the whole plan is made once per allowed largest opening
size and the cheapest plan is taken, so the permitted lengths are chosen
jointly.  At the end every bin shrinks to the smallest permitted length that
holds its contents.

Best fit treats pieces of one length alike, so the plan is made on the
histogram of lengths: at most ``max(sizes)`` numbers on the driver, and a plan
whose rows are bounded by the sizes too, whatever the number of documents.
Bins are handled as runs of equal bins.  The pieces find their places by
their rank among the pieces of their length: pieces are range-partitioned by
(length, unique number), so that even one length with a third of all rows is
spread, numbered inside their range, and offset by a table of one row per
range and length.

Defined results: null and empty texts take one place (the end mark); repeated
rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import ddl_of, stable

SIZES = (512, 1024, 2048, 4096, 8192)
#: Places that opening a sequence costs besides its length.
OVERHEAD = 64


def default_cost(size: int) -> float:
    return size + OVERHEAD


@dataclass
class Run:
    """``n`` equal bins from number ``start`` on: the places still free, and
    the pieces as (length, first rank, pieces per bin, offset in the bin)."""
    start: int
    n: int
    size: int
    free: int
    pieces: list[tuple[int, int, int, int]] = field(default_factory=list)

    def cut(self, n: int) -> Run:
        """The bins after the first ``n``, as a run of their own."""
        rest = Run(self.start + n, self.n - n, self.size, self.free,
                   [(ln, rank + n * q, q, off) for ln, rank, q, off in self.pieces])
        self.n = n
        return rest


def _plan(counts: dict[int, int], sizes: Sequence[int], cost: Callable[[int], float], largest: int) -> list[Run]:
    lengths = sorted(counts, reverse=True)
    free: dict[int, list[Run]] = {}
    order: list[int] = []
    done: list[Run] = []
    bins = 0
    short = np.zeros(max(sizes) + 1)                 # places of all pieces of at most this length, still to come
    for ln, c in counts.items():
        short[ln] += ln * c
    short = np.cumsum(short)
    gone = 0.0

    def keep(run: Run) -> None:
        if run.free == 0:
            done.append(run)
        elif run.n:
            if run.free not in free:
                free[run.free] = []
                insort(order, run.free)
            free[run.free].append(run)

    def take(room: int) -> Run:
        runs = free[room]
        run = runs.pop()
        if not runs:
            del free[room]
            order.pop(bisect_left(order, room))
        return run

    for ln in lengths:
        left, rank = counts[ln], 0
        while left:
            i = bisect_left(order, ln)
            if i < len(order):
                run = take(order[i])
            else:
                allowed = [s for s in sizes if s >= ln and (s <= largest or s == min(x for x in sizes if x >= ln))]

                def unit(s: int) -> float:
                    q = min(left, s // ln)
                    n = -(-left // q)
                    rest = s - q * ln
                    more = short[min(rest, ln - 1)] if rest else 0.0
                    return cost(s) / (q * ln + min(rest, more / n))

                size = min(allowed, key=lambda s: (unit(s), s))
                run = Run(bins, -(-left // (size // ln)), size, size)
                bins += run.n
            q = min(run.free // ln, left)
            full = min(run.n, left // q)
            if full < run.n:
                keep(run.cut(full))
            run.pieces.append((ln, rank, q, run.size - run.free))
            run.free -= q * ln
            keep(run)
            left -= full * q
            rank += full * q
    return done + [r for runs in free.values() for r in runs]


def plan_bins(counts: dict[int, int], sizes: Sequence[int] = SIZES, cost: Callable[[int], float] = default_cost) -> pd.DataFrame:
    """The cheapest plan as rows ``length, rank, count, bin, per_bin, offset,
    size``: ranks [rank, rank + count) of a length go into bins from ``bin``
    on, ``per_bin`` each, from ``offset`` on; ``size`` is the downsized bin."""
    sizes = sorted(sizes)

    def final(run: Run) -> int:
        return next(s for s in sizes if s >= run.size - run.free)

    plans = [_plan(counts, sizes, cost, m) for m in sizes]
    best = min(plans, key=lambda runs: sum(r.n * cost(final(r)) for r in runs))
    rows = [(ln, rank, r.n * q, r.start, q, off, final(r)) for r in best for ln, rank, q, off in r.pieces]
    out = pd.DataFrame(rows, columns=["length", "rank", "count", "bin", "per_bin", "offset", "size"], dtype="int64")
    return out.sort_values(["length", "rank"], ignore_index=True)


def pieces_of(docs: DataFrame, id_col: str, text_col: str, largest: int) -> DataFrame:
    """One row per piece: ``id_col, piece, first_place, n_places``."""
    places = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint") + 1
    n = F.col("__places")
    return (docs.select(F.col(id_col), places.alias("__places"))
            .select(id_col, "__places", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / largest))).alias("piece"))
            .select(id_col, F.col("piece").cast("int").alias("piece"), (F.col("piece") * largest).alias("first_place"),
                    F.least(n - F.col("piece") * largest, F.lit(largest).cast("bigint")).alias("n_places")))


def _numbered(items: DataFrame) -> DataFrame:
    """``items`` with ``rank`` among those of the same ``n_places``."""
    ranged = (items.repartitionByRange("n_places", "uid").sortWithinPartitions("n_places", "uid")
              .withColumn("part", F.spark_partition_id()))
    cols = ranged.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, seen = None, 0
        for b in batches:
            if not len(b):
                continue
            x = b["n_places"].to_numpy()
            at = b.groupby("n_places").cumcount().to_numpy()
            if x[0] == last:
                at = at + np.where(x == last, seen, 0)
            last, seen = x[-1], int(at[-1]) + 1
            yield b.assign(at=at)[[*cols, "at"]]

    local = stable(ranged.mapInPandas(run, ddl_of(ranged.schema.fields) + ", at bigint"))
    sizes = local.groupBy("part", "n_places").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("n_places").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("part", "n_places", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return local.join(first, ["part", "n_places"]).withColumn("rank", F.col("first") + F.col("at")).drop("part", "first", "at")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: Sequence[int] = SIZES,
         cost: Callable[[int], float] = default_cost) -> DataFrame:
    """One row per piece: ``id_col, piece, first_place, n_places, bin_id,
    bin_size, bin_offset``."""
    items = stable(pieces_of(docs, id_col, text_col, max(sizes)).withColumn("uid", F.monotonically_increasing_id()))
    counts = {r["n_places"]: r["n"] for r in items.groupBy("n_places").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_bins(counts, sizes, cost)
    ranked = _numbered(items)
    code = plan["length"].to_numpy() * (1 << 48) + plan["rank"].to_numpy()
    rank, start, per, off, size = (plan[c].to_numpy() for c in ("rank", "bin", "per_bin", "offset", "size"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, r = b["n_places"].to_numpy(), b["rank"].to_numpy()
            i = np.searchsorted(code, n * (1 << 48) + r, side="right") - 1
            k = r - rank[i]
            yield pd.concat([b[[id_col, "piece", "first_place", "n_places"]].reset_index(drop=True), pd.DataFrame({
                "bin_id": start[i] + k // per[i], "bin_size": size[i], "bin_offset": off[i] + k % per[i] * n})], axis=1)

    kept = [f for f in ranked.schema.fields if f.name in (id_col, "piece", "first_place", "n_places")]
    kept.sort(key=lambda f: (id_col, "piece", "first_place", "n_places").index(f.name))
    return ranked.mapInPandas(place, ddl_of(kept) + ", bin_id bigint, bin_size bigint, bin_offset bigint")

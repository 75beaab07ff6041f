"""Aggregates that grow by increments: stored mergeable partial states.

A ``Partial`` says how a grouped result splits into parts that merge: sums,
counts, least and greatest values, sketches, and exact distinct counts.  Each
load appends, under its own load id,

* one state row per key it touches (the measures over its own rows);
* per distinct count, the (key, value) pairs that no other load has stored yet,
  and their number per key, which adds up like any other count.

So a load reads its own rows and the stored pairs, never the rows of earlier
loads, and the result is the states merged by key.  A load id that is run again
replaces its own partition and nothing else, so a retry doubles nothing.  (A
retry must hold the same rows; loads into one store run one after another.)

``fold`` merges the stored loads into one base state, so that the number of
state rows does not grow with the number of loads; with ``as_table`` the base of
the pairs is bucketed by pair, and a later load joins it without shuffling it.
The base names the loads it holds and is swapped in as a whole; only then are
they deleted, so a fold that is cut short neither loses nor doubles a load.

Pairs are compared by their text (every part cast losslessly to a string, a
null part left out), so null keys are keys; null values are not counted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.functions.keys import key_text
from tierline.sinks.replace import drop_partition, replace_bucketed
from tierline.sinks.writers import stored_schema, write_table

LOAD, PAIR, FOLDED = "_load", "_pair", "_folded"

#: How the values of one measure merge.
MERGES: dict[str, Callable[[str], Column]] = {
    "sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_union_agg,
}


@dataclass(frozen=True)
class Partial:
    """``measures``: name -> (kind of merge, aggregate over input rows);
    ``distinct``: name of a count -> the column whose values it counts;
    ``finish``: merged measures and counts by key -> the result."""

    keys: Mapping[str, Column]
    measures: Mapping[str, tuple[str, Column]]
    finish: Callable[[DataFrame], DataFrame]
    distinct: Mapping[str, str] = field(default_factory=dict)


def state_of(rows: DataFrame, p: Partial) -> DataFrame:
    """The partial state of ``rows``: keys and measures."""
    return (rows.groupBy(*[c.alias(k) for k, c in p.keys.items()])
            .agg(*[c.alias(n) for n, (_, c) in p.measures.items()]))


def merged(states: DataFrame, p: Partial) -> DataFrame:
    """State rows of any number of loads -> one row per key."""
    counts = [F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in p.distinct]
    return states.groupBy(*p.keys).agg(*[MERGES[kind](n).alias(n) for n, (kind, _) in p.measures.items()], *counts)


def pairs_of(rows: DataFrame, p: Partial, name: str) -> DataFrame:
    """The distinct (keys, value) pairs of one count, with their text."""
    value = p.distinct[name]
    text = key_text([F.col(c) for c in (*p.keys, "__v")])
    return (rows.filter(F.col(value).isNotNull())
            .select(*[c.alias(k) for k, c in p.keys.items()], F.col(value).alias("__v")).distinct()
            .select(*p.keys, text.alias(PAIR)))


class Store:
    """Where the states and pairs of one product lie: folders below a path, or
    with ``as_table`` catalog tables ``<name>_state``, ``<name>_<count>`` and
    the folded ``<name>_state_base`` and ``<name>_<count>_base``."""

    def __init__(self, spark: SparkSession, dest: str, as_table: bool = False, buckets: int = 64) -> None:
        self.spark, self.dest, self.as_table, self.buckets = spark, dest.rstrip("/"), as_table, buckets

    def name(self, what: str) -> str:
        return f"{self.dest}_{what}" if self.as_table else f"{self.dest}/{what}"

    def read(self, what: str) -> DataFrame | None:
        at = self.name(what)
        schema = stored_schema(self.spark, at, as_table=self.as_table)
        if schema is None or self.as_table:
            return None if schema is None else self.spark.table(at)
        if LOAD in schema.names:                # as written: a load id "2001" is no number
            schema = StructType([f for f in schema.fields if f.name != LOAD]).add(LOAD, "string")
        return self.spark.read.schema(schema).parquet(at)

    def put(self, what: str, df: DataFrame, load: str) -> None:
        """Writes one load's partition, replacing an earlier run of it."""
        there = stored_schema(self.spark, self.name(what), as_table=self.as_table) is not None
        write_table(df.withColumn(LOAD, F.lit(load)), self.name(what), partition_by=[LOAD], dynamic_overwrite=there,
                    as_table=self.as_table, count_rows=False)

    def put_base(self, what: str, df: DataFrame, bucket_by: str | None = None) -> None:
        if self.as_table and bucket_by:
            replace_bucketed(df, self.name(what), self.buckets, [bucket_by])
        else:
            write_table(df, self.name(what), as_table=self.as_table, count_rows=False)

    def loads(self) -> list[str]:
        """The loads that are stored on their own."""
        state = self.read("state")
        return [] if state is None else sorted(r[0] for r in state.select(LOAD).distinct().collect())

    def folded(self) -> list[str]:
        """The loads that the base holds but that may still be stored, too."""
        base = self.read("state_base")
        row = base.select(FOLDED).first() if base is not None else None
        return list(row[0]) if row else []


def apply_load(rows: DataFrame, p: Partial, store: Store, load: str) -> None:
    """Adds the rows of load ``load`` to the stored state."""
    if load in store.folded():
        raise ValueError(f"load {load!r} is folded and cannot be run again")
    state = state_of(rows, p)
    for n in p.distinct:
        pairs = pairs_of(rows, p, n)
        stored, base = store.read(n), store.read(f"{n}_base")
        if stored is not None:
            pairs = pairs.join(stored.filter(F.col(LOAD) != load).select(PAIR), PAIR, "left_anti")
        if base is not None:
            pairs = pairs.join(base.select(PAIR), PAIR, "left_anti")
        store.put(n, pairs, load)
        fresh = store.read(n).filter(F.col(LOAD) == load)
        state = state.unionByName(fresh.groupBy(*p.keys).agg(F.count(F.lit(1)).alias(n)), allowMissingColumns=True)
    store.put("state", state, load)


def states(p: Partial, store: Store) -> DataFrame:
    """The state rows of the base and of the loads it does not hold."""
    base, loads = store.read("state_base"), store.read("state")
    if loads is not None:
        loads = loads.filter(~F.col(LOAD).isin(store.folded())).drop(LOAD)
    if base is None:
        return loads
    base = base.drop(FOLDED)
    return base if loads is None else base.unionByName(loads, allowMissingColumns=True)


def current(p: Partial, store: Store) -> DataFrame:
    """The result over all loads stored so far."""
    return p.finish(merged(states(p, store), p))


def fold(p: Partial, store: Store) -> None:
    """Merges all stored loads into the base.  A load cannot be run again after
    that."""
    loads = store.loads()
    for n in p.distinct:
        pairs, base = store.read(n), store.read(f"{n}_base")
        if pairs is not None:
            whole = pairs.select(PAIR) if base is None else pairs.select(PAIR).unionByName(base.select(PAIR)).distinct()
            store.put_base(f"{n}_base", whole, bucket_by=PAIR)
    store.put_base("state_base", merged(states(p, store), p).withColumn(FOLDED, F.array(*[F.lit(x) for x in loads]).cast("array<string>")))
    for what in ["state", *p.distinct]:
        for load in loads:
            drop_partition(store.spark, store.name(what), LOAD, load, store.as_table)

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import checkpoint_root, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stable(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared checkpoint folder: later stages
    read the files, so a lost executor never makes them recompute it with
    another row order or partitioning."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, read again, and its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` has made and nobody reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_or_empty(col="text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def doc_key(id_col="doc_id", text_col="text") -> Column:
    """Identity of a document row: its id and a hash of its text.  Rows equal
    in both are the same document to every operator that says so."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("h"))


def ddl_of(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def packed(df: DataFrame, text_col: str, level: int = 1) -> DataFrame:
    """``df`` with the text as zstd-compressed UTF-8 (null: empty): about 0.4
    of the bytes, where Spark's own block compression leaves 0.9 in a shuffle
    of whole texts."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        pack = zstandard.ZstdCompressor(level=level).compress
        for b in batches:
            cols = b.columns
            cols[at] = pa.array([pack((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in cols[at]], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    ddl = ", ".join(f"`{f.name}` {'binary' if f.name == text_col else f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, ddl)


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

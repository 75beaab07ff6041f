"""Replacing a stored table without a moment of loss.

The new rows are first written whole to a fresh location; a task or driver
that fails until then leaves the table as it was.  Only then is the table
pointed at them:

* catalog tables: ``ALTER TABLE ... SET LOCATION``, and for partitioned ones
  ``ALTER TABLE ... PARTITION ... SET LOCATION`` (or ``ADD PARTITION``) one
  partition after the other, stale partitions last.  Every partition is the old
  one or the new one at any time; a driver lost in between leaves some of each,
  and the same call again finishes.  The location that was replaced stays until
  the next replacement, so that running readers of it finish.
* paths: the old directory is renamed away, the new one renamed to its place,
  then the old one deleted; a failed second rename is undone.  A path has no
  catalog entry to swap, so a reader that lists it between the two renames finds
  nothing: use catalog tables where readers run beside loads.

As the old files stay until the swap, the new rows may be computed from the
table itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Write = Callable[[str], dict]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _staged(spark: SparkSession, location: str, write: Write) -> dict:
    try:
        return write(location)
    except BaseException:
        _delete(spark, location)
        raise


def _swap(spark: SparkSession, new: str, at: str, aside: str) -> None:
    """Directory ``new`` takes the place of ``at``."""
    (fs, source), (_, place), (_, old) = _fs(spark, new), _fs(spark, at), _fs(spark, aside)
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"cannot move {at} away")
    fs.mkdirs(place.getParent())
    if not fs.rename(source, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"cannot move {new} to {at}")
    if had:
        fs.delete(old, True)


def replace_path(spark: SparkSession, dest: str, write: Write, partition_by: Sequence[str] = (),
                 partitions_only: bool = False) -> dict:
    """``write(location)`` fills a fresh directory, which then replaces
    ``dest``, or with ``partitions_only`` the partitions that it holds."""
    dest = dest.rstrip("/")
    parent, _, name = dest.rpartition("/")
    tag = uuid.uuid4().hex[:12]
    staged = f"{parent}/_{name}.staged-{tag}"
    stats = _staged(spark, staged, write)
    if partitions_only:
        for spec in _directories(spark, staged, len(partition_by)):
            # Names with a leading underscore are no data to any reader.
            _swap(spark, f"{staged}/{spec}", f"{dest}/{spec}", f"{dest}/_replaced-{tag}-{spec.replace('/', '-')}")
        _delete(spark, staged)
    else:
        _swap(spark, staged, dest, f"{parent}/_{name}.replaced-{tag}")
    spark.catalog.refreshByPath(dest)
    return stats


def _directories(spark: SparkSession, root: str, depth: int) -> list[str]:
    """The partition directories ``depth`` levels below ``root``, relative to it."""
    fs, p = _fs(spark, root)
    found = [""]
    for _ in range(depth):
        found = [f"{d}{s.getPath().getName()}/" for d in found for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(p, d) if d else p)
                 if s.isDirectory() and "=" in s.getPath().getName()]
    return sorted(d.rstrip("/") for d in found)


# -- catalog tables -----------------------------------------------------------------

def _literal(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _database(spark: SparkSession, table: str) -> tuple[str, str]:
    db, _, name = table.replace("`", "").rpartition(".")
    db = db or spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(db).locationUri.rstrip("/"), name


def columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _known(spark: SparkSession, table: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _spec_of(name: str) -> str:
    """``a=1/b=x`` as a partition spec (the catalog casts the values)."""
    pairs = [part.partition("=")[::2] for part in name.split("/")]
    return ", ".join(f"`{c}` = " + ("null" if v == "__HIVE_DEFAULT_PARTITION__" else _literal(unquote(v))) for c, v in pairs)


def replace_table(spark: SparkSession, table: str, schema: StructType, write: Write, partition_by: Sequence[str] = (),
                  partitions_only: bool = False) -> dict:
    """``write(location)`` fills a fresh location with rows of ``schema``, to
    which the catalog table (or with ``partitions_only`` those of its partitions
    that the location holds) is then pointed.  A table that does not exist is
    created on the location."""
    base, name = _database(spark, table)
    location = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    stats = _staged(spark, location, write)
    parts = list(partition_by)
    if not spark.catalog.tableExists(table):
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {table} ({columns_ddl(schema)}) USING parquet{by} LOCATION {_literal(location)}")
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    elif not parts:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(location)}")
    else:
        known = _known(spark, table)
        new = _directories(spark, location, len(parts))
        for part in new:
            spec, where = _spec_of(part), _literal(f"{location}/{part}")
            if part in known:
                spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {where}")
            else:
                spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION {where}")
        if not partitions_only:
            for part in sorted(known - set(new)):
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec_of(part)})")
    spark.catalog.refreshTable(table)
    _drop_unused(spark, table, base, name, location)
    return stats


def replace_bucketed(df: DataFrame, table: str, buckets: int, columns: Sequence[str]) -> None:
    """``df`` as the bucketed catalog table ``table``, one sorted file per
    bucket: written as a table of its own, whose location ``table`` then takes."""
    spark = df.sparkSession
    base, name = _database(spark, table)
    tag = uuid.uuid4().hex[:12]
    location, staged = f"{base}/{name}-{tag}", f"{table}__{tag}"
    _staged(spark, location, lambda at: (df.repartition(buckets, *columns).write.format("parquet").bucketBy(buckets, *columns)
                                         .sortBy(*columns).option("path", at).saveAsTable(staged)) or {})
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(location)}")
        spark.sql(f"DROP TABLE {staged}")
    else:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    _drop_unused(spark, table, base, name, location)


def drop_partition(spark: SparkSession, dest: str, column: str, value: str, as_table: bool = False) -> None:
    """Takes one partition of a string column out of a stored table."""
    if as_table:
        spark.sql(f"ALTER TABLE {dest} DROP IF EXISTS PARTITION (`{column}` = {_literal(value)})")
        spark.catalog.refreshTable(dest)
    else:
        for spec in _directories(spark, dest, 1):
            if unquote(spec) == f"{column}={value}":
                _delete(spark, f"{dest}/{spec}")
        spark.catalog.refreshByPath(dest)


def drop_directory(spark: SparkSession, path: str) -> None:
    """Deletes one directory of files that no reader needs any more."""
    _delete(spark, path)


def _drop_unused(spark: SparkSession, table: str, base: str, name: str, newest: str) -> None:
    """Deletes the table's replaced locations, but for the last one."""
    fs, p = _fs(spark, base)
    path, uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    used = {path(uri(f)).toString() for f in spark.table(table).inputFiles()}
    unused = []
    for s in fs.listStatus(p):
        here = s.getPath().toString()
        tag = s.getPath().getName().removeprefix(f"{name}-")
        ours = len(tag) == 12 and tag != s.getPath().getName() and all(c in "0123456789abcdef" for c in tag)
        if s.isDirectory() and ours and not here.endswith("/" + newest.rpartition("/")[2]) and not any(f.startswith(here + "/") for f in used):
            unused.append((s.getModificationTime(), here))
    for _, here in sorted(unused)[:-1]:
        _delete(spark, here)


def table_columns(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``df`` with the partition columns last, as catalog tables have them."""
    return df.select(*[c for c in df.columns if c not in parts], *parts)

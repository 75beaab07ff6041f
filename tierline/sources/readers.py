"""Batch readers for the raw (bronze) layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Reader options per format, merged over the common ones.
COMMON_OPTIONS = {"mergeSchema": "true"}
FORMAT_OPTIONS = {
    "csv": {"header": "true", "inferSchema": "true", "sep": ",", "nullValue": ""},
    "json": {"multiLine": "true", "primitivesAsString": "true"},
    "parquet": {},
}

CORRUPT = "_corrupt_record"
#: A line that holds this sequence of control characters is an error.
NO_SEPARATOR = "\x01\x1f\x01"


def read_options(fmt: str, **overrides) -> dict:
    """Common options, then the format's own, then the caller's."""
    opts = {**COMMON_OPTIONS, **FORMAT_OPTIONS.get(fmt, {})}
    opts.update({k: (str(v).lower() if isinstance(v, bool) else str(v)) for k, v in overrides.items()})
    return opts


def read_source(spark: SparkSession, path, fmt: str = "csv", schema: StructType | str | None = None,
                **opts) -> DataFrame:
    """Read files of any format with the per-format defaults.

    Prefer an explicit ``schema`` at scale: ``inferSchema`` costs a full
    extra pass over CSV input.
    """
    o = read_options(fmt, **opts)
    reader = spark.read.format(fmt).options(**o)
    if schema is not None:
        reader = reader.schema(schema)
        o.pop("inferSchema", None)
    return reader.load(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = True) -> DataFrame:
    """Read a stored table by path, with the columns of all its files."""
    return spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower()).load(path)


def _parsed_lines(spark: SparkSession, root: str, fmt: str, schema: StructType, opts: dict) -> DataFrame:
    """Line files parsed against ``schema``: a struct ``r`` (with the corrupt
    record's text) and the partition columns.

    The file readers parse only the columns a query needs, so what counts as
    a bad row there depends on the projection.  Here every line is parsed
    whole, by one expression over the text source.
    """
    glob = opts.pop("pathGlobFilter")
    header = opts.pop("header", "false") == "true"
    for k in ("inferSchema", "mergeSchema"):
        opts.pop(k, None)
    if opts.pop("multiLine", "false") == "true":
        raise ValueError("bad_rows needs one record per line (multiLine=false)")
    if fmt == "csv" and header:
        # Spark's CSV reader drops each file's first line, and only that; with a
        # separator that no line has, what is left of a line is the line.
        lines = (spark.read.schema("value string").option("pathGlobFilter", glob)
                 .options(header=True, sep=NO_SEPARATOR, quote="", mode="FAILFAST").csv(root))
    else:
        lines = spark.read.option("pathGlobFilter", glob).text(root)
    parts = [c for c in lines.columns if c != "value"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + f", `{CORRUPT}` string"
    opts = {**opts, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parse = {"csv": F.from_csv, "json": F.from_json}[fmt]
    return lines.filter(F.length("value") > 0).select(parse("value", ddl, opts).alias("r"), *parts)


def read_landing(spark: SparkSession, root: str, glob: str = "*.csv", fmt: str = "csv",
                 schema: StructType | str | None = None, bad_rows: str | None = None, **opts):
    """Read a landing area: every file under ``root`` whose name matches
    ``glob`` (``k=v`` directories become partition columns).

    ``bad_rows`` (CSV and JSON files with one record per line):
      * ``None``         keep Spark's default (permissive) parsing
      * ``"drop"``       drop rows that do not fit ``schema`` (wrong type, too short)
      * ``"quarantine"`` return ``(good, bad)``: good rows without the
        corrupt-record column, and bad rows as ``_corrupt_record`` text plus
        whatever fields did parse, and the partition columns.

    Which rows are bad does not depend on the columns selected later; nothing
    is copied.  Needs ``schema``.  JSON is read with ``multiLine=true`` by
    default, one file per task: pass ``multiLine=False`` for line files.
    """
    o = {"pathGlobFilter": glob, **opts}
    if bad_rows is None:
        return read_source(spark, root, fmt, schema, **o)
    if bad_rows not in ("drop", "quarantine"):
        raise ValueError(f"bad_rows must be None, 'drop' or 'quarantine', not {bad_rows!r}")
    if fmt not in ("csv", "json"):
        raise ValueError(f"bad_rows is for csv and json, not {fmt}")
    if schema is None:
        raise ValueError(f"bad_rows={bad_rows!r} needs an explicit schema")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if fmt == "json":
        o.setdefault("multiLine", False)
    parsed = _parsed_lines(spark, root, fmt, schema, read_options(fmt, **o))
    parts = [c for c in parsed.columns if c != "r"]
    fields = [F.col("r")[f.name].alias(f.name) for f in schema.fields]
    good = parsed.filter(F.col("r")[CORRUPT].isNull()).select(*fields, *parts)
    if bad_rows == "drop":
        return good
    bad = parsed.filter(F.col("r")[CORRUPT].isNotNull()).select(F.col("r")[CORRUPT].alias(CORRUPT), *fields, *parts)
    return good, bad

"""Line deduplication by content-defined chunks of lines (SQL functions only).

A document is cut into chunks of whole lines.  The rolling hash of a line is the
polynomial ``(before * BASE + line) mod PRIME`` over the hashes of the last two
lines; a chunk ends where it is below ``PRIME / divisor`` (and the line before
was no such place, so that a chunk has two lines at least, but for the tail of
a document).  Equal passages are cut alike wherever they stand.  Where lines
repeat with period one or two (a line equals the last but one), every hash is
the same, and the stretch is cut into pairs from its first line on instead.

A chunk of two or more lines that hold a character other than white space is
removed if the same bytes stand at an earlier place (smaller doc_id, then chunk
number).

Bytes are compared by grouping the chunk texts themselves; the 64-bit hash
that leads back from a group to its occurrences is used only if exactly one
text has it (else the chunk stays).

A passage goes as far as whole chunks of it do: of a short one the cuts at its
ends may fall outside, and it stays (see the README for the share).

Shuffles: chunk texts once (combined map-side, so copies move once per
task), occurrences without text once, whole documents once for the rebuild.

``dedup_passages`` takes every place as a boundary: every two neighbouring full
lines, with the blank ones between them, are a window, and a window that stands
at an earlier place goes.  So a repeated passage of two or more full lines goes
whole wherever it stands, and the first place of every line stays.  With a
``divisor`` the repeated chunks of the rolling hash go, and the windows follow
as an exact check of what the cuts miss; both are found on the input, and the
text is rebuilt once.

Defined results: a null text has no lines and stays null; an empty text is
one empty line and stays.  Null doc_ids count as the last ids.  Rows that are
equal in doc_id and text are treated alike.  Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import doc_key, fresh

LAST_ID = 9223372036854775807
PRIME, BASE = (1 << 31) - 1, 1_000_003_579


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated
    once (an array column named in a lambda may be inlined by the optimizer
    and then evaluated for every element)."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def with_chunks(docs: DataFrame, text_col: str, divisor: int, out: str, starts: bool = False) -> DataFrame:
    """Adds ``out``: array<struct<text, lines, full>>, the chunks in text
    order; ``full`` counts the lines with a character other than white space.
    ``starts``: with ``start``, the number of the first line."""
    start = "'start', if(j = 0, 0, cuts[j - 1] + 1), " if starts else ""
    line = "slice(ls, if(j = 0, 1, cuts[j - 1] + 2), if(j = 0, c + 1, c - cuts[j - 1]))"
    chunk = _let(line, "part", f"""named_struct({start}'text', array_join(part, '\n'), 'lines', size(part),
                                  'full', size(filter(part, s -> s rlike '\\\\S')))""")
    # Stretches of period one or two: a cut before each and after every second line.
    first = "filter(sequence(0, size(again) - 1), i -> again[i] and not again[i - 1])"
    last = "filter(sequence(0, size(again) - 1), i -> again[i] and not coalesce(get(again, i + 1), false))"
    pairs = _let(first, "a", _let(last, "z", "flatten(transform(a, (s, k) -> sequence(s - 1, z[k], 2)))"))
    plain = "filter(sequence(0, size(raw) - 1), i -> raw[i] and not raw[i - 1] and not again[i])"
    ends = f"array_sort(array_distinct(concat({plain}, {pairs}, array(size(raw) - 1))))"
    cuts = _let(ends, "cuts", f"transform(cuts, (c, j) -> {chunk})")
    again = _let("transform(h, (x, i) -> i > 1 and x = h[i - 2])", "again", cuts)
    rolling = f"(h[i - 1] % {PRIME}) * {BASE} + x"
    raw = _let(f"transform(h, (x, i) -> i > 0 and ({rolling}) % {PRIME} < {PRIME // int(divisor)})", "raw", again)
    h = _let("transform(ls, s -> cast(conv(substring(md5(s), 1, 8), 16, 10) as bigint))", "h", raw)
    whole = _let(f"split(`{text_col}`, '\n', -1)", "ls", h)
    return docs.withColumn(out, F.when(F.col(text_col).isNotNull(), F.expr(whole)))


def later_chunks(chunked: DataFrame, id_col: str, key: str, chunks: str, place, *more: str) -> DataFrame:
    """(key, no, more): the chunks to remove.  ``place``: by which the first of
    equal chunks is told, of the columns ``id``, ``key`` and ``no``; ``more``:
    further fields of the chunks."""
    rows = (chunked.select(F.col(key), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"),
                           F.posexplode(chunks).alias("no", "c"))
            .filter(F.col("c.full") >= 2)
            .select(key, "no", *[F.col(f"c.{f}").alias(f) for f in more], F.xxhash64("c.text").alias("hash"),
                    F.col("c.text").alias("text"), place.alias("place")))
    texts = rows.groupBy("hash", "text").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    repeated = (texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"),
                                          F.min("first").alias("first"))
                .filter((F.col("texts") == 1) & (F.col("n") > 1)).select("hash", "first"))
    return (rows.select(key, "no", *more, "hash", "place").join(repeated, "hash")
            .filter(F.col("place") > F.col("first")).select(key, "no", *more))


def repeated_chunks(chunked: DataFrame, id_col: str, key: str, chunks: str) -> DataFrame:
    """(key, gone): the numbers of the chunks to remove, per document."""
    # id and chunk number as one number, in their order
    place = (F.col("id").cast("decimal(20,0)") * F.lit(10 ** 10).cast("decimal(11,0)") + F.col("no")).cast("decimal(38,0)")
    return later_chunks(chunked, id_col, key, chunks, place).groupBy(key).agg(F.collect_set("no").alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = 3) -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and the columns
    ``n_chunks, n_removed, removed_lines``."""
    key, other, chunks, gone = (fresh(c, docs) for c in ("__key", "__other", "__chunks", "__gone"))
    chunked = with_chunks(docs.withColumn(key, doc_key(id_col, text_col)), text_col, divisor, chunks)
    cut = repeated_chunks(chunked, id_col, key, chunks).withColumnRenamed(key, other).withColumnRenamed("gone", gone)
    j = chunked.join(cut, F.col(key).eqNullSafe(F.col(other)), "left").drop(other, key)
    is_gone = f"coalesce(array_contains({gone}, i), false)"
    kept = F.expr(f"array_join(transform(filter({chunks}, (c, i) -> not {is_gone}), c -> c.text), '\n')")
    lost = F.expr(f"aggregate(filter({chunks}, (c, i) -> {is_gone}), 0, (a, c) -> a + c.lines)")
    return (j.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept))
            .withColumn("n_chunks", F.coalesce(F.size(chunks), F.lit(0)))
            .withColumn("n_removed", F.coalesce(F.size(gone), F.lit(0)))
            .withColumn("removed_lines", F.coalesce(lost, F.lit(0)))
            .drop(chunks, gone))


def line_windows(docs: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """(key, id, h, no, digest): one row per two neighbouring full lines of a
    document, with the 128-bit MD5 of their bytes and of what is between."""
    digest = """transform(sequence(0, size(at) - 2), k ->
                    unhex(md5(array_join(slice(ls, at[k] + 1, at[k + 1] - at[k] + 1), '\n'))))"""
    digests = _let(_full("ls"), "at", f"if(size(at) < 2, array(), {digest})")
    return (docs.filter(F.col(text_col).isNotNull())
            .select(F.col(key), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.col(f"{key}.h").alias("h"),
                    F.posexplode(F.expr(_let(f"split(`{text_col}`, '\n', -1)", "ls", digests))).alias("no", "digest")))


def _full(ls: str) -> str:
    """SQL for the places of the lines with a character other than white space."""
    return f"filter(sequence(0, size({ls}) - 1), i -> {ls}[i] rlike '\\\\S')"


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int | None = None) -> DataFrame:
    """``docs`` without the windows of two full lines that stand at an earlier
    place (smaller id, text hash, window number), and the column
    ``removed_lines``.  Of a window that overlaps its first place (a run of one
    line) the second line goes, so that the first place stays whole.
    ``divisor``: without the chunks (see ``with_chunks``) that stand at an
    earlier place, too.

    Shuffles: digests and places twice, whole documents once for the rebuild;
    with ``divisor`` chunk texts and occurrences as ``dedup_lines`` does.
    """
    key, other, cut, left, chunks = (fresh(c, docs) for c in ("__key", "__other", "__cut", "__left", "__chunks"))
    keyed = docs.withColumn(key, doc_key(id_col, text_col))
    rows = line_windows(keyed, id_col, text_col, key)
    place = F.struct("id", "h", "no")
    repeated = (rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                .filter("n > 1").select("digest", "first"))
    overlaps = (F.col("first.id") == F.col("id")) & (F.col("first.h") == F.col("h")) & (F.col("first.no") == F.col("no") - 1)
    span = "struct<start:int,lines:int>"
    marks = (rows.join(repeated, "digest").filter(place > F.col("first"))
             .select(F.col(key).alias(other), (F.col("no") * 2 + overlaps.cast("int")).alias("window"), F.lit(None).cast(span).alias("chunk")))
    if divisor:
        chunked = with_chunks(keyed, text_col, divisor, chunks, starts=True)
        # in the windows' order, so that of any line a place stays
        later = later_chunks(chunked, id_col, key, chunks, F.struct("id", F.col(f"{key}.h").alias("h"), "no"), "start", "lines")
        marks = marks.unionByName(later.select(F.col(key).alias(other), F.lit(None).cast("int").alias("window"), F.struct("start", "lines").alias("chunk")))
    marks = marks.groupBy(other).agg(F.struct(F.sort_array(F.collect_set("window")).alias("windows"), F.collect_set("chunk").alias("chunks")).alias(cut))
    # f[k]: 0 for a window that goes, 1 for one that overlaps its first place, else -1 or null
    flags = f"""flatten(transform({cut}.windows, (c, j) -> concat(
                    array_repeat(-1, int(c div 2 - if(j = 0, 0, {cut}.windows[j - 1] div 2 + 1))), array(c % 2))))"""
    # the numbers of the lines that stay
    part = """concat(if(coalesce(get(f, k - 1), -1) >= 0 or coalesce(get(f, k), -1) = 0, array(), slice(ns, at[k] + 1, 1)),
                     if(coalesce(get(f, k), -1) >= 0, array(), slice(ns, at[k] + 2, coalesce(get(at, k + 1), size(ns)) - at[k] - 1)))"""
    kept = f"concat(slice(ns, 1, at[0]), flatten(transform(sequence(0, size(at) - 1), k -> {part})))"
    in_chunks = f"flatten(transform({cut}.chunks, c -> sequence(c.start, c.start + c.lines - 1)))"
    lines = f"split(`{text_col}`, '\n', -1)"
    stay = f"transform(array_except({kept}, {in_chunks}), i -> ls[i])"
    rebuilt = _let(lines, "ls", _let(_full("ls"), "at", _let("sequence(0, size(ls) - 1)", "ns", _let(flags, "f", stay))))
    j = keyed.join(marks, F.col(key).eqNullSafe(F.col(other)), "left").drop(other, key)
    is_cut = F.col(cut).isNotNull()
    return (j.withColumn(left, F.when(is_cut, F.expr(rebuilt)))
            .withColumn("removed_lines", F.when(is_cut, F.size(F.expr(lines)) - F.size(left)).otherwise(F.lit(0)))
            .withColumn(text_col, F.when(is_cut, F.array_join(left, "\n")).otherwise(F.col(text_col)))
            .drop(cut, left))

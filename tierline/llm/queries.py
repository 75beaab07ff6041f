"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import bpe, langid, license_scan, sql
from tierline.llm.common import drop_written, stable, table
from tierline.llm.line_chunks import dedup_lines
from tierline.llm.packing import pack
from tierline.llm.quality_rules import judge_quality
from tierline.llm.simhash import near_duplicates
from tierline.llm.suffix_index import remove_repeats
from tierline.llm.syncmer import compare_with_next
from tierline.llm.url_filter import judge_urls
from tierline.llm.vector_codes import compress, with_group_sum
from tierline.llm.warc import assemble, read_records, write_warc
from tierline.llm.whitening import fit_whitening, whiten
from tierline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.train(docs))
    known = F.expr("filter(licences, x -> x.family <> 'unknown')")
    return found.select("doc_id", "n_paragraphs", F.size(known).alias("n_confirmed"),
                        (F.size("licences") - F.size(known)).alias("n_unknown"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform(known, lambda x: x["family"]))), ",").alias("families"),
                        F.array_max(F.transform("licences", lambda x: x["score"])).alias("top_score"))


@query("op3_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@query("op4_line_dedup", sql.LINE_DEDUP)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_chunks", "n_removed", "removed_lines",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op5_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"))
    return (langid.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "typical"))


@query("op6_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return (bpe.decode(coded, ranks, digest=True)
            .select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")))


@query("op7_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


#: The fixed rules of the URL query: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op9_url_filter", sql.url_filter())
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@query("op10_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), min_match=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


@query("op11_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors, scale=256, check=4)
    explained = F.array(*[F.lit(float(e)) for e in model.explained[:4]])
    out = whiten(vectors, model, k=4)
    return (out.select("vec_id", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("whitened").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                    (F.get(explained, F.col("i")) if model.n else F.lit(None).cast("double")).alias("explained"),
                    F.lit(model.identity_error).alias("identity_error")))


#: The capture time that the archives of the WARC query state.
WARC_DATE = "2024-01-01T00:00:00Z"


@query("op12_warc", sql.WARC)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path, date=WARC_DATE, min_revisit=100)
    records = stable(read_records(spark, path, payload=False))
    drop_written(spark, path)
    captures = assemble(records).select(
        F.col("metadata.fields")["page-id"].cast("bigint").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"))
    kept = captures.filter(F.col("record_type") == "response")
    first = kept.groupBy(F.col("payload_digest").alias("digest")).agg(F.min("page_id").alias("refers_to"))
    again = captures.filter(F.col("record_type") == "revisit").join(first, F.col("payload_digest") == F.col("digest"), "left").drop("digest")
    return kept.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(again)


@query("op13_vector_codes", sql.vector_codes(parts=8, entries=16, rounds=6, scale=4096, dims=64))
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"),
                            parts=8, entries=16, rounds=6, scale=4096)
    code = F.array_join(F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    return (with_group_sum(coded, "label", "error", "label_error")
            .select("vec_id", code.alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")))

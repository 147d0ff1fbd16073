"""The operators of this folder as queries over the sample tables: ``QUERIES[name](spark, sf_dir)``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import credentials, decontaminate, edit_embedding, langid, lm, ngram_join, nn_descent, packing, quality, ranked_search, suffixes, vector_codes, warc
from fleetlens.llm.common import crc, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

VOCABULARY, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(crc("doc_id", 5) != 0))
    found = quality.score(docs, model)
    return found.select(
        "doc_id", (crc("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan(table(spark, sf_dir, "documents"))
    spans = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("secrets", lambda x: ~x["linked"])
    number = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[number(kind) for kind in ("assign", "access", "hex")],
        F.sha2(spans(base), 256).alias("base_sha256"),
        spans(F.col("secrets")).alias("spans"),
    )


@query
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc("doc_id", 3) != 1))
    found = langid.predict(docs, model)
    return found.select("doc_id", (crc("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    index = warc.write(warc.with_originals(pages), warc.folder(spark))
    page = lambda c: F.regexp_extract(c, "<urn:page:(.*)>", 1)
    return warc.read(index).select(
        F.expr("try_cast(regexp_extract(record_id, '<urn:page:(.*)>', 1) AS long)").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").cast(kind).alias("refers_to"),
    )


@query
def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = "crc32(cast(cast(doc_id AS string) AS binary)) % 10"
    found = lm.score(table(spark, sf_dir, "documents"), f"{part} <> 0", f"{part} = 1", order=3)
    return found.select(
        "doc_id", (crc("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.tokenize(table(spark, sf_dir, "documents"), VOCABULARY, RANKS))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nn_descent.near(table(spark, sf_dir, "embeddings"), exact=True)
    own = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return found.select("vec_id", "n_links", "component_id", own.alias("kept"))


@query
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated(table(spark, sf_dir, "documents"))


@query
def op11_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edit_embedding.neighbours(table(spark, sf_dir, "documents"))
    text = edit_embedding.text_of
    return found.select(
        "doc_id", "n_chars", "edited_sha256", text("fingerprint").alias("fingerprint"),
        text("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.codes(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book.tolist() for x in entry).encode()).hexdigest()
    digits = F.transform("code", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0"))
    return vector_codes.with_label_errors(coded).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def oracle_sql() -> dict[str, str]:
    from fleetlens.llm.oracle import ORACLE

    return dict(ORACLE)

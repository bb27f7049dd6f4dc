"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    centroids,
    chat,
    embedding_dedup,
    filter_audit,
    mixing,
    ngram_join,
    packing,
    passages,
    pii,
    quality,
    secret_scan,
    token_counts,
    urls,
)
from .shared import keep

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query
def op1_quality_rules(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op2_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(pages, _table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op3_token_counts(spark, sf_dir):
    """Every document enters by words, moves to the byte vocabulary, and copies of a text leave.

    The moving batch is committed twice, as by a job that was run again.
    """
    docs = keep(token_counts.counted(_table(spark, sf_dir, "documents")))
    firsts = docs.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    copies = docs.join(firsts, "digest").where("doc_id > _first")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("load", token_counts.inserts(docs, token_counts.WORDS, "n_words"))
    for _ in range(2):
        rollup.commit("move", token_counts.revisions(docs, token_counts.WORDS, "n_words", token_counts.BYTES, "n_ids"))
    rollup.commit("copies", token_counts.deletes(copies, token_counts.BYTES, "n_ids"))
    return rollup.totals()


@query
def op4_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"))


@query
def op5_pii(spark, sf_dir):
    found = pii.spans(_table(spark, sf_dir, "documents"))
    added = F.transform("terms", lambda t: F.struct(t["start"], t["end"], F.lit("term").alias("kind")))
    order = F.transform(
        F.concat(F.col("base"), added),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(F.array(*map(F.lit, (*pii.KINDS, "term"))), s["kind"]).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return found.select(
        "doc_id",
        *[_count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(order)).alias("spans"),
    )


@query
def op6_packing(spark, sf_dir):
    cut = packing.pieces(_table(spark, sf_dir, "documents"))
    slim = keep(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packing.place(slim).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op7_ngram_join(spark, sf_dir):
    return ngram_join.join_components(_table(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op8_secret_scans(spark, sf_dir):
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id",
        *[_count(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


@query
def op9_chat_formatting(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(probe).alias("text"),
    )
    back = chat.read_back(chat.render(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op10_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op12_substring_dedup(spark, sf_dir):
    return passages.digests(_table(spark, sf_dir, "documents"))


@query
def op13_centroid_clustering(spark, sf_dir):
    found = centroids.cluster(_table(spark, sf_dir, "embeddings"), clusters=16, rounds=3, dimensions=64, scale=64)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

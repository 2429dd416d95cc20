"""The queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    exact_dedup,
    html_text,
    hyperminhash,
    line_dedup,
    maxscore,
    merkle,
    nbest,
    packing,
    quality,
    sharding,
    simhash,
    token_files,
    vector_codes,
)
from tideline.session import fresh_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SHARDS = 40
NEIGHBOURS = 5
GRADES = 3
SEGMENTATIONS = 3


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer=tokenizer())
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed")


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer=tokenizer())
    return token_files.read_token_files(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0, k=NEIGHBOURS)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.OrdinalModel:
    """Fitted on the labels: the grade is the number of criteria passed (good quality, not toxic)."""
    grades = quality.criteria_grades(table(spark, sf_dir, "labels"))
    return quality.fit_on(quality.labelled_sample(docs, grades), GRADES)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, quality_model(spark, docs, sf_dir))


@query
def op7_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    best = nbest.best_segmentations(table(spark, sf_dir, "documents"), model=model, n=SEGMENTATIONS, with_ids=False)
    return best.select("doc_id", "rank", "score", "n_ids", "ids_crc32", "round_trip")


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row a leaf; where 2 divides the checksum of the id, the text is claimed without its line feeds."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    claim = F.when(picked & F.contains("text", F.lit("\n")), merkle.leaf_digest(*[F.col(f) for f in fields[:-1]], tampered))
    made = merkle.manifest(
        table(spark, sf_dir, "documents"), fields, order="doc_id", group="source", claim=claim, with_proofs=False
    )
    return made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"),
    )

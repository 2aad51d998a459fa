"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnish.functions.storage import new_path
from tarnish.llm.alignment import align_tokens
from tarnish.llm.common import load, remainder
from tarnish.llm.decontaminate import find_leaks
from tarnish.llm.host_rules import HOST_RULES_SQL, host_rules
from tarnish.llm.language import FOLDS, HELD_OUT, predict_language, train_language
from tarnish.llm.lines import LINES_SQL, drop_repeated_lines
from tarnish.llm.packing import pack
from tarnish.llm.quality import held_out, score_quality, train_quality
from tarnish.llm.quotes import link_quotes
from tarnish.llm.repeats import remove_repeats
from tarnish.llm.secret_scan import BASE_KINDS, scan_secrets
from tarnish.llm.simhash import near_copies
from tarnish.llm.token_files import read_token_files, write_token_files
from tarnish.llm.turns import repair_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    manifest = write_token_files(load(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, folder, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_quality(docs, train_quality(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _listed(spans: Column) -> Column:
    spelled = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(spelled, ",")


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    counts = [F.size(_of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return scan_secrets(load(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(spans).alias("spans")
    )


@query
def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLES["op4_host_rules"] = HOST_RULES_SQL


@query
def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(load(spark, sf_dir, "documents"))
    # Spark's hex() leaves leading zeros out.
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = predict_language(docs, train_language(docs, public_tokenizers.path("piece_bpe_32k.model")))
    fold = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op9_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(load(spark, sf_dir, "conversations"))


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(load(spark, sf_dir, "conversations"))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align_tokens(load(spark, sf_dir, "documents"), a, b, groups="sha256")
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(load(spark, sf_dir, "documents"), min_docs=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op13_line_dedup"] = LINES_SQL

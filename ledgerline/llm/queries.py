"""The operators of this package as registered queries over the text tables.

``QUERIES`` and ``ORACLE_SQL`` are what ``__spark_entry__`` adds. Every query
reads its whole table, whole texts included; the operators keep their own
general results, the queries derive the digest columns from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import centroids as CE
from ledgerline.llm import chat_format as CF
from ledgerline.llm import decontaminate as DC
from ledgerline.llm import filter_audit as FA
from ledgerline.llm import licenses as LI
from ledgerline.llm import line_dedup as LD
from ledgerline.llm import mixing as MX
from ledgerline.llm import multiset_hash as MH
from ledgerline.llm import pu_quality as PU
from ledgerline.llm import quality_rules as QR
from ledgerline.llm import simhash as SH
from ledgerline.llm import url_filter as UF
from ledgerline.llm import warc as WA
from ledgerline.llm.oracle import ORACLE_SQL  # noqa: F401  (read by the entry module)
from ledgerline.llm.staging import stage


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DC.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"),
                    _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = UF.fit(UF.labelled_urls(spark))
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return UF.filter_urls(pages, model).select(
        "page_id", *[f"url_verdict.{c}" for c in ("host", "path", "rule", "verdict", "score")])


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = LI.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select(
        "doc_id", *[f"scanned.{c}" for c in ("n_words", "n_base", "first_word", "last_word")],
        F.concat_ws(",", "scanned.base_labels").alias("base_labels"),
        F.concat_ws(",", "scanned.labels").alias("labels"), "scanned.score")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = CF.plain_turns(_read(spark, sf_dir, "conversations"))
    return CF.format_calls(calls, results).select(
        "conv_id", "turn", "call_id", "name", "position", "status", "valid",
        F.concat_ws(",", "errors").alias("errors"), "json")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PU.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return QR.judge(docs, QR.fit(docs, _read(spark, sf_dir, "labels"))).select("doc_id", "judged.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return MX.mix(docs).select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = stage(WA.pack(_read(spark, sf_dir, "pages")), "archives")
    return WA.unpack(archives).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                      "refers_to", "error")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = SH.near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op11_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = MH.compare(_read(spark, sf_dir, "documents"))
    return compared.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", MH.as_text(F.col("lanes")).alias("fingerprint"),
        MH.as_text(F.col("edited_lanes")).alias("edited_fingerprint"), "near_edited", "near_next")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FA.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CE.cluster(_read(spark, sf_dir, "embeddings"), k=8, rounds=10, seed=3)[0]


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_line_dedup, op3_url_filter, op4_license_scan, op5_chat_format,
    op6_quality, op7_mixing, op8_quality_rules, op9_warc, op10_simhash,
    op11_multiset_hash, op12_filter_audit, op13_centroids)}

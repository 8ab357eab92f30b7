"""The queries of this subpackage: thin callers of its operators over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.llm import decontaminate, fingerprints, html_text, language_id, licenses, mixing, oracles, simhash_dedup, substring_dedup, suffix_dedup, warc
from strandflow.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("hamming")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", (language_id.remainder("doc_id") == 2).alias("held_out"), "lang_pred", "score", "agree")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.find_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_edits(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text("picked").alias("fingerprint"), fingerprints.as_text("edited_picked").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return warc.audit(warc.manifest(pages), warc.damaged(pages))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_source_mix": op3_source_mix,
    "op4_language_id": op4_language_id,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_winnowing": op7_winnowing,
    "op8_warc_fixity": op8_warc_fixity,
    "op9_html_text": op9_html_text,
    "op10_suffix_dedup": op10_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": licenses.sql(),
    "op2_decontaminate": oracles.DECONTAMINATE,
    "op3_source_mix": mixing.SQL,
    "op5_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op8_warc_fixity": warc.SQL,
    "op10_suffix_dedup": oracles.SUFFIX_DEDUP,
}

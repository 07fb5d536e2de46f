"""The thin queries over the corpus operators, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chosen_path, common, host_rules, line_index, packing, private_spans, repeats, sentence_pieces, telephony, url_tree, warc_bundles


#: Where the public tokenizers' files are; a parameter of the operators.
TOKENIZERS = os.environ.get("TALKMILL_TOKENIZERS", "/opt/tokenizers")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(common.text_bytes(), 256).alias("text_sha256"))
    ids = sentence_pieces.encode(docs, model, carry=("doc_id", "text_sha256"), back=True)
    decoded = F.sha2(F.col("text").cast("binary"), 256)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_xxhash64"), decoded.alias("decoded_sha256"), (decoded == F.col("text_sha256")).alias("round_trip"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op3_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans.find(common.table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*private_spans.BASE))
    named = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of_kind = lambda k: F.filter("spans", lambda x: x["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in private_spans.BASE]
    return found.select("doc_id", *counts, F.sha2(named(base).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op4_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    index = line_index.LineIndex(spark)
    index.insert(docs)
    return index.digests(docs)


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = chosen_path.near_duplicates(common.table(spark, sf_dir, "documents"), k=4, percent=80)
    return judged.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = warc_bundles.folder(spark)
    return warc_bundles.read(warc_bundles.write(common.table(spark, sf_dir, "pages"), where), where)


def op7_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.features(telephony.store(common.table(spark, sf_dir, "documents")))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(common.table(spark, sf_dir, "documents"))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(common.table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *host_rules.METRICS, F.col("failed_base").alias("base_failed"), "kept")


def op10_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_tree.judge(common.table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_sentence_pieces": op1_sentence_pieces, "op2_packing": op2_packing, "op3_private_spans": op3_private_spans, "op4_line_index": op4_line_index, "op5_chosen_path": op5_chosen_path, "op6_warc_bundles": op6_warc_bundles, "op7_telephony": op7_telephony, "op8_repeats": op8_repeats, "op9_host_rules": op9_host_rules, "op10_url_tree": op10_url_tree}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_index": line_index.oracle(), "op6_warc_bundles": warc_bundles.oracle(), "op9_host_rules": host_rules.oracle(), "op10_url_tree": url_tree.oracle()}

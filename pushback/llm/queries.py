"""Registered queries of the training-data operators: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.llm import (bpe, extract, lattice, ledger, licenses, packing, ppm, quality, runs, simhash, sketch, stages,
                          toxicity, whiten)
from pushback.llm.common import SPACE_CLASS, id_hash, table
from pushback.llm.oracle_sql import SQL as SQL  # noqa: PLC0414


def op1_ppm_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = ppm.score_documents(table(spark, sf, "documents"), train=id_hash("doc_id") % 7 != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "n_bytes")


def op2_simhash_neardup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op3_rule_ledger(spark: SparkSession, sf: str) -> DataFrame:
    rows = ledger.apply_policy(ledger.ledger(table(spark, sf, "documents"), keep=["doc_id"]))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~ledger.passes(ledger.BASE)).alias("base_failed"), "kept")


def op4_tag_path_extract(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract(table(spark, sf, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"),
                        F.char_length("main_text").cast("bigint").alias("n_chars"))


def op5_scaled_sketch(spark: SparkSession, sf: str) -> DataFrame:
    found = sketch.fingerprints(table(spark, sf, "documents"))
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join(own, "").alias("fingerprint"), F.array_join(edited, "").alias("edited_fingerprint"),
        sketch.likeness(own, edited).alias("near_edited"), sketch.likeness(own, after).alias("near_next"),
        sketch.containment(own, edited).alias("contained_edited"), sketch.containment(own, after).alias("contained_next"))


def op6_subword_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.trained(docs, table(spark, sf, "labels"), train=stages.quality_train())
    return quality.score_documents(docs, model).select(
        "doc_id", (id_hash("doc_id") % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_deobfuscated_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.trained(docs, table(spark, sf, "labels"), train=stages.toxicity_train())
    return toxicity.score_documents(docs, model).select(
        "doc_id", (id_hash("doc_id") % 4 == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files: source and language are their directories."""
    docs = table(spark, sf, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", "text", path.alias("path")), id_col="doc_id")


def op9_bfd_packing(spark: SparkSession, sf: str, path: str | None = None) -> DataFrame:
    cut = packing.pieces(table(spark, sf, "documents"),
                         path=path or public_tokenizers.path("byte_bpe_50k.json"))
    cut = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(cut, order=["doc_id", "start", "ids_crc32"])


def op10_bpe_roundtrip(spark: SparkSession, sf: str, path: str | None = None) -> DataFrame:
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(table(spark, sf, "documents"), path=path, pattern=public_tokenizers.PATTERN)
    back = bpe.decode(ids, path=path)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_lattice_neardup(spark: SparkSession, sf: str) -> DataFrame:
    found = lattice.near_duplicates(table(spark, sf, "embeddings"))
    return found.select("vec_id", "n_links", "component_id",
                        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op12_exact_whitening(spark: SparkSession, sf: str) -> DataFrame:
    found = whiten.whitened(table(spark, sf, "embeddings"), components=4)
    return found.select("vec_id", "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
                        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Documents of which those with a crc32 of the id divisible by 10 go on,
    from a word that the id names, in a period that the id names."""
    h = id_hash("doc_id")
    words = F.filter(F.split("text", SPACE_CLASS), lambda w: w != "")
    staged = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"), F.floor(h / 10).alias("_g"))
    staged = staged.withColumn("_n", F.size("_w").cast("bigint"))
    staged = staged.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    staged = staged.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    times = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    period = F.slice("_w", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (F.col("_n") - F.col("_a")).cast("int"))
    whole = F.concat(F.slice("_w", F.lit(1), F.col("_a").cast("int")), tail)
    return staged.select("doc_id", F.when(F.col("_n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.periodic_runs(with_periodic_tails(table(spark, sf, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("_top", runs.longest("runs"))
    length, period = F.col("_top.length"), -F.col("_top.period")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_top.start")).alias("start"),
        length.alias("length"), period.alias("period"),
        F.expr("1000 * _top.length div -_top.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


QUERIES = {f.__name__: f for f in (
    op1_ppm_scores, op2_simhash_neardup, op3_rule_ledger, op4_tag_path_extract, op5_scaled_sketch,
    op6_subword_quality, op7_deobfuscated_toxicity, op8_license_scan, op9_bfd_packing, op10_bpe_roundtrip,
    op11_lattice_neardup, op12_exact_whitening, op13_periodic_runs)}

"""The registered query of each operator, over its whole table, and SQL twins where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmlens.llm import (
    compression_quality,
    lexical_search,
    line_dedup,
    near_duplicates,
    packing,
    page_text,
    periodic_runs,
    pieces,
    secret_ledger,
    shards,
    sql,
    target_ratio,
    toxicity_spans,
    vector_duplicates,
)
from harmlens.llm.labels import is_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, twin: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if twin:
            SQL[name] = twin
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _decision(scored: DataFrame, score: str, folds: int, held: int, *more) -> DataFrame:
    return scored.select(
        "doc_id", is_fold("doc_id", folds, held).alias("held_out"), F.col(score).alias("score"),
        (F.col(score) >= 0.7).cast("int").alias("predicted"), *more,
    )


@register("op1_page_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
    text = F.col(page_text.TEXT)
    return found.select("page_id", "url", text.alias("text"), F.char_length(text).cast("bigint").alias("n_chars"))


@register("op2_toxicity_spans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    model = toxicity_spans.fit(docs, table(spark, sf_dir, "labels"))
    spans = F.col(toxicity_spans.SPANS).alias("spans")
    return _decision(toxicity_spans.scored(docs, model).drop("text"), toxicity_spans.SCORE, toxicity_spans.FOLDS, toxicity_spans.HELD_OUT, spans)


@register("op3_target_ratio")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    weights = target_ratio.fit(docs, table(spark, sf_dir, "labels"))
    judged = target_ratio.judged(docs, weights).drop("text")
    return judged.select("doc_id", *(F.col(f.name).alias(f.name.strip("_")) for f in target_ratio.FIELDS))


@register("op4_secret_ledger", sql.secrets())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    found = secret_ledger.findings(secret_ledger.ledger_rows(secret_ledger.scan(docs)))
    base = [r.name for r in secret_ledger.RULES if r.base]
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("bigint")
    return secret_ledger.joined(docs, found).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(secret_ledger.written("__spans", base), 256).alias("base_sha256"), secret_ledger.written("__spans").alias("spans"),
    )


@register("op5_extendible_shards", sql.extendible_shards())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(texts(spark, sf_dir))


@register("op6_compression_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"))
    return _decision(compression_quality.scored(docs, model).drop("text"), compression_quality.SCORE, compression_quality.FOLDS, compression_quality.HELD_OUT)


@register("op7_sentence_pieces")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encoded(texts(spark, sf_dir)).drop("text")
    return found.select(
        "doc_id", F.size("__ids").cast("bigint").alias("n_ids"), F.col("__ids").alias("ids"),
        F.col("__parity").alias("parity"), F.col("__round_trip").alias("round_trip"),
    )


@register("op8_near_duplicates", sql.near_documents())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.grouped(texts(spark, sf_dir), near_duplicates.Settings(words=4))


@register("op9_sequence_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(texts(spark, sf_dir))


@register("op10_vector_duplicates", sql.near_vectors())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates.grouped(table(spark, sf_dir, "embeddings"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), where one in ten texts repeats a stretch of its words from some word on.

    With h the crc32 of the id and g = h / 10 rounded down, the texts with h % 10 = 0 repeat from word g % n on.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    some = docs.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.floor(h / 10))
    some = some.withColumn("a", F.expr("if(n > 0, int(g % n), 0)"))
    some = some.withColumn("p", F.expr("if(n > 0, int(1 + floor((n - a) / (3 + g % 8))), 1)"))
    tail = "flatten(array_repeat(slice(words, a + 1, p), int(3 + g % 8)))"  # p is above (n - a) / (3 + g % 8)
    text = F.when(F.col("n") > 0, F.expr(f"array_join(slice(concat(slice(words, 1, a), {tail}), 1, n), ' ')"))
    return some.select("doc_id", F.coalesce(text, "text").alias("text"))


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(repeated_tails(texts(spark, sf_dir))).drop("text")
    best = periodic_runs.longest("__runs")
    lines = F.transform("__runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("__runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("__collapsed", 256).alias("collapsed_sha256"),
    )


@register("op12_lexical_search", sql.ranked_documents())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@register("op13_line_dedup", sql.repeated_lines())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(texts(spark, sf_dir)).drop("text")
    return found.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("__kept_text", 256).alias("kept_sha256"),
    )

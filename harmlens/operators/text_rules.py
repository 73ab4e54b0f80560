"""Keyword rules over text tables (F38-F42). Whole texts, JVM string functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.exprs import row_count
from harmlens.operators.windows import last_turns


def _any_word(text: Column, words: Sequence[str]) -> Column:
    hit = text.contains(words[0])
    for w in words[1:]:
        hit = hit | text.contains(w)
    return hit


def score_observations(df: DataFrame, text: str = "text", keywords=dims.BEHAVIOUR_KEYWORDS) -> DataFrame:
    """keywords found, behaviour pattern, level, score and interventions per row."""
    rows = df.withColumn("__low", F.lower(text))
    low = F.col("__low")
    found = F.filter(
        F.array(*[F.struct(F.lit(f"{c}:{w}").alias("tag"), F.lit(w).alias("word")) for c, w in keywords]),
        lambda k: low.contains(k["word"]))
    rows = rows.withColumn("indicators", F.transform(found, lambda k: k["tag"]))
    pattern = F.when(_any_word(low, ["rapide", "presse"]), "RACCOURCI_TEMPS").when(
        _any_word(low, ["fatigue", "lent"]), "FATIGUE").otherwise("STANDARD")
    rows = rows.withColumn("hits", F.size("indicators")).withColumn("pattern", pattern)
    score = F.least(F.lit(100), F.col("hits") * 25 + F.when(F.col("pattern") != "STANDARD", 15).otherwise(0))
    rows = rows.withColumn("risk_score", score)
    mild, strong = ["CORRECTION_IMMEDIATE", "RAPPEL_SECURITE"], ["ARRET_IMMEDIAT", "INTERVENTION_SUPERVISEUR"]
    listed = lambda names: F.array(*[F.lit(n) for n in names])
    return rows.select(
        *df.columns, "indicators", "pattern",
        F.when(F.col("hits") >= 3, "CRITIQUE").when(F.col("hits") >= 2, "ELEVE").when(F.col("hits") >= 1, "MODERE").otherwise("FAIBLE").alias("risk_level"),
        "risk_score",
        F.when(F.col("risk_score") >= 75, listed(strong + mild)).when(F.col("risk_score") >= 50, listed(mild))
        .otherwise(F.array().cast("array<string>")).alias("interventions"))


def detect_intent(df: DataFrame, text: str = "text") -> DataFrame:
    """the first intent whose word list hits."""
    low = F.lower(text)
    intent = F
    for name, words in dims.INTENT_WORDS:
        intent = intent.when(_any_word(low, words), F.lit(name))
    return df.withColumn("intent", intent.otherwise("general"))


def mentioned_sector(df: DataFrame, text: str = "text", default: str = "221122") -> DataFrame:
    """the first sector whose code or name occurs in the text."""
    raw, low = F.col(text), F.lower(text)
    sector = F
    for code, name in dims.NAMED_SECTORS:
        sector = sector.when(raw.contains(code) | low.contains(name.lower()), F.lit(code))
    return df.withColumn("sector", sector.otherwise(default))


def chain_confidence(steps: DataFrame, key: str, confidence: str) -> DataFrame:
    """product of the steps' confidences, three decimals; 0 for a chain without steps."""
    return steps.groupBy(key).agg(F.round(F.coalesce(F.product(confidence), F.lit(0.0)), 3).alias("confidence"), row_count().alias("steps"))


def summarize(turns: DataFrame, n: int = 5, width: int = 100) -> DataFrame:
    """the last n turns of each conversation, shortened, one per line."""
    short = F.when(F.length("text") > width, F.concat(F.substring("text", 1, width), F.lit("..."))).otherwise(F.col("text"))
    last = last_turns(turns, n).select("conv_id", "recency", F.concat(F.lit("["), "role", F.lit("]: "), short).alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("recency")).alias("at"), "line")))
    return last.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda r: r["line"]), "\n").alias("summary"))

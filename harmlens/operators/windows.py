"""Shares, year-on-year changes, top-N and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harmlens.functions.exprs import band, change_pct, contains_ci, percent, row_count


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows; ties broken by key, so every run agrees."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc_nulls_first() for t in tie]).limit(k)


def first_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The first k rows in a stated order."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(k)


def order_nulls_last(df: DataFrame, col: str) -> DataFrame:
    """O02."""
    return df.orderBy(F.col(col).desc_nulls_last())


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """O07."""
    return df.select(col).distinct()


def concat(*dfs: DataFrame) -> DataFrame:
    """Rows of all frames by column name; absent columns are NULL."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def top_n_by(df: DataFrame, keys: Sequence[str], value: str, n: int, measure: str = "n") -> DataFrame:
    """The n largest rows per key.

    The rank filter lets Spark prune each task to n rows per key before the
    shuffle, so a hot key never gathers in one task.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(measure).desc(), F.col(value).asc_nulls_first())
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def share_of_total(counted: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Each row's share of its group's total.

    The total is a second group-by joined back, not a window over the whole
    group, so the group is never sorted or buffered in one task.
    """
    if not keys:
        total = counted.agg(F.sum(n).alias("t")).scalar()
        return counted.withColumn("pct", percent(n, total))
    totals = counted.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.sum(n).alias("__total"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = counted.join(totals, same, "left")
    return joined.withColumn("pct", percent(n, "__total")).drop("__total", *[f"__{k}" for k in keys])


def top_n_with_share(rows: DataFrame, keys: Sequence[str], column: str, n: int) -> DataFrame:
    """top values per key with their share of the key's non-null rows."""
    counted = rows.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("valeur")).agg(
        row_count().alias("n"))
    best = top_n_by(counted, keys, "valeur", n)
    totals = counted.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.sum("n").alias("__total"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return best.join(totals, same, "left").select(
        *keys, "rank", "valeur", F.col("n").alias("total"), percent("n", "__total").alias("pct"))


def yoy(series: DataFrame, keys: Sequence[str], year: str, n: str) -> DataFrame:
    """Change against the previous year of the same key.

    ``series`` is already one row per key and year, so a partition holds years.
    """
    window = Window.partitionBy(*keys).orderBy(year)
    previous = F.lag(n).over(window)
    return series.withColumn("previous", previous).withColumn(
        "variation_pct", F.when(F.col("previous").isNotNull(), F.round(change_pct(F.col(n), F.col("previous")), 1)))


def first_last(series: DataFrame, keys: Sequence[str], year: str, n: str) -> DataFrame:
    """First and last year with their values, by partial aggregation only."""
    return series.groupBy(*keys).agg(
        F.min(year).alias("annee_debut"), F.max(year).alias("annee_fin"),
        F.min_by(n, year).alias("valeur_debut"), F.max_by(n, year).alias("valeur_fin"), row_count().alias("nb_annees"))


def latest_two(series: DataFrame, keys: Sequence[str], year: str, n: str) -> DataFrame:
    """The two latest values per key, side by side; keys with one year drop out."""
    window = Window.partitionBy(*keys).orderBy(F.col(year).desc())
    ranked = series.withColumn("__r", F.row_number().over(window)).filter(F.col("__r") <= 2)
    pair = ranked.groupBy(*keys).agg(
        F.max(F.when(F.col("__r") == 1, F.col(n))).alias("recent"),
        F.max(F.when(F.col("__r") == 2, F.col(n))).alias("previous"), row_count().alias("__years"))
    return pair.filter(F.col("__years") == 2).drop("__years")


def latest_two_overall(series: DataFrame, year: str, n: str) -> DataFrame:
    """The two latest rows of one series as a single row."""
    last = series.orderBy(F.col(year).desc()).limit(2)
    return last.agg(F.max_by(n, year).alias("recent"), F.min_by(n, year).alias("previous"), row_count().alias("points"))


def last_turns(turns: DataFrame, n: int, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last n turns of each conversation."""
    window = Window.partitionBy(conversation).orderBy(F.col(turn).desc())
    return turns.withColumn("recency", F.row_number().over(window)).filter(F.col("recency") <= n)


# -- filters ---------------------------------------------------------------------

def scan(df: DataFrame, *, contains: dict[str, str | None] | None = None, equals: dict[str, object] | None = None,
         limit: int | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """Optional substring and equality filters, optional order and limit."""
    for column, text in (contains or {}).items():
        if text:
            df = df.filter(contains_ci(column, text))
    for column, value in (equals or {}).items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    if order:
        df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """P17."""
    return df.dropna(subset=list(columns))


def by_volume(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys with their volume, largest first."""
    return df.groupBy(key).agg(row_count().alias("total")).orderBy(F.col("total").desc(), F.col(key).asc_nulls_first())


def volume_band(df: DataFrame, n: str, steps, lowest: str) -> DataFrame:
    """Label a volume by thresholds."""
    return df.withColumn("niveau", band(F.col(n), list(steps), lowest))


def rank_risks(df: DataFrame, rates: Sequence[tuple[str, str]]) -> DataFrame:
    """Risk names by falling rate; ties keep the order given."""
    items = [F.struct((-F.col(column)).alias("rank"), F.lit(i).alias("ord"), F.lit(name).alias("type"))
             for i, (name, column) in enumerate(rates)]
    return df.withColumn("ranked", F.transform(F.sort_array(F.array(*items)), lambda s: s["type"]))

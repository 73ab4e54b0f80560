"""Secret scanning with a ledger of blobs, in DataFrame functions only.

A text is addressed by its SHA-256. The ledger holds one row for each (blob, rule, rule version) that has
been scanned, with the spans found; a run scans only pairs the ledger lacks, one representative row of each
new blob, and joins the findings back to every row that carries the blob. Appending a run's new rows to the
ledger makes the next run incremental; a changed rule gets a new version and only that rule runs again.

Spans count code points, end exclusive. Null text counts as the empty text. Rows may repeat and ids may be
null: each row keeps its own result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; a match whose group ``group`` is shorter than ``least`` drops out.

    ``possessive`` is the same pattern for the JVM, where a repeated group takes stack for every round unless it is possessive.
    """

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0
    base: bool = False
    possessive: str = ""

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: A private key runs to its END line, whatever stands between but a further BEGIN or another END; where none follows, the BEGIN
#: line is all. ``@`` marks the loops that may be possessive.
KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*@(?:(?:-{1,4}[^-]|-{5,}(?:[^-BE]|B[^-E]|BE[^-G]|E[^-N]|EN[^-D]))[^-]*@)*@"
    r"-{5,}END [A-Z ]*PRIVATE KEY-----)?"
)
#: Patterns and least lengths are fixed values. A least length of a plain run is part of its pattern.
RULES = (
    Rule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=1, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("private_key", KEY.replace("@", ""), version=2, possessive=KEY.replace("@", "+")),
    Rule("host_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
LEDGER = "blob string, rule string, version int, spans array<struct<start:bigint,end:bigint>>"
SALTS = 32  # parts that the rows of one blob are dealt to
NO_SPANS = "cast(array() as array<struct<start:bigint,end:bigint>>)"


def address(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def _found(text: Column, rule: Rule) -> Column:
    """Spans of a rule: the texts between matches and the matches give every position."""
    held = rule.possessive or rule.pattern
    pattern = F.lit(held)
    between = F.split(text, held, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = F.transform(matches, lambda m: F.char_length(m).cast("bigint"))
    if rule.least:
        values = F.regexp_extract_all(text, pattern, F.lit(rule.group))
        parts = F.arrays_zip(F.transform(F.slice(between, 1, F.size(matches)), lambda s: F.char_length(s).cast("bigint")).alias("gap"), sized.alias("n"), F.transform(values, lambda v: F.char_length(v) >= rule.least).alias("ok"))
    else:
        parts = F.arrays_zip(F.transform(F.slice(between, 1, F.size(matches)), lambda s: F.char_length(s).cast("bigint")).alias("gap"), sized.alias("n"), F.transform(matches, lambda m: F.lit(True)).alias("ok"))
    return F.when(text.rlike(held), parts)


def _placed(parts: str, rule: Rule) -> Column:
    """Spans from gap and match lengths."""
    return F.expr(
        f"""coalesce(transform(filter(transform({parts}, (x, i) -> struct(
                aggregate(slice({parts}, 1, i), 0L, (at, y) -> at + y.gap + y.n) + x.gap as start, x.n as n, x.ok as ok)),
              x -> x.ok), x -> struct(x.start as start, x.start + x.n as end)), {NO_SPANS})"""
    )


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """New blobs with the spans of each rule that the ledger lacks; null where the ledger has the pair.

    Columns: blob and one per rule. Only the representative row of an unseen blob is scanned.
    """
    rows = docs.select(address(text).alias("blob"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    chosen = rows.groupBy("blob").agg(F.min("id").alias("id"))
    wanted = F.array(*(F.lit(r.key) for r in rules))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
        chosen = chosen.join(seen, "blob", "left").withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen").filter(F.size("todo") > 0)
    else:
        chosen = chosen.withColumn("todo", wanted)
    # the representatives' side is built into hash tables: texts are moved once, neither sorted nor spilled
    picked = rows.join(chosen.hint("shuffle_hash"), ["blob", "id"])
    raw = picked.select("blob", "todo", *(F.when(F.array_contains("todo", r.key), _found(F.col("t"), r)).alias(r.name) for r in rules))
    placed = raw.select("blob", *(F.when(F.array_contains("todo", r.key), _placed(f"`{r.name}`", r)).alias(r.name) for r in rules))
    return placed.groupBy("blob").agg(*(F.first(r.name).alias(r.name) for r in rules))  # rows may repeat


def ledger_rows(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows to append to the ledger."""
    entries = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.col(r.name).alias("spans")) for r in rules))
    return scanned.select("blob", F.explode(entries).alias("e")).select("blob", "e.rule", "e.version", "e.spans").filter("spans is not null")


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Blobs with spans under the current rule versions: ``spans`` of (start, rank, kind, end), in order."""
    rank = F.array(*(F.lit(r.key) for r in rules))
    current = ledger.withColumn("rank", F.array_position(rank, F.concat_ws("@", "rule", "version")).cast("int")).filter("rank > 0 and size(spans) > 0")
    each = current.select("blob", F.explode("spans").alias("s"), "rank", "rule").select("blob", F.struct(F.col("s.start").alias("start"), "rank", F.col("rule").alias("kind"), F.col("s.end").alias("end")).alias("s"))
    return each.groupBy("blob").agg(F.array_sort(F.collect_set("s")).alias("spans"))


def joined(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__spans`` of every row's blob; an empty list where there are none."""
    none = F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint>>)")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))  # findings are few; rows of one blob may be many
    blobs = found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"), salts.alias("__salt"))
    salted = docs.withColumn("__blob", address(text)).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(blobs, ["__blob", "__salt"], "left").withColumn("__spans", F.coalesce("__spans", none)).drop("__blob", "__salt")


def written(spans: str, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    chosen = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: str, spans: str, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans become one."""
    # a span opens a gap unless an earlier one reaches past its start
    return F.expr(
        f"""case when size({spans}) = 0 then {text} else concat(
          concat_ws('', transform({spans}, (s, i) -> case
            when i > 0 and s.start <= array_max(transform(slice({spans}, 1, i), p -> p.end)) then ''
            else concat(substring({text},
                 cast(coalesce(array_max(transform(slice({spans}, 1, i), p -> p.end)), 0) + 1 as int),
                 cast(s.start - coalesce(array_max(transform(slice({spans}, 1, i), p -> p.end)), 0) as int)), '{mark}') end)),
          substring({text}, cast(array_max(transform({spans}, p -> p.end)) + 1 as int), char_length({text}))) end"""
    )

"""Quality rules as a ledger: every rule is judged once per document, and its failure is one bit.

Measurements and bits are stored; a policy is a named, versioned set of rules, so its verdict is a
mask over the stored bits, and what each rule alone contributes to it follows from counts of bits.

Defined cases: a null text has no words and fails the rules that need some; repeated rows are judged
alike; an empty table gives an empty ledger. Windows of words are compared by a 64-bit hash within one
document. Arrays are those of one document, so memory is bounded by the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import column, texts_of, words_of

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Fails where ``fails`` holds; the bit is the rule's place in ``RULES``."""

    name: str
    fails: str


#: Order fixes the bits: add at the end only.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 5 * word_chars"),
    Rule("duplicate_lines", "n_lines >= 5 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("capitals", "n_words >= 10 and 100 * n_capitals > 50 * word_chars"),
    Rule("word_length", "n_words >= 10 and (word_chars < 2 * n_words or word_chars > 20 * n_words)"),
)
BASE = ("few_words", "repeated_windows")
POLICIES = {
    "base": BASE,
    "1": (*BASE, "symbols", "duplicate_lines"),
    "2": (*BASE, "symbols", "duplicate_lines", "capitals", "word_length"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def mask_of(rules: tuple[str, ...]) -> int:
    """The bits of named rules; an unknown name is an error."""
    places = {rule.name: i for i, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in rules)


def measure(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """``doc_id`` and the measurements of its whole text, from one pass without a shuffle.

    With ``whole`` a column ``row`` holds the row of ``df`` as it is.
    """
    docs = texts_of(df, id_col, text_col) if not whole else df.select(
        column(df, id_col).alias("doc_id"),
        F.coalesce(column(df, text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(*[column(df, c) for c in df.columns]).alias("row"),
    )
    held = ["doc_id", *["row"] * whole]
    words = docs.select(
        *held,
        "text",
        words_of(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = words.select(
        *held,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("w") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("w", i, WINDOW))),
        ).alias("windows"),
    )
    # Only a document with equal windows pays for sorting them.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = counted.withColumn(
        "placed",
        F.when(twice, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    repeated = placed.withColumn(
        "at",
        F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        "placed",
                        lambda x, k: F.struct(
                            x["i"].alias("i"),
                            (
                                F.coalesce(F.get("placed", k - 1)["h"] == x["h"], F.lit(False))
                                | F.coalesce(F.get("placed", k + 1)["h"] == x["h"], F.lit(False))
                            ).alias("again"),
                        ),
                    ),
                    lambda x: x["again"],
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    # A caller's filter would move below these expressions and repeat them, once per word; it does not
    # pass an expression on the partition's number, of which this adds nothing.
    nothing = F.least(F.spark_partition_id(), F.lit(0))
    return repeated.withColumn("n_repeat_words", (F.coalesce(covered, F.lit(0)) + nothing).cast("long")).select(*held, *MEASURES)


def ledger(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits``: every rule evaluated once."""
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return measure(df, id_col=id_col, text_col=text_col, whole=whole).withColumn("fail_bits", bits)


def store(df: DataFrame, path: str, **columns: str) -> DataFrame:
    """Write the ledger of ``df`` once; what comes back reads it. Policies and their ablations are worked
    out from there, at any later time, without looking at a text again."""
    ledger(df, **columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def judged(entries: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """``policy, n_docs, n_kept``: what each version of the policy keeps of a ledger."""
    counts = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    masks = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(mask_of(rules)).cast("long").alias("mask")) for p, rules in policies.items()])
    kept = F.col("fail_bits").bitwiseAND(F.col("mask")) == 0
    return (
        counts.select("fail_bits", "n", F.inline(masks))
        .groupBy("policy")
        .agg(F.sum("n").alias("n_docs"), F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("n_kept"))
    )


def passes(rules: tuple[str, ...], bits: str = "fail_bits") -> Column:
    """Whether none of the rules failed."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(rules)).cast("long")) == 0


def ablations(entries: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """``policy, rule, n_docs, n_failed, n_only``: documents a rule rejects, and that only it rejects.

    Documents are first counted by their bits, of which there are at most two to the number of rules.
    """
    counts = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    asked = F.array(
        *[
            F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask_of(rules)).cast("long").alias("mask"), F.lit(mask_of((r,))).cast("long").alias("bit"))
            for p, rules in policies.items()
            for r in rules
        ]
    )
    each = counts.select("fail_bits", "n", F.inline(asked))
    fails = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    only = F.col("fail_bits").bitwiseAND(F.col("mask")) == F.col("bit")
    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("n_only"),
    )


def passing(df: DataFrame, policy: str = "2", *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that a policy keeps, as they are."""
    entries = ledger(df, id_col=id_col, text_col=text_col, whole=True)
    return entries.where(passes(POLICIES[policy])).select("row.*")


def verdicts(df: DataFrame, policy: str = "2") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    entries = ledger(df)
    return entries.withColumn("base_failed", ~passes(BASE)).withColumn("kept", passes(BASE) & passes(POLICIES[policy]))

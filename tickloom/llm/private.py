"""Personal data: fixed shapes, and identifiers found by the contexts that known ones stand in.

Known identifiers are the seeds. The words before an identifier are its lexical patterns: the last two
and the last three, and the last one or two with the identifier's outline. Patterns and instances form a
bipartite graph over the corpus. In rounds, a pattern's confidence is the share of its distinct instances
that are known, an unknown instance becomes known by the confident patterns it occurs in, and so on; words
alone speak for strings of any shape, with less weight than words with an outline. Strings that end up
known, and have no fixed shape, are reported as ``learned``.

All of it is DataFrame expressions and aggregates: positions come from the pieces between matches,
the graph from grouping distinct (pattern, instance) pairs, which combines before the shuffle.

Defined cases: a null text is empty; spans are of code points, end exclusive; repeated rows get equal
spans, and count once as evidence; a null id is kept; an empty table gives no rows. Identifiers and texts
may be of any length; a context is made of whole words, across other identifiers if need be, and ends at
the text's beginning. Columns other than the two named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import column, text_key, texts_of
from tickloom.plans.lineage import cut_lineage

#: Kinds in the order that spans of equal start follow.
KINDS = ("email", "ip", "card", "phone", "learned")
#: Shapes, written so that none goes back over a run it has taken: a start inside a run that its first
#: character could have begun is skipped, unless the match before ended there.
SHAPES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a shape to be looked for.
SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: Strings that may be identifiers: without punctuation that sets words apart, or ends a sentence at their
#: end, with a digit or an at sign.
_INSIDE = r"[^\x20\x09-\x0D\"'<>,;:=()\[\]{}|]"
CANDIDATE = rf"(?<!{_INSIDE})(?={_INSIDE}*?[0-9@]){_INSIDE}+(?<![.!?])"
#: Words of a context, and identifiers before one that are looked back over for them.
CONTEXT_WORDS = 3
#: Lengths added up at a time.
BLOCK = 64
SPAN = "struct<start: bigint, rank: int, end: bigint, value: string, before: string>"
#: Rounds over the graph; known instances that a pattern needs, and its confidence; score of an instance.
ROUNDS, LEAST_SEEDS, LEAST_CONFIDENCE, LEAST_SCORE = 3, 3, 0.8, 0.8
#: What the confidence of words without an outline counts for.
WORDS_WEIGHT = 0.8


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _last_words(before: Column) -> Column:
    """The last words of a context in lower case, without punctuation and with one digit for many."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(before), r"[^\p{L}\p{N}]+", " "), "[0-9]+", "9")
    words = F.split(F.trim(plain), " ")
    return F.array_join(F.slice(words, -F.least(F.size(words), F.lit(CONTEXT_WORDS)), F.lit(CONTEXT_WORDS)), " ")


def _placed(text: Column, pattern: str, rank: int) -> Column:
    """Matches with their places, and what stands before.

    The place of a match is the sum of the lengths before it, taken from sums of blocks and the rest of
    its own block, so that a text of many matches stays far from one step per pair of them.
    """
    total = lambda lengths: F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def spans(pairs: Column, lengths: Column, before: Column) -> Column:
        def span(x: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            first = F.get(before, block) + total(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK)) + x["gap"]
            return F.struct(
                first.alias("start"), F.lit(rank).alias("rank"), (first + F.length(x["m"])).alias("end"),
                x["m"].alias("value"), x["before"].alias("before"),
            )

        return F.transform(pairs, span)

    def blocks(lengths: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int")),
            lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))),
        )

    def upto(sums: Column) -> Column:
        return F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))

    def of(matches: Column, pieces: Column) -> Column:
        def before(i: Column) -> Column:
            # Every match has a word at least, so these hold the last words of the text.
            earlier = [x for k in range(CONTEXT_WORDS, 0, -1) for x in (F.get(pieces, i - k), F.get(matches, i - k))]
            return _last_words(F.concat(*[F.coalesce(x, F.lit("")) for x in (*earlier, F.get(pieces, i))]))

        pairs = F.transform(
            matches, lambda m, i: F.struct(m.alias("m"), F.length(F.get(pieces, i)).alias("gap"), before(i).alias("before"))
        )
        lengths = lambda p: F.transform(p, lambda x: (x["gap"] + F.length(x["m"])).cast("bigint"))
        return _with(
            pairs,
            lambda p: _with(lengths(p), lambda n: _with(blocks(n), lambda sums: _with(upto(sums), lambda before: spans(p, n, before)))),
        )

    return _with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.size(m) > 0, _with(F.split(text, pattern, -1), lambda p: of(m, p))).otherwise(F.array().cast(f"array<{SPAN}>")),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of a shape is a real one."""
    if kind == "ip":
        def small(part: Column) -> Column:
            number = F.regexp_replace(part, "^0+", "")
            return (F.length(number) <= 2) | ((F.length(number) == 3) & (number <= "255"))

        return F.forall(F.split(value, r"\."), small)
    n = F.length(_digits(value))
    if kind == "card":
        return F.when((n >= 12) & (n <= 19), F.call_function("luhn_check", _digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of the fixed shapes by start, then kind."""
    none = F.array().cast(f"array<{SPAN}>")

    def of(rank: int, kind: str) -> Column:
        found = F.filter(_placed(text, SHAPES[kind], rank), lambda s: _holds(kind, s["value"]))
        return F.when(text.contains("@") if kind == "email" else text.rlike(SIGNS[kind]), found).otherwise(none)

    return F.sort_array(F.concat(*[of(rank, kind) for rank, kind in enumerate(SHAPES)]))


def candidates(text: Column, spans: Column) -> Column:
    """Strings that may be identifiers and touch none of ``spans``."""
    fits = lambda c: ~F.exists(spans, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    return F.when(text.rlike("[0-9@]"), F.filter(_placed(text, CANDIDATE, len(SHAPES)), fits)).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


def patterns(value: Column, before: Column) -> Column:
    """Lexical patterns ``name, weight`` of an identifier: the last two and three words before it, and the
    last one and two with its outline.

    The outline keeps every digit's place and shortens runs of letters: such a pattern speaks for strings
    built like those it was learned from, after fewer words.
    """
    outline = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]", "9")
    words = F.filter(F.split(before, " "), lambda w: w != "")

    def last(n: int, shaped: bool) -> Column:
        name = F.array_join(F.slice(words, -n, n), " ")
        name = F.concat(name, F.lit(" | "), outline) if shaped else name
        weight = F.lit(1.0 if shaped else WORDS_WEIGHT)
        return F.when(F.size(words) >= n, F.struct(name.alias("pattern"), weight.alias("weight")))

    return F.array_compact(F.array(last(1, True), last(2, True), last(2, False), last(3, False)))


def learn(evidence: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """``value, score`` of unknown instances that confident patterns vouch for.

    ``evidence``: value, before, known. Only distinct pairs of pattern and instance count, so a text
    copied a thousand times is evidence once.
    """
    pairs = cut_lineage(
        evidence.select(F.inline(patterns(F.col("value"), F.col("before"))), "value", "known")
        .groupBy("pattern", "weight", "value")
        .agg(F.max("known").alias("known"))
    )
    seeds = pairs.where("known").select("value", F.lit(1.0).alias("score")).distinct()
    unknown = pairs.where(~F.col("known")).join(seeds, "value", "left_anti").select("pattern", "value")
    scores, gained = seeds, None
    for _ in range(rounds):
        trust = (
            pairs.select("pattern", "weight", "value").join(scores, "value", "left")
            .groupBy("pattern", "weight")
            .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("good"), F.count(F.lit(1)).alias("n"))
            .where((F.col("good") >= LEAST_SEEDS) & (F.col("good") >= LEAST_CONFIDENCE * F.col("n")))
            .select("pattern", (F.col("weight") * F.col("good") / (F.col("n") + 1.0)).alias("confidence"))
        )
        gained = (
            unknown.join(trust, "pattern")
            .groupBy("value")
            .agg((1.0 - F.exp(F.sum(F.log(1.0 - F.col("confidence"))))).alias("score"))
        )
        scores = seeds.unionByName(gained)
    return gained.where(F.col("score") >= LEAST_SCORE)


def find_private(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, text_key, spans``: kind, start, end of every span by start, then kind.

    ``text_key`` is a hash of the text; with the id it names the row.
    """
    docs = texts_of(df, id_col, text_col)
    based = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), base_spans(F.col("text")).alias("base"))
    first = cut_lineage(
        based.select("doc_id", "text_key", "base", candidates(F.col("text"), F.col("base")).alias("others"))
    )
    shown = first.where((F.size("base") > 0) | (F.size("others") > 0))
    evidence = shown.select(F.inline("base"), F.lit(True).alias("known")).unionByName(
        shown.select(F.inline("others"), F.lit(False).alias("known"))
    )
    learned = learn(evidence.select("value", "before", "known"), rounds=rounds)
    more = (
        shown.where(F.size("others") > 0)
        .select(F.col("doc_id").alias("other_id"), F.col("text_key").alias("other_key"), F.inline("others"))
        .join(learned.select("value"), "value", "left_semi")
        .groupBy("other_id", "other_key")
        .agg(F.collect_set(F.struct("start", "rank", "end", "value", "before")).alias("more"))
    )
    joined = first.join(more, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_key") == F.col("other_key")), "left")
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))))
    kinds = F.array(*map(F.lit, KINDS))
    return joined.select(
        "doc_id",
        "text_key",
        F.transform(spans, lambda s: F.struct(F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
    )


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def private_digests(df: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans, per document."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_private(df).select(
        "doc_id",
        *map(of, KINDS[:4]),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] != KINDS[4])), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def without_private(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``df`` with every span of its texts replaced by its kind; ``n_chars_col``, if any, is counted anew."""
    found = find_private(df, id_col=id_col, text_col=text_col).where(F.size("spans") > 0)
    found = found.groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))
    row = df.select(F.struct(*[column(df, c) for c in df.columns]).alias("row"), text_key(df, text_col).alias("key"))
    both = row.join(found, F.col("row")[id_col].eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left")
    text = F.when(F.col("spans").isNotNull(), masked(F.col("row")[text_col], F.col("spans"))).otherwise(F.col("row")[text_col])
    columns = {c: F.col("row")[c] for c in df.columns} | {text_col: text}
    if n_chars_col in columns:
        columns[n_chars_col] = F.when(F.col("spans").isNotNull(), F.length(text).cast(df.schema[n_chars_col].dataType)).otherwise(F.col("row")[n_chars_col])
    return both.select(*[columns[c].alias(c) for c in df.columns])


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first."""
    kept = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">"))),
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, kept).otherwise(text)

"""Secrets in texts: fixed shapes, and strings that compress badly where a secret is to be expected.

A string in a sensitive context - shortly after a word such as "key" or "password" - is measured by the
bytes that it adds to a zstandard frame whose dictionary holds the corpus's commonest identifiers and
whose history is the surrounding text. Names and prose are found there or compress; secrets do not. Measured are
runs of 12 and more characters of the usual alphabets with letters and digits, or of 24 and more letters
(which no word has); and strings of 8 and more characters with other symbols, or shorter
than 12, that have letters and digits and either both cases or a symbol. Below 12 the bar is higher. Not
measured, and so not found, are shorter strings, words, numbers, and secrets without a sensitive word before them.

Defined cases: a null text is empty; spans are of code points, end exclusive; repeated rows are
searched each by itself. Identifiers are counted over all texts; only the ``identifiers`` commonest go
into the dictionary, whose size is bounded by definition.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import process_cache, small_batches, texts_of, type_of

#: Kinds in the order that spans of equal start follow.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A cheap sign that ASSIGN may match, and words after which secrets are looked for.
SIGNS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Where a word begins or ends inside a name: beside what is no letter, and where the case changes.
_BOUND = r"|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"
SENSITIVE = re.compile(
    rf"(?=[abckpstABCKPST])(?:(?<![A-Za-z]){_BOUND})"
    r"(?i:pass(?:words?|wd|phrase|code)?|pwds?|secrets?|tokens?|api[_ -]?keys?|private[_ -]?keys?|access[_ -]?keys?|keys?|credentials?|creds?|bearer|auth)"
    rf"(?:(?![A-Za-z]){_BOUND})",
    re.ASCII,
)
SENSITIVE_SIGNS = ("pass", "pwd", "secret", "token", "key", "cred", "bearer", "auth")
LEAST_CHARS = 12
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}+", re.ASCII)
#: Characters after a sensitive word within which a candidate begins, and of surrounding text that prime the history.
REACH, AROUND = 80, 400
#: Bytes added per character from which a candidate is novel. Random hex adds at least half a byte a character.
NOVEL_BYTES_PER_CHAR = 0.5
#: The same for strings of less than twelve characters, which cost a frame as much as they are long if nothing is like them.
SHORT_BYTES_PER_CHAR = 0.9
#: Least characters of a run of letters, and of a string with other symbols.
LEAST_LETTERS, LEAST_WIDE = 24, 8
WIDE = re.compile(r"[^\x20\x09-\x0D\"'`,;(){}\[\]<>]{8,}+")
_BEFORE_WIDE, _AFTER_WIDE = re.compile(r"[^A-Za-z0-9]*"), re.compile(r"[.:?!]+$")
IDENTIFIERS = 4096


def identifier_counts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``identifier, n_docs``: names that stand before an assignment, or are joined by underscores."""
    docs = texts_of(df, id_col, text_col).where(F.col("text").rlike("[_=:]"))
    found = F.regexp_extract_all("text", F.lit(r"""(?<![A-Za-z0-9_])([A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)++|[A-Za-z][A-Za-z0-9_]{1,63}(?=["']?[\x20\t]{0,4}[:=]))"""), F.lit(1))
    names = docs.select(F.explode(F.array_distinct(found)).alias("identifier"))
    return names.where(F.length("identifier") <= 64).groupBy("identifier").agg(F.count(F.lit(1)).alias("n_docs"))


def dictionary(counts: DataFrame, size: int = IDENTIFIERS) -> bytes:
    """The commonest identifiers as content of a zstandard dictionary, commonest last (nearest)."""
    rows = counts.orderBy(F.desc("n_docs"), "identifier").limit(size).collect()
    return b"\n".join(r.identifier.encode("utf-8") for r in reversed(rows))


class Novelty:
    """Bytes that a string adds to a frame primed with a dictionary and the text around it."""

    def __init__(self, words: bytes):
        import zstandard

        held = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(words) >= 8 else None
        self.pack = zstandard.ZstdCompressor(level=9, dict_data=held, write_checksum=False, write_content_size=False).compress

    def added(self, text: str, start: int, end: int) -> int:
        around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).encode("utf-8", "replace")
        return len(self.pack(around + b"\n" + text[start:end].encode("utf-8", "replace"))) - len(self.pack(around + b"\n"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed shapes, leftmost and not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(sign in low for sign in SIGNS) or "K" in text or "ſ" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, added)`` of strings after sensitive words that no base span touches."""
    low = text.lower()
    if not any(sign in low for sign in SENSITIVE_SIGNS):
        return []
    words = [m.end() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    taken = sorted((start, end) for start, _, end in base)
    begins, ends = [start for start, _ in taken], list(accumulate((end for _, end in taken), max))
    found = []
    for run in RUN.finditer(text):
        begin, end = run.span()
        first, inside, last = bisect_left(words, begin - REACH), bisect_right(words, begin), bisect_left(words, end)
        # A string begins with its run, or after a sensitive word in it, and always goes on to the run's end.
        starts = [begin] * (inside > first) + words[inside:last]
        starts = [s for s in starts if end - s >= LEAST_CHARS]
        starts = [s for s, after in zip(starts, [*starts[1:], end]) if after - s >= LEAST_CHARS]
        if not starts:
            continue
        digit = _last(text, begin, end, str.isdigit)
        letter = _last(text, begin, end, str.isalpha)
        for start, after in zip(starts, [*starts[1:], end]):
            if letter < start or digit < start and end - start < LEAST_LETTERS:
                break
            if (i := bisect_left(begins, end)) and ends[i - 1] > start:
                continue
            if novelty.added(text, start, after) >= NOVEL_BYTES_PER_CHAR * (after - start):
                found.append((start, 3, end, novelty.added(text, start, end)))
                break
    return found + _wide_spans(text, words, sorted(taken + [(s, e) for s, _, e, _ in found]), novelty)


def _wide_spans(text: str, words: list[int], taken: list[tuple[int, int]], novelty: Novelty) -> list[tuple[int, int, int, int]]:
    """Like :func:`novel_spans`, of strings with symbols and of short ones that ``taken`` does not touch."""
    begins, ends = [start for start, _ in taken], list(accumulate((end for _, end in taken), max))
    found = []
    for run in WIDE.finditer(text):
        begin, end = run.span()
        first, inside, last = bisect_left(words, begin - REACH), bisect_right(words, begin), bisect_left(words, end)
        if first >= last:
            continue
        begin = _BEFORE_WIDE.match(text, words[last - 1] if last > inside else begin, end).end()
        if text[end : end + 1] not in ("'", '"', "`"):  # outside quotes, what ends a sentence is not part of it
            end = begin + len(_AFTER_WIDE.sub("", text[begin:end]))
        value = text[begin:end]
        cased = value != value.lower() and value != value.upper()
        symbol = not value.replace("_", "").replace("-", "").replace(".", "").replace("/", "").isalnum()
        plain = len(value) >= LEAST_CHARS and RUN.fullmatch(value)  # measured as a run
        if len(value) < LEAST_WIDE or plain or "://" in value or "@" in value and "." in value.rpartition("@")[2]:
            continue
        if not (any(map(str.isdigit, value)) and any(map(str.isalpha, value)) and (cased or symbol)):
            continue
        if (i := bisect_left(begins, end)) and ends[i - 1] > begin:
            continue
        bar = NOVEL_BYTES_PER_CHAR if len(value) >= LEAST_CHARS else SHORT_BYTES_PER_CHAR
        added = novelty.added(text, begin, end)
        if added >= bar * len(value):
            found.append((begin, 3, end, added))
    return found


def _last(text: str, begin: int, end: int, test: Callable[[str], bool]) -> int:
    """The last place from ``begin`` to ``end`` whose character passes; -1 if none does."""
    return next((i for i in range(end - 1, begin - 1, -1) if test(text[i])), -1)


def find_secrets(df: DataFrame, words: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: kind, start, end and added bytes of every span, by start, then kind."""
    docs = texts_of(df, id_col, text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added_bytes", pa.int64())])
    schema = f"doc_id {type_of(docs, 'doc_id')}, spans array<struct<kind: string, start: long, end: long, added_bytes: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = process_cache(("novelty", words), lambda: Novelty(words))
        for batch in small_batches(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                spans = [(s, k, e, novelty.added(text, s, e)) for s, k, e in base] + novel_spans(text, base, novelty)
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "added_bytes": n} for s, k, e, n in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    return docs.mapInArrow(run, schema)


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digests(df: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans, per document."""
    found = find_secrets(df, dictionary(identifier_counts(df)))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(of, KINDS[:3]),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )

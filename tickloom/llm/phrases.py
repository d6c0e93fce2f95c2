"""Substring deduplication by words: Aho-Corasick automata of the phrases that recur.

Recurring phrases are found and brought to the shards of documents where they occur (``passages``). A
shard compiles its phrases into one automaton over word numbers and streams its documents through it,
which finds every occurrence of every phrase at once, word for word. Words that lie in a phrase of a
document with a smaller id are removed.

Defined cases: a null text has no words; a null id is larger than every other and equal to other nulls,
so copies among null ids stay; rows of one id never remove words from each other; repeated rows come
out once each; words are separated by ASCII white space and compared as they are; an empty table gives
no rows. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import process_cache
from tickloom.llm.passages import NULL_FROM, Document, Symbols, recurring

LENGTH, GRAM = 13, 5
_CACHED_WORDS = 300_000
SCHEMA = "doc_id long, n_words long, n_removed long, starts array<int>, ends array<int>, kept string"


class _Codes(dict):
    """64-bit codes of words, never zero; holds a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word) or 1
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = code
        return code


def _words(text: str) -> list[bytes]:
    """Splitting bytes knows ASCII white space alone."""
    return text.encode("utf-8").split()


def _codes(words: list[bytes]) -> np.ndarray:
    held = process_cache("word codes", _Codes)
    return np.fromiter(map(held.__getitem__, words), np.uint64, len(words))


def _joined(words: list[bytes], begin: int, end: int) -> bytes:
    return b" ".join(words[begin:end])


class _Numbers(dict):
    """Numbers of the words of phrases; zero for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Automaton:
    """Phrases with the smallest document that holds each, over the numbers of their words."""

    def __init__(self, passages: list[tuple[int, bytes, np.ndarray]], length: int):
        import ahocorasick

        self.length, self.numbers = length, _Numbers()
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        number, held = self.numbers, {}
        for owner, text, spans in passages:
            codes = [number.setdefault(w, len(number) + 1) for w in text.split(b" ")]
            for begin, end in spans.tolist():
                key = tuple(codes[begin:end])
                if len(key) >= length and owner < held.get(key, NULL_FROM):
                    held[key] = owner
        for key, owner in held.items():
            self.trie.add_word(key, (len(key), owner))
        self.size = len(held)
        if held:
            self.trie.make_automaton()

    def covered(self, words: list[bytes], doc_id: int) -> np.ndarray:
        """Which words lie in a phrase of a document with a smaller id.

        A phrase can only occur where words of phrases follow each other at its length, so only such
        stretches run through the automaton.
        """
        change = np.zeros(len(words) + 1, np.int32)
        if self.size:
            numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            for begin, end in zip(*_spans(numbers > 0)):
                if end - begin >= self.length:
                    for last, (length, owner) in self.trie.iter(tuple(numbers[begin:end].tolist())):
                        if owner < doc_id:
                            change[begin + last + 1 - length] += 1
                            change[begin + last + 1] -= 1
        return np.cumsum(change[:-1]) > 0


def _spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def drop_repeated_phrases(
    df: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, starts, ends, kept``: word spans removed, and the words kept, joined by spaces."""
    kind = Symbols(length, min(GRAM, length), _words, _codes, _joined)

    def locate(docs: list[Document], passages: list[tuple[int, bytes, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(passages, length)
        rows = []
        for doc_id, text, _ in docs:
            words = _words(text)
            covered = automaton.covered(words, doc_id)
            starts, ends = _spans(covered)
            kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c] if len(starts) else words).decode("utf-8")
            rows.append((None if doc_id >= NULL_FROM else doc_id, len(words), int(covered.sum()), starts, ends, kept))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]
        columns = [pa.array(list(x), t) for x, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "starts", "ends", "kept"])

    return recurring(df, kind, locate, SCHEMA, id_col=id_col, text_col=text_col)


def phrase_digests(df: DataFrame) -> DataFrame:
    found = drop_repeated_phrases(df)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

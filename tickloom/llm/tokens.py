"""Byte-level BPE: encoding and decoding of whole texts over Arrow batches.

Bytes of a text become characters by the vocabulary's byte table, the tokenizers library merges them,
and decoding turns the table round. A cache of bounded size holds the ids of short pieces, since most
pieces of a corpus are repeats.

Defined cases: a null text is empty and has no ids; ids that are null, or outside the vocabulary,
decode to nothing; strings of special tokens are ordinary text; a character that two tokens share
belongs to both by its offsets, and decoding joins bytes before it makes characters of them. Rows are
kept as they are, repeated ones too.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import process_cache, small_batches, texts_of, type_of

#: Most pieces held by a worker, and the longest piece that is held.
HELD_PIECES, HELD_CHARS = 400_000, 48


def byte_table() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Ids, as little-endian 32-bit bytes, of pieces of text that merges never cross the ends of."""

    def __init__(self, path: str, pattern: str, before: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        self.split = regex.compile(pattern)
        self.map = {b: ord(c) for b, c in byte_table().items()}
        self.before = before

    def ids(self, piece: str) -> bytes:
        out: list[int] = []
        for match in self.split.findall(piece):
            mapped = match.encode("utf-8").decode("latin-1").translate(self.map)
            out.extend(token.id for token in self.model.tokenize(mapped))
        return np.array(out, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.ids(self.before + piece)
        if len(piece) <= HELD_CHARS:
            if len(self) >= HELD_PIECES:  # the first half came early because it is frequent
                frequent = dict(islice(self.items(), HELD_PIECES // 2))
                self.clear()
                self.update(frequent)
            self[piece] = ids
        return ids


class Encoder:
    """Ids of a text. A lone space between two other characters always starts a match of the pattern,
    so texts without double white space are cut there; other texts are cut by the pattern itself."""

    def __init__(self, path: str, pattern: str):
        self.spaced, self.plain = _Pieces(path, pattern, " "), _Pieces(path, pattern, "")
        self.pattern = regex.compile(pattern)
        self.wide = regex.compile(r"\s\s|^\s|\s$|[\x1c-\x1f]")

    def encode(self, text: str) -> np.ndarray:
        if self.wide.search(text):
            ids = b"".join(map(self.plain.__getitem__, self.pattern.findall(text)))
        else:
            first, *rest = text.split(" ")
            ids = self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))
        return np.frombuffer(ids, "<u4")


def vocabulary(path: str) -> list[bytes]:
    """Bytes of every id, by the byte table turned round."""
    back = {c: b for b, c in byte_table().items()}
    data = json.load(open(path, encoding="utf-8"))
    out = [b""] * (1 + max(data["model"]["vocab"].values()))
    for token, i in data["model"]["vocab"].items():
        out[i] = bytes(back[c] for c in token)
    for special in data.get("added_tokens", []):
        if special["id"] < len(out):
            out[special["id"]] = special["content"].encode("utf-8")
    return out


def _offsets(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one-after character of each id: the characters its bytes touch."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(sizes[ids])
    return char[ends - sizes[ids]].astype("<i4"), (char[ends - 1] + 1).astype("<i4")


def encode(
    df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """``doc_id, ids`` and, if asked for, ``starts, ends`` of each id in characters of the text."""
    docs = texts_of(df, id_col, text_col)
    schema = f"doc_id {type_of(docs, 'doc_id')}, ids array<int>" + ", starts array<int>, ends array<int>" * offsets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_cache(("encoder", path, pattern), lambda: Encoder(path, pattern))
        sizes = process_cache(("sizes", path), lambda: np.array([len(x) for x in vocabulary(path)])) if offsets else None
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            ids = [encoder.encode(x).astype("<i4") for x in texts]
            columns = [ids]
            if offsets:
                spans = [_offsets(x, i, sizes) if len(i) else (i, i) for x, i in zip(texts, ids)]
                columns += [[s for s, _ in spans], [e for _, e in spans]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(_lists, columns)], ["doc_id", "ids", "starts", "ends"][: 1 + len(columns)]
            )

    return docs.mapInArrow(run, schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.empty(0, "<i4")]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


class _Table:
    """Bytes of all ids in one array, from which those of many lists of ids are gathered."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([*map(len, tokens), 0], np.int64)  # the last stands for ids that there are not
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, lists: pa.Array) -> pa.Array:
        ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids[(ids < 0) | (ids >= len(self.sizes))] = len(self.sizes) - 1
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        data = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.firsts[ids] - (ends - sizes), sizes)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def decode(df: DataFrame, path: str, *, ids_col: str = "ids", characters: bool = False) -> DataFrame:
    """``df`` with ``decoded`` (bytes) and, if asked for, ``decoded_text`` (bytes that are no UTF-8 replaced)."""
    kept = df.select(*[c for c in df.columns if c not in ("decoded", "decoded_text")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", decoded binary"
    schema += ", decoded_text string" * characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = process_cache(("table", path), lambda: _Table(vocabulary(path)))
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                lists = part.column(part.schema.get_field_index(ids_col))
                columns = [*part.columns, table.decode(lists)]
                if characters:
                    columns.append(pa.array([x.as_py().decode("utf-8", "replace") for x in columns[-1]], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    columns, [*part.schema.names, "decoded", *["decoded_text"] * characters]
                )

    return kept.mapInArrow(run, schema)


def token_digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: count of ids, digest of the ids, digest of what they decode to."""
    both = decode(encode(df, path, pattern), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

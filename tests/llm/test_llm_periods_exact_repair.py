"""Periodic runs, exact duplicates by a stream, and repaired conversations beside plain versions."""

import os
import random
import tempfile

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import exact, periods, repair


def some_words(rng, n):
    words = [f"w{rng.randrange(rng.choice([1, 2, 3, 9]))}".encode() for _ in range(n)]
    kind = rng.random()
    if kind < 0.4 and n:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
        words = [words[min(n - 1, a + (i - a) % p)] if i >= a else words[i] for i in range(n)]
    elif kind < 0.6:
        x, y = [b"a"], [b"a", b"b"]
        while len(y) < n:
            x, y = y, y + x
        words = y[:n]
    if n and rng.random() < 0.3:
        words[rng.randrange(n)] = b"z"
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(25):
        docs = [some_words(rng, rng.choice([0, 1, 11, 12, 13, 40, 90, 200])) for _ in range(rng.randint(1, 6))]
        assert periods.document_runs(docs) == [brute.periodic_runs(w) for w in docs]


def test_transform_multiplies_exactly():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, periods.PRIME, (2, 3, 16), dtype=np.uint64)
    got = periods.transform(periods.transform(a) * periods.transform(b) % periods.PRIME, inverse=True)
    want = [[sum(int(x[j]) * int(y[(k - j) % 16]) for j in range(16)) % periods.PRIME for k in range(16)] for x, y in zip(a, b)]
    assert got.tolist() == want


def test_one_word_over_and_over_is_one_run():
    assert periods.document_runs([[b"a"] * 30_000]) == [[(0, 30_000, 1)]]
    long = [f"{i}".encode() for i in range(9_000)]
    assert periods.document_runs([long * 3, long]) == [[(0, 27_000, 9_000)], []]


def test_run_digests(spark):
    rng = random.Random(9)
    texts = [b" ".join(some_words(rng, rng.choice([0, 5, 30, 150]))).decode() for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(61, None), (62, ""), (None, "b " * 20), (63, " \t\n"), (63, " \t\n"), (64, "é ü x " * 9)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, `a.b` int")
    got = sorted((tuple(r) for r in periods.run_digests(df).collect()), key=str)
    assert got == sorted((brute.period_row(*r) for r in rows), key=str)
    assert periods.run_digests(df.limit(0)).count() == 0


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(spark, rows, path, schema="doc_id long, text string, file string, `a.b` int"):
    spark.createDataFrame([(*r, "f", 1) for r in rows], schema).coalesce(1).write.mode("append").parquet(path)


ROWS = [(1, "a"), (2, "A"), (3, "b"), (3, "B"), (None, "a"), (None, None), (4, ""), (5, "Ä"), (6, "ä"), (7, "a"), (8, "x" * 300_000), (9, "X" * 300_000)]


# The second digest is one that many texts share.
@pytest.mark.parametrize("digest", [exact.sha256, lambda data: bytes([len(data) % 2])])
def test_exact_duplicates(spark, digest):
    path = f"{folder()}/documents"
    for i in range(0, len(ROWS), 3):
        put(spark, ROWS[i : i + 3], path)
    # A batch for every file: copies are found in the state that earlier batches left.
    found = exact.deduplicate(spark, path, digest, batch_bytes=1)
    got = found.collect()
    assert sorted(map(str, [(r.doc_id, r.keep_id, r.group_size) for r in got])) == sorted(map(str, [x[:3] for x in brute.exact_rows(ROWS)]))
    # One row of each text stays, of repeated rows too, and it has the id that stays.
    assert sum(r.kept for r in got) == len({x[3] for x in brute.exact_rows(ROWS)})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_state_is_continued(spark):
    path, state = f"{folder()}/documents", folder()
    put(spark, ROWS[:5], path)
    first = {(r.keep_id, r.size) for r in exact_classes(spark, path, state)}
    assert first == {(2, 3), (3, 2)}
    put(spark, [(10, "A"), (11, "new")], path)
    assert {(r.keep_id, r.size) for r in exact_classes(spark, path, state)} == {(10, 4), (3, 2), (11, 1)}
    assert os.listdir(f"{state}/state")


def exact_classes(spark, path, state):
    exact.start(spark, path, state).awaitTermination()
    return exact.classes_of(spark, state).collect()


def test_exact_without_rows(spark):
    path = f"{folder()}/documents"
    spark.createDataFrame([], "doc_id long, text string").write.parquet(path)
    assert exact.exact_digests(spark, path).count() == 0


def turns_at_random(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "u", None]
    texts = ["a.", "b", "", "c!", " \t", "a.", "d? ", None, "é"]
    return [(rng.choice([None, 1, 1, 1, 1, 2, 3, 7, 20]), rng.choice([None, *range(30)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("seed, block", [(1, 48), (2, 2)])
def test_repairs_are_the_cheapest(seed, block, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rng = random.Random(seed)
    for _ in range(300):
        rows = [(1, t, role or " ", text or " ") for _, t, role, text in turns_at_random(rng, rng.randint(0, 12))]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        want = brute.repaired(rows)
        turns, counts = repair._turns_of([list(r[1:]) for r in rows], set())
        assert repair.cheapest(repair.part_table(turns, (repair.NONE,), True)[repair.NONE]) == want[5:7]
        assert (counts.gaps(), counts.blank, counts.duplicate, counts.truncated, counts.illegal) == want[:5]


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_repaired_conversations(spark, partitions):
    rng = random.Random(4)
    # One conversation has half of all rows: it spans many partitions.
    rows = turns_at_random(rng, 260)
    rows += [(100 + i // 4, i % 4, ["system", "user", "assistant"][i % 3], f"text {i}" + ".?x"[i % 3]) for i in range(200)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, slice string, `a.b` int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r[0]: tuple(r)[1:] for r in repair.repair_digests(df).collect()}
        found = repair.repair(repair.damaged(df))
        edits = found.edits.orderBy("part", "step").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute.repair_rows(rows)
    assert got == want
    for conv, x in want.items():
        mine = [e for e in edits if e.conv_id == conv]
        assert "".join(e.edit for e in mine) == x[6]
        assert brute.sha("\n".join(f"{e.role}:{e.text}" for e in mine if e.edit != "D")) == x[7]
    assert all((e.role is None) == (e.edit == "D") and (e.turn is None or e.edit != "I") for e in edits)


def test_repair_of_nothing_and_of_long_texts(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair_digests(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 0, "user", "a" * 2_000_000 + "."), (1, 1, "assistant", None), (None, None, None, None)]
    got = {r[0]: tuple(r)[1:] for r in repair.repair_digests(spark.createDataFrame(rows, schema)).collect()}
    assert got == brute.repair_rows(rows)
    whole = repair.repair(spark.createDataFrame([(5, i, "ua"[i % 2], "x.") for i in range(3)], schema)).conversations.select("cost", "audit", F.col("illegal")).first()
    assert tuple(whole) == (3, "KKD", 0)

"""Neighbours and chat perspectives beside brute force."""

import numpy as np

from pyspark.sql import functions as F

from tickloom.llm import chat, neighbours


def brute_nearest(rows, k, every=20):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q in good:
        if q % every == 0:
            scored = sorted(((-float(np.cumsum(good[q] * v)[-1]), i) for i, v in good.items() if i != q and len(v) == len(good[q])))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 12)).astype(np.float32)
    base[50:120] = base[50]  # a common vector: ties
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(400, None), (420, []), (440, [0.0] * 12), (460, [float("nan")] * 12), (480, [float("inf")] + [1.0] * 11), (500, [None] + [1.0] * 11), (None, [1.0] * 12), (520, [1.0, 2.0]), (521, [2.0, 1.0]), (540, [float(np.float32(1e30))] + [0.0] * 11), rows[20], rows[21]]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, size int").repartition(3)
    want = brute_nearest(rows, 20)
    for block in (neighbours.BLOCK_ROWS, 16):
        got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, block_rows=block)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_neighbours_of_rows_repeated_often(spark):
    """A near row repeated more than k times takes one place of the k, in one block and in several."""
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 12)).astype(np.float32))]
    rows += [(201 + j, (3 * np.array(rows[20 * j][1], np.float32)).tolist()) for j in range(10) for _ in range(30)]
    want = brute_nearest(rows, 20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    for block in (neighbours.BLOCK_ROWS, 64):
        got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, block_rows=block)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_neighbours_of_any_size(spark):
    """Components near both ends of what doubles hold, and vectors of one component."""
    rng = np.random.default_rng(11)
    sizes = [1.0, 1e160, 1e-160, 1e300, 1e-300, 5e-324, 1e-308]
    rows = [(i, (rng.normal(size=6) * sizes[i % len(sizes)]).tolist()) for i in range(160)]
    rows += [(200 + i, [0.0] * (i % 6) + [sizes[i % 7] * (-1) ** i] + [0.0] * (5 - i % 6)) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    good = {i: np.array(v) for i, v in rows if any(v)}
    want = []
    with np.errstate(all="ignore"):
        for q in good:
            if q % 20 == 0:
                found = {i: float(np.nan_to_num(np.cumsum(good[q] * v)[-1], nan=-np.inf, posinf=np.inf, neginf=-np.inf)) for i, v in good.items() if i != q}
                want += [(q, n, i, s) for n, (i, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:20], 1)]
    for block in (neighbours.BLOCK_ROWS, 16):
        got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, block_rows=block)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_neighbours_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(df, F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(50, 70)) * rng.exponential(size=(50, 1)), rng.normal(size=(60, 70))
    (sa, ka, la), (sb, kb, lb) = neighbours.quantise(a), neighbours.quantise(b)
    guess = neighbours._product(sa, sb) * ka[:, None] * kb[None, :]
    slack = la[:, None] * np.linalg.norm(b, axis=1) + (np.linalg.norm(a, axis=1) + la)[:, None] * lb
    assert (np.abs(guess - a @ b.T) <= slack + 1e-9).all()


def test_chat(spark):
    rows = [
        (1, 0, "system", "be brief", 0), (1, 1, "ann", "hi <|end|>", 0), (1, 2, "bob", None, 0), (1, 3, "ann", "é", 0), (1, 3, "ann", "é", 0),
        (2, 0, None, "who", 0), (2, None, " ", "first", 0), (3, 0, "system", "alone", 0), (None, 0, "x", "y", 0),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int").repartition(3)
    turns = chat.perspectives(df)
    got = {(r.conv_id, r.side): (r.text, [(m.start, m.end) for m in r.masks]) for r in chat.dialogues(turns).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (2, "unknown"), (None, "x")}
    text, masks = got[(1, "ann")]
    assert text == "<|system|>\nbe brief<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user bob|>\n<|end|>\n" + "<|assistant|>\né<|end|>\n" * 2
    assert [text[a:b] for a, b in masks] == ["hi < |end|><|end|>\n", "é<|end|>\n", "é<|end|>\n"]
    text, masks = got[(1, "bob")]
    assert [text[a:b] for a, b in masks] == ["<|end|>\n"] and "<|user ann|>\nhi" in text
    assert got[(2, "unknown")][0].startswith("<|assistant|>\nfirst")
    for r in turns.collect():
        assert got[(r.conv_id, r.side)][0][r.start : r.end] == r.rendered
    assert chat.perspectives(df.limit(0)).count() == 0

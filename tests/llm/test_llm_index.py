"""The run-length index and anchors beside brute force."""

import random

import numpy as np

from tickloom.llm import passages, runs


def test_matches_of_full_length():
    rng = random.Random(1)
    for trial in range(40):
        length, letters = rng.choice([3, 5, 8, 20]), rng.choice([1, 2, 3, 20])
        texts = [(rng.randrange(50), bytes(rng.randrange(97, 97 + letters) for _ in range(rng.randrange(length, 120)))) for _ in range(rng.randrange(1, 8))]
        texts += [(rng.randrange(50), t) for _, t in texts if trial % 3 == 0]
        index = runs.RunIndex(texts, length)
        lanes, asked = [], []
        for _ in range(12):
            text = bytes(rng.randrange(97, 98 + letters) for _ in range(90))
            cut = rng.randrange(60)
            text = (text[:cut] + rng.choice(texts)[1] + text[cut:])[: rng.randrange(1, 90)]
            lanes.append(np.concatenate([np.frombuffer(text, np.uint8).astype(np.int16) + 1, np.zeros(90 - len(text), np.int16)]))
            asked.append((rng.randrange(60), text))
        found = index.statistics(np.stack(lanes), np.array([i for i, _ in asked]))
        for (i, text), marks in zip(asked, found):
            want = [j + length <= len(text) and any(w < i and text[j : j + length] in t for w, t in texts) for j in range(90)]
            assert list(marks) == want


def test_runs_are_fewer_than_rows_in_repetitive_texts():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 101, 2000, dtype=np.uint8).tobytes()
    index = runs.RunIndex([(i, text[i:] + text[:i]) for i in range(20)], 50)
    assert len(index.starts) < 0.15 * index.n


def test_equal_windows_have_equal_anchors():
    kind = passages.Symbols(13, 5, None, None, None)
    rng = np.random.default_rng(3)
    shared = rng.integers(1, 1 << 60, 13, dtype=np.uint64)
    for _ in range(30):
        docs = [np.concatenate([rng.integers(1, 1 << 60, rng.integers(0, 9), dtype=np.uint64), shared, rng.integers(1, 1 << 60, rng.integers(0, 9), dtype=np.uint64)]) for _ in range(2)]
        hashes = [set(passages.Batch(kind, [d]).anchors()[1].tolist()) for d in docs]
        assert hashes[0] & hashes[1]
    assert len(passages.Batch(kind, []).anchors()[0]) == 0
    assert len(passages.Batch(kind, [np.ones(12, np.uint64)]).anchors()[0]) == 0


def test_arrays_round_trip():
    a, b = np.arange(5, dtype=np.int64), np.array([1, 1 << 39, 7, 0, 3], np.uint64)
    got = passages.read_arrays(passages.write_arrays((a, 4), (b, 5)), 4, 5)
    assert [x.tolist() for x in got] == [a.tolist(), b.tolist()]


def anchor_part(rng, docs, contexts, anchor=77):
    """What one batch sends of an anchor: a class each."""
    n = len(contexts)
    return passages.write_arrays(
        (np.full(n, anchor, np.uint64), 5), (np.array(contexts, np.uint64), 6), (np.array(docs, np.int64).view(np.uint64), 8), (np.arange(n, dtype=np.uint64), 4)
    )


def test_buckets_hold_what_differs():
    """An anchor in every batch, with the same or ever new surroundings: no more is held after 400 batches than after 50."""
    kind = passages.Symbols(13, 5, None, None, None)
    for fresh in (False, True):
        held = {}
        for count in (50, 400):
            rng = random.Random(9)
            bucket = passages.AnchorBucket(kind, 4)
            contested = 0
            for n in range(count):
                contexts = [4 * n + k for k in range(4)] if fresh else [1, 2, 3]
                rows = bucket.fold([anchor_part(rng, [rng.randrange(1 << 40) for _ in contexts], contexts)], last=False)
                contested += sum(len(passages.read_arrays(r[2], *passages.PLACES)[0]) for r in rows if r[0] == passages.CONTESTED)
            held[count] = len(bucket.held[0]) + len(bucket.open)
            assert contested == (4 * count if fresh else 0)
        assert held[50] == held[400] <= 5
        window = passages.WindowBucket(kind, 4)
        for n in range(400):
            columns = [(np.array([5, 6], np.uint64), 8), (np.array([n, 900 - n], np.uint64), 8), (np.array([1, 1], np.uint64), 4), (np.array([n % 4] * 2, np.uint64), 4)]
            window.fold([passages.write_arrays(*columns)], last=False)
        assert window.held[1].tolist() == [0, 501]


def test_folding_asks_a_smaller_document_for_each():
    """However the records come in, a document reaches the smallest of its class by asking."""
    kind = passages.Symbols(13, 5, None, None, None)
    rng = random.Random(10)
    for trial in range(60):
        records = [(rng.randrange(8), rng.randrange(3), rng.randrange(12)) for _ in range(rng.randrange(1, 40))]
        bucket, shards = passages.AnchorBucket(kind, 1_000_003), 1_000_003
        asked, contested, at = set(), set(), 0
        while at <= len(records):
            some = records[at : at + rng.randrange(1, 6)] if at < len(records) else []
            at += max(len(some), 1)
            # Places tell the class of a record.
            part = passages.write_arrays(
                (np.array([r[0] for r in some], np.uint64), 5), (np.array([r[1] for r in some], np.uint64), 6),
                (np.array([r[2] for r in some], np.uint64), 8), (np.array([100 * r[0] + 10 * r[1] for r in some], np.uint64), 4),
            )
            for what, _, data in bucket.fold([part] if some else [], last=at > len(records)):
                if what == passages.REQUEST:
                    owner, first, _, target = passages.read_arrays(data, *passages.REQUESTS)
                    asked |= set(zip((first.astype(int) - passages.SHIFT + kind.pad).tolist(), owner.tolist(), target.tolist()))
                else:
                    doc, place = passages.read_arrays(data, *passages.PLACES)
                    contested |= set(zip(doc.tolist(), place.tolist()))
        shard = {d: int(passages.shard_of(np.array([d]), shards)[0]) for d in range(12)}
        assert len(set(shard.values())) == 12
        for anchor, context, doc in records:
            place = 100 * anchor + 10 * context
            same = {d for a, c, d in records if (a, c) == (anchor, context)}
            assert doc == min(same) or any((place, d, shard[doc]) in asked for d in same if d < doc)
            kin = [(c, d) for a, c, d in records if a == anchor]
            if len({c for c, _ in kin}) > 1 and len({d for _, d in kin}) > 1:
                assert (min(same), place) in contested


def test_no_document_answers_for_many_shards():
    """A class in every shard: each shard asks once, a smaller document each time, none for more than the fan-out."""
    kind = passages.Symbols(13, 5, None, None, None)
    rng = random.Random(11)
    docs = rng.sample(range(1 << 40), 3_000)
    for bucket in (passages.AnchorBucket(kind, 700, 4), passages.WindowBucket(kind, 700, 4)):
        if isinstance(bucket, passages.AnchorBucket):
            part = anchor_part(rng, docs, [1] * len(docs))
        else:
            ones = np.ones(len(docs), np.uint64)
            ids = np.array(docs, np.int64)
            part = passages.write_arrays((ones, 8), (ids.view(np.uint64), 8), (ones, 4), (passages.shard_of(ids, 700).view(np.uint64), 4))
        pairs = []
        for what, key, data in bucket.fold([part], last=True):
            assert what == passages.REQUEST
            owner, _, _, target = passages.read_arrays(data, *passages.REQUESTS)
            assert set(passages.shard_of(owner.view(np.int64), 700).tolist()) == {key}
            pairs += zip(owner.tolist(), target.tolist())
        least = {}
        for d in sorted(docs)[1:]:
            least.setdefault(int(passages.shard_of(np.array([d]), 700)[0]), d)
        assert sorted(t for _, t in pairs) == sorted(least)
        assert all(owner < least[t] for owner, t in pairs)
        owners = [owner for owner, _ in pairs]
        assert max(owners.count(x) for x in set(owners)) == 4


def test_shared_lengths_look_at_each_pair_once(monkeypatch):
    """Both neighbours of a match are measured in one call, and as a plain comparison would."""
    import random

    import numpy as np

    from tickloom.llm.runs import RunIndex, _lanes

    rng = random.Random(8)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 300))) for _ in range(12)]
    index = RunIndex([(i, t) for i, t in enumerate(texts)], 50)
    a, b, most = (np.array([rng.randrange(n) for _ in range(400)]) for n in (index.n, index.n, 51))

    def plain(x, y, limit):
        k = 0
        while k < limit and x + k < index.n and y + k < index.n and index.text[x + k] == index.text[y + k] != 0:
            k += 1
        return k

    assert index._shared(a, b, most).tolist() == [plain(*x) for x in zip(a, b, most)]
    calls, turns, shared, turn = [], [], index._shared, index._turn
    monkeypatch.setattr(index, "_shared", lambda *x: calls.append(1) or shared(*x), raising=False)
    monkeypatch.setattr(index, "_turn", lambda *x: turns.append(1) or turn(*x), raising=False)
    data = np.frombuffer(texts[3], np.uint8).astype(np.int16) + 1
    lanes, _, which = _lanes(data, np.array([0]), np.array([len(data) - 49]), 50)
    index.statistics(lanes, np.full(len(which), 99))
    assert turns and len(calls) <= len(turns)


def peak_mb(work):
    """Result, and MB that numpy and Python held at most meanwhile."""
    import tracemalloc

    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_short_texts_with_a_common_passage_take_little_room():
    """A shard of 20,000 short texts: lanes are as wide as the texts, and a group of them is there at once."""
    rng = np.random.default_rng(4)
    common = rng.integers(97, 123, 60, dtype=np.uint8).tobytes()
    raw = [rng.integers(65, 91, 2 * 45, dtype=np.uint8).tobytes() for _ in range(20_000)]
    raw = [x[: i % 45] + common + x[45:] for i, x in enumerate(raw)]
    kind = passages.Symbols(50, 20, runs._encoded, runs._codes, runs._joined)
    covered, peak = peak_mb(lambda: runs._covered(kind, list(range(1, len(raw) + 1)), raw, [(0, common)]))
    for i, marks in enumerate(covered):
        assert np.flatnonzero(marks).tolist() == list(range(i % 45, i % 45 + 60))
    assert peak < 80, peak


def test_contested_windows_are_worked_on_in_parts(monkeypatch):
    """A passage contested in all texts of a shard: the same rows as from one part, without arrays over the whole shard."""
    rng = np.random.default_rng(5)
    kind = passages.Symbols(50, 20, runs._encoded, runs._codes, runs._joined)
    common = rng.integers(97, 123, 300, dtype=np.uint8).tobytes().decode()
    docs = []
    for i in range(1_200):
        own = rng.integers(65, 91, 2_000, dtype=np.uint8).tobytes().decode()
        docs.append(passages.Document(i // 2 if i < 8 else i, own[: i % 900] + common + own[900:], ""))
    places = []
    for i, text, _ in docs:
        batch = passages.Batch(kind, [runs._codes(text.encode())])
        at = batch.anchors()[0] - batch.starts[0]
        at = at[(at >= text.index(common)) & (at < text.index(common) + 280)]
        places.append(passages.write_arrays((np.full(len(at), i, np.uint64), 8), (at.astype(np.uint64), 4)))
    got, peak = peak_mb(lambda: passages._window_rows(kind, docs, places, 3, 5, 1))
    monkeypatch.setattr(passages, "PART_SYMBOLS", 1 << 40)
    want, _ = peak_mb(lambda: passages._window_rows(kind, docs, places, 3, 5, 1))
    assert got == want and {r[0] for r in got} == {passages.REQUEST, passages.RECORD}
    assert peak < 100, peak


def test_free_memory_goes_back():
    """What a worker has freed is no longer its own after the last batch."""
    import pyarrow as pa

    from tickloom.llm.common import small_batches

    def own_mb():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 / 1e6

    batches = list(small_batches([pa.record_batch({"text": ["a", "b"]})]))
    assert [b.num_rows for b in batches] == [2]
    held = [np.ones(12_000) for _ in range(2_000)]  # 192 MB in pieces below the size that is mapped by itself
    last = np.ones(10)
    before = own_mb()
    del held[:-1]
    list(small_batches(batches))
    assert own_mb() < before - 150 and last.sum() == 10

"""The subpackage's queries: those with a SQL twin beside it, the pipeline beside plain Python."""

import os
import sys

import brute
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
from compare import compare, database  # noqa: E402

import corpus_pipeline  # noqa: E402
from tickloom.llm import quality  # noqa: E402
from tickloom.llm.queries import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    problem, _ = compare(spark, database(FOLDER), QUERIES[name], ORACLE[name], FOLDER)
    assert problem is None, problem


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "personal_data", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = steps["quality_rules"](spark, docs, FOLDER)
    want = {r.doc_id for r in quality.verdicts(docs).where("kept").collect()}
    assert kept.columns == columns and {r.doc_id: r.text for r in kept.collect()} == {i: texts[i] for i in want}

    one = steps["near_duplicates"](spark, kept, FOLDER)
    rows = [(i, texts[i]) for i in sorted(want)]
    stay = {c for _, _, c in brute.components(rows)}
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted(stay)

    cut = steps["repeated_passages"](spark, one, FOLDER)
    raw = [(i, texts[i].encode()) for i in sorted(stay)]
    left = {}
    for (i, b), marks in zip(raw, brute.repeated(raw, 50)):
        text = bytes(x for x, m in zip(b, marks) if not m).decode("utf-8", "ignore")
        if brute.WORD.search(text):
            left[i] = text
    assert cut.columns == columns and {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == {i: (t, len(t)) for i, t in left.items()}

    safe = steps["personal_data"](spark, cut, FOLDER)
    got = {r.doc_id: r.text for r in safe.collect()}
    assert safe.columns == columns and set(got) == set(left)
    assert not any(brute.private_spans(t) for t in got.values())

    packed = steps["packing"](spark, safe, FOLDER).collect()
    assert {r.doc_id for r in packed} == set(got)
    assert entry.queries()["pipeline"](spark, FOLDER).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0

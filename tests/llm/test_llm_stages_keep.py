"""Stages of the pipeline hand on all columns and all rows that they do not decide about."""

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))
import corpus_pipeline  # noqa: E402

SCHEMA = (
    "doc_id long, text string, n_chars long, at timestamp, raw binary, counts map<int,string>, `a.b` double, `key` int, rest string, "
    "`row` struct<x:int,`y.z`:array<string>>, root string, spans int, fingerprint long, `odd ``name` date"
)


def words(n, start=0):
    return " ".join(f"word{start + i}x{(start + i) * 7919 % 1000}" for i in range(n))


def rows():
    texts = {
        1: words(40),
        2: words(40, 1000) + " contact me@mail.org today",
        3: words(30, 2000) + " " + words(30, 3000),
        4: words(30, 4000) + " " + words(30, 3000),
        5: words(40, 1000) + " contact me@mail.org today",
        6: " \n\t ",
        7: None,
        8: "",
    }
    out = []
    for i, t in texts.items():
        out.append((i, t, None if t is None else len(t), datetime(2024, 1, 1, 0, 0, i, 123456 + i), bytes([0, 255, i]), {i: "v", -1: None}, i / 3, i, None, (i, ["p", None]), "r", i, i, None))
    # The id of another row with another text, and a row without an id.
    out.append((1, words(40, 7000), 5, *out[0][3:]))
    out.append((None, words(40, 8000), None, *out[0][3:]))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def plain(df):
    return sorted((repr(tuple(r.asDict(True).items())) for r in df.collect()))


STAGES = dict(corpus_pipeline.STAGES)


def test_quality_keeps_rows_as_they_are(spark, docs):
    got = STAGES["quality_rules"](spark, docs, "")
    assert got.dtypes == docs.dtypes
    assert plain(got) == plain(docs.where("length(text) > 50"))


def test_one_of_each_keeps_texts_of_equal_ids(spark, docs):
    got = STAGES["near_duplicates"](spark, docs, "")
    assert got.dtypes == docs.dtypes
    # 5 is a copy of 2; the texts without words are one group, of which 6 stays.
    assert plain(got) == plain(docs.where("doc_id is null or doc_id not in (5, 7, 8)"))
    again = docs.unionByName(docs.withColumn("a.b", F.lit(9.0))).repartition(7)
    assert [r[:2] for r in sorted(map(repr, STAGES["near_duplicates"](spark, again.where("doc_id = 3"), "").collect()))] == [r[:2] for r in sorted(map(repr, docs.where("doc_id = 3").collect()))]


def test_repeats_keep_untouched_rows(spark, docs):
    got = STAGES["repeated_passages"](spark, docs, "")
    assert got.dtypes == docs.dtypes
    # Rows 4 and 5 repeat passages of 3 and 2; of 5 nothing is left.
    assert plain(got.where("doc_id is null or doc_id <> 4")) == plain(docs.where("doc_id is null or doc_id not in (4, 5)"))
    (four,) = got.where("doc_id = 4").collect()
    (before,) = docs.where("doc_id = 4").collect()
    assert four.n_chars == len(four.text) < before.n_chars and words(20, 4000) in four.text
    assert four.asDict() | {"text": 0, "n_chars": 0} == before.asDict() | {"text": 0, "n_chars": 0}


def test_masking_keeps_untouched_rows(spark, docs):
    got = STAGES["personal_data"](spark, docs, "")
    assert got.dtypes == docs.dtypes
    assert plain(got.where("doc_id is null or doc_id not in (2, 5)")) == plain(docs.where("doc_id is null or doc_id not in (2, 5)"))
    assert all("<email>" in r.text and r.n_chars == len(r.text) for r in got.where("doc_id in (2, 5)").collect())

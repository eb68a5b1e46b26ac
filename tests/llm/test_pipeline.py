"""The chained stages: whole rows, columns with clashing names, decisions that take effect, empty tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.common import shared_folder, stored
from llm.mixing import mixed
from tests.llm.corpus import text, words

# Names that the operators use inside, beside those of documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did string, tkey string, doc int, removed string, size string, row int, _text string"
BENCHMARK = "item_id string, text string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(31)
    plain = [text(rng, rng.choice([90, 150, 260])) for _ in range(40)]
    phrase = " ".join(words(rng, 30))
    line = "a line that stands in many texts and is said only once " * 2
    texts = [*plain, " ".join(plain[3].split()), plain[4] + " more", None, "", "too short", phrase + " " + phrase, *[f"{t}\n{line}" for t in plain[10:20]]]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["a", "a", "b", None]), len(t or ""), f"d{i}", "k", i, "r", "s", 7, "t") for i, t in enumerate(texts)]
    return rows, [("q1", phrase), ("q2", None), (None, "x")]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows[0], SCHEMA).repartition(3).write.parquet(str(out / "documents.parquet"))
    spark.createDataFrame(rows[1], BENCHMARK).write.parquet(str(out / "benchmark.parquet"))
    return str(out)


def test_stages_keep_whole_rows_and_take_effect(spark, rows, folder):
    given = {r[0]: r for r in rows[0]}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name.replace(" ", "-"))
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        kept[name] = {r.doc_id: tuple(r) for r in docs.collect()}
        for i, r in kept[name].items():  # all but text and its length is what was given
            assert r[0] == i and r[2:4] + r[5:] == given[i][2:4] + given[i][5:]
    quality, lines, near, clean = kept.values()
    assert {42, 43, 44}.isdisjoint(quality) and {0, 10, 40} <= set(quality) and all(r == given[i] for i, r in quality.items())
    said = "a line that stands in many texts and is said only once"
    assert set(lines) == set(quality) and sum(said in (r[1] or "") for r in lines.values()) == 1
    assert all(r[4] == len(r[1]) for i, r in lines.items() if r[1] != quality[i][1])
    assert {3, 40} & set(near) == {3} and near.items() <= lines.items()
    assert 45 not in clean and clean.items() <= near.items() and len(clean) > 30


def test_run_ends_with_the_mix(spark, rows, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ") if c.split()[0] != "size"] + ["size", "target", "copies", "taken"]
    found = out.collect()
    assert len(found) > 20 and all(1 <= r.copies <= 3 and r.taken == r.copies * r["size"] for r in found)
    assert Counter(r.doc_id for r in found) == Counter({r.doc_id for r in found})


def test_empty_tables_pass_through(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], BENCHMARK).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_mix_of_repeated_rows_and_clashing_names(spark):
    rows = [(1, "a b c", "x", 9, 1.0), (1, "a b c", "x", 9, 1.0), (2, None, None, 8, 2.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row int, target double")
    got = mixed(df)
    assert got.columns == ["doc_id", "text", "source", "row", "size", "target", "copies", "taken"]
    assert {(r.doc_id, r.row, r["size"]) for r in got.collect()} <= {(1, 9, 3)}


def test_intermediates_lie_in_the_shared_folder(spark):
    df = stored(spark.range(3), "t")
    assert df.stored_at.startswith(shared_folder(spark)) and df.agg(F.sum("id")).first()[0] == 3

"""The pipeline against plain versions of its stages, and the numbered queries as they are registered."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from rankweave.llm import queries
from rankweave.llm.jaccard import join_similar
from rankweave.llm.quality import judge_quality
from rankweave.llm.secrets import redact, scan_secrets
from rankweave.runtime import stored

FOLDER = "/root/testdata/sf0.001"
NUMBERS = {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES}


def test_all_operators_are_registered():
    import __spark_entry__ as contract

    assert NUMBERS == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_each_stage_does_its_operators_work(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()} if name != "packing" else {}
        after = stored(stage(spark, docs, FOLDER), name)
        rows = after.collect()
        if name == "quality":
            kept = {r["doc_id"] for r in judge_quality(docs).where("kept").collect()}
            assert {r["doc_id"] for r in rows} == kept and all(r == before[r["doc_id"]] for r in rows)
        if name == "near_copies":
            classes = {r["doc_id"]: r["class_id"] for r in join_similar(docs).collect()}
            assert {r["doc_id"] for r in rows} == set(classes.values()) and len(rows) == len(set(classes.values()))
        if name == "secrets":
            spans = {r["doc_id"]: r["spans"] for r in scan_secrets(docs).collect()}
            assert len(rows) == len(before)
            for r in rows:
                assert r["text"] == redact(before[r["doc_id"]]["text"], spans[r["doc_id"]])
                assert r["n_chars"] == len(r["text"])
        if name == "mixing":
            copies = Counter(r["doc_id"] for r in rows)
            assert max(copies.values()) == 2 and all(r == before[r["doc_id"]] for r in rows)
            words = sum(len(r["text"].split()) for r in rows)
            assert words == pytest.approx(1.5 * sum(len(r["text"].split()) for r in before.values()), rel=0.1)
        if name != "packing":
            assert after.columns == columns
            docs = after
        else:
            repeats = Counter()
            for r in rows:
                repeats[r["doc_id"]] += r["start"] == 0
            assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}[i] * n for i, n in repeats.items())
            assert repeats == Counter(r["doc_id"] for r in docs.collect())
        sizes.append(len(rows))
    assert sizes[1] <= sizes[0] and sizes[2] < sizes[1]


def test_stages_take_odd_tables(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, doc string, copies string"
    prose = " ".join(f"word{i}" for i in range(80))
    rows = [(1, prose, "en", "a"), (1, prose, "en", "a"), (2, prose, None, None), (None, None, None, None), (3, "", "en", "a"), (4, "token = abcdefgh " + prose[::-1], "en", "a")]
    odd = spark.createDataFrame([(*r, len(r[1] or ""), "x", "y", "z") for r in rows], schema)
    for table in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, FOLDER)
            assert stage is corpus_pipeline.packing or out.columns == table.columns
            assert out.count() <= 2 * table.count() + 6
    assert corpus_pipeline.near_copies(spark, odd, FOLDER).count() == 4
    (found,) = corpus_pipeline.secrets(spark, odd.where("doc_id = 4"), FOLDER).collect()
    assert found["text"].startswith("[secret] ") and found["n_chars"] == len(found["text"]) and found["row"] == "x"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    from tools.compare import oracle_rows, spark_rows

    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == oracle_rows(FOLDER, queries.ORACLES[name])

"""Registered queries against their SQL, the pipeline, and what the rest of the library may import."""

import pathlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tastebud.llm import mixing, piece_viterbi
from tastebud.llm import queries as Q
from tests.llm import brute as B
from tests.oracle_check import canon, duck

SF = "/root/testdata/sf0.01"
ROOT = pathlib.Path(__file__).parents[2]


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_its_sql(spark, name):
    got, want = E.queries()[name](spark, SF).toPandas(), duck(SF).execute(Q.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE)))
def test_query_returns_a_row_for_every_row(spark, name):
    out = E.queries()[name](spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.where(F.col("doc_id").isNull()).count() == 0


def test_the_verdict_of_a_bad_host_takes_its_good_documents(spark):
    rows = E.queries()["bad_host_rules"](spark, SF).collect()
    bad = [r for r in rows if r.doc_id % 25 == 0]
    assert not any(r.kept for r in bad) and any(not r.base_failed for r in bad)
    assert all(r.kept != r.base_failed for r in rows if r.doc_id % 25)


def test_native_operators_run_no_python(spark):
    for name in ("op1_quality_rules", "bad_host_rules", "op4_license_dice", "op9_mixing"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_all_operators_and_the_pipeline_are_registered():
    names = list(E.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, now = [], docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, SF)
        if i < 4:
            assert now.columns == docs.columns, name
            kept.append([r.doc_id for r in now.select("doc_id").collect()])
    quality, rules, dedup, mixed = kept
    bad = [d for d, q in labels.items() if q == 0]
    assert len(set(bad) & set(quality)) < 0.05 * len(bad) and all(d in set(quality) for d, q in labels.items() if q == 1)
    text = {r.doc_id: r.text for r in docs.collect()}
    # no host fails as a whole here, so the rules keep what its own counts keep
    assert sorted(rules) == sorted(d for d in quality if not B.base_stats(text[d])["base_failed"])
    order = sorted(rules)
    assert sorted(dedup) == sorted(set(B.hamming_components(order, [B.simhash(text[d]) for d in order])))
    assert len(dedup) == len(set(dedup)) < len(rules)
    kept_docs = docs.where(F.col("doc_id").isin(dedup))
    copies = {r.doc_id: r.copies for r in mixing.mix_sizes(kept_docs).collect()}
    assert sorted(mixed) == sorted(d for d, n in copies.items() for _ in range(n)) and len(mixed) > len(set(mixed))
    out = now.collect()
    assert sorted(r.doc_id for r in out) == sorted(mixed) and all(r.n_tokens == len(r.ids) > 0 for r in out)
    table = piece_viterbi.load_pieces()
    for r in out[:50]:
        ids = np.array(r.ids, np.int64)
        assert piece_viterbi.decode_ids(ids, np.array([len(ids)]), table).to_pylist() == [text[r.doc_id]]
    assert corpus_pipeline.run(spark, SF).count() == len(out)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tastebud").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tastebud.llm" not in path.read_text(), path

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from riskfeat.llm import queries
from riskfeat.llm.common import save, table
from tests.llm.helpers import SCHEMA, SF, awkward, documents
from tests.llm.test_near_dedup import brute
from tests.llm.test_tokens_packing import check_packed, whole

ROOT = Path(__file__).resolve().parents[2]


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = save(spark, stage(spark, docs, SF), name)
        kept[name] = {x.doc_id: x for x in docs.collect()} if name != "packing" else docs.toPandas()
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    all_docs = table(spark, SF, "documents").count()
    assert 0.5 * all_docs < len(kept["quality"]) <= all_docs
    assert kept["line_dedup"].keys() == kept["quality"].keys()
    rows = sorted((i, x.text) for i, x in kept["line_dedup"].items())
    group, _ = brute(rows, 5)
    assert kept["near_dedup"].keys() == {rows[g][0] for g in group}
    assert kept["decontaminate"].keys() < kept["near_dedup"].keys()
    texts = {i: whole(x.text) + [1] for i, x in kept["decontaminate"].items()}
    assert check_packed(kept["packing"], texts, 4096) == Counter({i: len(t) for i, t in texts.items()})


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_on_awkward_and_empty_tables(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    got = stage(spark, documents(spark, awkward()), SF)
    assert got.count() > 0
    assert stage(spark, spark.createDataFrame([], SCHEMA), SF).count() == 0


def test_run_writes_and_reads_each_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    row = lambda df: sorted(map(str, df[cols].itertuples(index=False, name=None)))
    assert row(want) == row(got)


def test_the_rest_works_without_these_operators():
    code = ("import sys, types; sys.modules['riskfeat.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q)\n"
            "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_registered():
    assert {int(k[2:].split("_")[0]) for k in queries.QUERIES} == set(range(1, 14))

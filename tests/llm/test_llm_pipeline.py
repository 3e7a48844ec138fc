"""The pipeline's contract, the registered queries, and the entry without the subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from llm_helpers import odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import simhash
from marketlake.llm.queries import ORACLES, QUERIES
from tools.oracle_check import _digest

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
SF = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "bpe"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols, rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert _digest(df.columns, [tuple(r) for r in df.collect()])[0] == _digest(cols, rows)[0]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert after.columns == columns, name
            assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "line_dedup":
            assert after.count() == before.count()
            assert after.where("n_chars != length(text)").count() == 0
        if name == "near_dedup":
            prints = [r.fingerprint % (1 << 64) for r in simhash.with_fingerprints(after.select("doc_id", "text")).collect()]
            assert all((a ^ b).bit_count() > 3 for n, a in enumerate(prints) for b in prints[n + 1:])
        before = after
    assert before.agg(F.min("exact")).first()[0] is True
    assert corpus_pipeline.run(spark, SF).count() == before.count()


def test_stages_bear_odd_rows(spark, tmp_path):
    labels, bench = spark.createDataFrame([(i, i % 2, 0) for i in range(15)], "doc_id long, quality int, toxic int"), [(1, "line one is here")]
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_documents(spark, "id body key fingerprint seg h1 keep score p_text p_meta p_toxic is_toxic n_removed whole_row ids hit")
    for df in (docs, docs.limit(0)):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, df, str(tmp_path))
            if i < 4:
                assert out.columns == df.columns, name
                own = df.columns[5:]
                assert all(r == ("own",) * len(own) for r in out.select(*own).collect()), name
            assert out.count() <= df.count()


def test_entry_without_the_subpackage(tmp_path):
    for name in ("marketlake", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'feature_table' in q and not any(n.startswith('op') for n in q); e.oracle_sql()"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=False).returncode == 0


def test_entry_without_a_third_party_module():
    """What the subpackage imports may be missing: the other queries stay."""
    code = ("import sys, warnings; sys.modules['xxhash'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as e; q = e.queries(); "
            "assert 'feature_table' in q and not any(n.startswith('op') for n in q)")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=False).returncode == 0

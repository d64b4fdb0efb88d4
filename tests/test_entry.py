from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("missing", ["xxhash", "zstandard", "wordloom.llm", "corpus_pipeline"])
def test_the_other_queries_stay_without_the_training_data_operators(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); print('A1_corpus_wer' in q, 'pipeline' in q)"
    got = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    assert got.stdout.split() == ["True", "False"]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_flagship_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    cur = con.execute(entry.oracle_sql()["A1_corpus_wer"])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in cur.fetchall())
    df = entry.entry(spark)
    assert sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect()) == want

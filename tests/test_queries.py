import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from siltbed.plans.queries import QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return bytes(v) if isinstance(v, bytearray) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    cur = db.execute(SQL[name])
    names = [d[0] for d in cur.description]
    want = [dict(zip(names, map(plain, r), strict=True)) for r in cur.fetchall()]
    got = [{k: plain(v) for k, v in r.asDict().items()} for r in df.collect()]
    assert sorted(df.columns) == sorted(names)
    text = lambda rows: sorted(repr(sorted(r.items())) for r in rows)
    assert text(got) == text(want) and got


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(SQL) <= set(entry.queries())


def test_without_the_llm_folders(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".*"))
    code = "import __spark_entry__ as e; assert 'q08_merge_full' in e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})


def test_a_source_that_differs_is_told(spark, tmp_path):
    rows = [(0, "click"), (1, "click"), (2, "click"), (3, "view"), (4, "view"), (5, "click"), (6, None)]
    spark.createDataFrame(rows, "event_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    want = [(0, 2, True), (1, 2, True), (2, 1, False)]
    assert sorted(map(tuple, QUERIES["q41_source_verdicts"](spark, str(tmp_path)).collect())) == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(db.execute(SQL["q41_source_verdicts"]).fetchall()) == want

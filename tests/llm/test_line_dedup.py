import hashlib
from collections import Counter

import pytest
from helpers import lower, made_up

from siltbed.llm.common import Scratch
from siltbed.llm.line_dedup import LineRuns, dedup_lines, line_hashes

WS = " \t\n\x0b\x0c\r"


def plain(docs, least):
    keys = Counter()
    for _, t in docs:
        keys.update({k for x in (t or "").split("\n") if (k := lower(x.strip(WS)))})
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keys[lower(x.strip(WS))] < least]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least, batches, fanout", [(2, 1, 2), (3, 4, 2), (3, 5, 3), (10, 4, 2)])
def test_against_a_plain_version(spark, least, batches, fanout):
    docs = [*made_up(80), (300, "İ Line \nSHARED line\x0b"), (301, "\n\n shared LINE\n"), (301, "other row\nshared line"), (None, "shared line\nx")]
    got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), least, batches, fanout).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, least)


def test_columns_stay_and_clashing_names_are_replaced(spark):
    df = spark.createDataFrame([(i, "a\nb" if i else "c", 7, "x", "y", "z") for i in range(3)], "doc_id long, text string, n_lines int, hi string, batch string, id string")
    got = dedup_lines(df, 2)
    assert got.columns == ["doc_id", "text", "hi", "batch", "id", "n_lines", "n_dropped"]
    assert [(r["text"], r["n_lines"], r["hi"], r["id"]) for r in got.orderBy("doc_id").collect()] == [("c", 1, "x", "z"), ("", 2, "x", "z"), ("", 2, "x", "z")]
    assert dedup_lines(df.where("false"), 2).count() == 0


def test_levels_compact_and_settle(spark):
    docs = spark.createDataFrame([(i, f"common\nonly {i}\nsome {i // 4}") for i in range(32)], "doc_id long, text string")
    lines = line_hashes(docs, 8)
    lines.cache()
    runs = LineRuns(Scratch(spark, "test"), threshold=10, fanout=2)
    for b in range(8):
        runs.add(lines.where(f"batch = {b}"))
    assert sum(len(x) for x in runs.levels) <= 4 and runs.settled
    assert runs.frequent().count() == 1
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_meet_in_merge_joins_that_neither_move_nor_sort_them(spark):
    docs = spark.createDataFrame([(i, f"common\nonly {i}\nsome {i // 4}") for i in range(40)], "doc_id long, text string")
    lines = line_hashes(docs, 4)
    lines.cache()
    runs = LineRuns(Scratch(spark, "test"), threshold=5, fanout=3)
    for b in range(2):
        runs.add(lines.where(f"batch = {b}"))
    assert len(runs.levels[0]) == 2
    with runs._in_order():
        merged, fresh = plan_of(runs.merged(*runs.levels[0])), plan_of(runs.fresh(lines.where("batch = 2")))
    assert "SortMergeJoin" in merged and "Exchange" not in merged and "Sort [" not in merged
    # only the batch is moved and sorted, and once
    assert fresh.count("SortMergeJoin") == 2 and fresh.count("Exchange hashpartitioning") == 1 and fresh.count("Sort [") == 1
    assert sorted(map(tuple, runs.merged(*runs.levels[0]).groupBy().count().collect())) == [(len({tuple(r) for r in lines.where("batch < 2").select("hi", "lo").collect()}),)]


def test_a_store_goes_on_where_it_was(spark, tmp_path):
    store, made = f"file://{tmp_path}/store", list(dict(made_up(60)).items())
    first, second = [made[:30], made[30:]]
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, dedup_lines(df(first), 3, batches=3, store=store).collect()), key=str) == plain(first, 3)
    got = sorted(((r["doc_id"], r["text"]) for r in dedup_lines(df(second), 3, batches=2, store=store).collect()), key=str)
    ids = [i for i, _ in second]
    assert got == sorted(((i, t) for i, t, _, _ in plain(made, 3) if i in ids), key=str)
    # a store made with other partitions is met by moving the batch to its buckets
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        third = dedup_lines(df([(900, "Shared line\nnew"), (901, "new"), (902, "new")]), 3, store=store).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r["doc_id"], r["text"]) for r in third) == [(900, ""), (901, ""), (902, "")]


def test_hot_lines_stay_where_they_are(spark, monkeypatch):
    from siltbed.llm import line_dedup as ld

    docs = [*made_up(80), *((500 + i, f"hot line\nown {i}") for i in range(40))]
    for hot in (1, 10**9):
        monkeypatch.setattr(ld, "HOT", hot)
        got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), 10).collect()
        assert sorted(map(tuple, got), key=str) == plain(docs, 10)

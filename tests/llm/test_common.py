import random

import pyarrow as pa
from helpers import components as plain
from helpers import made_up, words
from pyspark.sql import functions as F

from siltbed.llm.common import Scratch, Words, bound_batches, carried, components, pieces, shared_dir, unpacked


def test_words_are_those_of_the_pattern_and_hash_alike():
    texts = [t for _, t in made_up()] + ["a\x0bb\x0cc\rd\x1ce\xa0f", "", None]
    w = Words([None if t is None else t.encode() for t in texts])
    seen = {}
    for d, t in enumerate(texts):
        got = [w.text(i).decode() for i in range(w.first[d], w.first[d + 1])]
        assert got == words(t)
        for i, x in zip(range(w.first[d], w.first[d + 1]), got, strict=True):
            assert seen.setdefault(x, w.hash[i]) == w.hash[i]
    assert len(set(seen.values())) == len(seen)


def test_pieces_keep_all_rows_and_bound_their_size():
    texts = ["x" * n for n in (0, 5, 100, 3, 3, 3, 50)] + [None]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], names=["i", "text"]).slice(1)
    got = list(pieces([batch], most=10))
    assert [x for b in got for x in b.column("i").to_pylist()] == list(range(1, 8))
    assert all(b.num_rows == 1 or sum(len(x or "") for x in b.column("text").to_pylist()) <= 10 for b in got)


def test_components_of_chains_stars_and_random_graphs(spark):
    rnd = random.Random(5)
    chain = [(i, i + 1) for i in range(1000, 1300)]
    star = [(2000, 2000 + i) for i in range(1, 300)]
    noise = [(rnd.randint(0, 250), rnd.randint(0, 250)) for _ in range(180)] + [(7, 7)]
    edges = chain + star + noise
    rnd.shuffle(edges)
    got = components(Scratch(spark, "test"), spark.createDataFrame(edges, "a long, b long"), "c").collect()
    ids = {x for a, b in edges if a != b for x in (a, b)}
    want = plain(ids, edges)
    assert {r["id"]: r["component"] for r in got} == want and len(got) == len(ids)


def test_components_of_no_edges(spark):
    assert components(Scratch(spark, "test"), spark.createDataFrame([], "a long, b long"), "c").count() == 0


def test_components_of_few_edges_take_few_files(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(5000) if i % 50]
    files = {}
    save = Scratch.save

    def counted(self, df, name, by=None):
        out = save(self, df, name, by)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(Scratch, "save", counted)
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        found = components(Scratch(spark, "test"), spark.createDataFrame(edges, "a long, b long"), "c")
        got = {r["id"]: r["component"] for r in found.collect()}
        most = 2 * spark.sparkContext.defaultParallelism
        assert found.rdd.getNumPartitions() <= most < 40
        assert files.pop("c-0") > most >= max(files.values()) and len(files) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain({x for e in edges for x in e}, edges)


def test_the_shared_folder_is_the_one_that_the_session_names(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_batches_are_bounded_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for given, kept in (("10000", "1000"), ("0", "1000"), ("64", "64")):
        spark.conf.set(name, given)
        bound_batches(spark)
        assert spark.conf.get(name) == kept
    spark.conf.unset(name)


def test_tables_are_written_to_the_shared_folder(spark):
    scratch = Scratch(spark, "test")
    df = scratch.save(spark.range(10).selectExpr("id", "id % 3 AS p"), "t", by=["p"])
    assert df.where("p = 1").count() == 3 and scratch.root.startswith(shared_dir(spark))
    out, seen = scratch.observed(spark.range(7), "u", n=F.count(F.lit(1)))
    assert seen == {"n": 7} and out.count() == 7
    scratch.drop("u")


def test_clashing_names_are_carried(spark):
    df = spark.createDataFrame([(1, "x", 2)], ["id", "row", "a.b"])
    got = carried(df, id=F.lit(9)).select(*unpacked(df, ("id",), row=F.lit("y")), "id").collect()[0]
    assert got.asDict() == {"row": "y", "a.b": 2, "id": 9}

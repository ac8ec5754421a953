import hashlib
from collections import defaultdict

import pytest
from helpers import made_up, words

from siltbed.llm import mixing
from siltbed.llm.mixing import mix, op3_mixing, source_targets


def plain_targets(sizes, cycle=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and left * w[s] / free > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else left * w[s] / free for s in order}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 100, "b": 10, "c": 1, None: 5}, {"b": 0, "a": 7}, {"é": 50, "z": 50, "y": 3, "x": 2, "w": 1}, {"a": 0, "b": 0}])
def test_targets_reach_the_fixed_point(spark, sizes):
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r["source"]: r["target"] for r in got} == pytest.approx(plain_targets(sizes))


def test_mix_against_a_sorted_prefix(spark):
    names = ["a", "a", "a", "b", None, "c", "d"]
    docs = [(i, t, names[k % 7]) for k, (i, t) in enumerate(made_up(150))] + [(None, "one two", "a"), (5, "rows of one id", "a"), (900, "x " * 3000, "b")]
    got = mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += len(words(t))
    target = plain_targets(dict(size))
    taken = defaultdict(int)
    by = defaultdict(lambda: defaultdict(int))
    for i, t, s in docs:
        by[s][int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)] += len(words(t))
    more = {}
    for s, hs in by.items():
        whole = int(target[s] // size[s]) if size[s] else 0
        rest, at = target[s] - whole * size[s], 0
        for h in sorted(hs):
            more[s, h] = whole + (rest > 0 and at + hs[h] / 2 <= rest)
            at += hs[h]
    for r in got:
        h = int(hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest()[:15], 16)
        assert r["size"] == len(words(r["text"])) and r["source_size"] == size[r["source"]]
        assert r["taken"] == more[r["source"], h] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(docs)
    for s in size:
        assert abs(taken[s] - target[s]) <= max(by[s].values())


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([(1, "a b", "s", 5, "t")], "doc_id long, text string, source string, size int, cut string")
    assert mix(df.where("false")).count() == 0
    r = mix(df).collect()[0]
    assert (r["size"], r["cut"], r["taken"]) == (2, "t", 2)
    assert mix(df.withColumn("text", df["source"].substr(1, 0))).collect()[0]["taken"] == 0


def test_many_partitions_take_few_files(spark, tmp_path, monkeypatch):
    """Each part file on a local disk costs the JVM several processes; 40 partitions of texts have few rows of sizes."""
    files = []

    class Seen(mixing.Scratch):
        def save(self, df, name, by=None):
            out = super().save(df, name, by)
            files.append((name, len(out.inputFiles())))
            return out

    monkeypatch.setattr(mixing, "Scratch", Seen)
    docs = spark.createDataFrame([(i, t, "abc"[i % 3]) for i, t in made_up(150)], "doc_id long, text string, source string")
    docs.repartition(40, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    try:
        for n in before:
            spark.conf.set(n, "1k")
        most = 2 * spark.sparkContext.defaultParallelism
        assert read.rdd.getNumPartitions() > most
        want = mix(read)
        got = op3_mixing(spark, str(tmp_path))
        assert [n for k, n in files if k == "sizes" and n > most] == [] and len([k for k, _ in files if k == "sizes"]) == 2
        columns = ["doc_id", "size", "source_size", "target", "taken"]
        assert sorted(got.collect()) == sorted(want.select(columns).collect())
        assert not any(x in got._jdf.queryExecution().executedPlan().toString() for x in ("Python", "text"))  # texts are read once
    finally:
        for n, x in before.items():
            spark.conf.set(n, x)

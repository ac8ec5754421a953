import random

import numpy as np
from helpers import made_up

import corpus_pipeline as cp
from siltbed.llm import mixing, sentencepiece_codec


def write(spark, path, n=120):
    rnd = random.Random(1)
    rows = [(i, t, rnd.choice(["en", "de"]), rnd.choice(["a", "b", "c", None]), len(t or "")) for i, t in dict(made_up(n)).items()]
    rows.append((900, "123 456", "en", "a", 7))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return rows


def test_stages_against_plain_versions(spark, tmp_path):
    from test_line_dedup import plain as lines
    from test_near_dup import plain as near

    write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == columns
        held[name] = docs.collect()
    kept = {r["doc_id"]: r for r in held["language_id"]}
    assert not {200, 201, 203, 900} & set(kept) and len(kept) > 60
    after = {(i, t) for i, t, _, _ in lines([(r["doc_id"], r["text"]) for r in held["language_id"]], 10)}
    assert {(r["doc_id"], r["text"]) for r in held["line_dedup"]} == after and all(r["n_chars"] == len(r["text"]) for r in held["line_dedup"])
    reps = {i for i, _, _, k in near([(r["doc_id"], r["text"]) for r in held["line_dedup"]]) if k}
    assert {r["doc_id"] for r in held["minhash_near_dedup"]} == reps
    before = spark.createDataFrame(held["minhash_near_dedup"], docs.schema)
    times = {r["doc_id"]: r["repeats"] for r in mixing.mix(before).collect()}
    got = [r["doc_id"] for r in held["mixing"]]
    assert all(got.count(i) == n for i, n in times.items()) and sum(times.values()) == len(got)
    with open(sentencepiece_codec.MODEL, "rb") as f:
        codec = sentencepiece_codec.Codec(f.read())
    out = cp.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(got)
    text = {r["doc_id"]: r["text"] for r in held["mixing"]}
    assert all(r["tokens"] == np.frombuffer(codec.encode([text[r["doc_id"]].encode()])[0], "<i4").tolist() and r["n_tokens"] == len(r["tokens"]) for r in out)


def test_an_empty_table(spark, tmp_path):
    write(spark, tmp_path / "some", 2)
    spark.read.parquet(f"{tmp_path}/some/documents.parquet").where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0

import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.llm import sentencepiece_codec as sc


@pytest.fixture(scope="module")
def model():
    with open(sc.MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def both(model):
    return sc.Codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)


CASES = ["", " ", "     ", "A", "  Hello  world\n\nfoo\tbar ", "日本語 ½ ﬁ é", "<s> </s> <0x41>", "a　b▁c\xa0d​", "▁▁ a", "x" + " " * 37, "é\x00b", "日本語の文章はとても長いです。" * 40, "ab" * 400, "\U0001f600 ok"]


def test_against_the_library(both):
    codec, lib = both
    rnd = random.Random(3)
    texts = CASES + ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz  éß012.,\n▁日本") for _ in range(rnd.randint(0, 150))) for _ in range(300)]
    got = codec.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == lib.encode(texts)
    for t, x in zip(texts, got, strict=True):
        assert codec.decode(np.frombuffer(x, "<i4")) == t.replace("▁", " ")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=60))
def test_any_text(text):
    with open(sc.MODEL, "rb") as f:
        codec = sc._codec(f.read())
    lib = sentencepiece.SentencePieceProcessor(model_file=sc.MODEL)
    got = np.frombuffer(codec.encode([text.encode()])[0], "<i4")
    assert got.tolist() == lib.encode(text) and codec.decode(got) == text.replace("▁", " ")


def test_memory_of_segments_is_bounded(model, monkeypatch):
    monkeypatch.setattr(sc, "REMEMBERED", 1000)
    monkeypatch.setattr(sc, "INDEXED", 64)
    codec = sc.Codec(model)
    first = codec.encode([f"word{i} other".encode() for i in range(200)])
    assert codec.encode([f"word{i} other".encode() for i in range(200)]) == first
    assert codec.held < 60_000


def test_suffix_array_sorts_by_the_width():
    data = np.frombuffer(b"banana\xffbandana\xff" * 3, np.uint8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | padded[j : j + len(data)]
    sa = sc.suffix_array(data, words, 16)
    keys = [data[i : i + 16].tobytes() for i in sa]
    assert keys == sorted(keys) and sorted(sa.tolist()) == list(range(len(data)))


def test_columns(spark, both):
    t = sc.Tokenizer(spark)
    rows = [(i, x) for i, x in enumerate([*CASES, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in sc.tokenize(df).withColumn("back", t.decode("tokens")).withColumn("s", t.summary("tokens")).collect()}
    for i, x in rows:
        assert got[i]["tokens"] == both[1].encode(x or "")
        assert got[i]["back"] == got[i]["s"]["decoded"] == (x or "").replace("▁", " ") and got[i]["s"]["n_tokens"] == len(got[i]["tokens"])
    clash = df.select(F.lit(1).alias("tokens"), "text", "doc_id")
    assert sc.tokenize(clash).schema["tokens"].dataType.simpleString() == "array<int>"
    assert sc.tokenize(df.where("false")).count() == 0 and df.where("false").select(t.decode(F.lit(None).cast("array<int>"))).count() == 0


def test_any_names_are_carried(spark, both):
    df = spark.createDataFrame([("a b", 1, 2, 3)], ["text", "_text", "a.b", "text to encode"])
    r = sc.tokenize(df).collect()[0]
    assert (r["text"], r["_text"], r["a.b"], r["text to encode"], r["tokens"]) == ("a b", 1, 2, 3, both[1].encode("a b"))


def field(number, value):
    """A field of a protocol buffer message, an integer below 128 or bytes."""
    if isinstance(value, int):
        return bytes([*(x for x in ([number << 3] if number < 16 else [number << 3 & 0x7F | 0x80, number >> 4])), value])
    size = len(value)
    assert number < 16 and size < 1 << 14
    return bytes([number << 3 | 2]) + (bytes([size]) if size < 128 else bytes([size & 0x7F | 0x80, size >> 7])) + value


def test_models_of_other_kinds_are_refused(model):
    sc.check_model(model)
    fine = field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1)
    sc.check_model(field(2, field(3, 2)) + field(3, fine))
    for trainer, rules, said in (
        (field(3, 1), fine, "byte-pair"),
        (b"", fine, "byte-pair"),
        (field(3, 2) + field(24, 1), fine, "end of words"),
        (field(3, 2), field(1, b"nmt_nfkc") + field(2, b"rules") + field(4, 0), "nmt_nfkc"),
        (field(3, 2), field(1, b"identity"), "repeated blanks"),
        (field(3, 2), fine + field(3, 0), "in front"),
        (field(3, 2), fine + field(5, 0), "as they are"),
    ):
        with pytest.raises(ValueError, match=said):
            sc.check_model(field(2, trainer) + field(3, rules))


def test_the_whole_query_against_the_library(spark, both, tmp_path):
    import hashlib

    rows = [*enumerate([*CASES, None]), (3, "a repeated id"), (None, "no id"), (900, "very long " * 30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, sc.op7_sentencepiece(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "round_trip").collect()), key=str)
    want = []
    for i, x in rows:
        ids = both[1].encode(x or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest(), True))
    assert got == sorted(want, key=str)

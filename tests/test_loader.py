import pytest

import sstable_writer as sw

from siltbed.operators import sink
from siltbed.plans import loader
from siltbed.sources.sstable import naming


def files(where, keys):
    v = naming.JB
    sw.write(where / "ks-tbl-jb-1", [(k, sw.old_partition(v, k, [sw.old_cell(b"a", 5, b"v")])) for k in keys])


def test_a_store_is_loaded_and_failures_say_where_to_go_on(spark, tmp_path, capsys):
    keys = [b"bad1", b"bad2", *(b"key%d" % i for i in range(20))]
    files(tmp_path / "f", keys)
    args = ["-i", str(tmp_path / "f"), "-h", "one:4000", "-h", "two", "-k", "store:Store", "-u", str(tmp_path / "store"), "-p", "secret", "-e", "3", "-a", "2", "-n", "other"]
    for n, there in ((20, 0), (0, 20)):
        assert loader.main(args) == 1
        out = capsys.readouterr()
        assert f"Exported {n} records, failed to write 2, skipped 0 deleted and 0 expired ones and {there} that were there." in out.out
        first = min(sw.in_token_order(keys).index(b) for b in (b"bad1", b"bad2"))
        assert f"Go on with -s {sw.in_token_order(keys)[first].decode()}" in out.err and "warning: namespace other differs from ks" in out.err
    assert len(list((tmp_path / "store" / "one-4000-secret-other-tbl").iterdir())) == 20


def test_an_interrupted_run_says_where_to_go_on(spark, tmp_path, capsys, monkeypatch):
    keys = [b"key%d" % i for i in range(20)]
    files(tmp_path / "f", keys)
    order = sw.in_token_order(keys)
    target = tmp_path / "t"
    loader.main(["-i", str(tmp_path / "f"), "-o", str(target)])
    held = spark.read.parquet(str(target)).collect()
    kept = [r for r in held if bytes(r["key"]) in order[:7]]
    spark.createDataFrame(kept, loader.RECORD).write.mode("overwrite").parquet(str(tmp_path / "some"))
    capsys.readouterr()

    def stop(self, rows):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sink.TableTarget, "create", stop)
        assert loader.main(["-i", str(tmp_path / "f"), "-o", str(tmp_path / "some")]) == 130
        assert f"Stopped. Go on with -s {order[7].decode()}" in capsys.readouterr().err
        assert loader.main(["-i", str(tmp_path / "f"), "-o", str(target)]) == 130
        assert "Nothing is left." in capsys.readouterr().err
    assert loader.main(["-i", str(tmp_path / "f"), "-o", str(tmp_path / "some"), "-s", order[7].decode()]) == 0
    assert "Exported 13 records" in capsys.readouterr().out
    assert {bytes(r["key"]) for r in spark.read.parquet(str(tmp_path / "some")).collect()} == set(keys)


@pytest.mark.parametrize("bad", [["-h", "x"], ["-k", "a:b", "-o", "x"], ["-h", "x", "-k", "a:b", "-o", "y"], ["-o", "x", "-e", "0"], ["-o", "x", "-a", "0"]])
def test_options_that_are_wrong(bad):
    with pytest.raises(SystemExit):
        loader.options(["-i", "f", *bad])


def test_the_version_is_shown(capsys):
    with pytest.raises(SystemExit) as e:
        loader.options(["-v"])
    assert e.value.code == 0 and loader.VERSION in capsys.readouterr().out

import random
import re
from collections import Counter

import pytest

from siltbed.llm.licence_texts import MIT, TEMPLATES
from siltbed.llm.licences import op5_license_scan, scan_licences


def bigrams(text):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    return list(zip(w, w[1:], strict=False))


def plain(text, templates=TEMPLATES, threshold=0.8):
    g, out = bigrams(text), []
    for t, (name, template) in enumerate(templates):
        need = Counter(bigrams(template))
        n = sum(need.values())
        wide, best = min(len(g), n), None
        for s in range(len(g) - wide + 1) if wide else ():
            dice = 2 * sum((Counter(g[s : s + wide]) & need).values()) / (wide + n)
            if dice >= threshold and (best is None or dice > best[4]):
                best = (name, t, s, wide + 1, dice)
        if best:
            out.append(best)
    return sorted(out, key=lambda x: (-x[4], -x[3], x[2], x[1]))


def garbled(text, seed, share):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["foo", "bar"]) if rnd.random() < share else x for x in text.split())


@pytest.mark.parametrize("kind", ["short", "long"])
def test_against_all_windows(spark, kind):
    short = ["Released under the MIT License.", "see: LICENSED under CC BY-NC 4.0!", "licensed under the", "This work is licensed under the GNU General Public License, version 3. Licensed under the Apache License, Version 2.0.", None, "", "x", "under the MIT"]
    long = [f"int main\n/* {MIT} */ {garbled(MIT, 1, 0.05)}", garbled(MIT, 2, 0.08), garbled(MIT, 3, 0.3), MIT[: len(MIT) * 3 // 4], "é " + TEMPLATES[0][1] + " ü"]
    texts = short if kind == "short" else long
    got = scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        assert [tuple(x) for x in r["licences"]] == plain(texts[r["doc_id"]])
    assert any(r["licences"] for r in got) and len(got) == len(texts)


def test_names_clash_and_tables_are_empty(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.", 5)], "doc_id long, text string, licences int")
    assert scan_licences(df).collect()[0]["licences"][0]["licence"] == "MIT"
    assert scan_licences(df.where("false")).count() == 0
    assert scan_licences(df, [("none", ""), ("one", "word")]).collect()[0]["licences"] == []


def test_reserved_rights_and_missing_licences(spark, tmp_path):
    name = dict(map(reversed, TEMPLATES))
    by = {n: [t for t, x in name.items() if x == n] for n in ("BSL-1.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "LGPL-2.1", "LGPL-3.0", "Unlicense", "BSD-3-Clause")}
    want = {i: (n, t) for i, (n, t) in enumerate((n, garbled(t, 5, 0.03) if len(t) > 400 else t) for n, ts in by.items() for t in ts)}
    want[100] = ("LicenseRef-All-Rights-Reserved", "some words here\nAll rights reserved.\nand some more")
    want[101] = ("BSD-3-Clause", f"Copyright (c) X. All rights reserved. {garbled(by['BSD-3-Clause'][0], 6, 0.03)}")
    want[102] = (None, "all of the rights were reserved for later")
    spark.createDataFrame([(i, t) for i, (_, t) in want.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op5_license_scan(spark, str(tmp_path)).collect()}
    assert {i: r["licence"] for i, r in got.items()} == {i: n for i, (n, _) in want.items()}
    assert got[100]["n_licences"] == 1 and got[101]["n_licences"] >= 2


def test_words_made_to_collide_are_told_apart(spark):
    x = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    y = x.translate(str.maketrans("ab", "ba"))  # the same polynomial hash modulo 2**64
    df = spark.createDataFrame([(1, f"grant {x}"), (2, f"grant {y}")], "doc_id long, text string")
    got = {r["doc_id"]: [m["licence"] for m in r["licences"]] for r in scan_licences(df, [("L", f"grant {x}")]).collect()}
    assert got == {1: ["L"], 2: []}

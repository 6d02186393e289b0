import random

import pytest
from pyspark.sql import functions as F

from spectrine.llm import containment, decontaminate, license_scan
from spectrine.llm.shingles import shingle_hashes


def sets(text, n=5):
    w = [x for x in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize("overlap", [False, True])
def test_matches_brute_force(spark, documents, words, overlap):
    rng = random.Random(4)
    items = [(i, words(rng, n)) for i, n in enumerate([1, 3, 5, 7, 12, 13, 20, 36, 37, 60, 140, 200, 600])]
    docs = []
    for i in range(120):
        body = words(rng, rng.choice([0, 4, 50, 900, 5000]))
        item = items[i % len(items)][1].split()
        if i % 3:
            for _ in range(i % 4):  # edits, so that containment lies on both sides of 0.8
                item[rng.randrange(len(item))] = "edited"
            cut = rng.randrange(len(body.split()) + 1)
            body = " ".join([*body.split()[:cut], *item, *body.split()[cut:]])
        docs.append((i, body))
    want = {}
    for d, text in docs:
        have = sets(text)
        for k, item in items:
            s = sets(item)
            if len(s & have) >= 0.8 * len(s):
                want[d, k] = (len(s & have), len(s))
    df, bench = documents(docs), spark.createDataFrame(items, "item_id long, text string")
    hits = containment.contained_items(df, bench, overlap=overlap)
    keyed = df.select(containment.row_key("doc_id", "text").alias("doc"), "doc_id").join(hits, "doc")
    assert {(r.doc_id, r.item): (r.shared, r.item_shingles) for r in keyed.collect()} == want and len(want) > 30


def test_shingles(spark):
    df = spark.createDataFrame([("A b, C!",), ("a b c d e",), ("a b c d e f",), ("",), (None,), ("...",)], "t string")
    got = [r[0] for r in df.select(shingle_hashes(F.col("t"))).collect()]
    assert [len(x) for x in got] == [1, 1, 2, 0, 0, 0] and got[1][0] == got[2][0]


def test_decontaminate_edges(spark, edge, documents):
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, ""), (None, "one"), (1, "one two three four five six")], "item_id long, text string")
    got = decontaminate.leaks(edge, bench).collect()
    assert [(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got] == [(None, 1, 2, 2)]
    clean = decontaminate.decontaminate(edge, bench)
    assert clean.columns == edge.columns and clean.count() == edge.count() - 1
    for docs, items in ((edge.limit(0), bench), (edge, bench.limit(0)), (edge, bench.where("text is null"))):
        assert decontaminate.leaks(docs, items).count() == 0
        assert decontaminate.decontaminate(docs, items).count() == docs.count()
    long_text = " ".join(f"v{i}" for i in range(30000)) + " one two three four five six " + "tail " * 1000
    hit = decontaminate.leaks(documents([(9, long_text), (10, "ONE-two three; four\nfive six")]), bench).collect()
    assert sorted(r.doc_id for r in hit) == [9, 10]


def test_license_scan(spark, edge, documents):
    mit = dict(license_scan.TEMPLATES)["mit"]
    rows = [(1, "code " * 500 + "\n// " + mit.replace(". ", ".\n// ") + " more" * 300), (2, "Released under the MIT License."), (3, mit[: len(mit) // 2]), (4, "nothing")]
    got = {(r.doc_id, r.name) for r in license_scan.scan(documents(rows), license_scan.builtin_templates(spark)).collect()}
    assert got == {(1, "mit"), (2, "mit-line")}
    assert license_scan.scan(edge, license_scan.builtin_templates(spark)).count() == 0
    plan = decontaminate.leaks(edge, edge.select(F.col("doc_id").alias("item_id"), "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan

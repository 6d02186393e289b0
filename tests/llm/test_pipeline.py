import base64
import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_containment import sets
from test_near_dup import brute

import corpus_pipeline
from spectrine.llm import line_dedup, quality


def reference(rows, labels, bench, model):
    """The pipeline row by row: only the fitted classifier is shared."""
    rows = [r for r in rows if model.scores(quality.features(r[1])[None].astype(np.float32))[0] >= quality.THRESHOLD]
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r") and site is not None:
                sites[line.strip(" \t\r")].add(site)
    out = []
    for i, text, site in rows:
        lines = (text or "").split("\n")
        bare = [x.strip(" \t\r") for x in lines]
        bad = [len(sites.get(b, ())) >= line_dedup.MIN_SITES for b in bare]
        if any(bad) and sum(len(b) for b, x in zip(bare, bad, strict=True) if x) <= 0.5 * sum(map(len, bare)):
            text = "\n".join(x for x, b in zip(lines, bad, strict=True) if not b)
        out.append((i, text, site))
    kept = {i for i, _, _, keep in brute([(i, t) for i, t, _ in out], 5) if keep}
    rows = [r for r in out if r[0] in kept]
    items = [sets(t) for _, t in bench if sets(t)]
    rows = [r for r in rows if not any(len(s & sets(r[1])) >= 0.8 * len(s) for s in items)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = []
    for i, text, _ in rows:
        ids = encoding.encode_ordinary(text or "")
        got.append((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(got)


@pytest.fixture(scope="module")
def folder(spark, documents, words, tmp_path_factory):
    rng = random.Random(8)
    bench = [(k, words(rng, 30)) for k in range(5)]
    rows, labels = [], []
    for i in range(400):
        good = i % 6 != 0
        parts = [words(rng, rng.randint(5, 40)) for _ in range(rng.randint(1, 6))]
        if not good:
            parts = [p.upper() + " !!" if i % 4 else " ".join(x + "%%%" for x in p.split()) for p in parts]
        if i % 7 == 1:
            parts.insert(0, "Sign in to read the rest of this page")
        if i % 31 == 5:
            parts.append(bench[i % 5][1])
        text = "\n".join(parts)
        if i % 11 == 3 and rows:
            text = rows[rng.randrange(len(rows))][1] + (" tail" if i % 2 else "")
        rows.append((i, text, "en", f"site{rng.randrange(14)}", len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    root = tmp_path_factory.mktemp("sf")
    documents(rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows, labels, bench


def test_pipeline_matches_the_reference(spark, folder):
    root, rows, labels, bench = folder
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, root).collect())
    model = quality.train(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"))
    want = reference([(r[0], r[1], r[3]) for r in rows], labels, bench, model)
    assert got == want and 200 < len(got) < 350


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dup", "decontaminate", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), folder[0]).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder[0]).count() == 0

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spectrine.llm import collocations as C


def expected(rows, least=10, keep=2000):
    f = defaultdict(Counter)
    for lang, text in rows:
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        n = sum(v for k, v in counts.items() if len(k) == 1)
        often = {k: v for k, v in counts.items() if len(k) > 1 and v >= least}
        absorbed = {part for k, v in often.items() if len(k) == 3 for part in (k[:2], k[1:]) if 100 * v >= 50 * counts[part]}
        rows_of = []
        for k, a in often.items():
            if k in absorbed:
                continue
            cuts = [(1_000_000 * a * a // (counts[k[:i]] * counts[k[i:]]), i) for i in range(1, len(k))]
            score, i = min(cuts)
            rows_of.append((score, a, " ".join(k), counts[k[:i]], counts[k[i:]]))
        rows_of.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, r + 1, p, a, left, right, n, s) for r, (s, a, p, left, right) in enumerate(rows_of[:keep])]
    return sorted(out)


def rows_of(rng, n):
    out = []
    for _ in range(n):
        pool = [f"w{i}" for i in range(12)] + ["New", "YORK", "city", "É", "été", "\x00z"]
        words = rng.choices(pool, k=rng.randrange(1, 60))
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]) for w in words)
        out.append((rng.choice(["en", "en", "de", None, "und"]), text + rng.choice(["", "new york city", " New York City."])))
    return out


@pytest.mark.parametrize("mode", ["dictionary", "join", "small runs"])
def test_matches_brute_force(documents, mode):
    rng = random.Random(13)
    rows = rows_of(rng, 250) + [(None, None), ("en", ""), ("fr", "only once"), ("en", "a b " * 4000)]
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)]).repartition(3)
    options = {"dictionary": {}, "join": {"dictionary_words": 0, "chunk": 16}, "small runs": {"flush": 50}}[mode]
    got = sorted(tuple(r) for r in C.collocations(docs, **options).collect())
    assert got == expected(rows)


def test_the_best_of_many(documents):
    rng = random.Random(5)
    rows = rows_of(rng, 250)
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)])
    assert sorted(tuple(r) for r in C.collocations(docs, keep=7).collect()) == expected(rows, keep=7)
    assert sorted(tuple(r) for r in C.collocations(docs, min_count=25).collect()) == expected(rows, least=25)


def test_blocks_of_a_long_text():
    rng = random.Random(2)
    text = "".join(rng.choice(["ab ", "c.", "É", "\t", "\x0b", "d "]) for _ in range(5000)).encode()
    whole = [x for block in C.tokens(text, 1 << 30) for x in block]
    assert [x for block in C.tokens(text, 40) for x in block] == whole


def test_large_counts_are_exact(spark):
    a, left, right = 10**14 + 7, 10**14 + 9, 3 * 10**14 + 1
    row = spark.sql(f"select cast({a} as bigint) a, cast({left} as bigint) l, cast({right} as bigint) r")
    square = "cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
    got = row.select(F.expr(f"({square} * 1000000) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))").alias("s")).first().s
    assert got == 1_000_000 * a * a // (left * right)


def test_edges(edge, documents):
    rows = [(r.lang, r.text) for r in edge.collect()]
    got = C.collocations(edge.select("*", F.lit(1).alias("id"), F.lit(2).alias("weight"), F.lit("x").alias("word")))
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)
    assert C.collocations(documents([])).count() == 0

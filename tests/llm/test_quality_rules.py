import math
import random
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from spectrine.llm import quality_rules as Q

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base(text):
    text = text or ""
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if regex.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(regex.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def verdicts(rows, min_words, min_texts):
    """Brute force over (lang, text): base counts and kept."""
    judged, out = defaultdict(dict), []
    plain = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w]
    total = defaultdict(Counter)
    for lang, text in rows:
        lang, text = lang or "und", text or ""
        total[lang].update(plain(text))
        counts = base(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        out.append((lang, text, counts, failed))
        if not failed and counts[0] >= min_words:
            judged[lang][text] = None
    common = {k: sorted(w for w, n in c.items() if 1000 * n >= 3 * sum(c.values())) for k, c in total.items()}

    def histograms(lang, text):
        classes = [r"\p{Ll}", r"[\x20\x09-\x0D]", r"\p{Lu}", r"(?!\p{Ll}|\p{Lu})\p{L}", r"\p{Nd}", r"""[.,;:!?'"()-]"""]
        chars = [len(regex.findall(x, text)) for x in classes]
        words = Counter(plain(text))
        hits = [words[w] for w in common[lang]]
        return chars + [len(text) - sum(chars)], hits + [sum(words.values()) - sum(hits)] if hits else None

    refs = {}
    for lang, texts in judged.items():
        if len(texts) >= min_texts:
            shares = []
            for kind in (0, 1):
                sums = None
                for t in texts:
                    h = histograms(lang, t)[kind]
                    if h is not None:
                        ppm = [x * 1_000_000 // max(1, sum(h)) for x in h]
                        sums = ppm if sums is None else [a + b for a, b in zip(sums, ppm)]
                shares.append(sums and [x / sum(sums) for x in sums])
            refs[lang] = shares

    def distance(h, q):
        p = [x / sum(h) for x in h]
        m = [(a + b) / 2 for a, b in zip(p, q)]
        half = lambda u: sum(a * math.log2(a / b) for a, b in zip(u, m) if a > 0)
        return math.sqrt(max(0, (half(p) + half(q)) / 2))

    for lang, text, counts, failed in out:
        kept = not failed
        if kept and counts[0] >= min_words and lang in refs:
            for h, q, (floor, noise) in zip(histograms(lang, text), refs[lang], (Q.CHAR_BOUND, Q.WORD_BOUND)):
                if h and q and sum(h):
                    kept &= distance(h, q) <= floor + noise / math.sqrt(counts[0])
        yield (*counts, failed, kept)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for lang in ("en", "de", None):
        small = [f"{lang}{x}" for x in "abcdefghij"]
        rare = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöü", k=rng.randrange(3, 9))) for _ in range(600)]
        for i in range(40):
            words = [rng.choice(small if rng.random() < 0.5 else rare) for _ in range(rng.choice([10, 30, 80, 200]))]
            text = " ".join(w + ("\n" if rng.random() < 0.1 else "") for w in words)
            if i % 8 == 1:
                text = " ".join(w.upper() + "!!" for w in words)
            if i % 8 == 2:
                text = " | ".join(rng.choices(rare, k=len(words)))
            if i % 8 == 3:
                text += " " + " ".join(words[:12]) + "\n" + "same line\n" * 3
            out.append((lang, text))
    out += [("en", out[0][1])] * 60 + [("xx", out[0][1]), ("xx", "1 2 3"), (None, None), ("en", ""), ("de", " \t\r\n "), ("en", "w " * 5000)]
    return out


def test_matches_brute_force(documents, rows):
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)]).repartition(3)
    got = Q.quality_rules(docs, min_words=25, min_texts=5).orderBy("doc_id").collect()
    want = list(verdicts(rows, 25, 5))
    assert [tuple(r[c] for c in (*COUNTS, "base_failed", "kept")) for r in got] == want
    judged = [r for r in got if not r.base_failed]
    assert any(not r.kept for r in judged) and any(r.kept for r in judged)


def test_verdicts_without_texts_are_the_same(documents, rows, edge):
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)])
    for df in (docs, edge.select("*", *[F.lit("mine").alias(c) for c in ("row", "char", "bins", "usable", "table", "a", "kept", "n_words")])):
        one = Q.quality_rules(df, min_words=25, min_texts=5).drop("text")
        two = Q.judge(df, min_words=25, min_texts=5)
        assert one.columns == two.columns
        key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
        assert sorted(map(str, map(key, one.collect()))) == sorted(map(str, map(key, two.collect())))
    assert Q.judge(documents([])).count() == 0 and Q.judge(docs.select("text", "lang")).columns[0] == "lang"
    assert "Python" not in Q.judge(docs)._jdf.queryExecution().toString()


def test_languages_joined_by_key(documents, rows, monkeypatch):
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)])
    want = {r.doc_id: r.kept for r in Q.quality_rules(docs, min_words=25, min_texts=5).collect()}
    monkeypatch.setattr(Q, "BROADCAST_LANGUAGES", 0)
    assert {r.doc_id: r.kept for r in Q.quality_rules(docs, min_words=25, min_texts=5).collect()} == want


def test_words_near_the_share_are_counted(documents, rows, monkeypatch):
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)])
    monkeypatch.setattr(Q, "TRACKED", 1024)  # the error is as large as the share then
    got = [r.kept for r in Q.quality_rules(docs, min_words=25, min_texts=5).orderBy("doc_id").collect()]
    assert got == [v[-1] for v in verdicts(rows, 25, 5)]


def test_windows_that_overlap(spark):
    cases = ["a b c d e f g h a b c d e f g h", "x " * 9, "x " * 8, "a b c d e f g h i a b c d e f g h", "", "a"]
    got = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [r.n for r in Q.base_counts(got, "t").orderBy("i").select(F.col("n_repeat_words").alias("n")).collect()]
    assert got == [base(c)[4] for c in cases] == [16, 9, 0, 16, 0, 0]


def test_edges_and_clashing_columns(edge, documents):
    clash = edge.select("*", *[F.lit("mine").alias(c) for c in ("_lang", "_text", "_base", "slots", "n", "table", "char_reference", "weight", "kept", "n_words")])
    got = Q.quality_rules(clash).collect()
    assert len(got) == edge.count()
    assert all(r["_text"] == r["slots"] == r["n"] == r["weight"] == "mine" for r in got)
    assert {r.text for r in got} == {r.text for r in edge.collect()}
    assert all(isinstance(r.kept, bool) and isinstance(r.n_words, int) for r in got)
    assert Q.quality_rules(documents([])).count() == 0
    plan = Q.quality_rules(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan

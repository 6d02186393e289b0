import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spectrine.llm import fill_in_middle as M


def expected(ident, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_matches_the_rule(documents):
    rng = random.Random(12)
    bits = ["a", "é", "漢", "🤦🏼", "\n", " ", "<", ">", "P>", "<P", "<S>", "́", "\x00x", "\r\n"]
    rows = [(i, "".join(rng.choices(bits[: 9 + i % 6], k=rng.randrange(0, 60)))) for i in range(300)]
    docs = documents(rows)
    out = M.fill_in_middle(docs).withColumn("back", M.restore(F.col("output"), F.col("form"))).collect()
    forms = set()
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.back == r.text
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


@pytest.mark.parametrize("name", ["points", "words", "lines"])
def test_ranks_by_events(name):
    rng = random.Random(name)

    def units(text):  # brute force: one character after another
        grammar, out, fresh = M.UNITS[name], [], True
        for char in text:
            alone = char in grammar.changes and not grammar.closes
            if fresh or alone or grammar.each:
                out.append(char)
            else:
                out[-1] += char
            fresh = char in grammar.changes
        return out

    for _ in range(300):
        text = "".join(rng.choices("ab\n \té漢<P>", k=rng.randrange(0, 40)))
        scan, want = M.Scan(text, M.UNITS[name]), units(text)
        assert scan.count == len(want)
        assert [scan.offset(k) for k in range(len(want) + 1)] == [len("".join(want[:k])) for k in range(len(want) + 1)]
        for form in ("psm", "spm", "plain"):
            if not scan.sentinels:
                a, b = sorted(rng.choices(range(scan.count + 1), k=2))
                assert M.restored(M.rearrange(scan, a, b, form), form) == text


def test_events_are_sparse():
    scan = M.Scan("é" * 2_000_000)
    assert len(scan.starts) == 1 and scan.offset(1_234_567) == 1_234_567


def test_outputs_without_their_sentinels_are_refused():
    for output, form in (("abc", "psm"), ("<P>a<S>b", "psm"), ("x<P>a<S>b<M>c", "psm"), ("<P>a<S>b<M>c", "spm")):
        with pytest.raises(ValueError):
            M.restored(output, form)


def test_edges_and_clashing_columns(edge, documents):
    clash = edge.select("*", F.lit("mine").alias("_cut"), F.lit(7).alias("n"), F.lit("x").alias("output"))
    got = M.fill_in_middle(clash).collect()
    assert len(got) == edge.count() and {r["_cut"] for r in got} == {"mine"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
    assert M.fill_in_middle(documents([])).count() == 0

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spectrine.llm import byte_bpe, token_count

JSON, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["<|endoftext|>", "<|startoftext|>", " ", "\n\n", "\t", "\x1f", " ", " ", "é", "é", "İ", "漢字", "👍🏽", "don't", "'s", "X", "123", "%%%", "word", "ABC", "́", "\x85", "<|endof"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=60), st.integers(8, 40), st.integers(1, 8))
def test_spliced_counts_equal_the_library(parts, chunk, overlap):
    text = "".join(parts)
    counter = token_count.Counter(JSON, chunk, overlap)
    want = len(_whole().encode(text, add_special_tokens=False).ids)
    assert counter.count(text) == counter._long(text) == want if text else counter.count(text) == 0


_cache = []


def _whole():
    if not _cache:
        _cache.append(Tokenizer.from_file(JSON))
    return _cache[0]


def test_long_texts_with_and_without_blanks(library):
    rng = random.Random(1)
    for text in ("ab" * 50_000, "".join(rng.choices(ODD, k=30_000)), "word " * 40_000, "x" * 40_000 + " y" * 20_000):
        assert token_count.Counter(JSON).count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_tokens(edge, library):
    rows = token_count.count_tokens(edge, JSON).collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 2048)
        assert r.n_tokens == (len(library.encode(r.text, add_special_tokens=False).ids) if r.text else 0)
    assert token_count.count_tokens(edge.limit(0), JSON).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=80), st.integers(1, 30))
def test_pieces_do_not_change_ids(parts, size):
    text = "".join(parts)
    codec = byte_bpe._codec(RANKS, P.PATTERN)
    packed = codec.encode(text, size)
    assert packed == np.asarray(codec.encoding.encode_ordinary(text), "<u4").tobytes()
    assert codec.decode(packed) == text.encode() and "".join(byte_bpe.pieces(text, size)) == text


def test_digests(edge, encoding):
    rows = byte_bpe.digests(edge.withColumnRenamed("lang", "ids")).collect()
    texts = sorted((r.doc_id or 0, r.text or "") for r in edge.collect())
    want = []
    for i, t in texts:
        ids = encoding.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(want)
    assert byte_bpe.digests(edge.limit(0)).count() == 0
    codec = byte_bpe._codec(RANKS, P.PATTERN)
    part = np.asarray(encoding.encode_ordinary("é👍")[:1], "<u4").tobytes()
    assert codec.decode(part) == encoding.decode_single_token_bytes(int(np.frombuffer(part, "<u4")[0]))


def test_one_python_worker_a_task(edge):
    docs = edge.selectExpr("*", "'a' as both", "'b' as n_tokens")
    out = byte_bpe.encode_documents(docs, RANKS, P.PATTERN)
    assert out.columns == [*docs.columns, "ids", "decoded"] and {r.both for r in out.collect()} == {"a"}
    apart = docs.withColumn("ids", byte_bpe.encode(docs.text, RANKS, P.PATTERN)).withColumn("decoded", byte_bpe.decode(byte_bpe.F.col("ids"), RANKS, P.PATTERN))
    assert sorted((r.ids, r.decoded) for r in out.collect()) == sorted((r.ids, r.decoded) for r in apart.collect())
    for df in (out, byte_bpe.digests(edge)):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@settings(max_examples=150, deadline=None)
@given(parts=st.lists(st.sampled_from([*ODD, "。", "，漢", "\r\n", "Σ", "ᄀ", "ᅡ", "    "]), min_size=1, max_size=60), chunk=st.integers(4, 40), overlap=st.integers(1, 8))
def test_both_families_splice(name, parts, chunk, overlap):
    text = "".join(parts)
    counter = _counters[name] = _counters.get(name) or token_count.Counter(P.path(name))
    counter.chunk, counter.overlap = chunk, overlap
    assert counter.places is not None and counter._long(text) == counter._whole(text)


_counters = {}


class Traced(token_count.Counter):
    """Notes the spans that are encoded in one call."""

    def encode(self, text, a, b):
        self.spans.append((a, b))
        return super().encode(text, a, b)


@pytest.mark.parametrize("text", ["some words and more " * 20_000, "漢字仮名交，文化学。" * 20_000, "漢字" * 100_000, "x" * 100_000 + " y" * 60_000])
def test_chunks_overlap_and_cover(text, library):
    counter = Traced(JSON)
    counter.spans = []
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    spans = counter.spans
    if spans:  # a text without any proven place is one call
        assert spans[0][0] == 0 and spans[-1][1] == len(text)
        assert all(b[0] < a[1] < b[1] for a, b in zip(spans, spans[1:], strict=False))
        assert sum(b - a for a, b in spans) < 1.1 * len(text)  # nothing is encoded again and again


def test_failed_alignment_widens_and_ends_right(library):
    class Blind(Traced):
        def _common(self, *args):
            self.tries += 1
            return super()._common(*args) if self.tries > self.blind else None

    text = "some words and more " * 20_000
    for blind in (1, 5, 10**9):
        counter = Blind(JSON)
        counter.spans, counter.tries, counter.blind = [], 0, blind
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
        if blind == 5:
            assert counter.spans[1][0] - counter.spans[2][0] == token_count.OVERLAP


def test_tokenizers_without_proof_encode_whole(tmp_path, library):
    import json

    base = json.loads(library.to_str())
    for change in (
        {"normalizer": {"type": "NFKC"}},
        {"pre_tokenizer": {"type": "Whitespace"}},
        {"added_tokens": [{**base["added_tokens"][0], "lstrip": True}]},
        {"added_tokens": [{**base["added_tokens"][0], "content": "two words"}]},
    ):
        assert token_count.proven_places({**base, **change}) is None
    path = tmp_path / "other.json"
    path.write_text(json.dumps({**base, "normalizer": {"type": "NFKC"}}))
    text = "ｗｏｒｄ and ﬁ " * 10_000
    assert token_count.Counter(str(path)).count(text) == len(Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids)


def test_clashing_columns_are_replaced(edge):
    clash = edge.selectExpr("*", "'a' as n_tokens", "'b' as n_bytes", "'c' as over_limit", "'d' as tokens")
    rows = token_count.count_tokens(clash, JSON).collect()
    assert all(isinstance(r.n_tokens, int) and isinstance(r.over_limit, bool) and r.tokens == "d" for r in rows)

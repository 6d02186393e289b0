"""Token counts of whole texts, exactly as the tokenizers library gives them.

Texts up to ``CHUNK`` characters are encoded in one call. Longer ones are encoded in
overlapping chunks, each by one call with the library's offsets. Two neighbouring
chunks are spliced at a place where both have a token that starts there, with the
same id and end, and that is a proven boundary of the loaded tokenizer: one that no
pre-token and no added token crosses and that the normalizer does not look across
(:func:`proven_places`). What precedes such a place cannot change what follows it,
nor the reverse, so the left chunk counts up to it and the right one from it. An
overlap without a whole stretch between two such places is widened before anything
is encoded, and again where the two encodings do not agree. A chunk without any such
place (one word of a million letters) grows up to the next one beyond its end.

For a tokenizer whose parts the proofs do not cover no place is proven: its texts are
encoded whole, in one call, whatever their length.
"""

from __future__ import annotations

import functools
import json
import os
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bound_batches

CHUNK = 32_768
OVERLAP = 512
LIMIT = 2048

_BLANK = " \t\n\r\f\v"
_STOPS = "\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"

# The pattern of the tokenizer file's pre-tokenizer that drops white space.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: After a CJK stop and before an ideograph: runs of letters hold no stops, runs of signs no letters.
_AFTER_STOP = f"(?<=[{_STOPS}])(?=[\u4e00-\u9fff])"
#: White space is dropped, so no pre-token holds any.
_AFTER_BLANK = f"(?<=[{_BLANK}])(?=[^{_BLANK}])"
#: A pre-token may begin with white space or be white space, but none has any after another character.
_BEFORE_BLANK = f"(?<=\\S)(?=[{_BLANK}])"


def _parts(step: dict | None, key: str) -> list[dict]:
    if step is None:
        return []
    return [x for s in step[key] for x in _parts(s, key)] if step["type"] == "Sequence" else [step]


def proven_places(config: dict) -> re.Pattern | None:
    """The places of a text that no pre-token, added token or normalization crosses; None if nothing is proven.

    ``config`` is the tokenizer file's content. Covered are normalizers of NFC, lower case and folding of
    white space (none of which composes or moves characters across white space or a CJK stop) with a
    pre-tokenizer that keeps words and drops white space, or NFC alone with the byte-level one, which
    keeps white space in front of words.
    """
    for token in config.get("added_tokens") or []:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or re.search(rf"[\s{_STOPS}]", token["content"]):
            return None
    if config.get("post_processor") is not None:  # may move offsets
        return None
    forms = _parts(config.get("normalizer"), "normalizers")
    splits = _parts(config.get("pre_tokenizer"), "pretokenizers")
    fold = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    words = {"type": "Split", "pattern": {"Regex": _WORD_PATTERN}, "behavior": "Removed", "invert": True}
    if splits[:1] == [words] and all(f["type"] in ("NFC", "Lowercase") or f == fold for f in forms):
        if all(s["type"] == "ByteLevel" and not s["add_prefix_space"] for s in splits[1:]):
            return re.compile(f"{_AFTER_BLANK}|{_AFTER_STOP}")
    if len(splits) == 1 and splits[0]["type"] == "ByteLevel" and all(f["type"] == "NFC" for f in forms):
        if splits[0].get("use_regex", True) and not splits[0]["add_prefix_space"]:
            return re.compile(f"{_BEFORE_BLANK}|{_AFTER_STOP}")
    return None


class Counter:
    """Counts tokens with the tokenizer in the file ``path`` (format of tokenizers)."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.places = proven_places(json.loads(self.tokenizer.to_str()))
        self.chunk, self.overlap = chunk, overlap

    def count(self, text: str | None) -> int:
        """Number of tokens; 0 for null and empty text."""
        if not text:
            return 0
        return self._whole(text) if len(text) <= self.chunk or self.places is None else self._long(text)

    def _whole(self, text: str) -> int:
        return len(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0])

    def encode(self, text: str, a: int, b: int):
        """The library's encoding of text[a:b], in one call."""
        return self.tokenizer.encode(text[a:b], add_special_tokens=False)

    def _stretch(self, text: str, a: int, b: int) -> bool:
        """Whether two proven places lie strictly inside (a, b), so that both chunks hold all between them."""
        first = self.places.search(text, a + 1, b)
        return bool(first) and self.places.search(text, first.start() + 1, b) is not None

    def _end(self, text: str, a: int, b: int) -> int:
        """``b``, or the end of the first stretch beyond it where (a, b) has none; the text's end at most."""
        if b >= len(text) or self._stretch(text, a, b):
            return min(b, len(text))
        for _ in range(2):
            found = self.places.search(text, b + 1)
            if found is None:
                return len(text)
            b = found.start()
        return min(len(text), b + self.overlap)

    def _common(self, text: str, left, base: int, right, a: int, b: int) -> tuple[int, int, int] | None:
        """A proven place strictly inside (a, b) where both encodings have the same token, and its numbers in them.

        ``base`` and ``a`` are where the chunks begin. The last such place is taken.
        """
        ids, others = left.ids, right.ids
        for place in reversed([m.start() for m in self.places.finditer(text, a + 1, b)]):
            i, j = left.char_to_token(place - base), right.char_to_token(place - a)
            if i is None or j is None or ids[i] != others[j]:
                continue
            (x, y), (u, v) = left.token_to_chars(i), right.token_to_chars(j)
            if base + x == a + u == place and base + y == a + v < b:
                return place, i, j
        return None

    def _long(self, text: str) -> int:
        n, start, base, skip, total = len(text), 0, 0, 0, 0
        end = self._end(text, 0, self.chunk)
        if end == n:
            return self._whole(text)
        left = self.encode(text, 0, end)
        while end < n:
            b, overlap, found = self._end(text, end, end + self.chunk), self.overlap, None
            while found is None:
                a = max(start, end - overlap)
                if self._stretch(text, a, end):
                    right = self.encode(text, a, b)
                    found = self._common(text, left, base, right, a, end)
                if a == start:
                    break
                overlap *= 2
            if found is None:  # nothing left to overlap with: the chunk itself grows
                left, base, skip, end = self.encode(text, start, b), start, 0, b
            else:
                place, i, j = found
                total += i - skip
                left, base, start, skip, end = right, a, place, j, b
        return total + len(left) - skip


@functools.lru_cache(maxsize=4)
def _counter(path: str, chunk: int, overlap: int) -> Counter:
    return Counter(path, chunk, overlap)


def token_count(text: Column, path: str, *, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Number of tokens of ``text`` (long); 0 for null or empty text.

    ``path`` names the tokenizer's file as each executor sees it.
    """

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counter = _counter(path, chunk, overlap)
        return pd.Series([counter.count(x) for x in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, *, text: str = "text", limit: int = LIMIT, **options) -> DataFrame:
    """Every row and column of ``docs`` plus ``n_bytes``, ``n_tokens``, ``over_limit``.

    No begin, end or added special tokens, no truncation or padding; strings of
    special tokens inside a text are handled as the library does by default. Null
    and empty texts have 0 bytes and tokens. Rows are judged one by one: repeated
    rows, null ids and ties need no rule. Columns of the added names are replaced.
    An empty table gives an empty table.
    """
    bound_batches(docs.sparkSession)
    return (
        docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
        .withColumn("n_tokens", token_count(F.col(text), path, **options))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")

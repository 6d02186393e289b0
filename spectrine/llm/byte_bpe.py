"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Ids travel as packed little-endian unsigned 32-bit integers (BINARY), the usual
format of token files. Long texts are split before white space that follows a
non-blank character. No match of the pattern holds white space after a non-blank
character and the pattern has no look-behind, so every such place is a boundary
between matches, and the parts' ids, concatenated, are the ids of the whole. A
stretch without such a place is encoded in one piece, however long.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bound_batches
from .skew import fresh

PIECE = 65_536

_SAFE = re.compile(r"(?<=\S)[ \n]")


def pieces(text: str, size: int = PIECE):
    """Parts of ``text`` of about ``size`` characters, cut at safe boundaries."""
    at = 0
    while len(text) - at > size and (found := _SAFE.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class Codec:
    """The encoding that a rank file and a pattern define."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None, size: int = PIECE) -> bytes:
        """Packed ids; empty for null or empty text."""
        if not text:
            return b""
        return b"".join(np.asarray(self.encoding.encode_ordinary(x), dtype="<u4").tobytes() for x in pieces(text, size))

    def decode(self, packed: bytes | None) -> bytes:
        """Raw bytes of packed ids; they need not be valid UTF-8."""
        ids = np.frombuffer(packed or b"", dtype="<u4")
        return b"".join(self.encoding.decode_bytes(ids[k : k + PIECE].tolist()) for k in range(0, len(ids), PIECE))


@functools.lru_cache(maxsize=4)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(text: Column, path: str, pattern: str, *, size: int = PIECE) -> Column:
    """Packed ids (BINARY) of a text column; empty for null or empty text."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        codec = _codec(path, pattern)
        return pd.Series([codec.encode(x, size) for x in texts], dtype=object)

    return run.asNondeterministic()(text)  # so that no plan runs it twice for one row


def decode(packed: Column, path: str, pattern: str) -> Column:
    """Raw bytes (BINARY) of packed ids; empty for null."""

    @F.pandas_udf("binary")
    def run(ids: pd.Series) -> pd.Series:
        codec = _codec(path, pattern)
        return pd.Series([codec.decode(x) for x in ids], dtype=object)

    return run.asNondeterministic()(packed)


def encode_and_decode(text: Column, path: str, pattern: str, *, size: int = PIECE) -> Column:
    """``ids`` as of :func:`encode` and ``decoded`` as of :func:`decode` in one struct.

    Both functions in one plan take two Python workers a task, each with a codec
    of its own, and carry the ids to and fro; this takes one.
    """

    @F.pandas_udf("ids binary, decoded binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        codec = _codec(path, pattern)
        ids = [codec.encode(x, size) for x in texts]
        return pd.DataFrame({"ids": ids, "decoded": [codec.decode(x) for x in ids]}, dtype=object)

    return run.asNondeterministic()(text)


def encode_documents(docs: DataFrame, path: str, pattern: str, *, text: str = "text", size: int = PIECE) -> DataFrame:
    """Every row and column of ``docs`` plus ``ids``, ``n_tokens`` and ``decoded``.

    ``ids`` are packed, without special tokens; ``decoded`` are the bytes of the
    ids, which equal the text's UTF-8 bytes wherever the pattern covers the text.
    Null and empty texts have no ids. Rows are treated one by one: repeated rows
    and null ids need no rule. Columns of the added names are replaced. An empty
    table gives an empty table.
    """
    bound_batches(docs.sparkSession)
    both = fresh("both", docs.columns)
    return (
        docs.withColumn(both, encode_and_decode(F.col(text), path, pattern, size=size))
        .withColumn("ids", F.col(both)["ids"])
        .withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
        .withColumn("decoded", F.col(both)["decoded"])
        .drop(both)
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``docs`` under the production vocabulary."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = encode_documents(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: token ids' counts and digests of each document."""
    return digests(docs)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))

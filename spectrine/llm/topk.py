"""Exact top-k search by inner product with multi-resolution segment bounds.

Vectors are cut into equal segments. With a segment's length L, mean m and
deviation s (of the population), the Cauchy-Schwarz inequality gives

    <x, y> <= sum over segments of L * (m_x * m_y + s_x * s_y)

or, for squared distances, |x - y|^2 >= sum of L * ((m_x - m_y)^2 + (s_x - s_y)^2).
The bound tightens as segments get shorter. It is taken in rotated coordinates, the
principal axes of a bounded sample in order of their weight: a rotation changes no
product, and where vectors have structure it leaves the later segments little.

Queries are taken in blocks of fixed size. A block is handed to all tasks together
with a floor for each query, the k-th best exact score in the sample; candidates stay
where they are and are read as a stream. From the coarsest resolution to the finest,
candidates whose bound lies below the floor go; exact scores are computed for the
survivors alone and raise the floor of what follows. Each task hands on at most k rows
a query. So no vector is shuffled, and memory per task depends on the block sizes only.

Components are integers, scores are exact integers; bounds are floats with a margin
far over their rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import bound_batches
from .scratch import Scratch

SCALE = 64
K = 20
#: Queries handed out together, about, and candidates compared with them at a time.
QUERIES, CANDIDATES = 4096, 512
#: Segments of each resolution; the last has segments of two.
LEVELS = (1, 4, 16, 32)
#: Candidates that seed the floors and the rotation, chosen by a hash.
SAMPLE = 4096
#: A block with more than one survivor in so many pairs is scored as one matrix product.
DENSE = 64
#: A resolution that leaves more than this share of the pairs of a block is left out for the task's next blocks.
USELESS = 0.98


def quantise(df: DataFrame, *, vector: str = "embedding", ident: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """(id, v) with v = floor(scale * x) as longs.

    Rows with a null id or vector or a null or non-finite component take no part. A
    finite component that leaves the range of 64 bits once scaled is an error.
    """

    def scaled(c: Column) -> Column:
        wide = F.lit(float(scale)) * c.cast("double")
        fault = F.raise_error(F.lit("a component leaves the range of 64 bits")).cast("long")
        return F.when(F.abs(wide) < F.lit(float(2**63)), F.floor(wide)).otherwise(fault)

    x = F.transform(vector, scaled)
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return (
        df.where(F.col(ident).isNotNull() & F.col(vector).isNotNull())
        .where(fine)
        .select(F.col(ident).cast("long").alias("id"), x.cast("array<bigint>").alias("v"))
    )


def _stats(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows whose inner products are the upper bounds at this resolution."""
    out = []
    for seg in np.array_split(x, parts, axis=1):
        root = np.sqrt(seg.shape[1])
        out += [root * seg.mean(1), root * seg.std(1)]
    return np.stack(out, 1)


def _axes(sample: np.ndarray) -> np.ndarray:
    """Principal axes, heaviest first; the identity for an empty sample."""
    width = sample.shape[1]
    if not len(sample) or not np.isfinite(gram := sample.T @ sample).all():
        return np.eye(width)
    return np.linalg.eigh(gram)[1][:, ::-1]


class Block:
    """A block of queries of one length, and the best candidates seen so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, sample: tuple[np.ndarray, np.ndarray], k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.most = float(np.abs(vectors.astype(float)).max(initial=0))
        self.axes = _axes(sample[1].astype(float))
        self.x = vectors.astype(float)
        self.levels = [n for n in LEVELS if n <= vectors.shape[1]]
        self.turned = self.x @ self.axes
        self.stats = {n: _stats(self.turned, n) for n in self.levels}
        self.norms = np.linalg.norm(self.x, axis=1)
        self.floor = np.full(len(ids), -np.inf)
        self.reset()
        for a in range(0, len(sample[0]), CANDIDATES):
            self.meet(sample[0][a : a + CANDIDATES], sample[1][a : a + CANDIDATES])
        self.reset()  # the sample's rows come again in the stream; their floor stays

    def reset(self) -> None:
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.pairs, self.left = 0, dict.fromkeys([*self.levels, "exact"], 0)
        self.skip: set[int] = set()

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compares all queries with some candidates of the same length."""
        alive = self.ids[:, None] != ids[None, :]
        self.pairs += alive.size
        if vectors.shape[1] * self.most * float(np.abs(vectors.astype(float)).max(initial=0)) >= 2**53:
            return self._keep(*self._wide(ids, vectors, alive))
        c = vectors.astype(float)
        if np.isfinite(self.floor).any():
            turned = c @ self.axes
            margin = 1e-9 * self.norms[:, None] * np.linalg.norm(c, axis=1).max(initial=0) + 1e-6
            for n in self.levels:
                if n not in self.skip:
                    alive &= self.stats[n] @ _stats(turned, n).T + margin >= self.floor[:, None]
                    if np.count_nonzero(alive) > USELESS * alive.size:
                        self.skip.add(n)
                self.left[n] += np.count_nonzero(alive)
        count = np.count_nonzero(alive)
        self.left["exact"] += count
        if count * DENSE < alive.size:
            rows, cols = np.nonzero(alive)
            score = np.einsum("nd,nd->n", self.x[rows], c[cols])
        else:
            scores = self.x @ c.T
            rows, cols = np.nonzero(alive & (scores >= self.floor[:, None]))
            score = scores[rows, cols]
        # products and sums below 2**53 are exact
        self._keep(rows, ids[cols], np.rint(score).astype(np.int64))

    def _wide(self, ids: np.ndarray, vectors: np.ndarray, alive: np.ndarray):
        """Products that float64 does not hold exactly, as Python integers."""
        rows, cols = np.nonzero(alive)
        q, c = self.vectors.astype(object), vectors.astype(object)
        top = np.array([int(np.dot(q[i], c[j])) for i, j in zip(rows, cols, strict=True)], dtype=object)
        if any(abs(x) >= 2**63 for x in top):
            raise OverflowError("an inner product leaves the range of 64 bits")
        return rows, ids[cols], top.astype(np.int64)

    def _keep(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        rows, ids, score = (np.concatenate(x) for x in zip(self.best, (rows, ids, score), strict=True))
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        kth = place == self.k - 1
        # one unit below, for floats of large scores are rounded
        self.floor[rows[kth]] = np.maximum(self.floor[rows[kth]], score[kth].astype(float) * (1 - 1e-15 * np.sign(score[kth])) - 0.5)
        keep = place < self.k
        self.best = rows[keep], ids[keep], score[keep]

    def result(self) -> pd.DataFrame:
        rows, ids, score = self.best
        return pd.DataFrame({"query_id": self.ids[rows], "vec_id": ids, "score": score})


def _by_length(pdf: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a frame of (id, v), by the vectors' length."""
    lengths = np.array([len(v) for v in pdf["v"]], dtype=int)
    ids = pdf["id"].to_numpy(dtype=np.int64)
    out = {}
    for d in np.unique(lengths):
        at = np.nonzero(lengths == d)[0]
        out[int(d)] = ids[at], np.array([pdf["v"].iloc[i] for i in at], dtype=np.int64).reshape(len(at), d)
    return out


_BEST = "query_id long, vec_id long, score long"


def _search(queries: pd.DataFrame, sample: pd.DataFrame, k: int, report: bool = False):
    """A function for ``mapInPandas`` over candidates: their k best for each query, or what each resolution leaves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds = _by_length(sample)
        blocks = {}
        for d, (ids, vectors) in _by_length(queries).items():
            blocks[d] = Block(ids, vectors, seeds.get(d, (np.zeros(0, np.int64), np.zeros((0, d), np.int64))), k)
        for pdf in batches:
            for d, (ids, vectors) in _by_length(pdf).items():
                for a in range(0, len(ids), CANDIDATES) if d in blocks else ():
                    blocks[d].meet(ids[a : a + CANDIDATES], vectors[a : a + CANDIDATES])
        for block in blocks.values():
            if report:
                yield pd.DataFrame({"segments": [n if n != "exact" else 0 for n in block.left], "pairs": block.pairs, "survivors": block.left.values()})
            else:
                yield block.result()

    return run


def _blocks(queries: DataFrame, candidates: DataFrame) -> tuple[list[DataFrame], pd.DataFrame]:
    """The queries in blocks of about ``QUERIES`` rows, and the sample of candidates."""
    queries = Scratch(queries.sparkSession, "topk").save(queries.distinct(), "queries")
    n = -(-queries.count() // QUERIES)
    sample = candidates.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).toPandas()
    return [queries.where(F.pmod(F.xxhash64("id", "v", F.lit(9)), F.lit(n)) == b) for b in range(n)], sample


def top_k(queries: DataFrame, candidates: DataFrame, *, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query.

    Both inputs are (id, v) as :func:`quantise` gives them. Candidates with the
    query's own id are left out. Ties go to the smaller id. Vectors of unequal
    length are not compared. Queries with fewer than k candidates get all of them,
    those with none no row. Repeated query rows count once; every candidate row counts,
    repeated ones too. Of an id with several query vectors the best rows of all win. Empty
    tables give no rows.
    """
    spark = queries.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "topk")
    blocks, sample = _blocks(queries, candidates)
    if len(blocks) > 1:
        candidates = scratch.save(candidates, "candidates")
    best = spark.createDataFrame([], _BEST)
    for b, block in enumerate(blocks):
        # a block is bounded, whatever the number of queries
        found = candidates.select("id", "v").mapInPandas(_search(block.toPandas(), sample, k), _BEST)
        best = scratch.save(found, f"best-{b}") if b == 0 else best.unionByName(scratch.save(found, f"best-{b}"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def pruning(queries: DataFrame, candidates: DataFrame, *, k: int = K) -> DataFrame:
    """(segments, pairs, survivors): what each resolution leaves of all pairs; 0 segments are the exact scores computed."""
    blocks, sample = _blocks(queries, candidates)
    out = queries.sparkSession.createDataFrame([], "segments int, pairs long, survivors long")
    for block in blocks:
        out = out.unionByName(candidates.select("id", "v").mapInPandas(_search(block.toPandas(), sample, k, True), out.schema))
    return out.groupBy("segments").agg(F.sum("pairs").alias("pairs"), F.sum("survivors").alias("survivors"))


def query(spark, sf_dir: str) -> DataFrame:
    vectors = quantise(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors.where("id % 20 = 0"), vectors)


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""

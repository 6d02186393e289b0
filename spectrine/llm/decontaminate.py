"""Benchmark decontamination.

Finds test items inside documents of any length by the size-partitioned MinHash
containment search of :mod:`.containment`, verified on exact shingle sets: an item
has leaked into a document when at least 80 % of its distinct five-word shingles
occur there. Words are lower-case runs of letters and digits, so punctuation, case
and line breaks do not hide a leak. Items shorter than five words are one shingle, their
whole sequence: they match documents of exactly these words and are not found
inside longer ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .containment import THRESHOLD, contained_items, row_key
from .shingles import WORDS
from .skew import fresh


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
) -> DataFrame:
    """One row (doc_id, item_id, shared, item_shingles) for each document and leaked item.

    ``shared`` counts the item's distinct shingles that the document holds. Null,
    empty and wordless texts on either side match nothing, as do items without id.
    Documents with a null id are reported with a null id. Repeated rows are
    reported once. Rows that repeat an id with another text are judged each by
    itself and the best match is reported. An empty table gives no rows.
    """
    hits = contained_items(
        docs, benchmark, doc_id=doc_id, doc_text=text, item_id=item_id, item_text=item_text, threshold=threshold, words=words
    )
    return (
        docs.select(row_key(doc_id, text).alias("doc"), F.col(doc_id).alias("doc_id"))
        .join(hits, "doc")
        .groupBy("doc_id", F.col("item").alias("item_id"))
        .agg(F.max(F.struct(F.col("shared") / F.col("item_shingles"), "shared", "item_shingles")).alias("best"))
        .select("doc_id", "item_id", F.col("best.shared").cast("long").alias("shared"), F.col("best.item_shingles").cast("long").alias("item_shingles"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of ``benchmark``."""
    names = {k: options.get(k, v) for k, v in (("doc_id", "doc_id"), ("text", "text"))}
    searched = {"doc_text" if k == "text" else k: v for k, v in options.items()}
    hits = contained_items(docs, benchmark, **searched).select("doc").distinct()
    key = fresh("doc", docs.columns)
    keyed = docs.withColumn(key, row_key(names["doc_id"], names["text"]))
    return keyed.join(hits.withColumnRenamed("doc", key), key, "left_anti").select(*docs.columns)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def shingle_sql(source: str, ident: str) -> str:
    """DuckDB SQL for (id, s): the distinct five-word shingles of a table's texts."""
    return f"""
  SELECT DISTINCT {ident} AS id,
         unnest(CASE WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i : i + {WORDS - 1}], ' ')) END) AS s
  FROM (SELECT {ident}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source})
  WHERE len(w) > 0"""


SQL = f"""
WITH d AS ({shingle_sql('documents', 'doc_id')}
), b AS ({shingle_sql('benchmark', 'item_id')}
), q AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared, any_value(q.n) AS item_shingles
FROM b JOIN d ON d.s = b.s JOIN q ON q.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= {THRESHOLD} * any_value(q.n)
"""

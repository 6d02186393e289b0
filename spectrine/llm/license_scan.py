"""Licence notices inside documents.

Templates (name, text) are retrieved by MinHash bands over overlapping windows of
the text and verified by exact shingle containment: a document carries a notice
when at least 80 % of the notice's distinct five-word shingles occur in it. How
windows and bands are set, and why a match is retrieved with near certainty, is
stated in :mod:`.containment`; windows of size class k hold 2 S shingles and start
every S shingles.

``TEMPLATES`` holds short notices of widely used public licences. A fuller list of
full licence texts can be passed as a DataFrame; its size decides by itself
whether the bands are broadcast or shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .containment import THRESHOLD, contained_items, row_key
from .decontaminate import shingle_sql
from .shingles import WORDS

#: Customary notices of public licences.
TEMPLATES = (
    ("mit-line", "Released under the MIT License."),
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "bsd-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
        "the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("cc-by-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def builtin_templates(spark: SparkSession) -> DataFrame:
    """(name, text) of ``TEMPLATES``, as literals of the plan."""
    rows = [F.struct(F.lit(name).alias("name"), F.lit(text).alias("text")) for name, text in TEMPLATES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(
    docs: DataFrame,
    templates: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    name: str = "name",
    template_text: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
) -> DataFrame:
    """One row (doc_id, name, shared, template_shingles) per document and notice found.

    Null, empty and wordless texts match nothing; templates without a name are
    ignored. Documents with a null id are reported with a null id, repeated rows
    once. Rows that repeat an id with another text are judged each by itself and
    the best match is reported. Empty tables give no rows.
    """
    hits = contained_items(
        docs, templates, doc_id=doc_id, doc_text=text, item_id=name, item_text=template_text,
        threshold=threshold, words=words, overlap=True,
    )
    return (
        docs.select(row_key(doc_id, text).alias("doc"), F.col(doc_id).alias("doc_id"))
        .join(hits, "doc")
        .groupBy("doc_id", F.col("item").cast("string").alias("name"))
        .agg(F.max(F.struct(F.col("shared") / F.col("item_shingles"), "shared", "item_shingles")).alias("best"))
        .select("doc_id", "name", F.col("best.shared").cast("long").alias("shared"), F.col("best.item_shingles").cast("long").alias("template_shingles"))
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), builtin_templates(spark))


_VALUES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
SQL = f"""
WITH templates(name, text) AS (VALUES {_VALUES}
), d AS ({shingle_sql('documents', 'doc_id')}
), b AS ({shingle_sql('templates', 'name')}
), q AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS name, count(*) AS shared, any_value(q.n) AS template_shingles
FROM b JOIN d ON d.s = b.s JOIN q ON q.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= {THRESHOLD} * any_value(q.n)
"""

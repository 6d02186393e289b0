"""Queries against their SQL on rows that the given tables may lack."""

import duckdb
import numpy as np

import __spark_entry__
from spectrine.operators import matrix


def both(spark, name, folder, **tables):
    """Rows of the query and of its SQL over tables that are written to ``folder``."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    got = __spark_entry__.queries()[name](spark, str(folder))
    want = con.execute(__spark_entry__.oracle_sql()[name])
    names = [c[0] for c in want.description]
    return sorted(map(tuple, got.select(*names).collect()), key=repr), sorted(want.fetchall(), key=repr)


def test_paths_with_names_of_devices_and_line_separators(spark, tmp_path):
    words = ["Con", "aux.txt", "lpt9", "comx", "com0", "console", "nul..x", "a.", "a. ", "con ", "..\u0085", "", ".", "b c", "é", "x" * 600, "a/" * 20000 + "a", None]
    docs = spark.createDataFrame([(i, "src1", w) for i, w in enumerate(words)], "doc_id long, source string, text string")
    got, want = both(spark, "path_grammar", tmp_path, documents=docs)
    assert got == want
    ok = dict(got)
    assert [w for i, w in enumerate(words) if ok[i]] == ["comx", "com0", "console", "a. ", "con ", "..\u0085", "b c", "é"]


def test_best_of_a_sweep_is_chosen_by_unrounded_errors(spark, tmp_path):
    """Two models whose errors differ from the tenth place on."""
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(5000, 64)).astype("float32"), rng.integers(0, 10, 5000)
    rows = [(i, r.tolist(), int(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got, want = both(spark, "pls_select", tmp_path, embeddings=vectors)
    assert got == want


def test_wide_rows_are_made_of_their_cells(spark, tmp_path):
    """A supplier whose quantities add up to nothing stays, and no row is laid out over all headers."""
    lines = [(1, 10, 5.0), (1, 30, 2.0), (1, 30, 1.0), (2, 20, 4.0), (2, 20, -4.0), (3, 40, 0.5), (None, 10, 2.0)]
    lines += [(k, 1000 * k + 1, 1.0) for k in range(4, 60)]
    df = spark.createDataFrame(lines, "l_suppkey long, l_partkey long, l_quantity double")
    got, want = both(spark, "assemble_sparse", tmp_path, lineitem=df)
    assert got == want and (2, 60, 0, 0.0, 0.0) in got
    sparse = matrix.assemble_sparse(df, "l_suppkey", "l_partkey", "l_quantity", dense=False)
    assert "mapinarrow" not in sparse._jdf.queryExecution().toString().lower()
    rows = {r.l_suppkey: (r.size, r.indices, r["values"]) for r in sparse.collect()}
    assert rows[1] == (60, [0, 2], [5.0, 3.0]) and rows[None] == (60, [0], [2.0])

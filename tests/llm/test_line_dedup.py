from pyspark.sql import functions as F

from spectrine.llm import line_dedup as L


def test_removes_lines_of_many_sites(documents):
    rows = [(i, f"own line of page {i}\nsecond own line {i} with words\nShare this page\nlast words of {i}", "en", f"s{i}") for i in range(12)]
    rows += [(100 + i, f"page {i} again\nfew sites\nmore {i}", "en", f"s{i % 9}") for i in range(30)]
    got = {r.doc_id: r for r in L.remove_boilerplate(documents(rows)).collect()}
    assert got[3].text == "own line of page 3\nsecond own line 3 with words\nlast words of 3" and got[3].n_removed == 1
    assert got[101].n_removed == 0 and got[101].text == rows[13][1]


def test_near_threshold_is_exact(documents):
    rows = []
    for n in range(7, 15):
        rows += [(1000 * n + i, f"line on {n}\nonly here {n} {i} and some more text", "en", f"site{i}") for i in range(n)]
    df = documents(rows)
    for near in (0.0, 0.25, 0.9):
        marks = L.boilerplate_lines(df, near=near)
        assert marks.count() == sum(1 for n in range(7, 15) if n >= L.MIN_SITES)


def test_copies_are_left_whole(documents):
    rows = [(i, "copied line one\ncopied line two\ncopied line three", "en", f"s{i}") for i in range(15)]
    got = L.remove_boilerplate(documents(rows)).collect()
    assert all(r.n_boilerplate == 3 and r.n_removed == 0 and r.text == rows[0][1] for r in got)


def test_short_pages_are_cut_whatever_the_share(documents):
    head = "A long line that stands at the head of every page of a dozen sites"
    rows = [(i, f"{head}\nown {i}", "en", f"s{i}") for i in range(12)]
    rows += [(100 + i, f"{' ' * i}copied one\r\n{chr(10) * i}\tcopied two\n", "en", f"s{i}") for i in range(12)]
    got = {r.doc_id: r for r in L.remove_boilerplate(documents(rows)).collect()}
    assert all((got[i].n_boilerplate, got[i].n_removed, got[i].text) == (1, 1, f"own {i}") for i in range(12))
    # copies that differ in blanks alone stay whole
    assert all(got[r[0]].n_removed == 0 and got[r[0]].text == r[1] for r in rows[12:])


def test_edges(edge, spark):
    got = L.remove_boilerplate(edge.withColumn("n_lines", F.lit("clash")))
    assert got.columns == [*edge.columns, "n_lines", "n_boilerplate", "n_removed"] and got.count() == edge.count()
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert rows[1, None].n_lines == 0 and rows[2, ""].n_lines == 1
    assert L.remove_boilerplate(edge.limit(0)).count() == 0
    assert L.stage(spark, edge, "").columns == edge.columns


def test_stays_native(documents, spark):
    plan = L.remove_boilerplate(documents([(1, "a", "en", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_copies_among_edited_copies_stay_and_columns_pass(documents, spark):
    rows = [(i, "line one\nline two\nline three", "en", f"s{i}") for i in range(20)]  # copies
    rows += [(50 + i, f"line one\nline two\nline three\nedited {i}", "en", f"s{i}") for i in range(20)]  # each once
    rows += [(100 + i, f"common line\nown line {i}", "en", f"s{i}") for i in range(12)] + [(200, "common line\n\tcommon line ", "en", None)]
    df = documents(rows).withColumn("cuts", F.lit(5)).withColumn("part", F.lit(6)).withColumn("weight", F.lit(7))
    got = {r.doc_id: r for r in L.remove_boilerplate(df).collect()}
    assert len(got) == len(rows) and {(r.cuts, r.part, r.weight) for r in got.values()} == {(5, 6, 7)}
    assert all((got[i].text, got[i].n_removed, got[i].n_boilerplate) == (rows[i][1], 0, 3) for i in range(20))
    assert all((got[50 + i].text, got[50 + i].n_removed) == (f"edited {i}", 3) for i in range(20))
    assert all((got[100 + i].text, got[100 + i].n_removed) == (f"own line {i}", 1) for i in range(12))
    assert (got[200].text, got[200].n_removed, got[200].n_lines) == ("", 2, 2)

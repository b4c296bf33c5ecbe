import corpus_pipeline
from quillmesh.llm import line_winnowing, toxicity_kn

A, B, C, D = ("alpha one", "beta two", "gamma three", "delta four")
LONG = " ".join(f"w{i}" for i in range(30))


def test_later_runs_go(spark):
    rows = [(1, f"{A}\n{B}\n{C}\nx"), (2, f"p\n{A}\n{B}\n\n{C}\nq"), (3, f"y\n{LONG}"), (4, f"{LONG} \nz"), (5, f"{A}\nother"), (6, None), (7, ""), (None, LONG), (8, f"{A}\n{B}\n{C}\nx")]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_winnowing.op7(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (4, 0, rows[0][1]) and got[3] == (2, 0, rows[2][1]) and got[5] == (2, 0, rows[4][1])
    assert got[2] == (5, 3, "p\n\nq") and got[4] == (2, 1, "z") and got[8][1] == 4
    assert got[6] == (0, 0, None) and got[7] == (0, 0, "") and got[None][2] == LONG


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert line_winnowing.op7(docs).count() == 0
    assert toxicity_kn.op6(docs, labels).count() == 0


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, before = stage(spark, docs, "/root/testdata/sf0.001"), docs
        assert docs.columns == before.columns
    assert docs.count() > 0


def test_every_run_of_two_lines_goes(spark):
    rows = [(k, f"{a}\n{b}\nown {k}") for k, (a, b) in enumerate([(x, y) for x in "abcdefgh" for y in "ijklmnop"])]
    later = [(1000 + k, f"new {k}\n{t.splitlines()[0]}\n{t.splitlines()[1]}\nother {k}") for k, t in rows]
    got = {r["doc_id"]: r["text"] for r in line_winnowing.op7(spark.createDataFrame([*rows, *later], "doc_id long, text string")).collect()}
    assert all(got[i] == f"new {k}\nother {k}" for k, (i, _) in enumerate(later))
    assert all(got[i] == t for i, t in rows)


def test_matches_at_another_alignment_are_extended(spark):
    rows = [(1, f"{A}\n{B}\nx\n{B}\n{C}\n{D}"), (2, f"{A}\n{B}\n{C}\n{D}\nq")]
    got = {r["doc_id"]: r["text"] for r in line_winnowing.op7(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == "q"

"""Every unlabelled row takes part in the rounds, those with a null label too; labelled rows are bounded."""

from pyspark.sql import functions as F

from quillmesh.llm import cotraining


def test_all_unlabelled_rows_take_part(spark):
    good, bad = "A plain sentence about rivers and hills.", "### $$$ ### $$$ buy %%% buy"
    docs = spark.range(13_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, bad).otherwise(good).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"), F.lit(40).cast("long").alias("n_chars"))
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)] + [(300, None)], "doc_id long, quality int")
    table = cotraining.features(docs, labels)
    assert table.where("role = -1").count() == 12_700
    assert cotraining.features(docs, labels, rows=100).where("role >= 0").count() == 100
    model = cotraining.co_train(table)
    assert model["pool"] == 12_700 and len(model["rounds"]) == cotraining.ROUNDS
    wrong = cotraining.classify(table, model).where(F.col("predicted") != (F.col("doc_id") % 3 != 0).cast("int"))
    assert wrong.count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en", None, None), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert cotraining.op1(docs, labels).count() == 2
    assert cotraining.op1(docs.limit(0), labels).count() == 0


def test_texts_are_not_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b", "en", "x", 3), (2, "c", "en", "x", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    monkeypatch.setattr(cotraining.common, "as_table", lambda df, label: df)
    for threshold in ("-1", "10485760"):  # labels too large to broadcast, and small ones: the same plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            nodes = [cotraining.features(docs, labels)._jdf.queryExecution().executedPlan().initialPlan()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in nodes:
            nodes += [n.children().apply(k) for k in range(n.children().size())]
        moved = [{x.name() for x in (n.output().apply(k) for k in range(n.output().size()))} for n in nodes if n.nodeName() == "Exchange"]
        assert any({"t", "m"} <= x for x in moved) and not any("text" in x for x in moved)

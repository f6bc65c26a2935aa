"""Near-duplicates of more texts in one partition than a task keeps signatures of."""

from pyspark.sql import functions as F

from nestflow.llm import near_dup


def test_copy_of_a_text_whose_signature_was_given_up(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "KEPT", 30)
    words = [" ".join(f"w{k}x{i}" for i in range(8)) for k in range(60)]
    rows = [(k, text) for k, text in enumerate(words + words[:5] + words[20:40])]  # copies of texts long gone and of recent ones
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    rows_at_once = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_at_once)
    spark.conf.set(rows_at_once, "16")
    try:
        signed = near_dup._signed(docs.select(F.col("doc_id").alias("row"), "doc_id", "text"), 5).collect()
    finally:
        spark.conf.set(rows_at_once, before)
    text_of = dict(rows)
    drawn = {text_of[r.doc_id]: (r.d1, r.d2, r.bands, r.marks) for r in signed}
    assert len(signed) == len(rows) and len({(d1, d2) for d1, d2, _, _ in drawn.values()}) == len(words)
    assert all((r.d1, r.d2, r.bands, r.marks) == drawn[text_of[r.doc_id]] for r in signed)

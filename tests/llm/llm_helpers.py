"""Frames for the tests of the corpus operators."""
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns whose
    names clash with those that operators add."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0) for r in rows]
    frame = spark.createDataFrame(full, DOCS)
    return (frame.withColumn("rank", F.lit("x")).withColumn("component", F.lit(1.5))
            .withColumn("node", F.lit(None).cast("string")).withColumn("doc", F.lit("d"))
            .withColumn("score", F.lit("s")).withColumn("shard", F.lit("s")))

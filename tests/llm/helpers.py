"""What the tests of the corpus operators share."""

from __future__ import annotations

DOC = "doc_id bigint, text string"


def docs(spark, rows):
    return spark.createDataFrame(list(rows), DOC)


def clashing(frame):
    """Extra columns named like those that operators make themselves."""
    from pyspark.sql import functions as F

    names = "key label kind words features row tokens copies kept n_bytes h1 salt quality spans".split()
    return frame.select("*", *[F.lit(None).cast("string").alias(n) for n in names])

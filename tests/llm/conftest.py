from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
# columns of the names that operators use inside
CLASHING = ["words", "hash", "pos", "fp", "key", "component", "ids", "begin", "kind", "items", "secret_spans", "_rid", "text_key", "n_words", "_i"]


@pytest.fixture(scope="session")
def docs_of(spark):
    from strata.llm.common import ship

    ship(spark)

    def make(rows, clashing=False):
        df = spark.createDataFrame([tuple(r) for r in rows], DOCS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return df

    return make


@pytest.fixture(scope="session")
def documents(spark):
    from strata.llm.common import table

    return table(spark, SF001, "documents")

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Extra columns whose names clash with those the operators use inside.
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) pairs."""
    def make(rows, parts=3):
        full = [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def clashing(spark):
    """Adds columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["id", "row", "th", "n", "key", "bands", "bucket", "range", "kind", "data", "score", "kept", "lines", "weight", "tokens", "topic",
             "component", "spans", "places", "__text", "ids"]

    def add(df):
        return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(names) if c not in df.columns])
    return add

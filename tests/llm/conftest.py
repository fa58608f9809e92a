import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]])."""

    def make(*rows, extra=False):
        full = [(*r, *[None] * (4 - len(r)), None) for r in rows]
        df = spark.createDataFrame(full, T._parse_datatype_string(DOCS))
        if extra:
            # Columns named as those the operators make or use themselves.
            for name in ("fp", "size", "place", "rank", "row", "score", "p", "cid", "source_size", "taken"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def labels(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")

    return make

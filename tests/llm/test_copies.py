from collections import defaultdict
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from sedimark.llm import copies
from sedimark.llm.queries import ORACLE, QUERIES


def plain(rows):
    """(doc_id, keep_id, group_size, kept, digest) from the definition."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for doc, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc, keep, len(ids), doc == keep, sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    (1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "a "), (7, "a\x00"), (7, "a\x00"), (None, "a"), (None, "lone"),
    (None, "lone"), (8, "x" * 300_000), (9, "x" * 300_000), (10, "x" * 299_999 + "y"), (11, "é"), (12, "é"), (-3, "b"), (-4, "b"),
]


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert found(QUERIES["op13_copies"](spark, small)) == sorted(db.sql(ORACLE["op13_copies"]).fetchall(), key=repr)


def test_edge_cases(documents):
    assert found(copies.classes(documents(*ODD, extra=True))) == plain(ODD)
    assert copies.classes(documents()).count() == 0


@pytest.mark.parametrize("digest", [lambda t: F.lit("same"), lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_contents_decide_whatever_the_digest(documents, digest):
    rows = ODD + [(100 + i, f"text {i % 40}") for i in range(400)]
    assert found(copies.classes(documents(*rows).repartition(7), digest=digest)) == plain(rows)


@pytest.mark.parametrize("share", [1, 5, 10_000])
def test_hot_and_other_groups_agree(documents, monkeypatch, share):
    """The same result whether no group, some or all are hot."""
    monkeypatch.setattr(copies, "HOT_SHARE", share)
    monkeypatch.setattr(copies, "SALTS", 3)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 90}") for i in range(1_000)]
    assert found(copies.classes(documents(*rows).repartition(11))) == plain(rows)


def test_copies_merge_in_their_task(documents, plan):
    """Texts are merged before they are shuffled, and no Python runs."""
    rows = documents(*[(i, "t") for i in range(10)])
    hot = rows.select(F.lit("x").alias("digest"), F.lit(True).alias("hot")).limit(0)
    seen = []
    real = copies.stored
    copies.stored = lambda df, label, *a: seen.append((label, plan(df))) or real(df, label, *a)
    try:
        copies._winners(copies._rows(rows, "doc_id", "text", copies.sha256), hot)
    finally:
        copies.stored = real
    text = dict(seen)["copies-salted"]
    assert "partial_max" in text and text.index("partial_max") > text.index("Exchange hashpartitioning")
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_distinct_documents(documents):
    docs = documents(*ODD, extra=True)
    kept = copies.distinct_documents(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ODD})
    assert {r.doc_id for r in kept.collect()} == {k for _, k, *_ in plain(ODD)}
    assert copies.distinct_documents(documents()).count() == 0

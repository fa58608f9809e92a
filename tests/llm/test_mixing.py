import pytest
from pyspark.sql import functions as F

from sedimark.llm import mixing
from sedimark.llm.queries import ORACLE, QUERIES


def plain_targets(sizes):
    """Clamp, reshare the excess by weight, again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        budget = total - sum(capped.values())
        over = [s for s in rest if budget * weight[s] / sum(weight[r] for r in rest) > 3 * sizes[s]]
        if not over:
            return {**capped, **{s: budget * weight[s] / sum(weight[r] for r in rest) for s in rest}}
        capped.update({s: 3.0 * sizes[s] for s in over})


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 1, "c": 1}, {"a": 5}, {"a": 10, None: 400, "b": 3, "c": 0}, {"a": 7, "b": 7, "c": 7, "d": 900, "e": 2}],
)
def test_targets_equal_plain_filling(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_query_takes_what_is_due(spark, small):
    got = QUERIES["op6_mixing"](spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source")
    for r in got.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("a"), F.sum("size").alias("s"), F.first("source_size").alias("z")).collect():
        assert abs(r.t - r.a) <= 1 and r.s == r.z
    assert got.where("taken > 3 * size").count() == 0
    assert sorted(got.collect()) == sorted(QUERIES["op6_mixing"](spark, small).collect())


def test_query_equals_sql(spark, small):
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(db.sql(ORACLE["op6_mixing"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op6_mixing"](spark, small).collect()) == want


def test_edge_cases(documents):
    docs = documents(
        (1, "a b c", None, "s"), (1, "a b c", None, "s"), (None, "d", None, "t"), (None, None, None, "t"),
        (4, "", None, None), (5, "w " * 50_000, None, "u"), (6, "x\x0by z", None, None), extra=True,
    )
    got = mixing.mix(docs).collect()
    assert len(got) == 7
    assert sorted(r["size"] for r in got) == [0, 0, 1, 2, 3, 3, 50_000]
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert mixing.mix(documents()).count() == 0
    assert mixing.mix(documents((1, None), (2, ""))).agg(F.sum("taken")).first()[0] == 0


def test_documents_come_as_often_as_taken(documents):
    docs = documents(*[(i, "w " * (i % 7 + 1), None, "abc"[i % 3]) for i in range(200)], extra=True)
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns
    taken = {r.doc_id: r.taken / r["size"] for r in mixing.mix(docs.select("doc_id", "text", "source")).collect()}
    times = {r.doc_id: r["count"] for r in made.groupBy("doc_id").count().collect()}
    assert all(abs(times.get(d, 0) - t) <= 0.5 for d, t in taken.items())
    assert mixing.mixed_documents(documents()).count() == 0

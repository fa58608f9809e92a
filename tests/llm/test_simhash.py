import random

import numpy as np
import pytest
import xxhash

from sedimark.llm import simhash
from sedimark.llm.graph import connected
from sedimark.llm.queries import QUERIES


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    best = ids.copy()
    while True:
        new = np.array([best[n].min() for n in near])
        if (new == best).all():
            return best
        best = new


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "A b C d", "a b c d e É\x0bz ß", "x y " * 40_000])
def test_fingerprint_of_the_whole_text(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same_hash(spark):
    got = spark.sql("SELECT xxhash64('a b c d') AS h").first().h
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("level", [1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(level):
    rng = random.Random(level)
    masks = simhash.masks(level)
    for _ in range(3000):
        differing = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(not differing & m for m in masks)


def test_query_equals_brute_force(spark, small):
    got = QUERIES["op8_simhash"](spark, small).toPandas()
    prints = np.array([int(f, 16) for f in got.fingerprint], np.uint64)
    assert (components(got.doc_id.to_numpy(), prints) == got.component_id).all()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert all(int(f, 16) == plain_fingerprint(texts[d]) for d, f in zip(got.doc_id, got.fingerprint, strict=True))


def test_large_buckets_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 16)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(400)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.near_edges(spark.createDataFrame(signed, "fp bigint"))
    roots = {r.node: r.root for r in connected(edges).collect()}
    values = np.array([s[0] for s in signed])
    want = components(values, values.view(np.uint64))
    assert [roots.get(v, v) for v in values.tolist()] == want.tolist()


def test_all_covers_together_bound_a_bucket():
    """One mask of each cover fixes so many bits that the last bucket has no more values than one comparison takes."""
    fixed = np.zeros(1, np.uint64)
    for level in range(1, len(simhash._COVERS) + 1):
        fixed = np.unique(fixed[:, None] | np.array(simhash.masks(level), np.uint64)[None, :])
    assert 2 ** (64 - int(np.bitwise_count(fixed).min())) <= simhash.BUCKET


def test_a_bucket_of_two_covers_is_dealt_a_third_time(spark, monkeypatch):
    """Values that agree wherever a mask of the first and one of the second cover look."""
    monkeypatch.setattr(simhash, "BUCKET", 64)
    unions = [(a | b).bit_count() for a in simhash.masks(1) for b in simhash.masks(2)]
    assert min(unions) == 41
    a, b = next((a, b) for a in simhash.masks(1) for b in simhash.masks(2) if (a | b).bit_count() == 41)
    free = [i for i in range(64) if not (a | b) >> i & 1]
    rng = random.Random(6)
    prints = sorted({sum(1 << i for i in free if rng.random() < 0.5) for _ in range(1_500)})
    dealt, real = [], simhash._dealt
    monkeypatch.setattr(simhash, "_dealt", lambda p, level, owner=None: dealt.append(level) or real(p, level, owner))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.near_edges(spark.createDataFrame(signed, "fp bigint"))
    roots = {r.node: r.root for r in connected(edges).collect()}
    values = np.array([s[0] for s in signed])
    assert [roots.get(v, v) for v in values.tolist()] == components(values, values.view(np.uint64)).tolist()
    assert dealt == [1, 2, 3]


def test_dense_values_join_like_sparse_ones():
    values = np.unique(np.array([sum(1 << i for i in c) for c in __import__("itertools").combinations(range(20), 3)], np.uint64))
    forest = simhash.Forest()
    simhash.linked_in(values, forest)
    assert len(forest.links()) == len(values) - 1


def test_edge_cases(documents, spark):
    long = "alpha beta gamma delta epsilon " * 3000
    docs = documents((5, None), (3, ""), (9, long), (9, long), (7, long + "zeta"), (None, long), (2, "other words here entirely"), extra=True)
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 7), (2, 2), (3, 3), (5, 3), (7, 7), (9, 7), (9, 7)]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7]
    assert simhash.near_duplicates(documents()).count() == simhash.drop_near_duplicates(documents()).count() == 0


def test_repeated_rows_and_rows_without_id_keep_one(documents):
    docs = documents((4, "a b c d e"), (4, "a b c d e"), (None, "k l m n o p"), (None, "k l m n o p"))
    assert sorted(r.text for r in simhash.drop_near_duplicates(docs).collect()) == ["a b c d e", "k l m n o p"]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, i) for i in range(1001, 1200)]
    df = spark.createDataFrame([*chain, *star, (5, 5), (3, 2)], "a bigint, b bigint")
    got = {r.node: r.root for r in connected(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1200)}}
    assert connected(df.where("a < 0")).count() == 0

import zlib
from hashlib import sha256
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sedimark.llm import merkle
from sedimark.llm.queries import ORACLE, QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc, source, lang, n, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)])


def tree_of(hashes):
    """The root, and for every leaf its siblings per level as (before, after)."""
    nodes = [(x, [i]) for i, x in enumerate(hashes)]
    paths = [[] for _ in hashes]
    while len(nodes) > 1:
        upper = []
        for lo in range(0, len(nodes), 3):
            run = nodes[lo : lo + 3]
            for k, (_, below) in enumerate(run):
                step = ([x for x, _ in run[:k]], [x for x, _ in run[k + 1 :]])
                for i in below:
                    paths[i].append(step)
            upper.append((h(*[x for x, _ in run]), [i for _, below in run for i in below]))
        nodes = upper
    return nodes[0][0], paths


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) from the definition."""

    def order(r):
        return (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(*r))

    trees = []
    for _, group in groupby(sorted(rows, key=order), key=lambda r: r[1]):
        members = list(group)
        trees.append((members, *tree_of([leaf_of(*r) for r in members])))
    root, tops = tree_of([t[1] for t in trees])
    out = []
    for (members, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(members, paths, strict=True):
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, steps = leaf_of(*r[:4], text), path + top
            for before, after in steps:
                folded = h(*before, folded, *after)
            proof = h(*[x for before, after in steps for x in before + after])
            out.append((r[0], leaf_of(*r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(documents, rows):
    lengths = {(r[0], r[4]): r[3] for r in rows}
    made = documents(*[(d, t, lang, s) for d, s, lang, _, t in rows])
    assert not any(lengths.values())
    return made


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (4,), (1, 1, 1, 1), (27, 28), (1, 2, 3, 4, 5, 9, 10), (100, 1, 13)])
def test_trees_of_all_sizes(documents, sizes):
    rows = [(100 * s + i, f"s{s:02}", None, None, f"line {i}\nmore") for s, n in enumerate(sizes) for i in range(n)]
    assert found(merkle.verified(frame(documents, rows).repartition(5))) == plain(rows)


def test_edge_cases(documents):
    rows = [
        (1, None, None, None, "a\nb"), (2, None, "en", None, None), (3, "", None, None, ""), (None, "", None, None, "x\ny"),
        (None, "", None, None, None), (4, "é", None, None, "ü\n"), (4, "é", None, None, "ü\n"), (4, "é", None, None, "other"),
        (5, "z", None, None, "l\n" * 200_000), (-6, "z", None, None, "\n"), (7, "-", None, None, "t"), (8, "=", None, None, "t"),
    ]
    docs = frame(documents, rows)
    for name in ("tree", "at", "hash", "found", "path", "mark"):
        docs = docs.withColumn(name, F.lit("x"))
    assert found(merkle.verified(docs)) == plain(rows)
    assert merkle.verified(documents()).count() == 0


def test_a_row_that_repeats_is_spread(documents):
    rows = [(7, "hot", None, None, "same\n")] * 200 + [(i, "hot", None, None, "t") for i in range(40)]
    assert found(merkle.verified(frame(documents, rows))) == plain(rows)


def test_query_equals_sql(spark, small):
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(db.sql(ORACLE["op12_merkle"]).fetchall(), key=repr)
    got = QUERIES["op12_merkle"](spark, small)
    names = [c[0] for c in db.sql(ORACLE["op12_merkle"]).description]
    assert found(got.select(*names)) == want
    assert {r.verified for r in got.select("verified").distinct().collect()} == {True, False}


def test_any_change_is_found(documents):
    """Only the row whose leaf changed fails, and its path alone shows it."""
    rows = [(i, "ab"[i % 2], None, None, f"text {i}") for i in range(30)]
    docs = frame(documents, rows)
    changed = F.when(F.col("doc_id") == 11, F.lit("0" * 64)).otherwise(merkle.leaf([F.col(c) for c in merkle.FIELDS]))
    got = merkle.manifest(docs, checked=changed).collect()
    assert [r.doc_id for r in got if not r.verified] == [11]
    for r in got:
        value = r.leaf
        for before, after in r.path:
            value = h(before, value, after)
        assert value == r.root

import itertools

import numpy as np
import pytest

from sedimark.llm import quality
from sedimark.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(5))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    emit, steps, starts = rng.normal(size=11), rng.normal(size=(2, 2)), np.array([0, 4, 5, 11])
    want, pairs = np.zeros(11), np.zeros((2, 2))
    for a, b in itertools.pairwise(starts):
        paths = list(itertools.product((0, 1), repeat=b - a))
        weight = np.array([np.exp(emit[a:b] @ y + sum(steps[p] for p in itertools.pairwise(y))) for y in map(np.array, paths)])
        weight /= weight.sum()
        want[a:b] = weight @ np.array(paths)
        for w, y in zip(weight, paths, strict=True):
            for p in itertools.pairwise(y):
                pairs[p] += w
    good, found = quality.marginals(emit, steps, starts)
    assert np.allclose(good, want) and np.allclose(found, pairs)


def test_neighbours_are_features():
    rows, lengths = quality.document("One line.\n\n  \nTWO!! LINES!!\nthree lines")
    own = 6 * quality.SHARES
    assert rows.shape == (3, quality.WIDTH) and lengths.tolist() == [9, 13, 11]
    assert (rows[1, own : 2 * own] == rows[0, :own]).all() and (rows[1, 2 * own : 3 * own] == rows[2, :own]).all()
    assert (rows[0, own : 2 * own] == 0).all() and rows[:, -3:].tolist() == [[1, 1, 0], [1, 0, 0], [1, 0, 1]]


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op10_quality"](spark, folder)
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = got.where("held_out").join(truth, "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() > 0.9
    assert got.where("held_out <> (crc32(cast(doc_id AS string)) % 5 = 0)").count() == 0
    assert got.count() == 1000 and got.where("score < 0 OR score > 1").count() == 0


def test_edge_cases(documents, labels):
    good, bad = "The river was low, and the stones were dry.\nThey walked on until noon.", "BUY!! NOW!! CHEAP!!\n### $$$ ###"
    rows = [(i, good if i % 2 else bad) for i in range(80)]
    marks = labels(*[(i, i % 2, None) for i in range(80)], (None, 1, None), (3, None, None))
    odd = [(900, None), (901, ""), (902, " \n\n "), (903, bad * 5000), (None, good), (904, "word " * 100_000)]
    docs = documents(*rows, *odd, *odd[:1], extra=True)
    got = quality.score(docs, marks).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by = {r.doc_id: r for r in got}
    assert [by[i].predicted for i in (900, 901, 902, 903, None)] == [0, 0, 0, 0, 1]
    assert all(0 <= r.score <= 1 for r in got)


def test_labelled_documents_of_very_many_lines(documents, labels, monkeypatch):
    """They do not pass through the driver: the sample is bounded by lines as well."""
    monkeypatch.setattr(quality, "TRAIN_LINES", 200)
    good, bad = "The river was low, and the stones were dry.\nThey walked on until noon.", "BUY!! NOW!! CHEAP!!\n### $$$ ###"
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(100, f"{good}\n" * 150_000), (101, f"{bad}\n" * 3_000)]
    seen, real = [], quality._learn
    monkeypatch.setattr(quality, "_learn", lambda f, y: seen.append(sum(map(len, f))) or real(f, y))
    got = quality.score(documents(*rows), labels(*[(i, i % 2, None) for i in range(60)], (100, 1, None), (101, 0, None))).collect()
    assert seen and 50 < seen[0] <= 200
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id < 100)


def test_without_labels_or_rows(documents, labels):
    assert quality.score(documents(), labels((1, 1, 1))).count() == 0
    got = quality.score(documents((1, "a line"), (2, None)), labels()).collect()
    assert all(0 <= r.score <= 1 for r in got)
    assert quality.score(documents((1, "a line")), labels((1, 1, None))).first().predicted == 1

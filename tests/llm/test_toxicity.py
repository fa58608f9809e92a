import numpy as np
import pytest

from sedimark.llm import toxicity
from sedimark.llm.queries import QUERIES


def best_sum(scores):
    return max((scores[a:b].sum() for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)


def maximal(scores, offset=0):
    """Take out the best segment, then the same to its left and right."""
    if not len(scores) or best_sum(scores) <= 0:
        return []
    top = best_sum(scores)
    a, b = next((a, b) for n in range(1, len(scores) + 1) for a in range(len(scores) - n + 1) for b in [a + n] if abs(scores[a:b].sum() - top) < 1e-9)
    return [*maximal(scores[:a], offset), (a + offset, b + offset), *maximal(scores[b:], offset + b)]


@pytest.mark.parametrize("seed", range(60))
def test_all_maximal_segments(seed):
    rng = np.random.default_rng(seed)
    scores = rng.integers(-5, 4, 24) + rng.normal(0, 0.01, 24)
    assert [(a, b) for a, b, _ in toxicity.segments(scores)] == maximal(scores)


def steps_of(scores):
    """Lines run by the scan."""
    import sys

    count = 0

    def trace(frame, event, arg):
        nonlocal count
        if frame.f_code is not toxicity.segments.__code__:
            return None
        count += event == "line"
        return trace

    sys.settrace(trace)
    try:
        toxicity.segments(scores)
    finally:
        sys.settrace(None)
    return count


@pytest.mark.parametrize(
    "piece", [[1.0, -2.0], [2.0, -1.0], [1.0, -1.0], [3.0, -1.0, 1.0, -4.0], [1.0, -3.0, 2.0, -1.0, 2.0, -1.5]],
)
def test_scan_steps_grow_in_proportion(piece):
    """Falling, rising and level running totals: twice the runs, twice the steps."""
    few, many = (steps_of(np.array(piece * n)) for n in (500, 4_000))
    assert many < 9 * few


def test_scan_of_random_texts_is_linear():
    scores = np.random.default_rng(0).choice([2.0, -0.5], 40_000, p=[0.1, 0.9])
    assert len(toxicity.segments(scores)) > 100 and steps_of(scores) < 12 * steps_of(scores[:4_000])


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op9_toxicity"](spark, folder)
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = got.where("held_out").join(truth, "doc_id").toPandas()
    # A third of the toxic rows use forms that this small training part shows too rarely.
    assert (held.predicted == held.toxic).mean() > 0.9
    assert held[held.toxic == 1].score.mean() > held[held.toxic == 0].score.mean() + 0.3
    assert got.where("held_out <> (crc32(cast(doc_id AS string)) % 3 = 1)").count() == 0
    assert got.count() == 1000 and got.where("score < 0 OR score > 1").count() == 0


def made(documents, labels):
    rng = np.random.default_rng(1)
    clean = "day house tree water light stone river cloud".split()
    rows, marks = [], []
    for i in range(300):
        words = list(rng.choice(clean, 40))
        if i % 5 == 0:
            words[7:9] = ["vilest", "vileness"]
        rows.append((i, " ".join(words)))
        marks.append((i, None, int(i % 5 == 0)))
    return rows, labels(*marks)


def test_edge_cases(documents, labels):
    rows, marks = made(documents, labels)
    odd = [(900, None), (901, ""), (None, "vilest vileness " * 3), (902, "vilely vileness vilest"), (903, "tree " * 300_000), (904, "tree " * 300_000 + "vilest vileness vilest")]
    docs = documents(*rows, *odd, *odd[:1], extra=True)
    got = toxicity.score(docs, marks).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by = {r.doc_id: r for r in got}
    assert [by[i].predicted for i in (900, 901, 903)] == [0, 0, 0]
    # An unseen form of a toxic stem counts, and so does a passage in a very long text.
    assert [by[i].predicted for i in (None, 902, 904)] == [1, 1, 1]
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in rows if d % 5} | {900, 901, 903}


def test_significant_passages_are_named(documents, labels):
    rows, marks = made(documents, labels)
    model = toxicity.fit(documents(*rows), marks)
    text = "tree " * 50 + "vilest vileness " + "stone " * 50 + "vileness vilest"
    _, found = toxicity.Scorer(model).evidence(text)
    assert [(a, b) for a, b, _ in found] == [(50, 52), (102, 104)]


def test_without_labels_or_rows(documents, labels):
    rows = documents((1, "a b c"), (2, None))
    assert [r.predicted for r in toxicity.score(rows, labels()).collect()] == [0, 0]
    assert toxicity.score(documents(), labels((1, 1, 1))).count() == 0
    assert [r.predicted for r in toxicity.score(rows, labels((1, None, 0), (None, 1, 1), (2, None, None))).collect()] == [0, 0]

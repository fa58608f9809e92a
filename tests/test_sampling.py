import hashlib

import pytest

from sedimark.operators.sampling import bounded_sample, train_test


def smallest(ids, rows, seed=42):
    digest = {i: hashlib.md5(f"sample-{seed}|{i}".encode()).hexdigest() for i in ids}
    return sorted(ids, key=lambda i: (digest[i], i))[:rows]


@pytest.mark.parametrize("rows", [1, 10, 500, 1999, 2000, 5000])
def test_sample_is_the_smallest_hashes(spark, rows):
    found = sorted(r[0] for r in bounded_sample(spark.range(2000), rows, ["id"]).collect())
    assert found == sorted(smallest(range(2000), rows))


def test_sample_does_not_depend_on_layout(spark):
    expected = sorted(smallest(range(3000), 40))
    for n in (1, 5, 40):
        found = bounded_sample(spark.range(3000).repartition(n), 40, ["id"])
        assert sorted(r[0] for r in found.collect()) == expected


def test_sample_widens_a_bound_that_was_too_tight(spark, monkeypatch):
    from sedimark.operators import sampling

    tight = []

    def narrow(digest, fraction, honest=sampling.below_fraction):
        tight.append(fraction)
        return honest(digest, fraction / 8)

    monkeypatch.setattr(sampling, "below_fraction", narrow)
    found = bounded_sample(spark.range(5000), 600, ["id"])
    assert sorted(r[0] for r in found.collect()) == sorted(smallest(range(5000), 600))
    assert len(tight) > 1


def test_empty_sample_is_an_error(spark):
    with pytest.raises(ValueError, match="at least one"):
        bounded_sample(spark.range(3), 0, ["id"])


def test_train_and_test_rows_of_a_sample(spark):
    """The split must not follow the order in which the sample was drawn."""
    sample = bounded_sample(spark.range(20000), 2000, ["id"])
    train, test = train_test(sample, ["id"])
    assert train.count() + test.count() == 2000
    assert 330 < test.count() < 470
    assert train.join(test, "id").count() == 0

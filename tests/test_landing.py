import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.operators import snapshots
from sedimark.sources import history
from sedimark.streaming.landing import Delivery, ingest_arrivals

SCHEMA = T.StructType([T.StructField("ID", T.IntegerType()), T.StructField("City", T.StringType())])
D1, D2 = "2025-01-01", "2025-01-02"


@pytest.fixture()
def place(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    names = iter(range(1_000))

    class Place:
        bronze, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")

        def arrive(self, *rows):
            lines = ["ID,City", *[f"{i},{c}" for i, c in rows]]
            (tmp_path / "landing" / f"{next(names)}.csv").write_text("\n".join(lines) + "\n")

        def ingest(self, day, schema=SCHEMA):
            return ingest_arrivals(spark, str(tmp_path / "landing"), schema, self.bronze, self.progress, day)

        def rows(self):
            found = history.scan(spark, self.bronze).select("id", "city", "situation_date").collect()
            return sorted((r.id, r.city, str(r.situation_date)) for r in found)

    return Place()


def test_a_redelivered_day_replaces(place):
    place.arrive((1, "a"), (2, "b"))
    place.arrive((3, "c"))
    assert place.ingest(D1) == 3
    place.arrive((9, "z"))
    assert place.ingest(D2) == 1
    assert place.rows() == [(1, "a", D1), (2, "b", D1), (3, "c", D1), (9, "z", D2)]
    place.arrive((1, "again"))
    assert place.ingest(D1) == 1
    assert place.rows() == [(1, "again", D1), (9, "z", D2)]
    # Nothing new arrived: the day stays.
    assert place.ingest(D1) == 0 and place.rows() == [(1, "again", D1), (9, "z", D2)]


def test_streamed_and_batch_days_are_read_together(spark, place):
    batch = spark.createDataFrame([(5, "batch")], "id int, city string")
    snapshots.write_batches(snapshots.tag_batch(batch, D2), place.bronze)
    place.arrive((1, "a"))
    place.ingest(D1)
    snapshots.write_batches(snapshots.tag_batch(batch, "2025-01-03"), place.bronze)
    assert place.rows() == [(1, "a", D1), (5, "batch", D2), (5, "batch", "2025-01-03")]
    place.arrive((6, "streamed"))
    place.ingest(D2)
    assert place.rows()[1] == (5, "batch", "2025-01-03") and place.rows()[2] == (6, "streamed", D2)


def test_a_repeated_batch_id_changes_nothing(spark, place):
    delivery = Delivery(spark, place.progress)
    delivery.open(D1, place.bronze)
    rows = spark.createDataFrame([(1, "a")], "id int, city string")
    for _ in range(2):
        delivery.add(rows, 0)
    delivery.add(rows.withColumn("id", F.lit(2)), 1)
    assert delivery.publish() == 2
    assert place.rows() == [(1, "a", D1), (2, "a", D1)]


def test_an_interrupted_call_goes_on(spark, place, monkeypatch):
    """Files read before the failure are in the stage; the checkpoint does not give them again."""
    place.arrive((1, "a"))
    with monkeypatch.context() as broken:
        broken.setattr(Delivery, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            place.ingest(D1)
    assert not Path(place.bronze).exists()
    place.arrive((2, "b"))
    assert place.ingest(D1) == 2
    assert place.rows() == [(1, "a", D1), (2, "b", D1)]


def test_an_interrupted_day_is_completed_before_another(spark, place, monkeypatch):
    place.arrive((1, "a"))
    with monkeypatch.context() as broken:
        broken.setattr(Delivery, "publish", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            place.ingest(D1)
    place.arrive((2, "b"))
    assert place.ingest(D2) == 1
    assert place.rows() == [(1, "a", D1), (2, "b", D2)]


def test_a_published_stage_is_not_published_again(spark, place):
    """The call failed after the day was written and before its stage was removed."""
    delivery = Delivery(spark, place.progress)
    delivery.open(D1, place.bronze)
    delivery.add(spark.createDataFrame([(1, "a")], "id int, city string"), 0)
    delivery.publish()
    assert json.loads(Path(place.progress, "ledger.json").read_text())["published"]
    place.arrive((2, "b"))
    assert place.ingest(D1) == 1
    assert place.rows() == [(2, "b", D1)]


def test_a_later_call_may_have_other_columns(spark, place):
    place.arrive((1, "a"))
    place.ingest(D1)
    (Path(place.bronze).parent / "landing" / "wide.csv").write_text("ID,City,Lanes\n2,b,4\n")
    place.ingest(D2, T.StructType.fromDDL("ID int, City string, Lanes int"))
    found = history.scan(spark, place.bronze)
    assert found.columns[-2:] == ["lanes", "situation_date"]
    assert sorted(tuple(r) for r in found.select("id", F.coalesce("lanes", F.lit(0))).collect()) == [(1, 0), (2, 4)]

"""Each stage on what its predecessor kept, against its own plain meaning."""

import pytest

import corpus_pipeline
from sedimark.llm import language, mixing, pieces, simhash, toxicity
from sedimark.llm.tables import read_table


@pytest.fixture(scope="module")
def kept(spark, small, tmp_path_factory):
    """Every stage's rows, written and read again as the next one's documents."""
    base, docs, made = tmp_path_factory.mktemp("pipeline"), read_table(spark, small, "documents"), {}
    made["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(f"{base}/{name}")
        made[name] = docs = spark.read.parquet(f"{base}/{name}")
    return made


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_near_dedup", "mixing", "pieces"]
    assert all(kept[n].columns == kept["documents"].columns for n in list(kept)[:-1])


def test_language_stage_keeps_clean_documents(kept):
    rejected = {r.doc_id for r in language.identify(kept["documents"]).where("rejected").collect()}
    assert ids(kept["language_id"]) == ids(kept["documents"]) - rejected
    assert len(rejected) <= 1


def test_toxicity_stage(spark, small, kept):
    labels = read_table(spark, small, "labels")
    toxic = {r.doc_id for r in toxicity.score(kept["language_id"], labels).where("predicted = 1").collect()}
    assert ids(kept["toxicity"]) == ids(kept["language_id"]) - toxic


def test_dedup_stage(kept):
    groups = simhash.near_duplicates(kept["toxicity"])
    assert sorted(r.doc_id for r in kept["simhash_near_dedup"].collect()) == sorted(
        {r.component_id for r in groups.collect()}
    )


def test_mixing_stage(kept):
    taken = {r.doc_id: r.taken / r["size"] for r in mixing.mix(kept["simhash_near_dedup"]).collect() if r["size"]}
    times = {r.doc_id: r["count"] for r in kept["mixing"].groupBy("doc_id").count().collect()}
    assert all(abs(times.get(d, 0) - t) <= 0.5 for d, t in taken.items())


def test_last_stage_and_run(spark, small, kept):
    assert kept["pieces"].count() == kept["mixing"].count()
    v = pieces.vocabulary(pieces.default_model())
    texts = {r.doc_id: r.text for r in kept["mixing"].collect()}
    assert all(r.lossless and pieces.decode(v, r.ids) == texts[r.doc_id] for r in kept["pieces"].collect())
    run = corpus_pipeline.run(spark, small)
    columns = ["doc_id", "n_ids", "ids_crc32"]
    assert sorted(map(tuple, run.select(*columns).collect())) == sorted(map(tuple, kept["pieces"].select(*columns).collect()))

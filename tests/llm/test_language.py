import numpy as np
import pytest

from sedimark.llm import language
from sedimark.llm.queries import QUERIES

WORDS = {"en": "the thing with other words and these".split(), "fr": "le quelque être où voilà les choses".split()}


@pytest.fixture(scope="module")
def two_languages(documents):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(WORDS["en" if i % 2 else "fr"], 30)), "en" if i % 2 else "fr") for i in range(120)]
    return rows


def test_held_out_rows_are_told_apart(spark, small):
    got = QUERIES["op4_language"](spark, small)
    truth = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(truth, "doc_id").toPandas()
    assert len(held) > 20 and (held.lang == held.lang_pred).mean() > 0.97
    assert got.where("score < 0 OR score > 1").count() == 0
    assert got.where("held_out <> (crc32(cast(doc_id AS string)) % 4 = 2)").count() == 0


def test_prediction_uses_the_text_only(documents, two_languages):
    plain = {r.doc_id: r.lang_pred for r in language.identify(documents(*two_languages)).collect()}
    held = {d for d in plain if (__import__("zlib").crc32(str(d).encode()) % 4) == 2}
    changed = [(d, t, "fr" if d in held else lang, "other") for d, t, lang in two_languages]
    assert {r.doc_id: r.lang_pred for r in language.identify(documents(*changed)).collect()} == plain


def test_edge_cases(documents, two_languages):
    odd = [(500, None), (501, ""), (502, "123 !? 456"), (503, "x"), (None, "the other thing with words"), (504, "the thing " * 50_000), (505, "слово другое"), (505, "слово другое")]
    docs = documents(*two_languages, *odd, extra=True)
    got = language.identify(docs).collect()
    assert len(got) == len(two_languages) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score, by[i].rejected) for i in (500, 501, 502)] == [("und", 0.0, True)] * 3
    assert by[None].lang_pred == by[504].lang_pred == "en"
    assert by[503].lang_pred in WORDS and by[505].rejected
    kept = language.drop_rejected(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {d for d, *_ in two_languages} | {None, 504}
    assert not {500, 501, 502, 505} & {r.doc_id for r in kept.collect()}


def test_prediction_equals_the_nearest_centroid(documents, two_languages):
    """By brute force: the cosine with every centroid, from the definition of the vectors."""
    docs = documents(*two_languages, (700, "thing où the les"), (701, "zz"))
    model, letters = language.fit(docs), language.letter_table()
    assert len(model.names) == 2 * language.CENTROIDS or set(model.names) == set(WORDS)
    for r in language.identify(docs).collect():
        text = next(t for d, t, *_ in [*two_languages, (700, "thing où the les"), (701, "zz")] if d == r.doc_id)
        counts = language.ngram_counts(text, letters)
        value = np.log1p(counts) * model.idf
        value /= np.sqrt((value**2).sum())
        cosines = [float((c.astype(float) * value).sum() / np.sqrt((c.astype(float) ** 2).sum())) for c in model.centroids]
        assert abs(r.score - max(cosines)) < 1e-3
        near = {n for n, c in zip(model.names, cosines, strict=True) if c > max(cosines) - 1e-5}
        assert r.lang_pred in near
        floor = model.floors[int(np.argmax(cosines))] * min(counts.sum() / language.SHORT, 1) ** 0.5
        assert r.rejected == (max(cosines) < floor) or abs(max(cosines) - floor) < 1e-4


def test_null_and_repeated_ids_in_the_sample(documents, monkeypatch):
    """Rows without id take no places of the sample, and an id that repeats takes one."""
    monkeypatch.setattr(language, "SAMPLE_ROWS", 5)
    rows = [(None, f"nothing {i}", "en") for i in range(300)] + [(7, f"the thing {i}", "en") for i in range(300)]
    rows += [(10 + i, "other words and these", "en") for i in range(40)]
    sample = language._sample(documents(*rows)).collect()
    assert len(sample) == 5 and len({r.doc_id for r in sample}) == 5 and all(r.doc_id is not None for r in sample)
    many = documents(*[(i, f"t{i}", "en" if i % 3 else "fr") for i in range(4_000)])
    chosen = language._sample(many).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in chosen} == {"en": 5, "fr": 5}


def test_foreign_texts_of_the_same_script_are_rejected(spark):
    """Languages that no row has, in Latin letters; short clean texts stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = [
        (900_001, "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", None),
        (900_002, "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.", None),
        (900_003, "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności.", None),
        (900_004, "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.", None),
    ]
    more = spark.createDataFrame([(d, t, lang, None, None) for d, t, lang in foreign], docs.schema)
    got = {r.doc_id: r for r in language.identify(docs.unionByName(more)).collect()}
    assert all(got[d].rejected for d, *_ in foreign)
    # Invented prose of the learned languages, whole and cut short.
    clean = docs.where("lang IS NOT NULL AND length(text) BETWEEN 200 AND 4000").limit(100).collect()
    short = [(800_000 + i, r.text[:60].rsplit(" ", 1)[0], None, None, None) for i, r in enumerate(clean)]
    again = {r.doc_id: r for r in language.identify(docs.unionByName(spark.createDataFrame(short, docs.schema))).collect()}
    assert sum(again[r.doc_id].rejected for r in clean) == 0
    assert sum(again[d].rejected for d, *_ in short) <= 2


def test_without_languages_or_rows(documents):
    assert language.identify(documents()).count() == 0
    assert [r.lang_pred for r in language.identify(documents((1, "some text"))).collect()] == ["und"]


def test_counts_cover_whole_texts():
    letters = language.letter_table()
    text = "ab cd " * 400_000
    assert language.ngram_counts(text, letters).sum() >= 4 * 400_000

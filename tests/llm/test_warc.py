import hashlib
from datetime import datetime, timedelta, timezone
from pathlib import Path

import duckdb
import pytest

from sedimark.llm import files, warc
from sedimark.llm.queries import ORACLE, QUERIES

PAGES = "page_id bigint, url string, html string"
LONG = "<p>" + "x" * 200 + "</p>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<html>é page {i} {'y' * (i % 300)}</html>") for i in range(400)]
    rows += [(1000, "u", LONG), (900, "u", LONG), (950, None, LONG), (900, "u", LONG), (None, "u", LONG)]
    rows += [(2000, "u", "short"), (2001, "u", "short"), (2002, "u", None), (2003, "a\r\nb: c", ""), (2004, "u", "z" * 3_000_000)]
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS digest", "'y' AS bytes").repartition(5)


@pytest.fixture(scope="module")
def archive(pages):
    return warc.write(pages)


def plain(rows):
    first = {}
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        target = first.get(data)
        again = target is not None and page != target
        yield page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", target if again else None


def key(row):
    return repr(row)


def test_records_come_back(pages, archive):
    got = [tuple(r) for r in warc.read(archive).drop("payload").collect()]
    assert sorted(got, key=key) == sorted(plain(pages.collect()), key=key)


def test_payloads_come_back(pages, archive):
    stored = {r.page_id: bytes(r.payload) for r in warc.read(archive).where("record_type = 'response'").collect()}
    texts = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert all(stored[p] == texts[p] for p in stored)


def test_one_record_is_fetched_from_its_frame(spark, archive):
    wanted = spark.createDataFrame([(7,), (1000,), (2004,), (77777,)], "page_id bigint")
    got = {r.page_id: r for r in warc.fetch(archive, wanted).collect()}
    assert set(got) == {7, 1000, 2004}
    assert bytes(got[7].payload).startswith("<html>é page 7 ".encode())
    assert (got[1000].record_type, got[1000].refers_to, got[1000].payload) == ("revisit", 900, None)
    assert got[2004].payload_bytes == 3_000_000


def test_bundles_are_plain_zstandard_with_a_seek_table(archive):
    import zstandard

    name = archive.index.first().bundle
    frames = warc.seek_table(archive.folder, name)
    data = Path(archive.folder.removeprefix("file:")).joinpath(name).read_bytes()
    whole = b"".join(
        zstandard.ZstdDecompressor().decompressobj().decompress(data[at : at + size]) for at, size, _, _ in frames
    )
    assert len(whole) == sum(f[2] for f in frames)
    assert whole.startswith(b"WARC/1.1\r\n")


def records(archive):
    """Headers and block of every record, by walking the bundles from start to end."""
    for name in [r.bundle for r in archive.index.select("bundle").distinct().collect()]:
        for start, packed, plain, check in warc.seek_table(archive.folder, name):
            content, at = warc.frame_content(archive.folder, name, start, packed, check), 0
            while at < plain:
                headers, block, at = warc.parse(content, at)
                yield headers, block


def test_headers_that_the_format_demands(pages, archive):
    found = list(records(archive))
    assert len(found) == pages.count()
    ids = [h["WARC-Record-ID"] for h, _ in found]
    assert len(set(ids)) == len(ids) and all(i.startswith("<urn:uuid:") for i in ids)
    assert len({h["WARC-Date"] for h, _ in found}) == 1
    for headers, block in found:
        assert datetime.strptime(headers["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ")
        assert headers["Content-Type"] == "application/http; msgtype=response"
        assert int(headers["Content-Length"]) == len(block) and headers["WARC-Target-URI"]
        if headers["WARC-Type"] == "response":
            head, body = block.split(b"\r\n\r\n", 1)
            assert head.startswith(b"HTTP/1.1 200 OK\r\n") and f"Content-Length: {len(body)}".encode() in head
        else:
            assert (headers["WARC-Refers-To-Target-URI"], headers["Refers-To-Page-ID"], block) == ("u", "900", b"")
            assert headers["WARC-Refers-To-Date"] == headers["WARC-Date"]


def test_date_is_a_parameter(spark):
    given = datetime(2024, 2, 3, 5, 6, 7, tzinfo=timezone(timedelta(hours=1)))
    archive = warc.write(spark.createDataFrame([(1, None, "x")], PAGES), date=given)
    ((headers, _),) = records(archive)
    assert (headers["WARC-Date"], headers["WARC-Target-URI"]) == ("2024-02-03T04:06:07Z", "urn:none")


def test_index_and_frames_must_agree(archive):
    short = warc.Archive(archive.folder, archive.index.where("page_id is null or page_id <> 7"))
    with pytest.raises(Exception, match="index"):
        warc.read(short).collect()


def test_damage_is_found(archive):
    name = archive.index.first().bundle
    start, packed, _, check = warc.seek_table(archive.folder, name)[0]
    with pytest.raises(ValueError, match="damaged"):
        warc.frame_content(archive.folder, name, start, packed, check ^ 1)


def test_ranges_of_files(tmp_path):
    with files.create(str(tmp_path), "f") as out:
        out.write(b"0123456789")
    assert files.read(f"file://{tmp_path}", "f", -3, 2) == b"78"
    assert files.read(str(tmp_path), "f") == b"0123456789"


def test_empty_table(spark):
    assert warc.digests(spark.createDataFrame([], PAGES)).count() == 0


def test_query_equals_sql(spark, small):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    want = sorted(db.sql(ORACLE["op1_warc"]).fetchall(), key=key)
    assert sorted((tuple(r) for r in QUERIES["op1_warc"](spark, small).collect()), key=key) == want

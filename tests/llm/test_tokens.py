import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sedimark.llm import tokens
from sedimark.llm.queries import QUERIES

ODD = [
    "Don't they'll 'S", "x<|endoftext|>y a", "É é ß ²3 ½ œuvre é   z", "\x1c\x0b a\x85b", "日本 語！", "ΑΣ ΣΑΣ.",
    "İstanbul", "a​b c d", "'''ss ...'t", " ", "", "µ ª _a_b", "A" * 5000, "tab\tand\r\nlines",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_tokenizer())


def plain(library, rows):
    """Rows in ascending order of id, each with its ids, from the library alone."""
    start = 0
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        yield doc, start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)


def test_ids_are_the_librarys(library, spark, small):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = tokens.Tokenizer(tokens.default_tokenizer()).encode(texts)
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_random_strings_are_the_librarys(library, monkeypatch):
    """Also while the tokenizer forgets what it met once."""
    monkeypatch.setattr(tokens, "_KEPT_CHUNKS", 900)
    rng = np.random.default_rng(8)
    signs = list("abcdeiostABCé'ß .,;:!?-_()\"1²½µ\t\n\r\xa0\x0b\x1c\u0130\u0391\u03a3語<|>")
    texts = ["".join(rng.choice(signs, int(rng.integers(0, 60)))) for _ in range(6_000)]
    tokenizer = tokens.Tokenizer(tokens.default_tokenizer())
    for lo in range(0, len(texts), 250):
        part = texts[lo : lo + 250] + texts[:20]
        got = tokenizer.encode(part)
        assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
    assert len(tokenizer.numbers) < 5_000


@pytest.mark.parametrize("size", [0, 1, 31, 32, 33, tokens.BLOCK - 1, tokens.BLOCK, tokens.BLOCK + 1, 3 * tokens.BLOCK + 777])
def test_blocks_round_trip(size):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.zipf(1.3, size), 49_000).astype(np.uint32)
    table = tokens.Frequencies.of(np.bincount(ids, minlength=2).astype(float) + (np.arange(max(int(ids.max(initial=1)) + 1, 2)) == 1))
    assert int(table.share.sum()) == 1 << tokens.SCALE
    blocks = tokens.encode_blocks(ids, table)
    back = tokens.decode_blocks(blocks, table, table.symbols())
    assert np.array_equal(np.concatenate([*back, np.zeros(0, np.uint32)]), ids)
    assert len(blocks) == -(-size // tokens.BLOCK)


def test_blocks_are_independent_and_checked():
    ids = (np.arange(2 * tokens.BLOCK) % 900).astype(np.uint32)
    table = tokens.Frequencies.load(tokens.Frequencies.of(np.bincount(ids).astype(float)).dump())
    blocks = tokens.encode_blocks(ids, table)
    assert np.array_equal(tokens.decode_blocks(blocks[1:], table, table.symbols())[0], ids[tokens.BLOCK :])
    broken = blocks[0][:-1] + bytes([blocks[0][-1] ^ 255])
    with pytest.raises(ValueError, match="checksum"):
        tokens.decode_blocks([broken], table, table.symbols())


def test_skewed_frequencies_keep_every_id():
    counts = np.ones(40_000)
    counts[7] = 1e12
    table = tokens.Frequencies.of(counts)
    assert (table.share > 0).all() and int(table.share.sum()) == 1 << tokens.SCALE


def test_query_equals_the_library(spark, small, library):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op7_tokens"](spark, small).collect())
    assert got == list(plain(library, rows))


def test_edge_cases(documents, library):
    docs = documents((3, None), (1, "a b"), (2, ""), (9, "word " * 60_000), (5, "same"), (5, "same"), (None, "no id"), extra=True)
    got = sorted((tuple(r) for r in tokens.round_trip(docs).collect()), key=lambda r: (r[1], r[0] or -1))
    rows = [(None, "no id"), (1, "a b"), (2, ""), (3, None), (5, "same"), (5, "same"), (9, "word " * 60_000)]
    assert got == list(plain(library, rows))
    assert tokens.round_trip(documents()).count() == 0

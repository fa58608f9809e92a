"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its number of terms alone, and documents of equal m form a stratum. Documents are
dealt to shards in the order of their length, so a shard holds few strata, each with many documents; a length that many
documents have is spread over several shards. Within a shard, a term's postings are ordered by stratum and, within it,
by falling tf: documents of equal (stratum, tf) are one run and gain the same, so an impact is computed once per
run. The first run of a term in a stratum bounds what the term gives any document of it, and the sum over a query's
terms bounds the stratum. Strata are visited by falling bound until the next bound is below the score to beat.

Scores are whole numbers, so results are exact. Document frequencies are summed over all shards before any is searched,
and the shards' best together hold the best of all documents.
"""

from __future__ import annotations

import io
import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.llm import files
from sedimark.llm.tables import stored, stored_with
from sedimark.llm.text import Numbers
from sedimark.session import fresh_path

TOP = 10
SHARD_WORDS, QUERY_BLOCK = 2_000_000, 1_024
# Words that a document counts for besides its own when shards are cut.
_DOCUMENT = 16
# Significant binary digits of a length when shards are cut.
_DIGITS = 12
# Documents of the strata visited first; every further round has twice as many.
_FIRST = 512
_STRETCH = 1 << 20

# ASCII letters to lower case, other letters and digits as they are, all else of ASCII to spaces.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32 for b in range(256))
_ITEM = pa.schema([("block", pa.int64()), ("query", pa.int64()), ("item_id", pa.int64()), ("term", pa.binary()), ("times", pa.int64()), ("w", pa.int64())])


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The whole text's terms in order, in stretches of bounded size."""
    folded, start = (text or "").encode("utf-8", "replace").translate(_FOLD), 0
    while start < len(folded):
        end = folded.find(b" ", start + _STRETCH)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def bag_of(text: str | None) -> Counter[bytes]:
    bag: Counter[bytes] = Counter()
    for stretch in terms_of(text):
        bag.update(stretch)
    return bag


def normaliser(n: int, documents: int, words: int) -> int:
    return 25 + 75 * n * documents // words


@dataclass(frozen=True)
class Shard:
    """Documents by (m, id); per term its runs; per run stratum, tf and the place of its first posting."""

    names: list[bytes]
    frequency: np.ndarray
    ids: np.ndarray
    known: np.ndarray
    m: np.ndarray
    first_doc: np.ndarray
    first_run: np.ndarray
    run_stratum: np.ndarray
    run_tf: np.ndarray
    run_start: np.ndarray
    posting: np.ndarray

    @staticmethod
    def build(ids: np.ndarray, known: np.ndarray, n: np.ndarray, terms: Sequence[bytes], tfs: Sequence[bytes], documents: int, words: int) -> Shard:
        lengths, at = np.unique(n, return_inverse=True)
        m_of = np.array([normaliser(int(x), documents, words) for x in lengths], np.int64)[at]
        order = np.lexsort((ids, ~known, m_of))
        m, first_doc, stratum = np.unique(m_of[order], return_index=True, return_inverse=True)
        numbers = Numbers()
        split = [terms[i].split() for i in order]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        term = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        tf = np.frombuffer(b"".join(tfs[i] for i in order), "<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(order)), sizes)
        group = term * len(m) + stratum[doc]
        sort = np.lexsort((-tf, group))
        group, tf, doc, term = group[sort], tf[sort], doc[sort], term[sort]
        new = np.ones(len(sort), bool)
        new[1:] = (group[1:] != group[:-1]) | (tf[1:] != tf[:-1])
        start = np.flatnonzero(new)
        counts = np.arange(len(numbers) + 1)
        return Shard(
            numbers.names, np.bincount(term, minlength=len(numbers)), ids[order], known[order], m, np.append(first_doc, len(order)),
            np.searchsorted(term[start], counts), stratum[doc[start]], tf[start], np.append(start, len(sort)), doc,
        )

    def dump(self) -> tuple[bytes, bytes]:
        """The dictionary, and all else."""
        packed = []
        for names in (("frequency",), ("ids", "known", "m", "first_doc", "first_run", "run_stratum", "run_tf", "run_start", "posting")):
            out = io.BytesIO()
            if "frequency" in names:
                joined = b" ".join(self.names)
                out.write(len(joined).to_bytes(8, "little") + joined)
            for name in names:
                values = getattr(self, name)
                narrow = values if name in ("ids", "known", "m") else values.astype(np.min_scalar_type(int(values.max(initial=0))))
                np.save(out, narrow, allow_pickle=False)
            packed.append(zstandard.compress(out.getvalue(), 3))
        return packed[0], packed[1]

    @staticmethod
    def dictionary(data: bytes) -> tuple[list[bytes], np.ndarray]:
        """The terms and their document frequencies."""
        raw = io.BytesIO(zstandard.decompress(data))
        names = raw.read(int.from_bytes(raw.read(8), "little")).split()
        return names, np.load(raw).astype(np.int64)

    @staticmethod
    def load(dictionary: bytes, data: bytes) -> Shard:
        raw = io.BytesIO(zstandard.decompress(data))
        return Shard(*Shard.dictionary(dictionary), *[np.load(raw) for _ in range(9)])


class Searcher:
    """A loaded shard: its impacts are computed here, once per run."""

    def __init__(self, shard: Shard) -> None:
        self.shard = shard
        self.number = dict(zip(shard.names, range(len(shard.names)), strict=True))
        self.first_run, self.start = shard.first_run.astype(np.int64), shard.run_start.astype(np.int64)
        self.stratum, self.tf = shard.run_stratum.astype(np.int64), shard.run_tf.astype(np.int64)
        self.impact = (10**9 * self.tf) // (1000 * self.tf + 8 * shard.m[self.stratum])
        self.first_doc = shard.first_doc.astype(np.int64)
        self.in_stratum = np.diff(self.first_doc)
        # Postings read by the last query.
        self.read = 0

    def best(self, terms: Sequence[bytes], weights: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best `top`, ties in the order of ids."""
        known = [(self.number[t], w) for t, w in zip(terms, weights.tolist(), strict=True) if w and t in self.number]
        self.read = 0
        none = np.zeros(0, np.int64)
        if not known:
            return none, none
        at, w = (np.array(x, np.int64) for x in zip(*known, strict=True))
        sizes = self.first_run[at + 1] - self.first_run[at]
        runs = _ranges(self.first_run[at], sizes)
        stratum, gain = self.stratum[runs], np.repeat(w, sizes) * self.impact[runs]
        leads = np.ones(len(runs), bool)
        leads[1:] = stratum[1:] != stratum[:-1]
        leads[np.cumsum(sizes)[:-1]] = True
        bound = np.zeros(len(self.in_stratum), np.int64)
        np.add.at(bound, stratum[leads], gain[leads])

        order = np.argsort(-bound, kind="stable")
        order = order[: int((bound > 0).sum())]
        documents = np.cumsum(self.in_stratum[order])
        score = np.zeros(len(self.shard.ids), np.int64)
        found, seen, least, width = none, 0, 1, _FIRST
        while seen < len(order) and bound[order[seen]] >= least:
            until = max(int(np.searchsorted(documents, (documents[seen - 1] if seen else 0) + width)), seen + 1)
            visited = order[seen:until]
            visited = visited[bound[visited] >= least]
            here = np.zeros(len(bound), bool)
            here[visited] = True
            chosen = here[stratum]
            begin = self.start[runs[chosen]]
            length = self.start[runs[chosen] + 1] - begin
            doc = self.shard.posting[_ranges(begin, length)].astype(np.int64)
            np.add.at(score, doc, np.repeat(gain[chosen], length))
            self.read += len(doc)
            met = _ranges(self.first_doc[visited], self.in_stratum[visited])
            found = _leading(np.concatenate((found, met[score[met] > 0])), score, self.shard, top)
            if len(found) == top:
                least = int(score[found[-1]])
            seen, width = until, width * 2
        return found, score[found]


def _leading(docs: np.ndarray, score: np.ndarray, shard: Shard, top: int) -> np.ndarray:
    if len(docs) > top:
        mine = score[docs]
        docs = docs[mine >= np.partition(mine, len(docs) - top)[len(docs) - top]]
    order = np.lexsort((shard.ids[docs], ~shard.known[docs], -score[docs]))
    return docs[order[:top]].astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of each range, one range after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            rows = batch.slice(lo, 500)
            bags = [bag_of(t) for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), pa.array([b.total() for b in bags], pa.int64()), pa.array([b" ".join(b) for b in bags], pa.binary()),
                    pa.array([np.fromiter(b.values(), "<u4", len(b)).tobytes() for b in bags], pa.binary()),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )


@dataclass(frozen=True)
class Index:
    """A folder of shard files and the manifest that lists them: shard, name, dictionary (its bytes)."""

    folder: str
    manifest: DataFrame
    documents: int
    words: int


def _shards(bags: DataFrame) -> DataFrame:
    """`bags` with the shard of each row. Lengths are rounded down to _DIGITS binary digits, some 100,000 at most."""
    rounded = F.expr(f"n - n % shiftleft(1L, greatest(0, length(bin(n)) - {_DIGITS}))")
    sized = bags.withColumn("length", rounded)
    weight = F.sum("n") + F.count(F.lit(1)) * _DOCUMENT
    before = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    lengths = sized.groupBy("length").agg(weight.alias("weight"))
    lengths = lengths.withColumn("from", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    first, last = F.expr(f"`from` div {SHARD_WORDS}"), F.expr(f"(`from` + weight - 1) div {SHARD_WORDS}")
    lengths = lengths.select("length", first.alias("first"), (last - first + 1).alias("span"))
    dealt = sized.join(F.broadcast(lengths), "length")
    return dealt.withColumn("shard", F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("span"))).drop("length", "first", "span")


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The index of all documents' whole texts. Runs jobs. Documents without terms are not in it."""
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    bags = plain.mapInArrow(_bags, "doc_id bigint, n bigint, terms binary, tfs binary").where("n > 0")
    counted = {"documents": F.count(F.lit(1)), "words": F.coalesce(F.sum("n"), F.lit(0))}
    bags, seen = stored_with(bags, "strata-bags", compression="zstd", **counted)
    documents, words = int(seen["documents"]), int(seen["words"])
    folder = fresh_path(spark, "strata-index")

    def index(group: pd.DataFrame) -> pd.DataFrame:
        ids, known, n = (group[c].to_numpy() for c in ("doc_id", "known", "n"))
        shard = Shard.build(ids, known, n, group["terms"].tolist(), group["tfs"].tolist(), documents, words)
        name, (dictionary, rest) = files.fresh_name("stratum", ".bin"), shard.dump()
        with files.create(folder, name) as out:
            out.write(dictionary)
            out.write(rest)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "name": [name], "dictionary": [len(dictionary)]})

    # Arrow gives ids of which some are null as floats, which do not hold all of them.
    dealt = _shards(bags).select("shard", F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "n", "terms", "tfs")
    made = dealt.groupBy("shard").applyInPandas(index, "shard bigint, name string, dictionary bigint")
    return Index(folder, stored(made, "strata-manifest"), documents, words)


def _written(rows: DataFrame, folder: str) -> DataFrame:
    """A file per block of queries: block, file."""

    def write(group: pd.DataFrame) -> pd.DataFrame:
        name = files.fresh_name("queries", ".arrow")
        table = pa.Table.from_pandas(group[list(_ITEM.names)].sort_values("query", kind="stable"), _ITEM, preserve_index=False)
        with files.create(folder, name) as out, pa.ipc.new_stream(out, _ITEM) as sink:
            sink.write_table(table)
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "file": [name]})

    return stored(rows.groupBy("block").applyInPandas(write, "block bigint, file string"), "strata-blocks")


def _meetings(index: Index, blocks: DataFrame, count: int) -> DataFrame:
    """Every block of queries with every shard, as names of files: name, dictionary, file."""
    tasks = 2 * int(index.manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = index.manifest.withColumn("block", F.explode(F.expr(f"sequence(0L, {count - 1}L)")))
    pairs = numbered.join(blocks, "block").repartition(tasks, "shard", "file").sortWithinPartitions("shard", "file")
    return pairs.select("name", "dictionary", "file")


def _over(index: Index, blocks: DataFrame, count: int, folder: str, answer: Callable, schema: str) -> DataFrame:
    """What `answer`, given readers of a shard's two parts, says to each block of queries; as rows of `schema`."""
    place = index.folder

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, object] = {}
        for batch in batches:
            for name, size, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name not in held:
                    held = {name: answer(lambda: files.read(place, name, 0, size), lambda: files.read(place, name, size))}
                with pa.ipc.open_stream(files.read(folder, file)) as source:
                    yield from held[name](source.read_all())

    return _meetings(index, blocks, count).mapInArrow(meet, schema)


def _frequencies(dictionary: Callable, _data: Callable) -> Callable:
    names, frequency = Shard.dictionary(dictionary())
    df_of = dict(zip(names, frequency.tolist(), strict=True))

    def of(queries: pa.Table) -> Iterator[pa.RecordBatch]:
        found = [(t, df_of[t]) for t in queries["term"].unique().to_pylist() if t in df_of]
        block = queries["block"].combine_chunks()[:1].to_pylist() * len(found)
        columns = [pa.array(block, pa.int64()), pa.array([t for t, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "term", "df"])

    return of


def _hits(top: int) -> Callable:
    def open_shard(dictionary: Callable, data: Callable) -> Callable:
        searcher = Searcher(Shard.load(dictionary(), data()))

        def of(queries: pa.Table) -> Iterator[pa.RecordBatch]:
            query, terms = queries["query"].to_numpy(), queries["term"].to_pylist()
            items, known = queries["item_id"].fill_null(0).to_numpy(), queries["item_id"].is_valid().to_numpy()
            weights = queries["times"].to_numpy() * queries["w"].to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(query, prepend=query[:1] - 1)), len(query)).tolist()
            shard = searcher.shard
            best = [searcher.best(terms[a:b], weights[a:b], top) for a, b in zip(cuts, cuts[1:], strict=False)]
            starts = np.repeat(np.array(cuts[:-1], np.int64), [len(d) for d, _ in best])
            docs = np.concatenate([d for d, _ in best] or [starts])
            columns = [
                pa.array(query[starts]), pa.array(items[starts], mask=~known[starts]), pa.array(shard.ids[docs], mask=~shard.known[docs]),
                pa.array(np.concatenate([s for _, s in best] or [starts])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query", "item_id", "doc_id", "score"])

        return of

    return open_shard


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            queries, items, texts = (c.to_pylist() for c in batch.slice(lo, 500).columns)
            rows = [(q, i, *e) for q, i, t in zip(queries, items, texts, strict=True) for e in bag_of(t).items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["query", "item_id", "term", "times"])


def weight(documents: int, df: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2) / (2 * df + 1))).cast("bigint")


def search(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of each item's whole text. Runs jobs.

    Only scores above 0 count; equal scores go to the smaller doc_id, documents without id last. Every row of `items`
    is a query of its own, also where ids repeat or are null. Items are read in blocks, each of which meets every
    shard once.
    """
    plain = items.select(F.monotonically_increasing_id().alias("query"), F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))
    asked = stored(plain.mapInArrow(_asked, "query bigint, item_id bigint, term binary, times bigint"), "strata-asked")
    blocks = max(math.ceil(asked.select("query").distinct().count() / QUERY_BLOCK), 1)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))

    folder = fresh_path(items.sparkSession, "strata-queries")
    unweighed = _written(asked.withColumn("w", F.lit(0).cast("bigint")), folder)
    found = _over(index, unweighed, blocks, folder, _frequencies, "block bigint, term binary, df bigint")
    df = stored(found.groupBy("block", "term").agg(F.sum("df").alias("df")), "strata-frequencies")
    weighed = asked.join(df, ["block", "term"]).withColumn("w", weight(index.documents, F.col("df")))
    ready = _written(weighed.where("w > 0").drop("df"), folder)

    found = stored(_over(index, ready, blocks, folder, _hits(top), "query bigint, item_id bigint, doc_id bigint, score bigint"), "strata-hits")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score for every item over all documents. Runs jobs.

    Null and empty texts have no terms: such documents are never found, such items find nothing. Repeated rows are
    documents of their own. Empty tables give no rows. Other columns are not read.
    """
    return search(build(docs), items, top=top)


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
facts AS (SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM docs WHERE len(terms) > 0),
tf AS (
  SELECT doc_id, (25 + (75 * len(terms) * (SELECT n FROM facts)) // (SELECT l FROM facts))::BIGINT AS m, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, terms, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT n FROM facts) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf GROUP BY term),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

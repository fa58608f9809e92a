"""Token ids in files of interleaved range asymmetric numeral system (rANS) blocks.

One frequency table, counted over the whole corpus, is shared by all files. A file holds the documents of a
stretch of the corpus in ascending id order: independent blocks of interleaved lanes, then the documents' ids
and lengths. Within a block, checkpoints hold the state of every lane at regular steps, and a checksum of the
ids up to the next one; decoding can start at any checkpoint, and all of a file's advance side by side.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimark.llm import files
from sedimark.llm.tables import stored
from sedimark.llm.text import Numbers
from sedimark.session import fresh_path

END_ID = 1
# Width of the probability scale, lanes of a block, steps between checkpoints, checkpoints of a block.
SCALE, LANES, STEPS, POINTS = 20, 32, 512, 4
BLOCK = LANES * STEPS * POINTS
_LOW = np.uint64(1 << 31)
_MAGIC, _TABLE = b"RANS0001", "frequencies.rans"
# Chunks whose ids a worker process remembers.
_KEPT_CHUNKS = 1_000_000
# Ids held by an encoding task before it writes blocks.
_HELD = 32 * BLOCK

# The tokenizer's word pattern, for text of plain Latin letters in lower case.
_UNIT = re.compile(r"[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
_WORD_END = "</w>"
# Bytes of Latin-1 text that may be divided here.
_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA0, 0x100)])
_GAPS = re.compile(r"[ \t\n\r]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Tokenizer:
    """Ids of texts by the tokenizers library, which sees every different word once.

    The vocabulary's words never span white space, so a text's ids are those of the chunks between it. Chunks are
    numbered and their ids kept. A chunk of plain Latin letters that was not met before is divided into the
    tokenizer's own words, of which the library encodes the new ones; any other goes to the library as it is.
    """

    def __init__(self, path: str) -> None:
        # Tasks share the machine's cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(_WORD_END)]] = True
        # How ids are kept between the tasks.
        self.width = "<u2" if len(self.ends) <= 1 << 16 else "<u4"
        self.numbers, self.uses = Numbers(), np.zeros(0, np.int64)
        # New chunks below this number are of plain texts.
        self.plain_until = 0
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def of_worker(path: str) -> Tokenizer:
        """The tokenizer of this worker process: what it has learnt stays from task to task."""
        kept = sys.modules.setdefault("_sedimark_worker", ModuleType("_sedimark_worker")).__dict__
        if path not in kept:
            kept[path] = Tokenizer(path)
        return kept[path]

    def _compact(self) -> None:
        """Forget the chunks met once; of the others, those met most stay."""
        often = np.flatnonzero(self.uses > 1)
        often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[: _KEPT_CHUNKS // 2]])
        numbers = Numbers()
        for i in often.tolist():
            numbers[self.numbers.names[i]]
        self.ids = self.ids[_ranges(self.starts[often], self.sizes[often])]
        self.numbers, self.uses, self.sizes = numbers, self.uses[often], self.sizes[often]
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def plain(text: str) -> bool:
        """Whether the text is of plain Latin letters, without control characters or special tokens."""
        try:
            return "<|" not in text and not text.encode("latin-1").translate(None, _PLAIN)
        except UnicodeEncodeError:
            return False

    def _numbered(self, texts: pa.StringArray | pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all chunks of all texts, and how many each text has. Arrow divides plain texts and gathers
        their different chunks, so that only those become Python strings."""
        plain = np.fromiter(map(self.plain, texts.to_pylist()), bool, len(texts))
        counts = np.zeros(len(texts), np.int64)
        divided = pc.ascii_split_whitespace(texts.filter(pa.array(plain)))
        counts[plain] = divided.value_lengths().to_numpy(zero_copy_only=False)
        coded = divided.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        number = np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))
        self.plain_until = len(self.numbers)
        made = number[coded.indices.to_numpy()] if names else np.zeros(0, np.int64)
        if plain.all():
            return made, counts
        others = [[c for c in _GAPS.split(t) if c] for t in texts.filter(pa.array(~plain)).to_pylist()]
        counts[~plain] = list(map(len, others))
        of_plain = np.repeat(plain, counts)
        at = np.zeros(len(of_plain), np.int64)
        at[of_plain] = made
        at[~of_plain] = [self.numbers[c] for c in chain.from_iterable(others)]
        return at, counts

    def _learn(self) -> None:
        """Ids of the chunks numbered since the last time."""
        names, first = self.numbers.names, len(self.starts)
        composed: list[int] = []
        words: list[list[str]] = []
        library, single = [], []
        for i in range(first, len(names)):
            name = names[i]
            if name.isalpha() and name.islower() and (i < self.plain_until or self.plain(name)):
                single.append(i)
            elif i < self.plain_until or self.plain(name):
                composed.append(i)
                words.append(_UNIT.findall(name.lower()))
            else:
                library.append(i)
        # A chunk that is one word was not composed after all.
        alone = [i for i, w in zip(composed, words, strict=True) if w == [names[i]]]
        if alone:
            single.extend(alone)
            kept = [(i, w) for i, w in zip(composed, words, strict=True) if w != [names[i]]]
            composed, words = [i for i, _ in kept], [w for _, w in kept]
        known = len(names)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        parts = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        single.extend(range(known, len(names)))

        grown = len(names) - first
        self.starts, self.sizes = np.append(self.starts, np.zeros(grown, np.int64)), np.append(self.sizes, np.zeros(grown, np.int64))
        self.uses = np.append(self.uses, np.zeros(grown, np.int64))
        made, end = [self.ids], len(self.ids)

        def keep(at: Sequence[int], flat: np.ndarray, n: np.ndarray) -> None:
            nonlocal end
            self.starts[at], self.sizes[at] = end + np.cumsum(n) - n, n
            made.append(flat)
            end += len(flat)

        for lo in range(0, len(single), 5_000):
            part = single[lo : lo + 5_000]
            # One text of words, told apart by the ids that end a word.
            text = " ".join([names[i] for i in part])
            flat = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            n = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
            if len(n) == len(part) and n.sum() == len(flat):
                keep(part, flat, n)
            else:
                library.extend(part)
        for lo in range(0, len(library), 5_000):
            part = library[lo : lo + 5_000]
            ids = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast([names[i] for i in part], add_special_tokens=False)]
            keep(part, np.concatenate(ids), np.array(list(map(len, ids))))
        self.ids = np.concatenate(made)
        if composed:
            sizes = np.concatenate(([0], np.cumsum(self.sizes[parts])))
            ends = np.cumsum(counts)
            made = [self.ids]
            keep(composed, self.ids[_ranges(self.starts[parts], self.sizes[parts])], sizes[ends] - sizes[ends - counts])
            self.ids = np.concatenate(made)

    def encode(self, texts: pa.StringArray | Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        if len(self.numbers) > _KEPT_CHUNKS:
            self._compact()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        at, counts = self._numbered(texts.fill_null(""))
        if len(self.numbers) > len(self.starts):
            self._learn()
        self.uses += np.bincount(at, minlength=len(self.uses))
        sizes = self.sizes[at]
        flat = self.ids[_ranges(self.starts[at], sizes)]
        cuts = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)]
        return np.split(flat, cuts[:-1])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of each range, one range after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


@dataclass(frozen=True)
class Frequencies:
    """Share of each id out of 2^SCALE, and where its stretch begins."""

    share: np.ndarray
    begin: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Frequencies:
        """Shares in proportion to the counts, at least one for every id that occurs, adding up exactly."""
        total = 1 << SCALE
        if (counts > 0).sum() > total:
            raise ValueError("more ids than the probability scale can tell apart")
        share = np.where(counts > 0, np.maximum(counts * (total / max(counts.sum(), 1)), 1).astype(np.int64), 0)
        order = np.argsort(-share, kind="stable")
        rest = total - int(share.sum())
        while rest and counts.any():
            for i in order.tolist():
                change = rest if rest > 0 else -min(-rest, int(share[i]) // 2)
                share[i] += change
                rest -= change
                if not rest:
                    break
        return Frequencies(share.astype(np.uint64), (np.cumsum(share) - share).astype(np.uint64))

    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.share), dtype=np.uint32), self.share.astype(np.int64))

    def dump(self) -> bytes:
        return zlib.compress(self.share.astype("<u4").tobytes())

    @staticmethod
    def load(data: bytes) -> Frequencies:
        share = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
        return Frequencies(share.astype(np.uint64), (np.cumsum(share) - share).astype(np.uint64))


def encode_blocks(ids: np.ndarray, table: Frequencies) -> list[bytes]:
    """Independent blocks of BLOCK ids; the last one may be shorter.

    A block is its number of ids, its number of checkpoints and of words, then per checkpoint the place of
    its first word, the checksum of its ids and the lanes' states, then the words.
    """
    out: list[bytes] = []
    whole = len(ids) // BLOCK
    groups = [ids[lo * BLOCK : min(lo + 64, whole) * BLOCK].reshape(-1, BLOCK) for lo in range(0, whole, 64)]
    if len(ids) % BLOCK:
        groups.append(ids[None, whole * BLOCK :])
    filler = int(table.share.argmax())
    for group in groups:
        n = group.shape[1]
        rows = -(-n // LANES)
        padded = np.full((len(group), rows * LANES), filler, np.int64)
        padded[:, :n] = group
        symbols = padded.reshape(len(group), rows, LANES)
        state = np.full((len(group), LANES), _LOW)
        words = np.zeros((len(group), rows, LANES), np.uint32)
        sent = np.zeros((len(group), rows, LANES), bool)
        points: dict[int, np.ndarray] = {}
        for t in range(rows - 1, -1, -1):
            share, begin = table.share[symbols[:, t]], table.begin[symbols[:, t]]
            full = state >= share << np.uint64(63 - SCALE)
            sent[:, t], words[:, t] = full, state & np.uint64(0xFFFFFFFF)
            state = np.where(full, state >> np.uint64(32), state)
            whole_part = state // share
            state = (whole_part << np.uint64(SCALE)) + (state - whole_part * share) + begin
            if t % STEPS == 0:
                points[t] = state
        for b, block in enumerate(group):
            per_row = np.concatenate(([0], np.cumsum(sent[b].sum(axis=1))))
            parts = [struct.pack("<III", n, len(points), int(per_row[-1]))]
            for t in sorted(points):
                checksum = zlib.crc32(block[t * LANES : (t + STEPS) * LANES].astype("<u4").tobytes())
                parts.append(struct.pack("<II", int(per_row[t]), checksum) + points[t][b].astype("<u8").tobytes())
            out.append(b"".join(parts) + words[b][sent[b]].astype("<u4").tobytes())
    return out


def decode_blocks(blocks: Sequence[bytes], table: Frequencies, symbols: np.ndarray) -> list[np.ndarray]:
    """The ids of every block. All checkpoints of all blocks are decoded side by side; checksums are verified."""
    counts, owners, sizes, checks, states, starts, words, base = [], [], [], [], [], [], [], 0
    for b, block in enumerate(blocks):
        n, points, held = struct.unpack_from("<III", block)
        counts.append(n)
        width = 8 + 8 * LANES
        for k in range(points):
            at, check = struct.unpack_from("<II", block, 12 + k * width)
            states.append(np.frombuffer(block, "<u8", LANES, 12 + k * width + 8))
            owners.append(b)
            starts.append(base + at)
            checks.append(check)
            sizes.append(min(n - k * STEPS * LANES, STEPS * LANES))
        words.append(np.frombuffer(block, "<u4", held, 12 + points * width))
        base += held
    if not states:
        return [np.zeros(0, np.uint32) for _ in blocks]
    stream = np.concatenate([*words, np.zeros(LANES, np.uint32)]).astype(np.uint64)
    size = np.array(sizes)
    order = np.argsort(-size, kind="stable")
    state, place, rows = np.stack(states)[order], np.array(starts)[order], -(-size[order] // LANES)
    made = np.zeros((len(order), int(rows.max()), LANES), np.uint32)
    active = np.searchsorted(-rows, -np.arange(int(rows.max())), side="left")
    mask = np.uint64((1 << SCALE) - 1)
    for t in range(int(rows.max())):
        if active[t] < len(state):
            state, place = state[: active[t]], place[: active[t]]
        slot = state & mask
        symbol = symbols[slot]
        made[: len(state), t] = symbol
        state = table.share[symbol] * (state >> np.uint64(SCALE)) + slot - table.begin[symbol]
        short = state < _LOW
        taken = np.cumsum(short, axis=1)
        word = stream[np.minimum(place[:, None] + taken - 1, len(stream) - 1)]
        state = np.where(short, (state << np.uint64(32)) | word, state)
        place = place + taken[:, -1]
    found: list[list[np.ndarray]] = [[] for _ in blocks]
    back = np.argsort(order)
    for k, owner in enumerate(owners):
        ids = made[back[k]].ravel()[: sizes[k]]
        if zlib.crc32(ids.astype("<u4").tobytes()) != checks[k]:
            raise ValueError("a block's checksum does not match its ids")
        found[owner].append(ids)
    return [np.concatenate(f) for f in found]


class Shard:
    """Writes one file: blocks as they fill, then the block table and the documents."""

    def __init__(self, folder: str, table: Frequencies, part: int, first: int) -> None:
        self.table, self.part, self.first = table, part, first
        self.name = files.fresh_name("tokens", ".rans")
        self.out = files.create(folder, self.name)
        self.out.write(_MAGIC)
        self.sizes: list[int] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.held: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= _HELD:
            self._write(self.waiting // BLOCK * BLOCK)

    def _write(self, count: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for block in encode_blocks(ids[:count], self.table):
            self.out.write(block)
            self.sizes.append(len(block))
        self.held, self.waiting = [ids[count:]], len(ids) - count

    def close(self) -> tuple:
        """The manifest row."""
        self._write(self.waiting)
        known = np.array([d is not None for d in self.docs], np.uint8)
        packed = [
            np.array(self.sizes, "<u8"), np.array([d or 0 for d in self.docs], "<i8"), np.array(self.lengths, "<u8"), known,
        ]
        tail = zlib.compress(b"".join(a.tobytes() for a in packed), 1)
        self.out.write(tail + struct.pack("<QQQ", len(self.sizes), len(self.docs), len(tail)) + _MAGIC)
        self.out.close()
        return (self.part, self.first, self.name, len(self.docs), sum(self.lengths))


def read_shard(folder: str, name: str, table: Frequencies, symbols: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document of a file, decoding some blocks at a time."""
    blocks, docs, size = struct.unpack("<QQQ", files.read(folder, name, -32, 24))
    if files.read(folder, name, -8, 8) != _MAGIC:
        raise ValueError(f"{name} is not complete")
    tail = zlib.decompress(files.read(folder, name, -32 - size, size))
    ends = np.cumsum([0, 8 * blocks, 8 * docs, 8 * docs, docs])
    sizes, ids, lengths, known = (np.frombuffer(tail[a:b], t) for a, b, t in zip(ends[:-1], ends[1:], ("<u8", "<i8", "<u8", "u1"), strict=True))
    offsets = len(_MAGIC) + np.cumsum(sizes) - sizes
    held, have, at = [], 0, 0

    for doc, length, real in zip(ids.tolist(), lengths.tolist(), known.tolist(), strict=True):
        while have < length:
            until = min(at + 32, blocks)
            data = files.read(folder, name, int(offsets[at]), int(sizes[at:until].sum()))
            cuts = np.concatenate(([0], np.cumsum(sizes[at:until].astype(np.int64)))).tolist()
            held += decode_blocks([data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], table, symbols)
            have, at = sum(map(len, held)), until
        if len(held) != 1:
            held = [np.concatenate(held) if held else np.zeros(0, np.uint32)]
        found, held[0] = held[0][:length], held[0][length:]
        have -= length
        yield doc if real else None, found


@dataclass(frozen=True)
class TokenFiles:
    """A folder of files, and the manifest that lists them: part, first, name, docs, tokens, start."""

    folder: str
    manifest: DataFrame


def _tokenized(docs: DataFrame, doc_id: str, text: str, path: str) -> DataFrame:
    """(part, place, doc_id, ids, counts) in ascending id order: by part, within it by place. Rows without id come first.

    Some rows carry, as pairs of id and number, how often the ids of the rows since the last such row occur.
    Documents are range-partitioned by id; a hash of the text spreads the rows of an id that repeats.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = plain.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, place = Tokenizer.of_worker(path), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2_000):
                rows = batch.slice(lo, 2_000)
                ids = tokenizer.encode(rows.column(2))
                total = np.bincount(np.concatenate([*ids, np.full(len(ids), END_ID, np.uint32)]))
                counts = [None] * (rows.num_rows - 1) + [np.stack((total.nonzero()[0], total[total > 0])).astype("<u8").tobytes()]
                made = pa.array([np.append(i, END_ID).astype(tokenizer.width).tobytes() for i in ids], pa.binary())
                places = pa.array(range(place, place + rows.num_rows), pa.int64())
                place += rows.num_rows
                columns = [rows.column(0), places, rows.column(1), made, pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "place", "doc_id", "ids", "counts"])

    made = dealt.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return made.mapInArrow(encode, "part int, place bigint, doc_id bigint, ids binary, counts binary")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for pairs in batch.column(0).to_pylist():
            at, n = np.frombuffer(pairs, "<u8").astype(np.int64).reshape(2, -1)
            if len(at) and at[-1] >= len(total):
                total = np.append(total, np.zeros(int(at[-1]) + 1 - len(total), np.int64))
            total[at] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])


def write(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> TokenFiles:
    """Token files of every document's whole text with END_ID after it. Runs jobs.

    Null texts are empty. The frequency table is counted over the whole corpus; only it, as long as the
    vocabulary, passes through the driver. A task that runs twice leaves a file the manifest does not name.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    width = Tokenizer(path).width
    tokens = stored(_tokenized(docs, doc_id, text, path), "tokens", "zstd")
    told = tokens.select("counts").where("counts IS NOT NULL")
    counted = told.mapInArrow(_counts, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.float64)
    counts[counted["id"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy()
    folder = fresh_path(spark, "token-files")
    table = Frequencies.of(counts)
    with files.create(folder, _TABLE) as out:
        out.write(table.dump())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shard, rows = Frequencies.load(files.read(folder, _TABLE)), None, []
        for batch in batches:
            for part, place, doc, ids in zip(*batch.columns, strict=True):
                part, place = part.as_py(), place.as_py()
                # Rows come in the order of their file; a new file or a gap starts a new shard.
                if shard and (part != shard.part or place != shard.first + len(shard.docs)):
                    rows.append(shard.close())
                    shard = None
                shard = shard or Shard(folder, table, part, place)
                shard.add(doc.as_py(), np.frombuffer(ids.as_buffer(), width))
        if shard:
            rows.append(shard.close())
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["part", "first", "name", "docs", "tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    made = stored(tokens.drop("counts").mapInArrow(encode, "part int, first bigint, name string, docs bigint, tokens bigint"), "token-manifest")
    # One row per file.
    before = Window.orderBy("part", "first").rowsBetween(Window.unboundedPreceding, -1)
    manifest = made.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return TokenFiles(folder, stored(manifest, "token-manifest"))


def read(made: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, decoded from the files. Each file is one task's work."""
    folder = made.folder
    tasks = int(made.manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, symbols = None, None
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if table is None:
                    table = Frequencies.load(files.read(folder, _TABLE))
                    symbols = table.symbols()
                rows = []
                for doc, ids in read_shard(folder, name, table, symbols):
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    listed = made.manifest.select("name", "start").repartition(tasks)
    return listed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per row, from files written and read back. Runs jobs.

    A null text has the end id alone. Rows without id come first; rows repeated stay repeated, those of equal id
    in the order of a hash of their text. An empty table gives no rows. Other columns are not read.
    """
    return read(write(docs))

"""Piece encoding with seeded merge-dropout, and lossless decoding.

The vocabulary of a public piece model (byte-pair merges ranked by score, byte fallback) is used with an own
agenda: among all neighbouring symbols whose concatenation is a piece, the best one merges first, leftmost
first among equals. A candidate merge is skipped when a keyed hash of the document, the word's place in it
and the merge's place in the word falls below the dropout rate; it never comes back, while merges around it
go on. So every occurrence of a word has draws of its own, alike in every run. The ids of a word without a
skip are remembered with the merges judged on the way; an occurrence that skips none of those has these ids,
any other goes through the agenda itself. Without dropout the ids are those of the model's own encoder.

A literal U+2581, which the model uses for the space, is written by its bytes, so decoding is lossless.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from sedimark.llm.text import Numbers

DROPOUT, SEED = 0.1, 42
MARK = "▁"
# A unit is what merges cannot cross: a run of spaces with the letters after it, or a control character.
_UNIT = re.compile(r" +[^ \x00-\x1f▁]*|[^ \x00-\x1f▁]+|[\x00-\x1f▁]")
_KEPT_UNITS = 150_000
_NONE = np.int32(2**31 - 1)
# Stands where no symbol is, or no longer; -1 is a character without a piece.
_GONE = np.int32(-2)
# Units longer than this are merged one by one with their own agenda, not padded into a block.
_LONG = 64
# Occurrences and units that are merged, or whose draws are made, at once.
_ROWS = 20_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Vocabulary:
    letters: np.ndarray  # id of the piece of each code point, -1 without one; the space has that of MARK
    byte_ids: list[int]  # id of each fallback byte
    table: np.ndarray  # open-addressed: left * size + right -> slot
    merged: np.ndarray  # id of the concatenation, per slot
    pairs: dict[int, int]  # the same without slots, for one pair at a time
    rank: np.ndarray  # place in the order of merges, per id
    by_rank: np.ndarray  # id per place
    size: int
    content: list[bytes]  # text of each id


def _slot(keys: np.ndarray, width: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - width)).astype(np.int64)


_WIDTH = 20


def vocabulary(path: str) -> Vocabulary:
    """Everything the agenda needs, from the model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte_ids, plain, content = [0] * 256, {}, [b""] * size
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            content[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            plain[piece] = i
            content[i] = piece.replace(MARK, " ").encode()
    order = sorted(plain.values(), key=lambda i: -model.get_score(i))
    rank = np.full(size, _NONE)
    rank[order] = np.arange(len(order), dtype=np.int32)
    pairs = [
        (plain[p[:k]] * size + plain[p[k:]], i)
        for p, i in plain.items()
        for k in range(1, len(p))
        if p[:k] in plain and p[k:] in plain
    ]
    table, merged = np.full(1 << _WIDTH, -1, np.int64), np.zeros(1 << _WIDTH, np.int64)
    for key, i in pairs:
        at = int(_slot(np.array([key]), _WIDTH)[0])
        while table[at] >= 0:
            at = (at + 1) % (1 << _WIDTH)
        table[at], merged[at] = key, i
    letters = np.full(0x110000, -1, np.int32)
    for p, i in plain.items():
        if len(p) == 1:
            letters[ord(p)] = i
    letters[ord(" ")], letters[ord(MARK)] = letters[ord(MARK)], -1
    return Vocabulary(letters, byte_ids, table, merged, dict(pairs), rank, np.array(order, np.int32), size, content)


def _concatenations(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Id of the piece that both symbols make, or -1."""
    keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * v.size + right, -2)
    at = _slot(keys, _WIDTH)
    found = np.full(keys.shape, -1, np.int64)
    open_ = np.arange(keys.size)
    flat_keys, flat_at, flat_found = keys.ravel(), at.ravel().copy(), found.ravel()
    while len(open_):
        here = v.table[flat_at[open_]]
        hit = here == flat_keys[open_]
        flat_found[open_[hit]] = v.merged[flat_at[open_[hit]]]
        open_ = open_[~hit & (here >= 0)]
        flat_at[open_] = (flat_at[open_] + 1) % (1 << _WIDTH)
    return flat_found.reshape(keys.shape)


def _keyed(words: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A uniform 64-bit value per candidate merge, from the occurrence's key and the merge's place."""
    x = words + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= middle.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + end.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_BITS = 2**64 - 1


def _keyed_one(word: int, start: int, middle: int, end: int) -> int:
    """`_keyed` for a single candidate."""
    x = (word + start * 0x9E3779B97F4A7C15) & _BITS
    x ^= (middle * 0xC2B2AE3D27D4EB4F + end * 0x165667B19E3779F9) & _BITS
    for _ in range(2):
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _BITS
    return x ^ (x >> 29)


def _limit(dropout: float) -> int:
    return min(int(dropout * 2.0**64), _BITS)


def _merge_block(
    v: Vocabulary, symbols: np.ndarray, lengths: np.ndarray, keys: np.ndarray, dropout: float, judged: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The agenda for many units at once: each round does the best open merge of every unit.

    `symbols` holds the characters of a unit per row, then _GONE, and is changed; returns the symbols left, end to end, and their
    number per unit. A symbol stays at its first character, linked to those before and after it. A merge's place is
    given by the characters where it starts, divides and ends, so the decision to skip it does not depend on the
    order in which it is met. `judged` takes the rows and packed places of all candidates met.
    """
    n, width = symbols.shape
    limit = np.uint64(_limit(dropout))
    inside = np.arange(width) < lengths[:, None]
    flat = symbols.reshape(-1)
    after = np.tile(np.arange(1, width + 1, dtype=np.int32), n)
    before = np.tile(np.arange(-1, width - 1, dtype=np.int32), n)
    # Per gap after a symbol the rank of the merge that closes it, _NONE when there is none or it is skipped.
    rows, ranks = np.arange(n), np.full((n, width), _NONE)

    def judge(at: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> None:
        row = rows[at]
        made = _concatenations(v, flat[row * width + start], flat[row * width + middle])
        met = np.flatnonzero(made >= 0)
        at, row, start, middle, end, made = at[met], row[met], start[met], middle[met], end[met], made[met]
        if judged is not None:
            judged.append((row, (start << 16 | middle << 8 | end).astype(np.int32)))
        if dropout > 0:
            kept = np.flatnonzero(_keyed(keys[row], start, middle, end) >= limit)
            at, start, made = at[kept], start[kept], made[kept]
        ranks.reshape(-1)[at * width + start] = v.rank[made]

    every, start = np.nonzero(inside[:, 1:])
    judge(every, start, start + 1, start + 2)
    while len(rows):
        best = ranks.argmin(axis=1)
        first = ranks.reshape(-1)[np.arange(len(rows)) * width + best]
        at = np.flatnonzero(first < _NONE)
        start, first = best[at], first[at]
        if 4 * len(at) < 3 * len(rows):
            rows, ranks, at = rows[at], ranks[at], np.arange(len(at))
        row = rows[at]
        own = row * width
        middle = after[own + start]
        end = after[own + middle]
        flat[own + start], flat[own + middle], after[own + start] = v.by_rank[first], _GONE, end
        open_ = ranks.reshape(-1)
        open_[at * width + start] = open_[at * width + middle] = _NONE
        right = np.flatnonzero(end < lengths[row])
        before[own[right] + end[right]] = start[right]
        beyond = after[own[right] + end[right]]
        left_of = before[own + start]
        left = np.flatnonzero(left_of >= 0)
        open_[at[left] * width + left_of[left]] = _NONE
        judge(
            np.concatenate([at[right], at[left]]), np.concatenate([start[right], left_of[left]]),
            np.concatenate([end[right], start[left]]), np.concatenate([beyond, end[left]]),
        )
    stays = symbols != _GONE
    return symbols[stays], stays.sum(axis=1)


def _merge_long(v: Vocabulary, symbols: np.ndarray, key: int, dropout: float) -> list[int]:
    """The same agenda for one long unit, as a heap over a linked list."""
    n, limit = len(symbols), _limit(dropout) if dropout > 0 else 0
    pairs, size, rank = v.pairs, v.size, v.rank.tolist()
    made = _concatenations(v, symbols[:-1], symbols[1:])
    gaps = np.flatnonzero(made >= 0)
    if dropout > 0:
        gaps = gaps[_keyed(np.full(len(gaps), key, np.uint64), gaps, gaps + 1, gaps + 2) >= np.uint64(limit)]
    agenda = [(rank[m], a, a + 1, a + 2, m) for a, m in zip(gaps.tolist(), made[gaps].tolist(), strict=True)]
    heapq.heapify(agenda)
    ids = symbols.tolist()
    after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n

    def offer(a: int, b: int) -> None:
        # Bytes stand as -1 and join with nothing; every key of `pairs` has two ids.
        made = pairs.get(ids[a] * size + ids[b], -1) if ids[a] >= 0 and ids[b] >= 0 else -1
        if made >= 0 and (not limit or _keyed_one(key, a, b, ends[b]) >= limit):
            heapq.heappush(agenda, (rank[made], a, b, ends[b], made))

    while agenda:
        _, a, b, end, made = heapq.heappop(agenda)
        if not (alive[a] and alive[b] and after[a] == b and ends[a] == b and ends[b] == end):
            continue
        ids[a], alive[b], ends[a], after[a] = made, False, end, after[b]
        if after[b] < n:
            before[after[b]] = a
            offer(a, after[a])
        if before[a] >= 0:
            offer(before[a], a)
    return [i for i, stays in zip(ids, alive, strict=True) if stays]


class _Ragged:
    """Arrays of different lengths, end to end."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat, self.sizes = flat, sizes
        self.starts = np.cumsum(sizes) - sizes

    def extend(self, other: _Ragged) -> None:
        self.starts = np.concatenate([self.starts, other.starts + len(self.flat)])
        self.flat = np.concatenate([self.flat, other.flat])
        self.sizes = np.concatenate([self.sizes, other.sizes])

    def take(self, at: np.ndarray) -> _Ragged:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return _Ragged(self.flat[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(total)], sizes)


def _no_rows(kind: type) -> _Ragged:
    return _Ragged(np.zeros(0, kind), np.zeros(0, np.int64))


def _joined(parts: list[_Ragged], order: np.ndarray, kind: type) -> _Ragged:
    """The parts in turn hold the rows named by `order`; these rows in their own order."""
    if not parts:
        return _no_rows(kind)
    whole = _Ragged(np.concatenate([p.flat for p in parts]), np.concatenate([p.sizes for p in parts]))
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    return whole.take(at)


class Encoder:
    """Encodes texts. Remembers of the units met: symbols, ids without a skip, and the merges judged for these."""

    def __init__(self, v: Vocabulary, dropout: float = DROPOUT) -> None:
        self.v, self.dropout = v, dropout
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.symbols, self.plain, self.judged = _no_rows(np.int32), _no_rows(np.int32), _no_rows(np.int32)

    def _agenda(self, units: np.ndarray, keys: np.ndarray, dropout: float, judge: bool = False) -> tuple[_Ragged, _Ragged]:
        """Ids of the units' occurrences with the given keys, and the merges judged for them if wanted."""
        v, lengths = self.v, self.symbols.sizes[units]
        order = np.argsort(lengths, kind="stable")
        short = order[: np.searchsorted(lengths[order], _LONG, side="right")]
        made, met = [], []
        for lo in range(0, len(short), _ROWS):
            part = short[lo : lo + _ROWS]
            own = self.symbols.take(units[part])
            block = np.full((len(part), int(own.sizes.max())), _GONE)
            block[np.arange(block.shape[1]) < own.sizes[:, None]] = own.flat
            found: list | None = [] if judge else None
            made.append(self._with_bytes(units[part], _Ragged(*_merge_block(v, block, own.sizes, keys[part], dropout, found))))
            if found:
                rows, places = (np.concatenate(x) for x in zip(*found, strict=True))
                met.append(_Ragged(places[np.argsort(rows, kind="stable")], np.bincount(rows, minlength=len(part))))
            else:
                met.append(_Ragged(np.zeros(0, np.int32), np.zeros(len(part), np.int64)))
        for i in order[len(short) :].tolist():
            start = self.symbols.starts[units[i]]
            ids = _merge_long(v, self.symbols.flat[start : start + lengths[i]], int(keys[i]), dropout)
            made.append(self._with_bytes(units[i : i + 1], _Ragged(np.array(ids, np.int32), np.array([len(ids)]))))
            met.append(_Ragged(np.zeros(0, np.int32), np.zeros(1, np.int64)))
        return _joined(made, order, np.int32), _joined(met, order, np.int32)

    def _with_bytes(self, units: np.ndarray, made: _Ragged) -> _Ragged:
        """Unknown characters, each standing alone as -1, replaced by the ids of their bytes."""
        if not (made.flat < 0).any():
            return made
        owner = np.repeat(np.arange(len(units)), made.sizes)
        parts = np.split(made.flat, np.cumsum(made.sizes)[:-1])
        for k in np.unique(owner[made.flat < 0]).tolist():
            unknown = iter(c for c in self.numbers.names[units[k]] if self.v.letters[ord(c)] < 0)
            ids: list[int] = []
            for i in parts[k].tolist():
                ids.extend([i] if i >= 0 else [self.v.byte_ids[b] for b in next(unknown).encode("utf-8", "surrogatepass")])
            parts[k] = np.array(ids, np.int32)
        return _Ragged(np.concatenate(parts), np.array([len(p) for p in parts], np.int64))

    def _learn(self) -> None:
        """Symbols of the units numbered since the last call, and for all that blocks take their ids without a skip."""
        known = len(self.symbols.sizes)
        names = self.numbers.names[known:]
        if not names:
            return
        points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.symbols.extend(_Ragged(self.v.letters[points], np.fromiter(map(len, names), np.int64, len(names))))
        units = np.arange(known, len(self.numbers))
        if self.dropout > 0:
            # Long units are seldom free of skips and go through the agenda each time.
            short = np.flatnonzero(self.symbols.sizes[units] <= _LONG)
        else:
            short = np.arange(len(units))
        ids, judged = self._agenda(units[short], np.zeros(len(short), np.uint64), 0.0, judge=self.dropout > 0)
        for kept, new in ((self.plain, ids), (self.judged, judged)):
            sizes = np.zeros(len(units), np.int64)
            sizes[short] = new.sizes
            kept.extend(_Ragged(new.flat, sizes))

    def _skipping(self, units: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which occurrences skip a merge that their unit would meet without any skip, or are too long to tell."""
        found, limit = self.symbols.sizes[units] > _LONG, np.uint64(_limit(self.dropout))
        for lo in range(0, len(units), _ROWS):
            met = self.judged.take(units[lo : lo + _ROWS])
            drawn = _keyed(np.repeat(keys[lo : lo + _ROWS], met.sizes), met.flat >> 16, met.flat >> 8 & 255, met.flat & 255)
            found[lo + np.repeat(np.arange(len(met.sizes)), met.sizes)[drawn < limit]] = True
        return found

    def encode(self, texts: Sequence[str], keys: Sequence[int]) -> list[np.ndarray]:
        """Ids of every text; `keys` draws the skips of its words."""
        if len(self.numbers) > _KEPT_UNITS:
            self._forget()
        # Numbered text by text: the units of a block are never all held as strings.
        number = self.numbers.__getitem__
        numbered = [np.fromiter(map(number, _UNIT.findall(" " + t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        counts = np.fromiter(map(len, numbered), np.int64, len(numbered))
        at = np.concatenate([np.zeros(0, np.int64), *numbered])
        del numbered
        self._learn()
        ids, rows = self.plain, at
        if self.dropout > 0 and len(at):
            places = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            drawn = _keyed(np.repeat(np.array([k & _BITS for k in keys], np.uint64), counts), places, places, places)
            again = np.flatnonzero(self._skipping(at, drawn))
            own, _ = self._agenda(at[again], drawn[again], self.dropout)
            # The ids of occurrences with a skip stand behind the remembered ones.
            rows = at.copy()
            rows[again] = len(ids.sizes) + np.arange(len(again))
            ids = _Ragged(ids.flat, ids.sizes)
            ids.extend(own)
        made = ids.take(rows)
        cuts = np.concatenate(([0], np.cumsum(made.sizes)))[np.cumsum(counts)]
        return np.split(made.flat, cuts[:-1]) if len(texts) else []


def decode(v: Vocabulary, ids: Sequence[int]) -> str:
    """The text that the ids were made from."""
    made = b"".join(map(v.content.__getitem__, ids))
    return made[1:].decode("utf-8", "surrogatepass")


def _blocks(texts: list[str], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` characters, so a batch with long texts is not encoded at once."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encoded(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model: str | None = None) -> DataFrame:
    """doc_id, ids, n_ids, ids_crc32, lossless per row; a single pass over doc_id and text.

    ids_crc32 is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers; lossless tells that
    decoding them gave the text back, which holds for every text. The text of null is empty and gives no ids.
    Merges are skipped by the document's id and whole text, so repeated rows are encoded alike. Rows repeated
    stay repeated; an empty table gives no rows. Other columns are not read.
    """
    path = model or default_model()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        encoder = Encoder(v, dropout)
        for batch in batches:
            plain = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _blocks(plain):
                part, names = plain[lo:hi], batch.column(0).slice(lo, hi - lo)
                keys = [
                    xxhash.xxh64_intdigest(f"{n}|{t}".encode("utf-8", "surrogatepass"), seed)
                    for n, t in zip(names.to_pylist(), part, strict=True)
                ]
                ids = encoder.encode(part, keys)
                checks = [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]
                same = [decode(v, i.tolist()) == t for i, t in zip(ids, part, strict=True)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [names, lists, pa.array(np.diff(ends).astype(np.int64)), pa.array(checks, pa.int64()), pa.array(same)],
                    ["doc_id", "ids", "n_ids", "ids_crc32", "lossless"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_ids bigint, ids_crc32 bigint, lossless boolean"
    return docs.select("doc_id", "text").mapInArrow(encode, schema)

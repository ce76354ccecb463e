"""Removal of passages that earlier documents hold: repeated windows, by level-wise doubling.

The first level looks for windows of ``WINDOW`` words that start in more than one document. Only
windows repeated at one length are extended to twice that length: such a window can be repeated
only if both of its halves are. Levels follow until no candidate survives. A word is removed if a
window of the first length covers it that also starts in a document with a smaller id; the later
levels tell how long the repeated passages are.

Documents are packed in blocks, one row for each batch of a scan: the block's distinct words and a
number per word. Whether a window is repeated is asked by its key: a block sends each of its keys
once to the bucket of that key's leading bits, and gets back two bits, whether another block has the
key and whether one has it in a document with a smaller id. A passage that a third of all documents
hold is thus one key per block and no group of rows. Two steps keep the levels small. Documents with
the same words as one with a smaller id are found by a key of their whole text; all their windows
are repeated. And a sieve asks for short keys of all windows first, long enough for the number of
windows, so that the first level asks for those alone that seem repeated. Keys of the levels are
96 bits of a hash over the words' hashes.

Defined results: a null or empty text has no words; texts with fewer words than a window keep all;
a null id is greater than every other; rows that share an id never remove from each other, so
repeated rows have equal results; spans of removed words are joined where they meet or overlap; an
empty table gives an empty result. Other columns are left out. Ids are whole numbers.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import prepare_workers, written
from stratalake.llm.packing import numbered_blocks, pack, pack_bits, run_edges, unpack, unpack_bits

WINDOW = 13
# Keys that one bucket holds at most on average, and bits of a sieve's keys beyond the number's own.
BUCKET_KEYS = 2 << 20
SIEVE_BITS = 5
# Stands for a null id, which is greater than every other.
LAST_ID = np.iinfo(np.int64).max

_MULTIPLIERS = (
    (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)),
    (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)),
)


# --- keys --------------------------------------------------------------------------------------


def joined(first: np.ndarray, second: np.ndarray, lane: int) -> np.ndarray:
    """Keys of sequences made of two parts each, from the parts' keys."""
    spread, scramble = _MULTIPLIERS[lane]
    key = first * spread + second
    key ^= key >> np.uint64(32)
    key *= scramble
    key ^= key >> np.uint64(29)
    return key


def window_keys(words: np.ndarray, length: int, lane: int, window: int = WINDOW) -> np.ndarray:
    """The key of the window of ``length`` words at each place; ``length`` is a doubled window.

    A window's key is joined from those of powers of two, as its length is a sum of them; longer
    windows' keys are joined from their halves.
    """
    power, size, made, done = words, 1, None, 0
    while size <= window:
        if window & size:
            room = len(words) - done - size + 1
            if room <= 0:
                return words[:0]
            made = power[:room] if made is None else joined(made[:room], power[done : done + room], lane)
            done += size
        power = joined(power[:-size], power[size:], lane)
        size *= 2
    while done < length:
        made = joined(made[:-done], made[done:], lane)
        done *= 2
    return made


def word_lanes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word."""
    digests = b"".join(xxhash.xxh3_128_digest(w) for w in words)
    both = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def distinct_keys(low: np.ndarray, high: np.ndarray, ids: np.ndarray):
    """Of keys in two parts: the number of each one's distinct key, and of distinct keys, in order,
    both parts and the smallest id."""
    order = np.lexsort((high, low))
    low, high, ids = low[order], high[order], ids[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    starts = np.flatnonzero(new)
    number = np.empty(len(low), np.int64)
    number[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids, starts) if len(starts) else ids
    return number, low[starts], high[starts], least


def _per_bucket(low: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of sorted keys, by their leading bits."""
    if not bits:
        if len(low):
            yield 0, 0, len(low)
        return
    bucket = (low >> np.uint64(64 - bits)).astype(np.int64)
    found, starts = np.unique(bucket, return_index=True)
    yield from zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(low)])


def bucket_bits(keys: int) -> int:
    return max(0, math.ceil(math.log2(max(1, keys / BUCKET_KEYS))))


# --- asking and answering ----------------------------------------------------------------------

_ASKS = "kind int, bucket int, block long, low binary, high binary, least binary"
_ASK_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_ANSWERS = "kind int, block long, bucket int, count int, elsewhere binary, smaller binary"
_ANSWER_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
WHOLE, SIEVE, LEVEL = 0, 1, 2


def _table(rows: list[tuple], fields: str, types: list) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in types]
    names = [f.split()[0] for f in fields.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _full_asks(kind: int, block: int, low, high, least, bits: int) -> list[tuple]:
    """Rows that ask for distinct keys of both parts, with the smallest id that has each."""
    return [
        (kind, bucket, block, pack(np.diff(low[a:b], prepend=np.uint64(0))), pack(high[a:b]), pack(least[a:b]))
        for bucket, a, b in _per_bucket(low, bits)
    ]


def _answer(asks: pa.Table) -> pa.Table:
    """For each key that a block asked for: whether another block has it, also with a smaller id.

    The keys of a bucket come from all blocks, each block's own once.
    """
    rows = asks.to_pylist()
    lows = [np.cumsum(unpack(r["low"], np.uint64), dtype=np.uint64) for r in rows]
    low, sizes = np.concatenate(lows), [len(x) for x in lows]
    full = rows[0]["high"] is not None
    high = np.concatenate([unpack(r["high"], np.uint32) for r in rows]) if full else np.zeros(len(low), np.uint32)
    least = np.concatenate([unpack(r["least"], np.int64) for r in rows]) if full else np.zeros(len(low), np.int64)
    number, _, _, smallest = distinct_keys(low, high, least)
    elsewhere = np.bincount(number)[number] > 1
    smaller = smallest[number] < least
    out, at = [], 0
    for r, n in zip(rows, sizes):
        own = slice(at, at + n)
        out.append((r["kind"], r["block"], r["bucket"], n, pack_bits(elsewhere[own]), pack_bits(smaller[own])))
        at += n
    return _table(out, _ANSWERS, _ANSWER_TYPES)


def answered(asks: DataFrame) -> DataFrame:
    return asks.groupBy("kind", "bucket").applyInArrow(_answer, _ANSWERS)


def _bits_of(answers: list[dict], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's answers of a kind, in the order of its keys."""
    own = sorted((r for r in answers if r["kind"] == kind), key=lambda r: r["bucket"])
    nothing = [np.zeros(0, bool)]
    return (
        np.concatenate([unpack_bits(r["elsewhere"], r["count"]) for r in own] or nothing),
        np.concatenate([unpack_bits(r["smaller"], r["count"]) for r in own] or nothing),
    )


# --- blocks of documents -----------------------------------------------------------------------

_BLOCKS = "block long, windows long, ids binary, nulls binary, sizes binary, dictionary binary, words binary"
_BLOCK_TYPES = [pa.int64(), pa.int64(), *[pa.binary()] * 5]


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """One row per batch of (id, text): ids, words per text, distinct words, a number per word."""
    for block, batch in numbered_blocks(batches):
        ids = batch.column(0)
        nulls = np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
        numbers = ids.fill_null(int(LAST_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        sizes, parts = [], []
        for text in batch.column(1):
            own = (text.as_py() or "").encode().split()  # on the six ASCII spaces
            sizes.append(len(own))
            parts.append(np.fromiter(map(known.__getitem__, own), np.int32, len(own)))
        counts = np.array(sizes, np.int64)
        row = (
            block,
            int(np.maximum(0, counts - window + 1).sum()),
            pack(numbers),
            pack_bits(nulls),
            pack(counts),
            zstandard.compress(b" ".join(known), 1),
            pack(np.concatenate(parts)),
        )
        yield from _table([row], _BLOCKS, _BLOCK_TYPES).to_batches()


class Block:
    """A block's documents, as arrays."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.ids, self.sizes = unpack(row["ids"], np.int64), unpack(row["sizes"], np.int64)
        self.nulls = unpack_bits(row["nulls"], len(self.ids))
        self.dictionary = zstandard.decompress(row["dictionary"]).split()
        self.words = unpack(row["words"], np.int32)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def whole_keys(self):
        """Of the documents: the distinct keys of their whole texts."""
        lanes = word_lanes(self.dictionary)
        size = self.sizes.astype(np.uint64)
        low, high = size.copy(), size.copy()
        # Sums of words' hashes, each scrambled with its place, over each document.
        place = np.arange(len(self.words)) - np.repeat(self.starts, self.sizes)
        some = np.flatnonzero(self.sizes)
        for lane, out in enumerate((low, high)):
            if len(some):
                keys = joined(lanes[lane][self.words], place.astype(np.uint64), lane)
                out[some] += np.add.reduceat(keys, self.starts[some])
        return distinct_keys(low, (high >> np.uint64(32)).astype(np.uint32), self.ids)

    def window_places(self, window: int) -> np.ndarray:
        """The words at which a window starts."""
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(self.words))
        return np.flatnonzero(left >= window)

    def sieve_keys(self, window: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of windows, number of the key of each, distinct keys cut to their leading bits)."""
        low, _ = word_lanes(self.dictionary)
        at = self.window_places(window)
        keys = window_keys(low[self.words], window, 0, window)[at]
        keys = (keys >> np.uint64(64 - bits)) << np.uint64(64 - bits)
        distinct, number = np.unique(keys, return_inverse=True)
        return at, number, distinct


def _first_asks(batches: Iterator[pa.RecordBatch], window: int, sieve: int, whole_bits: int, sieve_split: int):
    """Ask for the keys of whole texts and for the sieve's keys of all windows."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            _, low, high, least = block.whole_keys()
            out = _full_asks(WHOLE, block.number, low, high, least, whole_bits)
            _, _, keys = block.sieve_keys(window, sieve)
            short = keys >> np.uint64(64 - sieve)
            for bucket, a, b in _per_bucket(keys, sieve_split):
                steps = np.diff(short[a:b], prepend=np.uint64(0))
                out.append((SIEVE, bucket, block.number, pack(steps), None, None))
            yield from _table(out, _ASKS, _ASK_TYPES).to_batches()


# --- levels ------------------------------------------------------------------------------------

# A block at a level: the words that candidate windows cover, their segments and which of the
# places start a candidate; and what the level before found.
_LEVELS = (
    "block long, candidates long, ids binary, segments binary, documents binary, words binary, "
    "lanes_low binary, lanes_high binary, starts binary, origins binary, copies binary, early binary"
)
_LEVEL_TYPES = [pa.int64(), pa.int64(), *[pa.binary()] * 10]


class Segments:
    """Covered words of a block, cut into segments that never go over a document's end."""

    def __init__(self, ids, lengths, documents, words, low, high, starts, origins) -> None:
        self.ids, self.lengths, self.documents = ids, lengths, documents
        self.words, self.low, self.high = words, low, high
        self.starts, self.origins = starts, origins

    @classmethod
    def read(cls, row: dict) -> Segments:
        words = unpack(row["words"], np.int32)
        return cls(
            unpack(row["ids"], np.int64),
            unpack(row["segments"], np.int64),
            unpack(row["documents"], np.int32),
            words,
            unpack(row["lanes_low"], np.uint64),
            unpack(row["lanes_high"], np.uint64),
            unpack_bits(row["starts"], len(words)),
            unpack(row["origins"], np.int64),
        )

    def keys(self, length: int, window: int):
        """(places of candidates, their documents, distinct keys of theirs)."""
        at = np.flatnonzero(self.starts)
        document = np.repeat(self.documents, self.lengths)[at]
        low = window_keys(self.low[self.words], length, 0, window)[at]
        high = window_keys(self.high[self.words], length, 1, window)[at]
        cut = (high >> np.uint64(32)).astype(np.uint32)
        return at, document, distinct_keys(low, cut, self.ids[document])

    def covered(self, at: np.ndarray, length: int) -> Segments:
        """The words that the windows at these places cover; the windows stay as they are."""
        ends = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(ends, at, 1)
        np.add.at(ends, at + length, -1)
        inside = np.cumsum(ends[:-1]) > 0
        breaks = np.zeros(len(self.words), bool)
        first = np.cumsum(self.lengths) - self.lengths
        breaks[first] = True
        segment = np.repeat(np.arange(len(self.lengths)), self.lengths)
        new = inside & (breaks | ~np.concatenate([[False], inside[:-1]]))
        begin = np.flatnonzero(new)
        kept = np.flatnonzero(inside)
        lengths = np.diff(np.concatenate([np.searchsorted(kept, begin), [len(kept)]]))
        used, words = np.unique(self.words[kept], return_inverse=True)
        starts = np.zeros(len(self.words), bool)
        starts[at] = True
        return Segments(
            self.ids, lengths, self.documents[segment[begin]], words.astype(np.int32), self.low[used],
            self.high[used], starts[kept], self.origins[segment[begin]] + begin - first[segment[begin]],
        )

    def doubled(self, at: np.ndarray, length: int) -> Segments:
        """Candidates of twice the length: windows both of whose halves are among ``at``."""
        repeated = np.zeros(len(self.words) + length, bool)
        repeated[at] = True
        segment = np.repeat(np.arange(len(self.lengths)), self.lengths)
        end = np.cumsum(self.lengths)[segment[at]] if len(at) else at
        on = at[(at + 2 * length <= end) & repeated[at + length]]
        return self.covered(on, 2 * length)

    def row(self, block: int, copies: bytes | None, early: bytes) -> tuple:
        return (
            block, int(self.starts.sum()), pack(self.ids), pack(self.lengths), pack(self.documents),
            pack(self.words), pack(self.low), pack(self.high), pack_bits(self.starts), pack(self.origins),
            copies, early,
        )


def _sieved(blocks: pa.Table, answers: pa.Table, window: int, sieve: int) -> pa.Table:
    """The first level's candidates: windows whose short key came back, or is twice in the block.

    Documents with the words of one with a smaller id are marked, and have no candidates.
    """
    if not blocks.num_rows:
        return _table([], _LEVELS, _LEVEL_TYPES)
    block, known = Block(blocks.to_pylist()[0]), answers.to_pylist()
    number, _, _, least = block.whole_keys()
    _, smaller = _bits_of(known, WHOLE)
    copy = (smaller[number] | (block.ids > least[number])) & (block.sizes >= window)
    at, key, distinct = block.sieve_keys(window, sieve)
    elsewhere, _ = _bits_of(known, SIEVE)
    repeated = (elsewhere | (np.bincount(key, minlength=len(distinct)) > 1))[key] if len(at) else np.zeros(0, bool)
    document = np.repeat(np.arange(len(block.sizes), dtype=np.int32), block.sizes)
    on = at[repeated & ~copy[document[at]]]
    filled = np.flatnonzero(block.sizes)
    low, high = word_lanes(block.dictionary)
    whole = Segments(
        block.ids, block.sizes[filled], filled.astype(np.int32), block.words, low, high,
        np.zeros(len(block.words), bool), block.starts[filled],
    )
    state = whole.covered(on, window)
    return _table([state.row(block.number, pack_bits(copy), pack(np.zeros(0, np.int64)))], _LEVELS, _LEVEL_TYPES)


def _level_asks(batches: Iterator[pa.RecordBatch], length: int, window: int, bits: int):
    for batch in batches:
        for row in batch.to_pylist():
            _, _, (_, low, high, least) = Segments.read(row).keys(length, window)
            yield from _table(_full_asks(LEVEL, row["block"], low, high, least, bits), _ASKS, _ASK_TYPES).to_batches()


def _next_level(states: pa.Table, answers: pa.Table, length: int, window: int) -> pa.Table:
    """What a level found in a block, and the candidates of twice its length.

    Found at the first level: runs (start, end) of words to remove, in words of the block. Found at
    the others: documents with a window that one with a smaller id has too.
    """
    if not states.num_rows:
        return _table([], _LEVELS, _LEVEL_TYPES)
    row = states.to_pylist()[0]
    state = Segments.read(row)
    at, document, (number, _, _, least) = state.keys(length, window)
    elsewhere, smaller = _bits_of(answers.to_pylist(), LEVEL)
    early = smaller[number] | (state.ids[document] > least[number])
    repeated = elsewhere[number] | (np.bincount(number)[number] > 1)
    if length == window:
        first = np.cumsum(state.lengths) - state.lengths
        begin = at[early] + np.repeat(state.origins - first, state.lengths)[at[early]]
        found = _joined_runs(begin, document[early], window).reshape(-1)
    else:
        found = np.unique(document[early]).astype(np.int64)
    after = state.doubled(at[repeated], length)
    return _table([after.row(row["block"], None, pack(found))], _LEVELS, _LEVEL_TYPES)


def _joined_runs(begin: np.ndarray, document: np.ndarray, window: int) -> np.ndarray:
    """(start, end) of the words that windows cover, joined where those of a document meet."""
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    new = np.concatenate([[True], (np.diff(begin) > window) | (np.diff(document) != 0)])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(begin) - 1]])
    return np.stack([begin[new], begin[last] + window], axis=1)


# --- on Spark ----------------------------------------------------------------------------------

_RESULTS = "id long, n_words long, n_removed long, longest_repeat long, removed array<struct<start:long,end:long>>, kept_text string"


def _results(blocks: pa.Table, found: pa.Table, window: int) -> pa.Table:
    """The documents of a block without the words that the first level removes."""
    rows = []
    if blocks.num_rows:
        block = Block(blocks.to_pylist()[0])
        n = len(block.sizes)
        longest, copy, runs = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros((0, 2), np.int64)
        for r in found.to_pylist():
            early = unpack(r["early"], np.int64)
            if r["length"] == 0:
                copy = unpack_bits(r["copies"], n)
            elif r["length"] == window:
                runs = early.reshape(-1, 2)
            else:
                longest[early] = np.maximum(longest[early], r["length"])
        owner = np.searchsorted(block.starts + block.sizes, runs[:, 0], side="right")
        longest[owner] = np.maximum(longest[owner], window)
        by_owner: dict[int, list] = defaultdict(list)
        for o, (a, b) in zip(owner.tolist(), runs.tolist()):
            by_owner[o].append((a, b))
        for k, (start, size) in enumerate(zip(block.starts.tolist(), block.sizes.tolist())):
            spans, repeat = by_owner.get(k, []), int(longest[k])
            if copy[k]:
                spans, repeat = [(start, start + size)], window << int(math.log2(size // window))
            kept, at = [], start
            for a, b in [*spans, (start + size, start + size)]:
                kept += map(block.dictionary.__getitem__, block.words[at:a].tolist())
                at = b
            removed = [{"start": a - start, "end": b - start} for a, b in spans]
            rows.append(
                (
                    None if block.nulls[k] else int(block.ids[k]), size,
                    sum(b - a for a, b in spans), repeat, removed, b" ".join(kept).decode(),
                )
            )
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [*[pa.int64()] * 4, span, pa.string()]
    names = ["id", "n_words", "n_removed", "longest_repeat", "removed", "kept_text"]
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document: its words, those removed, the spans of these, and the kept text.

    ``longest_repeat`` is the longest window, of ``window`` words or that doubled time and again,
    that starts in the document and in one with a smaller id; 0 without one.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    blocks = written(slim.mapInArrow(lambda b: _blocks(b, window), _BLOCKS), "blocks")
    windows, count = blocks.agg(F.coalesce(F.sum("windows"), F.lit(0)), F.count(F.lit(1))).first()
    sieve = min(64, max(1, math.ceil(math.log2(windows + 1))) + SIEVE_BITS)
    split = min(sieve, bucket_bits(windows))
    # A block holds a batch of documents at most, so there are far fewer texts than windows.
    first = blocks.mapInArrow(lambda b: _first_asks(b, window, sieve, split, split), _ASKS)
    state = written(
        blocks.groupBy("block")
        .cogroup(answered(first).groupBy("block"))
        .applyInArrow(lambda b, a: _sieved(b, a, window, sieve), _LEVELS),
        "sieved",
    )
    length, found = window, [state.select("block", F.lit(0).alias("length"), "copies", "early")]
    while (candidates := state.agg(F.sum("candidates")).first()[0] or 0) > 0:
        state = _level(state, length, window, bucket_bits(candidates))
        found.append(state.select("block", F.lit(length).alias("length"), "copies", "early"))
        length *= 2
    results = blocks.groupBy("block").cogroup(reduce(DataFrame.union, found).groupBy("block")).applyInArrow(
        lambda b, f: _results(b, f, window), _RESULTS
    )
    kind = docs.schema[id_column].dataType
    return results.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_column)


def _level(state: DataFrame, length: int, window: int, bits: int) -> DataFrame:
    """One level: ask for the candidates' keys, keep what is repeated, and double."""
    live = state.filter("candidates > 0")
    asks = live.mapInArrow(lambda b: _level_asks(b, length, window, bits), _ASKS)
    after = live.groupBy("block").cogroup(answered(asks).groupBy("block")).applyInArrow(
        lambda s, a: _next_level(s, a, length, window), _LEVELS
    )
    return written(after, f"level-{length}")

"""Near-duplicates by SimHash: 64-bit fingerprints that differ in at most a few bits are linked.

A bit of a fingerprint is 1 if it is 1 in over half of the hashes of the text's shingles. Distinct
fingerprints become candidates through tables: 64 bits are cut into ``BLOCKS`` blocks, and two
fingerprints within ``radius`` bits agree in at least ``BLOCKS - radius`` whole blocks, so some
choice of that many blocks is a key that they share. This finds every link.

Within a key the comparison is bit-sliced. The fingerprints are stored as 64 bit planes, with one
lane per fingerprint, so that one machine word holds a bit of 64 fingerprints. The differing bits
against a query are added, three planes at a time, by carry-save full adders to counters that are
stored in the same way. Lanes beyond the radius are marked, and a word is abandoned once all of
its lanes are. A key with many fingerprints is cut into chunks, and each pair of chunks is work of
its own. Only links that join parts not yet joined leave a run of lanes, never all pairs.

Defined results: a null text or one without words has fingerprint 0 and is linked like any other;
a text with fewer words than a shingle is one shingle; copies share a fingerprint and need no
comparison; a group whose ids are all null has a null component; an empty table gives an empty
result. Columns of the input that share a name with a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.common import column_udf, prepare_workers, with_fields, written
from stratalake.llm.components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
HASH_SEED = 42

BLOCKS = 6
# Fingerprints in one chunk of a key; a unit of work holds two chunks at most.
CHUNK = 4096
# Runs up to this length are compared together, pairs as lanes; longer ones one by one.
SHORT_RUN = 64
PAIRS_AT_ONCE = 1 << 18
QUERIES_AT_ONCE = 64

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ------------------------------------------------------------------------------


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of the text's words, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, six ASCII spaces
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(flat, HASH_SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-width] + 1)).tolist()
    hashes = [digest(flat[s:e], HASH_SEED) for s, e in zip(starts, ends[width - 1 :].tolist())]
    return np.array(hashes, np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The fingerprint as a signed long: bits set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.int64)[0])


def with_fingerprints(
    docs: DataFrame, text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """The rows with ``fingerprint``, the 64 bits as a long."""

    def step(texts: list) -> list:
        return [[majority_bits(shingle_hashes(t, shingle_words)) for t in texts]]

    made = column_udf(docs.sparkSession, step, "fingerprint long", [pa.int64()])
    return with_fields(docs, made(F.col(text_column).cast("string")), ["fingerprint"])


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- bit-sliced comparison ---------------------------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Fingerprints stored vertically: row p holds bit p of all, 64 lanes to a word."""
    words = -(-len(values) // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(values)] = np.unpackbits(
        np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def lanes_of(words: np.ndarray) -> np.ndarray:
    """Positions of the set lanes in a row of words."""
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius."""
    above, same = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            same &= counters[k]
        else:
            above |= same & counters[k]
            same &= ~counters[k]
    return above


def lanes_within(
    planes: np.ndarray, queries: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, word, lanes): the lanes of each word within the radius of each query.

    Words without such a lane are left out.
    """
    words = planes.shape[1]
    query, word = np.repeat(np.arange(len(queries)), words), np.tile(np.arange(words), len(queries))
    # A query's bits as whole words, so that a plane is compared by one exclusive or.
    asked = (queries[None, :] >> np.arange(64, dtype=np.uint64)[:, None] & np.uint64(1)) * ALL
    # An open lane is at most at the radius before three more bits are added.
    counters = [np.zeros(len(word), np.uint64) for _ in range((radius + 3).bit_length())]
    far = np.zeros(len(word), np.uint64)
    for p in range(0, 64, 3):
        x = [planes[q][word] ^ asked[q][query] for q in range(p, min(p + 3, 64))]
        if len(x) == 3:
            half = x[0] ^ x[1]
            carry = (x[0] & x[1]) | (x[2] & half)
            one = half ^ x[2]
        else:
            one, carry = x[0], np.zeros_like(x[0])
        _add(counters, 0, one)
        _add(counters, 1, carry)
        far |= _over(counters, radius)
        open_words = far != ALL
        if not open_words.all():
            if not open_words.any():
                return query[:0], word[:0], far[:0]
            if open_words.sum() * 4 < 3 * len(word):
                query, word, far = query[open_words], word[open_words], far[open_words]
                counters = [c[open_words] for c in counters]
    return query, word, ~far


def _add(counters: list[np.ndarray], k: int, carry: np.ndarray) -> None:
    for c in counters[k:]:
        out = c & carry
        c ^= carry
        carry = out


class Forest:
    """Keeps only the links that join parts not yet joined."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        parent = self.parent
        while (above := parent.setdefault(x, x)) != x:
            parent[x] = parent[above]
            x = above
        return x

    def add(self, a: int, b: int) -> None:
        top_a, top_b = self.top(a), self.top(b)
        if top_a != top_b:
            self.parent[max(top_a, top_b)] = min(top_a, top_b)
            self.links.append((a, b))


def link_long_run(values: np.ndarray, radius: int, forest: Forest) -> None:
    """Join the fingerprints of one run that are reachable from each other within it.

    From a fingerprint the search goes on from what it found. What is found once is no target any
    more, so a group of near copies costs little more than its size.
    """
    planes = bit_planes(values)
    left = np.zeros(planes.shape[1] * 64, bool)
    left[: len(values)] = True
    ints = values.view(np.int64).tolist()

    def hits(lanes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        open_words = np.flatnonzero(left.reshape(-1, 64).any(axis=1))
        query, word, found = lanes_within(planes[:, open_words], values[lanes], radius)
        for k, lane in enumerate(lanes.tolist()):
            own = query == k
            full = np.zeros(planes.shape[1], np.uint64)
            full[open_words[word[own]]] = found[own]
            yield lane, lanes_of(full)

    while left.any():
        seeds = np.flatnonzero(left)[:QUERIES_AT_ONCE]
        for seed, first in list(hits(seeds)):
            if not left[seed]:
                continue
            left[seed] = False
            queue = [(seed, first)]
            while queue:
                waiting = []
                for lane, found in queue:
                    new = found[left[found]]
                    left[new] = False
                    for other in new.tolist():
                        forest.add(ints[lane], ints[other])
                    waiting.extend(new.tolist())
                queue = []
                for at in range(0, len(waiting), QUERIES_AT_ONCE):
                    if left.any():
                        queue.extend(hits(np.array(waiting[at : at + QUERIES_AT_ONCE])))


def link_short_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int, forest: Forest) -> None:
    """Join the fingerprints of many short runs; the lanes are pairs of one run."""
    end_of = np.repeat(ends, ends - starts)
    place = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends)]) if len(starts) else end_of
    nothing = np.zeros(1, np.uint64)
    for step in range(1, SHORT_RUN):
        inside = place + step < end_of
        place, end_of = place[inside], end_of[inside]
        if not len(place):
            return
        for at in range(0, len(place), PAIRS_AT_ONCE):
            first = place[at : at + PAIRS_AT_ONCE]
            differing = values[first] ^ values[first + step]
            _, word, found = lanes_within(bit_planes(differing), nothing, radius)
            full = np.zeros(-(-len(first) // 64), np.uint64)
            full[word] = found
            near = lanes_of(full)
            near = first[near[near < len(first)]]
            for a, b in zip(values[near].view(np.int64).tolist(), values[near + step].view(np.int64).tolist()):
                forest.add(a, b)


def link_runs(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys; a run may go over several batches."""
    kept_keys, kept_values = None, np.empty(0, np.uint64)

    def finish(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        forest = Forest()
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        ends = np.r_[starts[1:], keys.shape[1]]
        short = (ends - starts > 1) & (ends - starts <= SHORT_RUN)
        link_short_runs(values, starts[short], ends[short], radius, forest)
        for s, e in zip(starts, ends):
            if e - s > SHORT_RUN:
                link_long_run(values[s:e], radius, forest)
        a, b = zip(*forest.links) if forest.links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
        values = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        if kept_keys is not None:
            keys, values = np.concatenate([kept_keys, keys], axis=1), np.concatenate([kept_values, values])
        if not keys.shape[1]:
            continue
        differs = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
        cut = differs[-1] + 1 if len(differs) else 0
        if cut:
            yield finish(keys[:, :cut], values[:cut])
        kept_keys, kept_values = keys[:, cut:], values[cut:]
    if kept_keys is not None and kept_keys.shape[1]:
        yield finish(kept_keys, kept_values)


# --- distributed search ------------------------------------------------------------------------


def _tables(radius: int) -> list[int]:
    """Masks of the choices of blocks in which two fingerprints within the radius agree."""
    blocks = max(BLOCKS, radius + 1)
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct ``fingerprint`` values within the radius."""
    spark = prints.sparkSession
    prepare_workers(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")
    choices = F.array(
        *[
            F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in enumerate(_tables(radius))
        ]
    )
    keyed = prints.select("fingerprint", F.inline(choices))
    crowded = written(
        keyed.groupBy("table", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > CHUNK)
        .select("table", "key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")),
        "simhash-crowded",
    )
    # A fingerprint of a crowded key goes to every pair of chunks that its own chunk is in.
    own = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    pairs = F.when(
        F.col("chunks").isNotNull(),
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: (c != own) | (F.col("chunks") == 1)),
            lambda c: F.struct(F.least(own, c).alias("i"), F.greatest(own, c).alias("j")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
    units = keyed.join(crowded, ["table", "key"], "left").select(
        "table", "key", F.inline(pairs), "fingerprint"
    )
    order = ["table", "key", "i", "j"]
    runs = units.repartition(*order).sortWithinPartitions(*order)
    return runs.mapInArrow(lambda batches: link_runs(batches, radius), "a long, b long")


def fingerprint_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component): the least fingerprint reachable, itself included."""
    links = written(fingerprint_links(prints.select("fingerprint").distinct(), radius), "simhash-links")
    joined = connected_components(links)
    return (
        prints.select("fingerprint").distinct()
        .join(joined, F.col("fingerprint") == F.col("node"), "left")
        .select("fingerprint", F.coalesce("component", "fingerprint").alias("component"))
    )


def simhash_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """(id, fingerprint, component_id) per row; component_id is the smallest id reachable."""
    slim = with_fingerprints(
        docs.select(F.col(id_column), F.col(text_column)), text_column, shingle_words
    ).drop(text_column)
    slim = written(slim, "simhash-prints")
    firsts = slim.groupBy("fingerprint").agg(F.min(id_column).alias("__first"))
    parts = fingerprint_components(firsts, radius)
    named = written(parts.join(firsts, "fingerprint"), "simhash-parts")
    names = named.groupBy("component").agg(F.min("__first").alias("component_id"))
    by_print = named.join(names, "component").select("fingerprint", "component_id")
    return slim.join(by_print, "fingerprint").select(id_column, "fingerprint", "component_id")


def one_per_group(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """The documents, one of each group of near-duplicates: the one with the smallest id.

    Rows without an id come last in their group. Of rows with equal id and text one stays.
    """
    key = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    numbered = docs.withColumns({"__key": key, "__tie": F.xxhash64(F.col(text_column).cast("string"))})
    slim = with_fingerprints(
        numbered.select(F.col(id_column), "__key", "__tie", F.col(text_column)), text_column, shingle_words
    ).drop(text_column)
    slim = written(slim, "simhash-prints")
    parts = fingerprint_components(slim.select("fingerprint").distinct(), radius)
    first = F.min(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), "__key", "__tie"))
    per_print = slim.groupBy("fingerprint").agg(first.alias("first"))
    kept = (
        per_print.join(parts, "fingerprint")
        .groupBy("component")
        .agg(F.min("first").alias("first"))
        .select("first.__key", "first.__tie")
    )
    return (
        numbered.join(kept, ["__key", "__tie"])
        .dropDuplicates(["__key", "__tie"])
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )

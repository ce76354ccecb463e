"""Byte-level BPE by dynamic programming over prefixes.

Merging pair after pair is not needed to find what merging gives. A sequence of tokens is the
result of merging if and only if each of its neighbours is: two tokens stay as they are when no
pair across their border would have merged before both were complete. So every prefix of a piece
has exactly one last token, and its table is filled from left to right. The tokens that end at a
place are found by an automaton over all tokens' bytes, in which each state knows the longest
token that is a suffix of what was read, and each token the next shorter one. The first of them
that is compatible with the last token of the prefix before it is the answer. The ids of the
piece are read off by following the table back from its end.

The vocabulary is read from a tokenizer file; a pattern cuts texts into pieces first. Pieces never
cross a space that is followed by something else than space, so texts are cut there and the work
is done once for each distinct part that a worker meets, in two bounded generations of memory. The
new pieces of a batch fill their tables side by side, one place at a time, in numpy; a very long
piece fills its table alone.

Defined results: a null text is like an empty one, with no ids and an empty decoded text; special
tokens' strings in a text become their ids; a piece may be of any length; ties cannot occur, as
the table is unique; an empty table gives an empty result. Columns of the input that share a name
with a result are replaced.
"""

from __future__ import annotations

import functools
import json
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import Remembering, prepare_workers, with_fields

# Fixed value: the pattern of this kind of vocabulary.
PIECE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = 1 << 60
# Pieces up to this many bytes fill their tables side by side, so many bytes at a time.
LONGEST_TOGETHER = 64
BYTES_TOGETHER = 1 << 20
# Pairs of tokens whose test is remembered.
PAIRS_REMEMBERED = 1 << 18
# Characters of texts that are cut into parts at a time.
CHARS_TOGETHER = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file: printable ones themselves, others from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file, with the automaton over the tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: t.encode() for t, i in self.special.items()}
        ids: dict[bytes, int] = {}
        for token, i in file["model"]["vocab"].items():
            if token not in self.special:
                ids[bytes(letters[c] for c in token)] = i
        self.bytes_of |= {i: raw for raw, i in ids.items()}
        size = max(self.bytes_of) + 1
        self.size, self.length = size, [0] * size
        for raw, i in ids.items():
            self.length[i] = len(raw)
        # By token: the rank of the merge that makes it and its two parts.
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.pair_rank: dict[int, int] = {}
        for rank, merge in enumerate(file["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            raw_a, raw_b = (bytes(letters[c] for c in part) for part in (a, b))
            x, y, made = ids[raw_a], ids[raw_b], ids[raw_a + raw_b]
            self.pair_rank[x * size + y] = rank
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, x, y
        self._build_automaton(ids)
        self._fits: dict[int, bool] = {}
        self._build_arrays()
        self.pieces = regex.compile(PIECE_PATTERN)
        self.uneven = regex.compile(r" (?:\s|$)")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.of_piece = Remembering(self._piece_ids)
        self.of_part = Remembering(lambda part: self._part_ids(" " + part))

    def _build_arrays(self) -> None:
        """The automaton and the merges for look-ups of many at once."""
        at = np.fromiter(self.step.keys(), np.int64, len(self.step))
        order = np.argsort(at)
        self.step_at = at[order]
        self.step_to = np.fromiter(self.step.values(), np.int64, len(self.step))[order]
        pairs = np.fromiter(self.pair_rank.keys(), np.int64, len(self.pair_rank))
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.pairs_rank = np.fromiter(self.pair_rank.values(), np.int64, len(self.pair_rank))[order]
        names = ("length", "rank", "left", "right", "back", "longest", "shorter")
        self.arrays = {n: np.array(getattr(self, n), np.int64) for n in names}
        self.tested = np.full(PAIRS_REMEMBERED, -1, np.int64)
        self.tested_fits = np.zeros(PAIRS_REMEMBERED, bool)

    def _build_automaton(self, ids: dict[bytes, int]) -> None:
        """States are prefixes of tokens; ``step`` maps state * 256 + byte to the next state."""
        self.step: dict[int, int] = {}
        ends = [-1]
        state_of: dict[int, int] = {}
        for raw, i in ids.items():
            state = 0
            for byte in raw:
                at = state << 8 | byte
                state = self.step.get(at, -1)
                if state < 0:
                    state = self.step[at] = len(ends)
                    ends.append(-1)
            ends[state] = i
            state_of[i] = state
        below: list[list[tuple[int, int]]] = [[] for _ in ends]
        for at, state in self.step.items():
            below[at >> 8].append((at & 255, state))
        # ``back``: the longest proper suffix of a state that is a state. ``longest``: of the
        # tokens that are suffixes of a state, the longest.
        self.back, self.longest = [0] * len(ends), list(ends)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for byte, child in below[state]:
                if state:
                    up = self.back[state]
                    while up and (up << 8 | byte) not in self.step:
                        up = self.back[up]
                    self.back[child] = self.step.get(up << 8 | byte, 0)
                if self.longest[child] < 0:
                    self.longest[child] = self.longest[self.back[child]]
                queue.append(child)
        self.shorter = [-1] * self.size
        for i, state in state_of.items():
            self.shorter[i] = self.longest[self.back[state]]

    def fits(self, a: int, b: int) -> bool:
        """Whether a followed by b stays a, b: no pair across the border merges too early.

        Goes back in time from the complete tokens, undoing the later merge of the two that touch
        the border. A pair across it merges if its rank comes before the left one is used by its
        own token, and not after the right one is, as of equal ranks the left pair comes first.
        """
        size, rank, pair_rank = self.size, self.rank, self.pair_rank
        x, y, x_used, y_used = a, b, NEVER, NEVER
        while True:
            merged = pair_rank.get(x * size + y, NEVER)
            if merged < x_used and merged <= y_used and merged < NEVER:
                return False
            if rank[x] > rank[y]:
                x_used, x = rank[x], self.right[x]
            elif rank[y] >= 0:
                y_used, y = rank[y], self.left[y]
            else:
                return True

    def piece_tokens(self, raw: bytes) -> list[int]:
        """The ids of one piece: the table of last tokens, then the way back."""
        step, back, longest = self.step, self.back, self.longest
        length, shorter, known, size = self.length, self.shorter, self._fits, self.size
        last = [0] * (len(raw) + 1)
        state = end = 0
        for byte in raw:
            end += 1
            at = step.get(state << 8 | byte)
            while at is None and state:
                state = back[state]
                at = step.get(state << 8 | byte)
            state = at or 0
            token = longest[state]
            while start := end - length[token]:
                pair = last[start] * size + token
                fits = known.get(pair)
                if fits is None:
                    if len(known) >= PAIRS_REMEMBERED:
                        known.clear()
                    fits = known[pair] = self.fits(last[start], token)
                if fits:
                    break
                token = shorter[token]
            last[end] = token
        out = []
        while end:
            out.append(last[end])
            end -= length[last[end]]
        out.reverse()
        return out

    # The same for many pieces at once.

    def _next_states(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out = np.zeros(len(state), np.int64)
        todo, state = np.arange(len(state)), state.copy()
        while len(todo):
            at = state << 8 | byte
            found = np.searchsorted(self.step_at, at)
            found[found == len(self.step_at)] = 0
            hit = self.step_at[found] == at
            out[todo[hit]] = self.step_to[found[hit]]
            miss = ~hit & (state > 0)
            todo, byte, state = todo[miss], byte[miss], self.arrays["back"][state[miss]]
        return out

    def fits_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``fits`` for arrays of tokens; results are kept in a table of the latest pairs."""
        pair = a * self.size + b
        slot = (pair * 0x9E3779B1 >> 15) % PAIRS_REMEMBERED
        new = np.flatnonzero(self.tested[slot] != pair)
        out = self.tested_fits[slot]
        if len(new):
            distinct, where = np.unique(pair[new], return_inverse=True)
            out[new] = self._test(distinct // self.size, distinct % self.size)[where]
            self.tested[slot[new]], self.tested_fits[slot[new]] = pair[new], out[new]
        return out

    def _test(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        rank, left, right = self.arrays["rank"], self.arrays["left"], self.arrays["right"]
        out = np.ones(len(x), bool)
        todo = np.arange(len(x))
        x_used, y_used = np.full(len(x), NEVER), np.full(len(x), NEVER)
        while len(todo):
            pair = x * self.size + y
            at = np.searchsorted(self.pairs, pair)
            at[at == len(self.pairs)] = 0
            merged = np.where(self.pairs[at] == pair, self.pairs_rank[at], NEVER)
            early = (merged < x_used) & (merged <= y_used) & (merged < NEVER)
            out[todo[early]] = False
            x_later = rank[x] > rank[y]
            y_later = ~x_later & (rank[y] >= 0)
            x_used, y_used = np.where(x_later, rank[x], x_used), np.where(y_later, rank[y], y_used)
            x, y = np.where(x_later, right[x], x), np.where(y_later, left[y], y)
            on = ~early & (x_later | y_later)
            todo, x, y, x_used, y_used = todo[on], x[on], y[on], x_used[on], y_used[on]
        return out

    def tokens_of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many pieces, as the bytes of 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for k in np.flatnonzero(lengths > LONGEST_TOGETHER).tolist():
            out[k] = array("i", self.piece_tokens(pieces[k])).tobytes()
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= LONGEST_TOGETHER]
        step = BYTES_TOGETHER // LONGEST_TOGETHER
        for at in range(0, len(order), step):
            some = order[at : at + step]
            for k, ids in zip(some.tolist(), self._fill([pieces[k] for k in some], lengths[some])):
                out[k] = ids
        return out

    def _fill(self, pieces: list[bytes], lengths: np.ndarray) -> list[bytes]:
        """Tables of pieces in order of length, side by side, and the way back."""
        n, width = len(pieces), int(lengths[-1])
        raw = np.frombuffer(b"".join(p.ljust(width) for p in pieces), np.uint8).reshape(n, width)
        length, longest, shorter = (self.arrays[k] for k in ("length", "longest", "shorter"))
        last = np.zeros((n, width + 1), np.int64)
        state = np.zeros(n, np.int64)
        for end in range(1, width + 1):
            begin = int(np.searchsorted(lengths, end))
            state[begin:] = self._next_states(state[begin:], raw[begin:, end - 1].astype(np.int64))
            row, token = np.arange(begin, n), longest[state[begin:]]
            while len(row):
                start = end - length[token]
                fits = start == 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self.fits_many(last[row[inner], start[inner]], token[inner])
                last[row[fits], end] = token[fits]
                row, token = row[~fits], shorter[token[~fits]]
        back = np.zeros((n, width), np.int32)
        row, end, place = np.arange(n), lengths.copy(), np.full(n, width)
        while len(row):
            token = last[row, end[row]]
            place[row] -= 1
            back[row, place[row]] = token
            end[row] -= length[token]
            row = row[end[row] > 0]
        flat = back[np.arange(width)[None, :] >= place[:, None]].tobytes()
        ends = np.cumsum(4 * (width - place)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    # Ids are kept as the bytes of 32-bit integers, which join without a loop.

    def _piece_ids(self, piece: str) -> bytes:
        return array("i", self.piece_tokens(piece.encode("utf-8", "surrogatepass"))).tobytes()

    def _part_ids(self, part: str) -> bytes:
        return b"".join([self.of_piece[p] for p in self.pieces.findall(part)])

    def _parts(self, text: str) -> list[str]:
        """The text cut at spaces that start a piece; all but the first part lost that space."""
        parts = text.split(" ")
        if not self.uneven.search(text):
            return parts
        # A space before other space, or at the end, belongs to what is before it.
        whole = [parts[0]]
        for part in parts[1:]:
            if not part or part[0].isspace() and self.pieces.fullmatch(" " + part[0]):
                whole[-1] += " " + part
            else:
                whole.append(part)
        return whole

    def _learn(self, cut: list[list[str]]) -> None:
        """Fill the memory with the parts of some texts that are not in it, all at once."""
        parts: set[str] = set()
        for own in cut:
            parts.update(own[1:])
        new = self.of_part.unknown(parts)
        # A part of letters is one piece with its space; others go through the pattern.
        words = [p for p in new if p.isalpha()]
        self.of_part.put(words, self.tokens_of_pieces([(" " + w).encode() for w in words]))
        rest = [p for p in new if not p.isalpha()]
        found = [self.pieces.findall(" " + p) for p in rest]
        pieces = self.of_piece.unknown({x for own in found for x in own})
        self.of_piece.put(pieces, self.tokens_of_pieces([x.encode("utf-8", "surrogatepass") for x in pieces]))
        piece_ids = self.of_piece.__getitem__
        self.of_part.put(rest, [b"".join(map(piece_ids, own)) for own in found])

    def _plain_ids(self, text: str) -> bytes:
        """Ids of a text without special tokens, part by part."""
        return self._ids_of_cut(self._parts(text))

    def _ids_of_cut(self, parts: list[str]) -> bytes:
        return self._part_ids(parts[0]) + b"".join(map(self.of_part.__getitem__, parts[1:]))

    def encode(self, text: str) -> bytes:
        if self.specials is None or not self.specials.search(text):
            return self._plain_ids(text)
        return b"".join(
            array("i", [self.special[s]]).tobytes() if s in self.special else self._plain_ids(s)
            for s in self.specials.split(text)
        )

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` for many texts, learning the parts of some texts at a time."""
        out, some, chars = [], [], 0
        for k, text in enumerate(texts):
            some.append(text or "")
            chars += len(some[-1])
            if chars >= CHARS_TOGETHER or k == len(texts) - 1:
                plain = [self.specials is None or not self.specials.search(t) for t in some]
                cut = [self._parts(t) if p else [] for t, p in zip(some, plain)]
                self._learn(cut)
                out += [self._ids_of_cut(c) if p else self.encode(t) for t, p, c in zip(some, plain, cut)]
                some, chars = [], 0
        return out

    def decode(self, ids: list[int] | memoryview) -> str:
        """The text of the ids' bytes; what is no UTF-8 becomes replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path)


def _id_lists(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def with_tokens(docs: DataFrame, vocabulary_path: str, text_column: str = "text") -> DataFrame:
    """The rows with ``ids``, the tokens of the whole text as an array of integers."""
    prepare_workers(docs.sparkSession)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(vocabulary_path)
        for batch in batches:
            yield _id_lists(known.encode_all(batch.to_pylist()))

    step = F.arrow_udf(encode, "array<int>").asNondeterministic()
    return docs.withColumn("ids", step(F.col(text_column).cast("string")))


def with_round_trip(docs: DataFrame, vocabulary_path: str, text_column: str = "text") -> DataFrame:
    """The rows with ``ids`` and ``decoded``, what the ids stand for, from one pass in one worker."""
    prepare_workers(docs.sparkSession)

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(vocabulary_path)
        for batch in batches:
            found = known.encode_all(batch.to_pylist())
            texts = pa.array([known.decode(memoryview(f).cast("i")) for f in found], pa.string())
            yield pa.StructArray.from_arrays([_id_lists(found), texts], names=["ids", "decoded"])

    step = F.arrow_udf(both, "ids array<int>, decoded string").asNondeterministic()
    return with_fields(docs, step(F.col(text_column).cast("string")), ["ids", "decoded"])


def with_decoded(tokens: DataFrame, vocabulary_path: str, ids_column: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text that the ids stand for."""
    prepare_workers(tokens.sparkSession)

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(vocabulary_path)
        for batch in batches:
            values, ends = np.asarray(batch.values), np.asarray(batch.offsets).tolist()
            # One text's ids at a time become Python numbers.
            texts = [known.decode(values[a:b].tolist()) for a, b in zip(ends, ends[1:])]
            yield pa.array(texts, pa.string())

    step = F.arrow_udf(decode, "string").asNondeterministic()
    return tokens.withColumn("decoded", step(F.col(ids_column)))

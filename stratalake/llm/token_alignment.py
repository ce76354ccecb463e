"""Alignment of two tokenizers over the same texts, and the pairs of tokens that end together.

The first is a byte-level BPE of the tokenizers library, the second a BPE with byte fallback of
sentencepiece. Both write a text with a space before it. Where a token of each ends at the same
byte, the text is cut: what lies between two cuts is a group, and the last tokens of a group are
linked. The library's character offsets and sentencepiece's spans (byte offsets of its proto) say
where tokens end. They are coarse where several tokens share a character, as bytes of a multibyte
character or of a byte fallback do; there the tokens' own decoded bytes say it.

Neither tokenizer merges over the start of a run of spaces that follows something else than space,
which is checked for the second's pieces, so texts are cut there. Each distinct part is aligned
once while a worker remembers it, in two bounded generations; groups of a text are those of its
parts. How often a pair of ids is linked in all texts is counted per block of texts first, so that
a pair that is in all texts is one row per block, and goes back to the blocks the same way.

Defined results: texts that are null or empty, or whose joined bytes of either tokenizer differ from
the text with its space (as with U+2581, which the second reads as a space), have no tokens, and
zeros; special tokens' strings are plain text; ties count as best; repeated rows count each; an
empty table gives an empty result. Columns of the input are kept under numbered names while the
work goes on, so none can clash.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.bpe import byte_letters
from stratalake.llm.common import LONGEST_REMEMBERED, Remembering, prepare_workers, written
from stratalake.llm.packing import numbered_blocks, pack, unpack

SPACE_MARK = "▁"
# Parts that are aligned at a time; more of them leave the processor's caches.
PARTS_TOGETHER = 1024
# Parts that a worker remembers, in each of two generations.
PARTS_REMEMBERED = 200_000

# Of a part: tokens of the first, tokens of the second, groups as text, links (first << 32 | second).
Aligned = tuple[int, int, str, bytes]


class _Tokens:
    """The bytes of all tokens of a tokenizer."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))

    def decoded(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def refined(self, ids: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Where tokens end: at their spans' ends, unless they share a character with others; there
        their decoded bytes say it."""
        decoded = np.cumsum(self.length[ids])
        return np.where(spans == decoded, spans, decoded)


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the parts aligned lately."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_path)
        self.first.encode_special_tokens = True
        self.first.no_truncation()
        self.first.no_padding()
        self.second = SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        special = {t.content for t in self.first.get_added_tokens_decoder().values()}
        vocabulary = self.first.get_vocab()
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.first_bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.first_table, self.second_table = _Tokens(self.first_bytes), _Tokens(self.second_bytes)
        # Ids as they are written: inside a group, at the end of its first and of its second half.
        self.size = max(len(self.first_bytes), len(pieces))
        self.marked = [f"{i}{mark}" for mark in ",|;" for i in range(self.size)]
        # Texts may be cut before a space only if no piece goes over one.
        over = regex.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
        self.cuts = not any(over.search(p) for p in pieces)
        self.uneven = regex.compile(r"^ |\s | $")
        self.of_part = Remembering(lambda part: self.align([part])[0], PARTS_REMEMBERED)

    def parts(self, text: str) -> list[str]:
        """The text cut before runs of spaces that follow something else; each part lost one space.

        The space before the text is the first part's.
        """
        if not self.cuts:
            return [text]
        parts = text.split(" ")
        if not self.uneven.search(text):
            return parts
        whole = [parts[0]]
        for k, part in enumerate(parts[1:], 1):
            # A space alone at the end is no text of its own to the second tokenizer.
            alone = not part and k == len(parts) - 1
            if alone or not whole[-1] or whole[-1][-1].isspace():
                whole[-1] += " " + part
            else:
                whole.append(part)
        return whole

    def align(self, parts: list[str]) -> list[Aligned | bool]:
        """The groups and links of each part with a space before it; False if its bytes differ.

        As parts may follow each other in a text, both tokenizers read many as one text, unless
        that would join spaces, or would let one part's other bytes spoil the rest.
        """
        out: list[Aligned | bool] = [False] * len(parts)
        run = [k for k, p in enumerate(parts) if p and not p[-1].isspace() and SPACE_MARK not in p]
        found = self._align_run([parts[k] for k in run]) if self.cuts and len(run) > 1 else None
        if found is None:
            run = []
        for k, groups in zip(run, found or []):
            out[k] = groups
        for k in set(range(len(parts))).difference(run):
            found = self._align_run([parts[k]])
            out[k] = found[0] if found else False
        return out

    def _align_run(self, parts: list[str]) -> list[Aligned] | None:
        """The groups of parts that lie one after the other; None if either's bytes are others."""
        text = " ".join(parts)
        raw = (" " + text).encode("utf-8", "surrogatepass")
        first = self.first.encode(" " + text, add_special_tokens=False)
        second = self.second.encode(text, return_type="proto").pieces
        a, b = np.array(first.ids, np.int64), np.array([p.id for p in second], np.int64)
        if self.first_table.decoded(a) != raw or self.second_table.decoded(b) != raw:
            return None
        # Offsets of the first are characters, whose bytes begin where none is continued.
        a_spans = np.array([end for _, end in first.offsets], np.int64)
        if len(raw) > len(text) + 1:
            begins = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
            a_spans = np.append(begins, len(raw))[a_spans]
        # Spans of the second are bytes, and do not count the space that it adds.
        b_spans = np.array([p.end for p in second], np.int64) + 1
        a_ends, b_ends = self.first_table.refined(a, a_spans), self.second_table.refined(b, b_spans)
        sizes = map(len, parts) if text.isascii() else (len(p.encode("utf-8", "surrogatepass")) for p in parts)
        borders = np.cumsum(np.fromiter(sizes, np.int64, len(parts)) + 1)
        a_at, b_at = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        a_at[a_ends], b_at[b_ends] = True, True
        common = a_at & b_at
        if not common[borders].all():
            return None
        return self._groups(a, a_ends, b, b_ends, common, borders)

    def _groups(self, a, a_ends, b, b_ends, common, borders) -> list[Aligned]:
        """Tokens of both and their ends, cut at common ends into groups and at borders into parts."""
        a_last, b_last = common[a_ends], common[b_ends]
        links = a[a_last] << 32 | b[b_last]
        # Tokens in the order of the text form: by group, the first's before the second's.
        group = np.concatenate([2 * (np.cumsum(a_last) - a_last), 2 * (np.cumsum(b_last) - b_last) + 1])
        marks = np.concatenate([a + a_last * self.size, b + b_last * (2 * self.size)])
        marks = marks[np.argsort(group, kind="stable")]
        texts = list(map(self.marked.__getitem__, marks.tolist()))
        a_to, b_to = np.searchsorted(a_ends, borders) + 1, np.searchsorted(b_ends, borders) + 1
        links_to = 8 * (np.searchsorted(a_ends[a_last], borders) + 1)
        raw, out, at = links.tobytes(), [], (0, 0, 0)
        for to in zip(a_to.tolist(), b_to.tolist(), links_to.tolist()):
            text = "".join(texts[at[0] + at[1] : to[0] + to[1]])[:-1]
            out.append((to[0] - at[0], to[1] - at[1], text, raw[at[2] : to[2]]))
            at = to
        return out

    def align_texts(self, texts: list[str | None]) -> list[list[Aligned] | None]:
        """The aligned parts of each text, None for a text without tokens."""
        cut = [self.parts(t) if t else None for t in texts]
        new = self.of_part.unknown({p for own in cut if own for p in own})
        # Long parts are not remembered, so they wait until their text asks for them.
        short = [p for p in new if len(p) <= LONGEST_REMEMBERED]
        for at in range(0, len(short), PARTS_TOGETHER):
            some = short[at : at + PARTS_TOGETHER]
            self.of_part.put(some, self.align(some))
        out = []
        for own in cut:
            found = list(map(self.of_part.__getitem__, own)) if own else [False]
            out.append(None if False in found else found)
        return out


@functools.lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per worker process and pair of files."""
    return Aligner(byte_path, piece_path)


_FIELDS = [
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.string()),
    ("links", pa.binary()), ("block", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary()),
]
_DDL = "n_a long, n_b long, n_groups long, groups string, links binary, block long, pairs binary, counts binary"


def _aligned_rows(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], digest: bool) -> Iterator[pa.RecordBatch]:
    """The rows with their groups and links; each batch's first has the batch's pairs and counts."""
    known = aligner(*paths)
    for block, batch in numbered_blocks(batches):
        rows, all_links = [], []
        for parts in known.align_texts(batch.column("__text").to_pylist()):
            if parts is None:
                rows.append((0, 0, 0, "", b""))
                continue
            a, b, groups, links = zip(*parts)
            text, linked = ";".join(groups), b"".join(links)
            all_links.append(linked)
            shown = hashlib.sha256(text.encode()).hexdigest() if digest else text
            rows.append((sum(a), sum(b), len(linked) // 8, shown, pack(np.frombuffer(linked, np.int64))))
        pairs, counts = np.unique(np.frombuffer(b"".join(all_links), np.int64), return_counts=True)
        rest = [None] * (len(rows) - 1)
        columns = [*zip(*rows), [block] * len(rows), [pack(pairs), *rest], [pack(counts), *rest]]
        kept = [n for n in batch.schema.names if n != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), *(pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS))],
            names=[*kept, *(n for n, _ in _FIELDS)],
        )


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
            pair = unpack(pairs, np.int64)
            made = [np.full(len(pair), block), pair, unpack(counts, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["block", "pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(block, pair, count, best): the pairs of each block with their counts over all blocks, and
    whether no other pair with the same second id has a higher one."""
    spread = aligned.filter("pairs IS NOT NULL").select("block", "pairs", "counts")
    rows = spread.mapInArrow(_pair_rows, "block long, pair long, n long")
    counted = written(rows.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("second")
    highest = counted.groupBy(second).agg(F.max("count").alias("highest"))
    scored = counted.withColumn("second", second).join(highest, "second")
    return rows.select("block", "pair").join(
        scored.select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "pair"
    )


def token_alignment(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    text_column: str = "text",
    digest: bool = False,
) -> DataFrame:
    """The rows without their text, with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups`` (ids of both tokenizers in order, as ``a1,a2|b1;a3|b2,b3``; its
    SHA-256 if ``digest``; empty without tokens)."""
    prepare_workers(docs.sparkSession)
    others = [c for c in docs.columns if c != text_column]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)],
        F.col(f"`{text_column}`").cast("string").alias("__text"),
    )
    own = rows.drop("__text").schema
    ddl = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in own.fields), _DDL])
    paths = (byte_path, piece_path)
    aligned = written(rows.mapInArrow(lambda b: _aligned_rows(b, paths, digest), ddl), "aligned")
    scores = [("n_best", pa.int64()), ("count_sum", pa.int64())]
    kept = [*own.fieldNames(), "n_a", "n_b", "n_groups", "groups"]

    def score(block: pa.Table, counts: pa.Table) -> pa.Table:
        pair = counts.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, count = pair[order], counts.column("count").to_numpy()[order]
        best = counts.column("best").to_numpy()[order].astype(np.int64)
        made = []
        for links in block.column("links").to_pylist():
            at = np.searchsorted(pair, unpack(links, np.int64)) if links else []
            made.append((int(best[at].sum()), int(count[at].sum())) if links else (0, 0))
        table = block.select(kept)
        for (name, kind), column in zip(scores, zip(*made) if made else ((), ())):
            table = table.append_column(name, pa.array(column, kind))
        return table

    result = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in own.fields),
                        "n_a long, n_b long, n_groups long, groups string, n_best long, count_sum long"])
    scored = (
        aligned.select(*kept, "links", "block")
        .groupBy("block")
        .cogroup(pair_counts(aligned).groupBy("block"))
        .applyInArrow(score, result)
    )
    made = ["n_a", "n_b", "n_groups", "n_best", "count_sum", "groups"]
    return scored.select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(others) if c not in [*made, "n_links"]],
        *made[:3], F.col("n_groups").alias("n_links"), *made[3:],
    )

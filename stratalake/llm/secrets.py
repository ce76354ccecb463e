"""Secret scans through a trigram index, in DataFrame operations only.

Each rule is a regular expression. From its parse tree follows what every match must contain, as a
Boolean query over trigrams: an alternation gives an OR, a sequence an AND, and optional or free
parts give nothing. The trigrams of all queries are looked up in each text, which makes an inverted
index: a posting list of texts for each trigram. The index is cut into blocks of texts, so that a
trigram that most texts have is many lists of bounded length and not one. Per block the postings
are intersected and united as the queries say, and only the texts that remain for a rule are
verified with the rule itself. A rule without a mandatory trigram scans all texts.

The index is on ASCII-lower-cased texts, as some rules take letters in either case; verification
is exact. Texts are known by a hash, and two texts with one hash would be verified together.

Defined results: a null or empty text has no secrets; matches of one rule don't overlap, leftmost
first, and those of different rules may; a match that is too short is dropped after it has used up
its text; repeated rows get equal results; an empty table gives an empty result. Columns of the
input that share a name with a result are replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.common import written

# Texts whose postings make one block of the index.
BLOCK_TEXTS = 2048
# Sets of exact strings larger than this are given up as mandatory text.
MOST_EXACT = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of the match or of one of its groups."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# The base rules, in the order in which ties are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=1,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
ADDED_RULES = (
    # From the BEGIN line up to the END line, or without one up to the last long run of base64, with
    # a short padded rest. Line breaks may be escaped. Classes and not groups repeat, as Java's
    # matcher goes deeper with each repeat of a group.
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
        r"(?:(?:[\x20\t\r\nrn\\]*(?:Proc-Type|DEK-Info):[^\r\n\\]*){0,2}"
        r"(?:[A-Za-z0-9+/=\x20\t\r\n\\]*-----END [A-Z ]{0,40}PRIVATE KEY-----"
        r"|[\x20\t]*[A-Za-z0-9+/=\r\n\\]*[A-Za-z0-9+/]{16,}(?:=|[\r\nrn\\]+[A-Za-z0-9+/]{1,15}=)?=?))?",
    ),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + ADDED_RULES


# --- what a pattern must contain ---------------------------------------------------------------

# A query is None (no condition), a trigram, or ("and" | "or", queries).


def _all_of(queries: list):
    parts = list(dict.fromkeys(q for q in queries if q is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any_of(queries: list):
    if any(q is None for q in queries):
        return None
    parts = list(dict.fromkeys(queries))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _trigrams_of(strings: set[str]):
    """Every string has all of its trigrams, so one of the sets of trigrams must be there."""
    return _any_of([_all_of([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _required(items) -> tuple[set[str] | None, object]:
    """(exact strings or None, query) of a sequence of parsed items."""
    exact: set[str] = {""}
    queries, whole = [], True
    for kind, value in items:
        name = str(kind)
        own, query = None, None
        if name == "LITERAL":
            own = {_low(chr(value))}
        elif name == "IN":
            own = _small_class(value)
        elif name == "SUBPATTERN":
            own, query = _required(value[3])
        elif name == "BRANCH":
            found = [_required(branch) for branch in value[1]]
            if all(e is not None for e, _ in found):
                own = set().union(*(e for e, _ in found))
            query = _any_of([q if e is None else _trigrams_of(e) for e, q in found])
        elif name == "MAX_REPEAT":
            low, high, inner = value
            e, q = _required(inner)
            if e is not None and (low, high) == (0, 1):
                own = e | {""}
            elif e is not None and low == high and low * max(map(len, e)) <= 8 and len(e) == 1:
                own = {next(iter(e)) * low}
            elif low:
                query = q if e is None else _trigrams_of(e)
        if own is not None and len(exact) * len(own) <= MOST_EXACT:
            exact = {a + b for a in exact for b in own}
            continue
        # What comes next may be anything: settle what is known so far.
        queries += [_trigrams_of(exact), query if own is None else _trigrams_of(own)]
        exact, whole = {""}, False
    if whole:
        return exact, _trigrams_of(exact)
    return None, _all_of([*queries, _trigrams_of(exact)])


def _low(c: str) -> str:
    return c.lower() if c.isascii() else c


def _small_class(items) -> set[str] | None:
    out = set()
    for kind, value in items:
        if str(kind) != "LITERAL":
            return None
        out.add(_low(chr(value)))
    return out if len(out) <= 8 else None


def trigram_query(pattern: str):
    """The Boolean trigram query that every text with a match satisfies; None if there is none."""
    return _required(re._parser.parse(pattern))[1]


def trigrams_in(query) -> list[str]:
    if query is None:
        return []
    if isinstance(query, str):
        return [query]
    return sorted({t for q in query[1] for t in trigrams_in(q)})


def alternatives(query) -> list[tuple[str, ...]] | None:
    """The query as alternatives of trigrams that must all be there; None if it is no condition.

    Beyond ``MOST_EXACT`` alternatives a part of an AND is left out, which only admits more texts.
    """
    if query is None:
        return None
    if isinstance(query, str):
        return [(query,)]
    op, parts = query
    found = [alternatives(p) for p in parts]
    if op == "or":
        return list(dict.fromkeys(t for terms in found for t in terms))
    out = found[0]
    for terms in found[1:]:
        if len(out) * len(terms) <= MOST_EXACT:
            out = [tuple(sorted({*a, *b})) for a in out for b in terms]
    return out


# --- the index ---------------------------------------------------------------------------------


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trigram_index(keyed: DataFrame, trigrams: list[str], blocks: int) -> DataFrame:
    """(block, trigram, postings): the keys of the texts of a block that have the trigram."""
    low = keyed.select("__key", _ascii_lower(F.col("__text")).alias("__low"))
    # The literal array keeps each search a plain substring test.
    present = F.array_compact(
        F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(t)) for t in trigrams])
    )
    return (
        low.select("__key", F.explode(present).alias("trigram"))
        .groupBy(F.pmod("__key", F.lit(blocks)).alias("block"), "trigram")
        .agg(F.collect_set("__key").alias("postings"))
    )


def candidates(keyed: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(__key, __kinds): the rules whose trigram query a text satisfies."""
    terms = [(r.kind, t) for r in rules for t in alternatives(trigram_query(r.pattern)) or ()]
    trigrams = sorted({t for _, term in terms for t in term})
    blocks = max(1, math.ceil(keyed.count() / BLOCK_TEXTS))
    index = trigram_index(keyed, trigrams, blocks)
    by_block = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "postings"))).alias("lists")
    )
    asked = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.array(*map(F.lit, t)).alias("term")) for k, t in terms]
    )
    nothing = F.array().cast("array<bigint>")

    def postings(trigram: Column) -> Column:
        return F.coalesce(F.element_at("lists", trigram), nothing)

    # An alternative's postings are intersected; the alternatives of a rule are united below.
    both = F.aggregate(
        "term",
        postings(F.element_at("term", 1)),
        lambda keys, trigram: F.array_intersect(keys, postings(trigram)),
    )
    return (
        by_block.select("lists", F.inline(asked))
        .select("kind", F.explode(both).alias("__key"))
        .groupBy("__key")
        .agg(F.collect_set("kind").alias("__kinds"))
    )


# --- verification ------------------------------------------------------------------------------


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches as an array of (start, rank, kind, end), in code points.

    Splitting at the matches gives what lies between them, so starts are sums of lengths.
    """
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    steps = F.transform(
        matches,
        lambda m, i: F.struct(
            F.length(F.element_at(between, i + 1)).alias("gap"),
            F.length(m).alias("length"),
            (F.length(F.element_at(measured, i + 1)) >= rule.least).alias("good"),
        ),
    )
    span = "struct<start:int,rank:int,kind:string,end:int>"
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out")),
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["length"]).alias("at"),
            F.when(
                x["good"],
                F.concat(
                    s["out"],
                    F.array(
                        F.struct(
                            (s["at"] + x["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            F.lit(rule.kind).alias("kind"),
                            (s["at"] + x["gap"] + x["length"]).alias("end"),
                        ).cast(span)
                    ),
                ),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
    )
    return walked["out"]


def with_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """The rows with ``secrets``: (start, rank, kind, end) of each match, by start, then rule."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    keyed = docs.withColumns(
        {"__text": text, "__key": F.xxhash64(F.col(id_column).cast("string"), text)}
    )
    found = written(candidates(keyed.select("__key", "__text"), rules), "secret-candidates")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    own = []
    for rank, rule in enumerate(rules):
        if trigram_query(rule.pattern) is None:
            wanted = F.col("__text").rlike(rule.pattern)
        else:
            wanted = F.coalesce(F.array_contains("__kinds", rule.kind), F.lit(False))
        own.append(F.when(wanted, _spans(F.col("__text"), rule, rank)).otherwise(none))
    return (
        keyed.join(found, "__key", "left")
        .withColumn("secrets", F.array_sort(F.concat(*own)))
        .drop("__key", "__text", "__kinds")
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with a mark in place of each run of overlapping spans; null stays null."""
    walked = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when((x["start"] < s["at"]) & (s["at"] > 0), s["out"])
            .otherwise(F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, walked).otherwise(text)

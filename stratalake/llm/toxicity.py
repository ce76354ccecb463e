"""Toxic spans and document scores by a linear-chain conditional random field.

The field tags each word as toxic or not. A word's score is the sum of the weights of its features
(the word itself and its beginnings), and a 2 x 2 matrix scores neighbouring tags. Documents are
labelled, words are not, so training words get their labels from the documents: a feature is
evidence if it is seen in toxic documents in enough different surroundings and rarely elsewhere,
and a word of a toxic document with such a feature is labelled toxic. Counting surroundings and
not occurrences keeps copied passages from making all of their words evidence, and texts that are
mostly copied from others are left out of training.

Forward-backward gives each word's probability of being toxic. Words above one half make up the
offending spans; the largest probability, the expected number of toxic words and their share make the
document's score through a logistic curve fitted to the documents' labels.

The chain of a whole batch of texts is evaluated at once. It is cut into columns of equal length;
one pass multiplies the transfer matrices of each column, a short loop carries the state over the
columns, and a second pass fills in all words. Texts of any length take the same time per word.

Training uses a bounded sample: at most ``SAMPLE_PER_LABEL`` documents of each label, chosen by a
hash of their ids, of at most ``LONGEST_SAMPLE`` characters. Scoring covers every whole text.

Defined results: a null or empty text has no spans and the score of a text without evidence; rows
are scored each by itself, so ties and repeated rows agree; without labelled documents of both
kinds every score is the share of toxic labels, or 0; an empty table gives an empty result.
Columns of the input that share a name with a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import Remembering, column_udf, held_out, with_fields

SAMPLE_PER_LABEL = 2_000
LONGEST_SAMPLE = 50_000
THRESHOLD = 0.3

# A feature is evidence if this share of its surroundings is in toxic documents, after
# ``PRIOR_SEEN`` surroundings at the overall share are added.
EVIDENCE_SHARE = 0.6
PRIOR_SEEN = 3.0
LEAST_TOXIC_SEEN = 4
BEGINNINGS = range(4, 9)
# Texts with a larger share of four-word windows from earlier texts are left out of training.
MOST_COPIED = 0.3
# Words on each side of one with a feature that training looks at.
SURROUNDINGS = 4
ROUNDS = 40
STEP = 0.4
TEXTS_TOGETHER = 100
# Words whose chains training evaluates together, and slots for windows of words.
WORDS_TOGETHER = 200_000
WINDOW_SLOTS = 1 << 26
SHRINK = 1e-4

WORD = re.compile(r"\w+")
NO_FEATURE = -4.0


def features_of(word: str) -> list[str]:
    """The features of a word in lower case."""
    low = word.lower()
    return [low + "$", *(low[:n] for n in BEGINNINGS if n <= len(low))]


# --- the chain ---------------------------------------------------------------------------------


def forward(odds: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward vectors (n, 2), each scaled to sum 1, of chains laid end to end.

    ``odds``: the factor of the toxic tag for each word. ``first``: where a chain begins; there
    ``start`` takes the place of ``moves`` from the word before.
    """
    n = len(odds)
    if not n:
        return np.empty((0, 2))
    height = max(1, math.isqrt(n))
    columns = -(-n // height)
    e, f = np.ones(height * columns), np.ones(height * columns, bool)
    e[:n], f[:n] = odds, first
    e, f = e.reshape(columns, height).T.copy(), f.reshape(columns, height).T.copy()

    def step(plain, toxic, k):
        total = plain + toxic
        new_plain = np.where(f[k], total * start[0], plain * moves[0, 0] + toxic * moves[1, 0])
        new_toxic = np.where(f[k], total * start[1], plain * moves[0, 1] + toxic * moves[1, 1]) * e[k]
        return new_plain, new_toxic

    # Each column's product, as the images of both unit vectors.
    plain = np.repeat([[1.0], [0.0]], columns, axis=1)
    toxic = 1.0 - plain
    for k in range(height):
        plain, toxic = step(plain, toxic, k)
        scale = (plain + toxic).max(axis=0)
        plain, toxic = plain / scale, toxic / scale
    enter = np.empty((columns, 2))
    state = np.array([1.0, 0.0])
    for c in range(columns):
        enter[c] = state
        a = state[0] * plain[0, c] + state[1] * plain[1, c]
        b = state[0] * toxic[0, c] + state[1] * toxic[1, c]
        state = np.array([a, b]) / (a + b)
    out = np.empty((height, columns, 2))
    plain, toxic = enter[:, 0], enter[:, 1]
    for k in range(height):
        plain, toxic = step(plain, toxic, k)
        total = plain + toxic
        plain, toxic = plain / total, toxic / total
        out[k, :, 0], out[k, :, 1] = plain, toxic
    return out.transpose(1, 0, 2).reshape(-1, 2)[:n]


def both_ways(odds, first, moves, start) -> tuple[np.ndarray, np.ndarray]:
    """Forward vectors and backward ones; the latter include the word's own factor."""
    last = np.r_[first[1:], True] if len(first) else first
    back = forward(odds[::-1], last[::-1], moves.T, np.ones(2))[::-1]
    return forward(odds, first, moves, start), back


def marginals(odds, first, moves, start) -> np.ndarray:
    """Each word's probability of the toxic tag."""
    ahead, back = both_ways(odds, first, moves, start)
    toxic = ahead[:, 1] * back[:, 1] / odds
    return toxic / (toxic + ahead[:, 0] * back[:, 0])


# --- training ----------------------------------------------------------------------------------


@dataclass
class Model:
    """Weights of the features, scores of neighbouring and first tags, and the document curve."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = NO_FEATURE
    moves: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.ones(2))
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    constant: float | None = 0.0

    def word_odds(self, word: str) -> float:
        get = self.weights.get
        return math.exp(min(30.0, max(-30.0, self.bias + sum(get(f, 0.0) for f in features_of(word)))))


class Scorer:
    """Applies a model to batches of texts."""

    def __init__(self, model: Model) -> None:
        self.model, self.odds_of = model, Remembering(model.word_odds)

    def word_probabilities(self, texts: Iterable[str]) -> list[np.ndarray]:
        odds = [np.fromiter(map(self.odds_of.__getitem__, WORD.findall(t)), float) for t in texts]
        ends = np.cumsum([len(o) for o in odds])
        flat = np.concatenate(odds) if odds else np.empty(0)
        first = np.zeros(len(flat), bool)
        starts = np.r_[0, ends[:-1]] if len(ends) else ends
        first[starts[starts < len(flat)].astype(int)] = True
        return np.split(marginals(flat, first, self.model.moves, self.model.start), ends[:-1]) if odds else []

    def evidence(self, probabilities: np.ndarray) -> tuple[float, ...]:
        """What the document curve sees: the largest probability, the expected toxic words up to
        three, as more add little, and how many there are in a hundred."""
        if not len(probabilities):
            return 0.0, 0.0, 0.0
        expected = float(probabilities.sum())
        share = 100 * expected / len(probabilities)
        return float(probabilities.max()), min(expected, 3.0), math.log1p(share)

    def score(self, probabilities: np.ndarray) -> float:
        if self.model.constant is not None:
            return self.model.constant
        level = sum(c * x for c, x in zip(self.model.curve, (1.0, *self.evidence(probabilities))))
        return 1.0 / (1.0 + math.exp(-level))

    def spans(self, text: str, probabilities: np.ndarray) -> list[tuple[int, int]]:
        """Start and end of runs of toxic words, in code points."""
        if not len(probabilities) or probabilities.max() < 0.5:
            return []
        out, before = [], -2
        for k, m in enumerate(WORD.finditer(text)):
            if probabilities[k] >= 0.5:
                if k == before + 1:
                    out[-1] = (out[-1][0], m.end())
                else:
                    out.append(m.span())
                before = k
        return out


def number_words(texts: Iterable[str]) -> tuple[list[np.ndarray], list[str]]:
    """Each text's words as numbers, and the words in lower case by their numbers."""
    number: dict[str, int] = {}
    docs = [
        np.fromiter((number.setdefault(w.lower(), len(number)) for w in WORD.findall(t)), np.int64)
        for t in texts
    ]
    return docs, list(number)


def without_copies(docs: list[np.ndarray]) -> list[int]:
    """Places of the texts that are not for the most part copied from those before.

    Copies with small changes would show all of their words in many surroundings. Windows of four
    words are remembered by hash, one byte each.
    """
    seen, kept = np.zeros(WINDOW_SLOTS, bool), []
    for k, d in enumerate(docs):
        mixed = d[: max(0, len(d) - 3)].copy()
        for step in range(1, 4):
            mixed = mixed * 0x9E3779B1 + d[step : step + len(mixed)]
        slots = np.unique((mixed ^ (mixed >> 29)) % WINDOW_SLOTS)
        if not len(slots) or seen[slots].mean() <= MOST_COPIED:
            kept.append(k)
            seen[slots] = True
    return kept


def _surroundings(docs: list[np.ndarray], words: int) -> np.ndarray:
    """In how many different surroundings (word before, word after) each word is seen."""
    if not docs:
        return np.zeros(words, np.int64)
    word = np.concatenate(docs)
    before = np.concatenate([np.r_[-1, d[:-1]] if len(d) else d for d in docs])
    after = np.concatenate([np.r_[d[1:], -1] if len(d) else d for d in docs])
    around = (before + 1) * (words + 1) + after + 1
    order = np.lexsort((around, word))
    word, around = word[order], around[order]
    new = np.r_[True, (word[1:] != word[:-1]) | (around[1:] != around[:-1])] if len(word) else word
    return np.bincount(word[new], minlength=words)


def find_evidence(docs: list[np.ndarray], labels: list[int], names: list[str]) -> dict[str, float]:
    """Features that tell toxic documents, with the share of toxic ones among their surroundings."""
    by_label = [[d for d, y in zip(docs, labels) if y == label] for label in (0, 1)]
    tokens = [sum(map(len, own)) for own in by_label]
    share = tokens[1] / max(1, sum(tokens))
    clean, toxic = (_surroundings(own, len(names)) for own in by_label)
    # A feature has the surroundings of all of its words.
    n_toxic: Counter = Counter()
    for k in np.flatnonzero(toxic).tolist():
        for f in features_of(names[k]):
            n_toxic[f] += int(toxic[k])
    candidates = {f: n for f, n in n_toxic.items() if n >= LEAST_TOXIC_SEEN}
    n_all: Counter = Counter()
    for k, n in enumerate((clean + toxic).tolist()):
        for f in features_of(names[k]):
            if f in candidates:
                n_all[f] += n
    out = {}
    for f, n in candidates.items():
        part = (n + PRIOR_SEEN * share) / (n_all[f] + PRIOR_SEEN)
        if part >= EVIDENCE_SHARE:
            out[f] = part
    return out


def train(texts: list[str], labels: list[int], toxic_share: float) -> Model:
    """Fit the field to words and the curve to documents. ``toxic_share``: of all labels."""
    docs, words = number_words(texts)
    kept = without_copies(docs)
    texts, labels, docs = ([x[k] for k in kept] for x in (texts, labels, docs))
    if len(set(labels)) < 2:
        return Model(constant=toxic_share)
    found = find_evidence(docs, labels, words)
    if not found:
        return Model(constant=toxic_share)
    names = sorted(found)
    number = {f: i for i, f in enumerate(names)}
    # Words and their features as one sparse table.
    pairs = [(k, number[f]) for k, w in enumerate(words) for f in features_of(w) if f in number]
    rows, cols = np.array(pairs).T
    known = np.zeros(len(words), bool)
    known[rows] = True
    tokens, tags, first = [], [], []
    for d, label in zip(docs, labels):
        own = known[d]
        below = np.r_[0, np.cumsum(own)]
        at = np.arange(len(d))
        near = below[np.minimum(at + SURROUNDINGS + 1, len(d))] - below[np.maximum(at - SURROUNDINGS, 0)]
        place = np.flatnonzero(near)
        tokens.append(d[place])
        tags.append(own[place] & bool(label))
        first.append(np.r_[True, np.diff(place) > 1] if len(place) else np.zeros(0, bool))
    parameters = np.zeros(len(names) + 1 + 6)
    parameters[len(names)] = NO_FEATURE
    chains = np.concatenate(tokens), np.concatenate(tags).astype(np.int64), np.concatenate(first)
    model = _climb(parameters, names, *chains, rows, cols, len(words))
    _fit_curve(model, texts, labels, toxic_share)
    return model


def _pieces(first: np.ndarray) -> Iterator[slice]:
    """The chains in pieces of bounded size, cut where a chain begins."""
    begins, at = np.flatnonzero(first), 0
    while at < len(first):
        after = np.searchsorted(begins, at + WORDS_TOGETHER)
        end = int(begins[after]) if after < len(begins) else len(first)
        yield slice(at, end)
        at = end


def _climb(parameters, names, token, tag, first, rows, cols, kinds) -> Model:
    """Gradient ascent on the likelihood of the tags, with step sizes by parameter."""
    n = len(names)
    mean, spread = np.zeros_like(parameters), np.zeros_like(parameters)
    for t in range(1, ROUNDS + 1):
        weights, bias = parameters[:n], parameters[n]
        moves = np.exp(parameters[n + 1 : n + 5].reshape(2, 2))
        start = np.exp(parameters[n + 5 : n + 7])
        by_kind = np.exp(np.clip(bias + np.bincount(rows, weights[cols], minlength=kinds), -30, 30))
        own, move_slope, start_slope = np.zeros(kinds), np.zeros((2, 2)), np.zeros(2)
        for piece in _pieces(first):
            odds, y, begin = by_kind[token[piece]], tag[piece], first[piece]
            ahead, back = both_ways(odds, begin, moves, start)
            toxic = ahead[:, 1] * back[:, 1] / odds
            p = toxic / (toxic + ahead[:, 0] * back[:, 0])
            inside = np.flatnonzero(~begin)
            pairs = ahead[inside - 1][:, :, None] * moves[None] * back[inside][:, None, :]
            pairs /= pairs.sum(axis=(1, 2), keepdims=True)
            own += np.bincount(token[piece], y - p, minlength=kinds)
            move_slope += np.bincount(2 * y[inside - 1] + y[inside], minlength=4).reshape(2, 2)
            move_slope -= pairs.sum(axis=0)
            start_slope += np.bincount(y[begin], minlength=2)
            start_slope -= np.array([(1 - p[begin]).sum(), p[begin].sum()])
        slope = np.concatenate(
            [np.bincount(cols, own[rows], minlength=n), [own.sum()], move_slope.ravel(), start_slope]
        ) / len(token) - SHRINK * parameters
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        parameters = parameters + STEP * (mean / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.99**t)) + 1e-8)
    return Model(
        dict(zip(names, parameters[:n].tolist())),
        float(parameters[n]),
        np.exp(parameters[n + 1 : n + 5].reshape(2, 2)),
        np.exp(parameters[n + 5 : n + 7]),
        constant=None,
    )


def _fit_curve(model: Model, texts: list[str], labels: list[int], toxic_share: float) -> None:
    """Logistic curve from a document's evidence to its label, at the labels' own shares."""
    scorer = Scorer(model)
    y = np.array(labels, float)
    x = np.array(
        [
            (1.0, *scorer.evidence(p))
            for at in range(0, len(texts), TEXTS_TOGETHER)
            for p in scorer.word_probabilities(texts[at : at + TEXTS_TOGETHER])
        ]
    )
    weight = np.where(y == 1, toxic_share / max(1, y.sum()), (1 - toxic_share) / max(1, (1 - y).sum()))
    c = np.zeros(x.shape[1])
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-x @ c))
        slope = x.T @ (weight * (y - p)) - 1e-3 * c
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(c))
        c = c + np.linalg.solve(bend, slope)
    model.curve = tuple(c.tolist())


# --- on Spark ----------------------------------------------------------------------------------


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_per_label: int = SAMPLE_PER_LABEL,
) -> Model:
    """Train on labelled documents that are not held out: a bounded sample of each label."""
    known = labels.select(F.col(id_column), F.col(label_column).cast("int").alias("__label"))
    known = known.filter(F.col(id_column).isNotNull() & F.col("__label").isin(0, 1) & ~held_out(id_column))
    counts = {r[0]: r[1] for r in known.groupBy("__label").count().collect()}  # two rows
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    place = F.md5(F.col(id_column).cast("string").cast("binary"))
    texts = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("__text")).filter(
        F.length("__text").between(1, LONGEST_SAMPLE)
    )
    sample = []
    for label in (0, 1):
        # More ids than needed, as some have no text; at most this many rows are broadcast.
        ids = known.filter(F.col("__label") == label).dropDuplicates([id_column])
        ids = ids.withColumn("__place", place).orderBy("__place").limit(2 * sample_per_label)
        found = texts.join(F.broadcast(ids), id_column).select("__place", "__text", "__label")
        sample += found.orderBy("__place", "__text").limit(sample_per_label).collect()
    once = dict.fromkeys((r["__text"], r["__label"]) for r in sample)
    return train([t for t, _ in once], [y for _, y in once], share)


def with_toxicity(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows with ``toxicity``, from 0 to 1, and ``toxic_spans``, offsets of toxic words."""
    scorers: list[Scorer] = []

    def step(texts: list) -> list:
        if not scorers:  # one per batch stream, not shipped
            scorers.append(Scorer(model))
        scorer = scorers[0]
        whole = [t or "" for t in texts]
        probabilities = scorer.word_probabilities(whole)
        spans = [scorer.spans(t, p) for t, p in zip(whole, probabilities)]
        return [
            [scorer.score(p) for p in probabilities],
            [[{"start": a, "end": b} for a, b in s] for s in spans],
        ]

    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    made = column_udf(
        docs.sparkSession,
        step,
        "toxicity double, toxic_spans array<struct<start:int,end:int>>",
        [pa.float64(), pa.list_(span)],
    )
    return with_fields(docs, made(F.col(text_column).cast("string")), ["toxicity", "toxic_spans"])

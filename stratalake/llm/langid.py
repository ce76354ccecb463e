"""Language identification by a convolutional network over bytes.

Each byte has a small learned vector. Filters of several widths slide over the bytes of a window of
fixed length, each filter keeps its largest value in the window, and a softmax over the languages
follows. A text is all of its windows, the last one filled up with spaces; the text's language has
the largest sum of log probabilities over them, so every byte of a text counts. The network is
trained in numpy, by mini-batches with step sizes by parameter.

Training windows are kept as they are; prediction uses that a filter over byte vectors is a sum of
tables: the bytes at two neighbouring places select a row of a 65,536-row table, so a filter of
width four is two look-ups and one addition instead of a product of matrices.

Every language that is a label is learned, whatever their number. Training uses a bounded sample:
at most ``SAMPLE_PER_LANGUAGE`` documents of each language, fewer if that makes more than
``SAMPLE_DOCUMENTS`` in all but at least one, chosen by a hash of their ids and texts, and of each
at most ``WINDOWS_PER_TEXT`` windows spread over the text, which are cut where the text lies.
Prediction covers every whole text.

Defined results: a null text or one without a letter is ``und`` with score 0; without a labelled
text everything is ``und``; of equal sums the language first in code point order wins; rows are
predicted each by itself, so repeated rows agree; an empty table gives an empty result. Columns of
the input that share a name with a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stratalake.llm.common import column_udf, held_out, with_fields, written

SAMPLE_PER_LANGUAGE = 600
SAMPLE_DOCUMENTS = 120_000
WINDOWS_PER_TEXT = 8
WINDOW = 64
VECTOR = 8
FILTERS = 16
WIDTHS = (3, 4)
EPOCHS = 6
BATCH = 128
STEP = 0.01

UNKNOWN = "und"
FILL = 0x20
# Windows whose filters are evaluated at once.
WINDOWS_AT_ONCE = 1024


def windows_of(raw: bytes) -> np.ndarray:
    """The bytes of a text as rows of equal length."""
    count = max(1, -(-len(raw) // WINDOW))
    out = np.full(count * WINDOW, FILL, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(count, WINDOW)


def training_bytes(text: str) -> bytes:
    """The windows of a text that train the network: whole ones, spread over the text."""
    own = windows_of(text.encode("utf-8", "replace"))
    if len(own) > 1:
        own = own[:-1]  # whole windows tell more
    chosen = np.unique(np.linspace(0, len(own) - 1, min(len(own), WINDOWS_PER_TEXT)).astype(int))
    return own[chosen].tobytes()


@dataclass
class Network:
    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)


def _initial(languages: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(1)
    out = {"vectors": rng.normal(0, 0.3, (256, VECTOR))}
    for w in WIDTHS:
        out[f"filter{w}"] = rng.normal(0, (w * VECTOR) ** -0.5, (w * VECTOR, FILTERS))
        out[f"bias{w}"] = np.zeros(FILTERS)
    out["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), languages))
    out["out_bias"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in out.items()}


def _patches(x: np.ndarray, width: int) -> np.ndarray:
    """(windows, places, width * VECTOR): what a filter sees at each place."""
    places = x.shape[1] - width + 1
    return np.concatenate([x[:, k : k + places] for k in range(width)], axis=2)


def gradients(weights: dict, rows: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean loss of a batch of windows and its slopes."""
    n = len(rows)
    x = weights["vectors"][rows]
    kept, pooled = {}, []
    for w in WIDTHS:
        patches = _patches(x, w)
        values = patches @ weights[f"filter{w}"]
        best = values.argmax(axis=1)
        top = np.take_along_axis(values, best[:, None], axis=1)[:, 0] + weights[f"bias{w}"]
        kept[w] = (patches, best, top > 0)
        pooled.append(np.maximum(top, 0))
    features = np.concatenate(pooled, axis=1)
    logits = features @ weights["out"] + weights["out_bias"]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    loss = -np.log(p[np.arange(n), labels] + 1e-12).mean()
    p[np.arange(n), labels] -= 1
    p /= n
    slopes = {"out": features.T @ p, "out_bias": p.sum(axis=0)}
    back = p @ weights["out"].T
    dx = np.zeros_like(x)
    each = np.arange(n)[:, None]
    for i, w in enumerate(WIDTHS):
        patches, best, positive = kept[w]
        d = back[:, i * FILTERS : (i + 1) * FILTERS] * positive
        slopes[f"bias{w}"] = d.sum(axis=0)
        chosen = patches[each, best]  # (n, filters, width * vector)
        slopes[f"filter{w}"] = np.einsum("nfk,nf->kf", chosen, d)
        parts = (d[:, :, None] * weights[f"filter{w}"].T[None]).reshape(n, FILTERS, w, VECTOR)
        for k in range(w):
            np.add.at(dx, (each, best + k), parts[:, :, k])
    vectors = np.zeros_like(weights["vectors"])
    np.add.at(vectors, rows.ravel(), dx.reshape(-1, VECTOR))
    slopes["vectors"] = vectors
    return float(loss), slopes


def train(texts: list[str], languages: list[str]) -> Network:
    return train_windows([training_bytes(t) for t in texts], languages)


def train_windows(samples: list[bytes], languages: list[str]) -> Network:
    """Train on what ``training_bytes`` gives for each text."""
    names = sorted(set(languages))
    if not names:
        return Network([])
    number = {n: i for i, n in enumerate(names)}
    rows, labels = [], []
    for sample, language in zip(samples, languages):
        rows.append(np.frombuffer(sample, np.uint8).reshape(-1, WINDOW))
        labels += [number[language]] * len(rows[-1])
    data, target = np.concatenate(rows), np.array(labels)
    weights = _initial(len(names))
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    spread = {k: np.zeros_like(v) for k, v in weights.items()}
    rng, t = np.random.default_rng(2), 0
    # A small sample is gone through more often.
    epochs = max(EPOCHS, -(-400 * BATCH // len(data)))
    for _ in range(min(epochs, 100)):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            t += 1
            batch = order[at : at + BATCH]
            _, slopes = gradients(weights, data[batch], target[batch])
            for k, g in slopes.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                spread[k] = 0.99 * spread[k] + 0.01 * g * g
                step = STEP * (mean[k] / (1 - 0.9**t)) / (np.sqrt(spread[k] / (1 - 0.99**t)) + 1e-6)
                weights[k] = (weights[k] - step).astype(np.float32)
    return Network(names, weights)


class Predictor:
    """A trained network as tables, applied to whole texts."""

    def __init__(self, network: Network) -> None:
        self.languages = network.languages
        if not network.languages:
            return
        w = network.weights
        # For each width: tables of neighbouring bytes, and of the last byte if the width is odd.
        self.tables: list[tuple[int, list[tuple[int, bool, np.ndarray]], np.ndarray]] = []
        for width in WIDTHS:
            by_place = [
                w["vectors"] @ w[f"filter{width}"][k * VECTOR : (k + 1) * VECTOR] for k in range(width)
            ]
            parts = []
            for k in range(0, width - 1, 2):
                both = by_place[k][:, None, :] + by_place[k + 1][None, :, :]
                parts.append((k, True, both.reshape(65536, FILTERS)))
            if width % 2:
                parts.append((width - 1, False, by_place[-1]))
            self.tables.append((width, parts, w[f"bias{width}"]))
        self.out, self.out_bias = w["out"], w["out_bias"]

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """(windows, languages)."""
        pairs = rows[:, :-1].astype(np.int32) << 8 | rows[:, 1:]
        pooled = []
        for width, parts, bias in self.tables:
            places = WINDOW - width + 1
            total = None
            for k, two, table in parts:
                found = table[(pairs if two else rows)[:, k : k + places]]
                total = found if total is None else np.add(total, found, out=total)
            pooled.append(np.maximum(total.max(axis=1) + bias, 0))
        logits = np.concatenate(pooled, axis=1) @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        """Language and probability of each text; windows of many texts go through together."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not known or not self.languages:
            return names, scores
        sums = np.zeros((len(known), len(self.languages)))
        for rows, owner in _chunks(texts[i] for i in known):
            np.add.at(sums, owner, self.log_probabilities(rows))
        sums -= sums.max(axis=1, keepdims=True)
        p = np.exp(sums)
        p /= p.sum(axis=1, keepdims=True)
        for k, i in enumerate(known):
            best = int(p[k].argmax())
            names[i], scores[i] = self.languages[best], float(p[k, best])
        return names, scores


def _chunks(texts: Iterator[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of the texts in chunks of bounded size, with the number of each window's text."""
    rows, owners, held = [], [], 0
    for k, t in enumerate(texts):
        own = windows_of(t.encode("utf-8", "replace"))
        for at in range(0, len(own), WINDOWS_AT_ONCE):
            part = own[at : at + WINDOWS_AT_ONCE]
            rows.append(part)
            owners.append(np.full(len(part), k))
            held += len(part)
            if held >= WINDOWS_AT_ONCE:
                yield np.concatenate(rows), np.concatenate(owners)
                rows, owners, held = [], [], 0
    if rows:
        yield np.concatenate(rows), np.concatenate(owners)


def fit_languages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> Network:
    """Train on labelled documents that are not held out: a bounded sample of each language."""
    usable = docs.select(
        F.col(id_column).alias("__id"),
        F.col(text_column).cast("string").alias("__text"),
        F.col(label_column).cast("string").alias("__label"),
    ).filter(
        F.col("__label").isNotNull() & (F.length("__text") > 0) & ~held_out("__id")
    )
    draw = F.pmod(F.xxhash64(F.col("__id").cast("string"), "__text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    usable = usable.withColumn("__draw", draw)
    # A hash below (share / rows) draws about twice as many rows of a language as are kept; the
    # smallest is drawn in any case, as a language may be copies of one row.
    counts = written(
        usable.groupBy("__label").agg(F.count(F.lit(1)).alias("__rows"), F.min("__draw").alias("__least")),
        "language-counts",
    )
    each = max(1, min(sample_per_language, sample_documents // max(1, counts.count())))
    share = F.lit(float(2 * each + 30)) / F.col("__rows")
    drawn = (
        usable.join(counts, "__label")
        .filter((F.col("__draw") < share) | (F.col("__draw") == F.col("__least")))
        .groupBy("__label", "__text")
        .agg(F.min("__draw").alias("__draw"))
    )
    ranked = Window.partitionBy("__label").orderBy("__draw", "__text")
    kept = drawn.withColumn("__n", F.row_number().over(ranked)).filter(F.col("__n") <= each)
    made = column_udf(
        docs.sparkSession, lambda texts: [list(map(training_bytes, texts))], "windows binary", [pa.binary()]
    )
    rows = kept.select("__label", "__draw", made(F.col("__text"))["windows"].alias("__windows")).collect()
    rows.sort(key=lambda r: (r["__draw"], r["__label"], bytes(r["__windows"])))
    return train_windows([bytes(r["__windows"]) for r in rows], [r["__label"] for r in rows])


def with_language(docs: DataFrame, network: Network, text_column: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``lang_score``, the probability of that language."""
    predictors: list[Predictor] = []

    def step(texts: list) -> list:
        if not predictors:  # tables are built by the worker, not shipped
            predictors.append(Predictor(network))
        return list(predictors[0].predict(texts))

    made = column_udf(
        docs.sparkSession, step, "lang_pred string, lang_score double", [pa.string(), pa.float64()]
    )
    return with_fields(docs, made(F.col(text_column).cast("string")), ["lang_pred", "lang_score"])

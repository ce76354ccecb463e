"""Mixing sources to target weights along a curriculum whose weights change over time.

Each source has a schedule: its weight as a function of the training time from 0 to 1, given by
knots with straight lines between them. The integral of a schedule is the weight of the source in
the whole mix, which fixes how many words the mix takes of it. The same integral up to a time is
the share of those words that is used by then; its inverse turns the place of a document in its
source's line of words into a time, the document's training position.

The line of a source is its documents in the order of a hash of their ids and texts, repeated as
often as the target asks for. Hot sources are cut into buckets of that order: only sums per bucket
meet in one place, so no task needs a whole source, whatever the ids.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of
its own, after all others; rows with equal ids each count, and which of their texts is used does
not depend on how they are stored; rows that also share their text may stand for each other; an
empty table gives an empty mix. Columns that are not used are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.common import WORD_PATTERN, checkpointed, written
from stratalake.operators.aggregates import with_positions

# Leading hexadecimal digits of the order that make a bucket: 4,096 of them for each source.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Schedule:
    """Weight over time: knots (time, weight) from time 0 to time 1, straight lines between."""

    knots: tuple[tuple[float, float], ...]

    def segments(self) -> list[tuple[float, float, float, float, float]]:
        """(start, end, weight at start, weight at end, integral up to the start)."""
        out, area = [], 0.0
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            out.append((t0, t1, w0, w1, area))
            area += (w0 + w1) / 2 * (t1 - t0)
        return out

    @property
    def total(self) -> float:
        """The integral over the whole training: the source's weight in the mix."""
        return sum((w0 + w1) / 2 * (t1 - t0) for t0, t1, w0, w1, _ in self.segments())

    def time_of(self, share: Column) -> Column:
        """The time by which this share of the source's words is used: the inverse integral."""
        area = share * F.lit(self.total)
        out = None
        for t0, t1, w0, w1, before in reversed(self.segments()):
            rest = area - F.lit(before)
            slope = (w1 - w0) / (t1 - t0)
            if slope:
                root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
                at = F.lit(t0) + (root - F.lit(w0)) / F.lit(slope)
            else:
                at = F.lit(t0) + rest / F.lit(w0)
            end = before + (w0 + w1) / 2 * (t1 - t0)
            out = at if out is None else F.when(area < F.lit(end), at).otherwise(out)
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


# The mix of this package's queries: sources in order of their names take these in turn. The
# first fades, the second grows, the third stays; their integrals are 3, 1 and 2.
CURRICULUM = (
    Schedule(((0.0, 4.5), (1.0, 1.5))),
    Schedule(((0.0, 0.5), (1.0, 1.5))),
    Schedule(((0.0, 2.0), (1.0, 2.0))),
)


def word_volume(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))).cast("long")


def source_targets(
    sized: DataFrame, schedules: tuple[Schedule, ...], share: float, most_repeats: float
) -> DataFrame:
    """One row per source: its size, its schedule and the words that the mix takes of it.

    ``share`` times all words are dealt to the sources by weight. No source gives more than
    ``most_repeats`` times its size; what it can't give is dealt again among the others. This
    settles at one level of words per unit of weight: in order of (limit / weight), sources are
    full up to some point, and the rest share what is left. The level that would hold if the
    sources before were full rises up to that point and falls after it.
    """
    per_source = sized.groupBy("__source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()  # one row per source
    ranked = per_source.withColumn(
        "schedule", (F.row_number().over(everything.orderBy("__source")) - 1) % len(schedules)
    )
    weight = F.element_at(F.array(*[F.lit(s.total) for s in schedules]), F.col("schedule") + 1)
    limited = ranked.withColumn("weight", weight).withColumn(
        "limit", F.lit(most_repeats) * F.col("source_size")
    )
    filled = everything.orderBy(F.col("limit") / F.col("weight"), "__source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("limit").over(filled), F.lit(0.0)
    )
    weights = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(filled), F.lit(0.0)
    )
    level = limited.withColumn("level", left / weights)
    reached = F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("level"))
    settled = level.withColumn("level", F.max(reached).over(everything))
    return settled.select(
        "__source",
        "source_size",
        "schedule",
        F.coalesce(
            F.least(F.col("limit"), F.col("level") * F.col("weight")), F.col("limit")
        ).alias("target"),
    )


def document_takes(
    docs: DataFrame,
    schedules: tuple[Schedule, ...] = CURRICULUM,
    share: float = 1.5,
    most_repeats: float = 2.0,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    row_column: str | None = None,
) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken of it.

    ``offset`` is the place of the document's first word in one pass over its source. A column that
    tells rows apart is kept if it is named.
    """
    source = F.col(source_column).cast("string")
    kept = [] if row_column is None else [row_column]
    content = F.concat_ws(
        "|", F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    )
    sized = docs.select(
        *kept,
        F.col(id_column).alias("__id"),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("__source"),
        word_volume(F.col(text_column)).alias("size"),
        F.md5(content.cast("binary")).alias("__order"),
    ).withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS))
    # Counting words reads every text; what follows needs the counts three times.
    sized = checkpointed(sized)
    targets = source_targets(sized, schedules, share, most_repeats)
    buckets = sized.groupBy("__source", "__bucket").agg(F.sum("size").alias("__sum"))
    before = (
        Window.partitionBy("__source")  # sums of buckets, a bounded number per source
        .orderBy("__bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = buckets.withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).join(
        targets, "__source"
    )
    line = (
        Window.partitionBy("__source", "__bucket")
        .orderBy("__order", "__id", "size", *kept)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.col("__start") + F.coalesce(F.col("__inside"), F.lit(0))
    words = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - passes.cast("long") * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - F.col("offset")))
    placed = (
        sized.withColumn("__inside", F.sum("size").over(line))
        .join(starts.drop("__sum"), ["__source", "__bucket"])
        .withColumn("offset", offset)
    )
    return placed.select(
        *kept,
        F.col("__id").alias(id_column),
        F.when(F.col("__source") != "1", F.substring("__source", 2, 1 << 30)).alias(source_column),
        "size",
        "source_size",
        "target",
        "schedule",
        "offset",
        (passes.cast("long") * F.col("size") + part).alias("taken"),
    )


def document_uses(takes: DataFrame, schedules: tuple[Schedule, ...] = CURRICULUM) -> DataFrame:
    """One row per use of a document with its training position from 0 to 1, and one row without
    words and position for each document that is not used.

    ``words`` are the words this use takes: all of the document, but for the last use of the one
    document per source at which the target is reached. A position is the time at which the
    middle of those words is due, the inverse of the schedule's integral.
    """
    uses = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size")).cast("int"))
    spread = takes.withColumn("use", F.explode_outer(F.sequence(F.lit(0), uses - 1))).withColumn(
        "words", F.least(F.col("size"), F.col("taken") - F.col("use") * F.col("size"))
    )
    words = F.when(F.col("use").isNotNull(), F.col("words"))
    share = (F.col("use") * F.col("source_size") + F.col("offset") + F.col("words") / F.lit(2.0)) / F.col("target")
    position = F.lit(None).cast("double")
    for k, schedule in enumerate(schedules):
        position = F.when(F.col("schedule") == k, schedule.time_of(share)).otherwise(position)
    used = F.col("use").isNotNull()
    return spread.withColumns({"words": words, "position": F.when(used, position)}).drop("taken", "schedule")


def training_order(takes: DataFrame, schedules: tuple[Schedule, ...] = CURRICULUM) -> DataFrame:
    """The uses of documents, range-sorted by their training positions."""
    return document_uses(takes, schedules).filter("use IS NOT NULL").orderBy("position", takes.columns[0], "use")


def mixed_takes(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """One row per document: the words the mix takes of it, the positions of its first and last use,
    and the place of its first use among all, from 1, in the range-sorted training order."""
    keyed = docs.withColumn("__row", F.monotonically_increasing_id())
    # The ids are kept with the sizes, which are read once.
    takes = document_takes(
        keyed, id_column=id_column, source_column=source_column, text_column=text_column, row_column="__row"
    )
    # Words of a source start at one offset each, so uses that are due at once have an order.
    order = [F.col("position").asc_nulls_last(), F.col(source_column).asc_nulls_last(), "offset", "use", "__row"]
    placed = with_positions(document_uses(takes), order, "__number")
    same = [id_column, source_column, "size", "source_size", "target"]
    used = F.col("use").isNotNull()
    return (
        placed.groupBy("__row", *same)
        .agg(
            F.coalesce(F.sum("words"), F.lit(0)).alias("taken"),
            F.min("position").alias("first_position"),
            F.max("position").alias("last_position"),
            F.min(F.when(used, F.col("__number"))).alias("first_place"),
        )
        .select(id_column, "size", "source_size", "target", "taken", source_column, "first_position", "last_position", "first_place")
    )


def mixed_documents(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """The documents in training order, each as often as the mix uses it, in their own columns.

    Texts stay whole: the one document per source that the mix cuts is used once more if at least
    half of it is taken, and else stays at its full uses. Positions are found without texts, which
    are read again to be joined once and sorted once.
    """
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    numbered = docs.toDF(*names.values()).withColumn("row", F.monotonically_increasing_id())
    # Rows keep their numbers, also if a task is done again.
    keyed = written(numbered, "mixing")
    takes = document_takes(
        keyed, id_column=names[id_column], source_column=names[source_column], text_column=names[text_column],
        row_column="row",
    )
    uses = document_uses(takes).filter("use IS NOT NULL AND words * 2 >= size").select("row", "position")
    ordered = keyed.join(uses, "row").orderBy("position", names[id_column], "row")
    return ordered.select(*names.values()).toDF(*names)

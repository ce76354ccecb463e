"""The mix against a plain version: targets by repeated dealing, lines by walking them."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake.llm import mixing
from stratalake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"
WEIGHTS = [3.0, 1.0, 2.0]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Deal by weight, stop at twice the size, deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def plain_takes(rows):
    """{(id, source, size): words taken}, summed over equal rows."""
    by = defaultdict(list)
    for i, text, source in rows:
        content = f"{'' if i is None else i}|{text or ''}"
        by[source].append((hashlib.md5(content.encode()).hexdigest(), i is not None, i, words(text)))
    sizes = {s: sum(x[3] for x in own) for s, own in by.items()}
    target, taken = plain_targets(sizes), Counter()
    for s, own in by.items():
        left = math.floor(target[s] + 0.5)
        while left > 0:
            for place, _, i, size in sorted(own, key=lambda x: (x[0], x[1], x[2] or 0, x[3])):
                taken[i, s, size] += min(size, left)
                left -= min(size, left)
    return sizes, target, taken


def compare(rows, takes):
    sizes, target, taken = plain_takes(rows)
    got, count = Counter(), 0
    for r in takes:
        got[r.doc_id, r.source, r.size] += r.taken
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6)
        assert r.taken <= 2 * r.size
        count += 1
    assert count == len(rows)
    assert +got == +taken


@pytest.fixture
def odd(spark):
    rng = random.Random(4)
    rows = [(k, " ".join("w" * rng.randrange(1, 30)), rng.choice(["a", "a", "a", "b", "é", "Z", None])) for k in range(300)]
    rows += [(900, None, "a"), (901, "", "b"), (902, "x " * 5000, "b"), (5, "a b c", "a"), (5, "a b c", "a"), (5, "a b", "a"), (None, "n n", None), (903, "\x1c \x0b", "only")]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, size string")


def test_takes_equal_plain(odd):
    rows, docs = odd
    compare(rows, mixing.document_takes(docs).collect())


def test_query_equals_plain(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    compare(rows, QUERIES["op1_mix_sources"](spark, SF_DIR).collect())


def test_query_counts_repeated_ids_by_row(spark, odd, tmp_path):
    rows, docs = odd
    rows = rows + [(None, "n " * k, s) for k in range(1, 60) for s in ("a", None)] + [(5, "a b c", "b"), (None, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op1_mix_sources"](spark, str(tmp_path))
    compare(rows, got.collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(ORACLES["op1_mix_sources"])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(found.fetchall()) == Counter(tuple(r) for r in got.select(*names).collect())


def test_order_follows_the_schedules(odd):
    _, docs = odd
    takes = mixing.document_takes(docs)
    order = mixing.training_order(takes).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(0 <= r.position <= 1 for r in order)
    assert sum(r.words for r in order) == takes.agg(F.sum("taken")).first()[0]
    # The first source fades from three halves of its weight to one half: 5/8 come in the first half.
    first = [r for r in order if r.source == "Z"]
    early = sum(r.words for r in first if r.position < 0.5) / sum(r.words for r in first)
    assert abs(early - 0.625) < 0.05


@pytest.mark.parametrize("schedule", [*mixing.CURRICULUM, mixing.Schedule(((0.0, 1.0), (0.25, 3.0), (0.5, 3.0), (1.0, 0.5)))])
def test_times_invert_integrals(spark, schedule):
    shares = [k / 40 for k in range(41)]
    times = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(schedule.time_of(F.col("s"))).collect()]

    def integral(t):
        return sum((w0 + (w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0))) / 2 * (min(t, t1) - t0)
                   for t0, t1, w0, w1, _ in schedule.segments() if t > t0)

    assert all(math.isclose(integral(t) / schedule.total, s, abs_tol=1e-9) for s, t in zip(shares, times))


def test_documents_come_as_often_as_they_are_used(odd):
    rows, docs = odd
    takes = mixing.document_takes(docs).collect()
    want = Counter()
    for r in takes:
        if r.size:
            want[r.doc_id] += r.taken // r.size + (r.taken % r.size * 2 >= r.size)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = mixed.collect()
    assert Counter(r.doc_id for r in got) == +want
    known = {(i, t, s) for i, t, s in rows}
    assert all((r.doc_id, r.text, r.source) in known for r in got)


def test_reruns_agree(odd):
    _, docs = odd
    a = mixing.document_takes(docs).collect()
    b = mixing.document_takes(docs.repartition(7)).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_the_query_sorts_by_position(spark, odd, tmp_path):
    _, docs = odd
    docs.drop("size").write.parquet(str(tmp_path / "documents.parquet"))
    got = [r for r in QUERIES["op1_mix_sources"](spark, str(tmp_path)).collect() if r.taken]
    by_place = sorted(got, key=lambda r: r.first_place)
    assert [r.first_position for r in by_place] == sorted(r.first_position for r in got)
    uses = mixing.document_uses(mixing.document_takes(docs)).filter("use IS NOT NULL")
    assert sorted(r.first_place for r in got)[0] == 1 and max(r.first_place for r in got) <= uses.count()
    plan = mixing.training_order(mixing.document_takes(docs))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(position" in plan


def test_texts_that_share_an_id_do_not_depend_on_storage(spark):
    rows = [(None, f"a{k} b c", "s") for k in range(6)] + [(1, "x y z", "s"), (2, "u v w " * 9, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = [Counter(r.text for r in mixing.mixed_documents(docs.repartition(n)).collect()) for n in (1, 3, 5)]
    assert mixed[0] == mixed[1] == mixed[2]


def test_null_ids_are_dealt_to_many_buckets(spark):
    rows = [(None, f"a{k}", "s") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    takes = mixing.document_takes(docs, row_column=None)
    assert takes.select("offset").distinct().count() == 200
    order = F.md5(F.concat(F.lit("|"), F.col("text")).cast("binary"))
    assert docs.select(F.substring(order, 1, mixing.BUCKET_DIGITS)).distinct().count() > 150


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.document_takes(empty).count() == mixing.mixed_documents(empty).count() == 0

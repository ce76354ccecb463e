"""Round trips through archives, and what the reader saves of damaged ones."""

import io
import random

import pytest

from stratalake.llm import warc
from stratalake.llm.queries import QUERIES


def archive(data):
    return warc.Archive(io.BytesIO(data), len(data))


def records(n, packed=True):
    rng = random.Random(n)
    out = []
    for k in range(n):
        payload = f"<p>{k} {rng.random()} WARC/1.1 text \x1f</p>".encode() * rng.randrange(40)
        raw = warc.record_bytes(k, f"http://x/{k}", payload, None if k % 3 else 0, "2000-01-01T00:00:00Z")
        out.append((payload, warc.member(raw) if packed else raw))
    return out


def ids(found):
    return [warc._page(f.fields["warc-record-id"]) for f in found if f.reason is None]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("window", [1 << 20, 600])
def test_whole_archives(packed, window, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", window)
    made = records(30, packed)
    found = list(warc.read_records(archive(b"".join(r for _, r in made))))
    assert ids(found) == [str(k) for k in range(30)] and not any(f.reason for f in found)
    for k, ((payload, _), f) in enumerate(zip(made, found)):
        assert f.payload_bytes == len(payload)
        assert f.payload == (payload if k % 3 else None)
        assert f.fields["warc-payload-digest"] == "sha1:" + warc.sha1_base32(payload)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("window", [1 << 20, 600])
def test_damage_costs_only_what_it_touches(packed, window, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", window)
    made = [r for _, r in records(20, packed)]
    starts = [sum(map(len, made[:k])) for k in range(21)]
    data = bytearray(b"".join(made))
    for k in (4, 5, 11):
        middle = starts[k] + len(made[k]) // 2
        data[middle : middle + 8] = b"\x00" * 8
    found = list(warc.read_records(archive(bytes(data))))
    assert ids(found) == [str(k) for k in range(20) if k not in (4, 5, 11)]
    assert [(f.start, f.end) for f in found if f.reason] == [(starts[4], starts[6]), (starts[11], starts[12])]


@pytest.mark.parametrize("packed", [True, False])
def test_rubbish_and_cut_ends(packed):
    made = [r for _, r in records(5, packed)]
    data = b"rubbish\x1f\x8b\x08" + b"".join(made[:3]) + b"\x1f\x8b more" + made[3] + made[4][:-20]
    found = list(warc.read_records(archive(data)))
    assert ids(found) == ["0", "1", "2", "3"]
    gaps = [f for f in found if f.reason]
    assert [g.end - g.start for g in gaps] == [10, 7, len(made[4]) - 20]
    assert list(warc.read_records(archive(b""))) == []
    assert [(f.start, f.end) for f in warc.read_records(archive(b"x" * 99))] == [(0, 99)]


def test_a_changed_payload_is_found():
    raw = warc.record_bytes(1, None, b"payload", None, "d").replace(b"payload\r\n\r\n", b"payl0ad\r\n\r\n")
    assert [f.reason for f in warc.read_records(archive(warc.member(raw)))] == ["block digest differs"]


def test_pages_round_trip(spark, tmp_path):
    long = "é<br>" * 100_000
    data = [
        (5, "http://a\r\nX: y", "same", "x"), (3, None, "same", "x"), (3, "u", "same", "x"), (None, "n", "same", None),
        (7, "e", None, "x"), (8, "e", "", "x"), (9, "l", long, "x"), (10, "o", "\r\n\r\nWARC/1.1\r\n", "x"),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, payload string")
    made = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=200)
    got = warc.read_archives(spark, made).collect()
    assert made.count() > 1 and all(r.gap_reason is None for r in got)
    rows = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got)
    html = {str(i): (h or "") for i, _, h, _ in data}
    kind = {"5": ("revisit", "3"), "3": ("response", None), "None": ("revisit", "3"), "8": ("revisit", "7")}
    want = sorted(
        (str(i), *kind.get(str(i), ("response", None)), len(html[str(i)].encode()), warc.sha1_base32(html[str(i)].encode()))
        for i, *_ in data
    )
    assert rows == want
    assert {r.page_id: r.payload.decode() for r in got if r.payload is not None} == {
        i: html[i] for i in ("3", "7", "9", "10")
    }
    assert {r.target_uri for r in got if r.page_id == "5"} == {"http://a%0D%0AX: y"}


@pytest.mark.parametrize("length", [65_000, 65_200, 65_536, 100_000, 300_000])
def test_long_headers(length):
    made = [warc.record_bytes(k, "u" * (length + k), b"text", None, "d") for k in range(40)]
    for data in (b"".join(made), b"".join(map(warc.member, made))):
        found = list(warc.read_records(archive(data)))
        assert [len(f.fields["warc-target-uri"]) for f in found] == [length + k for k in range(40)]


def test_query_keeps_pages_with_long_urls(spark, tmp_path):
    data = [(1, "u" * 100_000, "a"), (2, "\x01" * 30_000, "b"), (3, "u", "c")]
    spark.createDataFrame(data, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted(r.page_id for r in QUERIES["op8_warc_round_trip"](spark, str(tmp_path)).collect()) == [1, 2, 3]


def test_query_fails_for_a_gap(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    made = warc.write_archives(spark.read.parquet(str(tmp_path / "pages.parquet")), str(tmp_path / "w"))
    with open(made.first().path.removeprefix("file:"), "rb+") as file:
        file.truncate(20)
    monkeypatch.setattr(warc, "write_archives", lambda *_: made)
    with pytest.raises(Exception, match="gap in .* member is cut off"):
        QUERIES["op8_warc_round_trip"](spark, str(tmp_path)).count()


def kept_and_lost(data):
    found = list(warc.read_records(archive(data)))
    return ids(found), [(f.start, f.end, f.reason) for f in found if f.reason]


def many(n=300, bad=()):
    """Records of one member, some with a changed block, and where each ends in the content."""
    made = [raw for _, raw in records(n, packed=False)]
    for k in bad:
        made[k] = made[k].replace(b"HTTP/1.1 200", b"HTTP/1.1 2x0")
    return made, [sum(map(len, made[: k + 1])) for k in range(n)]


@pytest.mark.parametrize("window", [1 << 20, 3000])
def test_a_bad_record_of_a_large_member_costs_only_itself(window, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", window)
    made, ends = many(bad=(0, 100, 101, 299))
    data = warc.member(b"".join(made))
    after = records(3)
    kept, lost = kept_and_lost(data + b"".join(r for _, r in after))
    assert kept == [str(k) for k in range(300) if k not in (0, 100, 101, 299)] + ["0", "1", "2"]
    ranges = [(0, ends[0]), (ends[99], ends[101]), (ends[298], ends[299])]
    assert lost == [(0, len(data), f"block digest differs (bytes {a} to {b} of the member's content)") for a, b in ranges]


@pytest.mark.parametrize("window", [1 << 20, 3000])
@pytest.mark.parametrize("level", [0, 3])
def test_a_cut_or_damaged_member_keeps_what_came_before(window, level, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", window)
    monkeypatch.setattr(warc, "LEVEL", level)
    made, _ = many()
    data = warc.member(b"".join(made))
    after = b"".join(r for _, r in records(3))
    kept, lost = kept_and_lost(data[: len(data) // 2] + after)
    n = len(kept) - 3
    assert n > 100 and kept == [str(k) for k in range(n)] + ["0", "1", "2"]
    if level:  # stored bytes of the next member look like this one's content
        assert [end for _, end, _ in lost] == [len(data) // 2] and 0 < lost[0][0] <= len(data) // 2
    kept, lost = kept_and_lost(data[: len(data) // 2])
    assert kept == [str(k) for k in range(n)] and lost[0][2] == "member is cut off"
    broken = bytearray(data)
    broken[len(data) // 2 : len(data) // 2 + 40] = b"\xff" * 40
    kept, lost = kept_and_lost(bytes(broken) + after)
    assert kept[:100] == [str(k) for k in range(100)] and kept[-3:] == ["0", "1", "2"] and lost
    assert len(set(kept[:-3])) == len(kept) - 3


def test_a_large_member_is_not_held_whole(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 4096)
    made, _ = many(2000)
    found, most = [], 0
    opened = []
    start = warc.Member.__init__
    monkeypatch.setattr(warc.Member, "__init__", lambda self, *a: (start(self, *a), opened.append(self))[0])
    for f in warc.read_records(archive(warc.member(b"".join(made)))):
        found.append(f)
        most = max(most, len(opened[0].data))
    assert ids(found) == [str(k) for k in range(2000)] and most < 200_000 < sum(map(len, made))


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc")], "page_id long, url string, html string")
    made = warc.write_archives(pages, str(tmp_path / "w"), least_payload=4)
    assert {r.record_type for r in warc.read_archives(spark, made).collect()} == {"response"}


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(pages, str(tmp_path / "w"))).count() == 0

"""Archives: exact round trip, revisits, broken frames and records."""

import hashlib
import io
import struct

import pytest
import zstandard

from shiftwise.llm import warc

ROWS = [(1, "u a\r\nX: y", "x" * 100), (2, "u", "x" * 100), (None, None, "x" * 100), (5, "v", None), (6, "w", ""),
        (7, "w", ""), (3, "w", "y" * 99), (4, "w", "y" * 99), (1, "u a\r\nX: y", "x" * 100), (9, "z", "é" * 50),
        (-9, "z", "é" * 50), (None, "q", "only null" * 20), (None, "q", "only null" * 20), (11, "l", "ab😀" * 300_000)]
ROWS += [(100 + i, f"http://h/{i}", f"<p>page {i}</p>" * (20 + i)) for i in range(30)]
SCHEMA = "page_id long, url string, html string, key string, digest string, size int, first string, salt int"


def model(rows):
    """(page_id, bytes, digest, type, refers_to) of each row."""
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and (h or "") in first and first[h] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                    first[h] if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "k", "d", 1, "f", 2) for r in ROWS], SCHEMA).repartition(3)


@pytest.mark.parametrize("limit", [8 << 20, -1])  # shipped or salted look-up of shared payloads
@pytest.mark.parametrize("through_spark", [False, True])
def test_round_trip(spark, pages, limit, through_spark):
    archives = warc.write_archives(pages, archive_bytes=2000, broadcast_bytes=limit)
    assert archives.count() > 3
    records = warc.read_archives(archives, through_spark=through_spark)
    assert sorted(map(tuple, warc.page_report(records).collect()), key=str) == model(ROWS)
    stored = {r["payload"] and bytes(r["payload"]) for r in records.collect() if r["record_type"] == "response"}
    assert {h.encode() for _, _, h in ROWS if h} <= {s for s in stored if s}
    assert warc.unresolved_revisits(records).count() == 0
    uris = {r["target_uri"] for r in records.collect()}
    assert "u%20a%0D%0AX:%20y" in uris  # no header can be smuggled in


def test_no_rows(spark, pages):
    archives = warc.write_archives(pages.limit(0))
    assert archives.count() == 0
    for through_spark in (False, True):
        assert warc.read_archives(archives, through_spark=through_spark).collect() == []


def test_copies_of_one_page_for_a_third_of_the_rows(spark):
    rows = [(i, "u", "same page " * 20 if i % 3 == 0 else f"page {i} " * 20) for i in range(900)]
    out = warc.page_report(warc.read_archives(warc.write_archives(
        spark.createDataFrame(rows, "page_id long, url string, html string"), broadcast_bytes=-1)))
    assert sorted(map(tuple, out.collect()), key=str) == model(rows)


def _archive(records, dictionary=b"", packed=False, **options):
    given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    out = b""
    if dictionary:
        content = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
        out = struct.pack("<II", 0x184D2A5D, len(content)) + content
    for r in records:
        out += zstandard.ZstdCompressor(**given, **options).compress(r)
    return out


def _record(payload=b"hello world", **change):
    args = dict(key=b"1", url=b"http://h/", payload=payload, size=len(payload),
                digest=hashlib.sha256(payload).hexdigest(), refers_to=None, date="2024-01-01T00:00:00Z")
    return warc.format_record(**{**args, **change})


def _read(data, **options):
    return list(warc.read_stream("a", io.BytesIO(data), **options))


@pytest.fixture(scope="module")
def dictionary():
    samples = [b"<html><body>page %d of the common frame</body></html>" % i * 5 for i in range(300)]
    return zstandard.train_dictionary(2048, samples, k=64, d=8).as_bytes()


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_in_the_leading_frame(dictionary, packed):
    data = _archive([_record(), _record(b"")], dictionary, packed)
    assert [r["payload"] for r in _read(data)] == [b"hello world", b""]
    with pytest.raises(warc.BadArchive):  # its records need that dictionary
        _read(data[struct.unpack("<I", data[4:8])[0] + 8:])


def test_a_leading_frame_without_a_dictionary(dictionary):
    bad = struct.pack("<II", 0x184D2A5D, 5) + b"other"
    with pytest.raises(warc.BadArchive, match="no dictionary"):
        _read(bad + _archive([_record()]))
    # Any other skippable frame is passed over.
    assert len(_read(struct.pack("<II", 0x184D2A50, 5) + b"other" + _archive([_record()]))) == 1


@pytest.mark.parametrize("options", [{}, {"write_checksum": True}, {"write_content_size": False}, {"level": 19}])
def test_frames_are_found_by_their_blocks(options):
    import random
    big = random.Random(1).randbytes(700_000)
    records = [_record(p) for p in (b"", b"a" * 500_000, big, b"x")]
    data = _archive(records, **options)
    assert [r["payload"] for r in _read(data)] == [b"", b"a" * 500_000, big, b"x"]
    offsets = [r["offset"] for r in _read(data)]
    assert offsets == [data.index(struct.pack("<I", 0xFD2FB528), o) for o in offsets]


@pytest.mark.parametrize("record, message", [
    (_record() + _record(), "block is not"), (_record()[:-1], "block is not"), (b"no header", "does not end"),
    (_record().replace(b"WARC/1.1", b"WARC/9.9", 1), "version"),
    (_record().replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""), "missing"),
    (_record().replace(b"WARC-Date", b"WARC-Type"), "repeats"),
    (_record(size=12), "payload of 11 bytes"), (_record(digest="00"), "another digest"),
    (_record().replace(b"Content-Length: 11\r\n\r\nhello", b"Content-Length: -1\r\n\r\nhello"), "content length"),
    (_record().replace(b"WARC-Type: response", b"WARC-Type response:"), "missing"),
    (_record(refers_to=b"7").replace(b"WARC-Refers-To: <urn:x-page:7>\r\n", b""), "names no record"),
])
def test_bad_records(record, message):
    data = _archive([_record(b"first"), record, _record(b"last")])
    with pytest.raises(warc.BadArchive, match=message):
        _read(data)
    first, bad, last = _read(data, on_error="flag")  # the next frame is read all the same
    assert first["payload"] == b"first" and last["payload"] == b"last"
    assert message in bad["error"] and bad["payload"] is None and bad["frame_bytes"] > 0


def test_broken_frames():
    good = _archive([_record(b"first" * 50), _record(b"last" * 50)], write_checksum=True)
    half = len(good) // 2
    flipped = bytearray(good)
    flipped[half - 20] ^= 1
    rows = _read(bytes(flipped), on_error="flag")
    assert [r["error"] is None for r in rows] in ([True, True, False], [False, True], [True, False])
    cut = _read(good[:-3], on_error="flag")
    assert cut[0]["payload"] == b"first" * 50 and "ends inside" in cut[1]["error"] and len(cut) == 2
    assert "no frame" in _read(b"\x1f\x8b\x08\x00rest", on_error="flag")[0]["error"]


def test_flagged_rows_on_spark(spark, tmp_path):
    path = tmp_path / "a.warc.zst"
    path.write_bytes(_archive([_record(), b"bad", _record(b"last")]))
    archives = warc.archive_table(spark, [f"file://{path}"])
    rows = warc.read_archives(archives, on_error="flag").collect()
    assert [r["error"] is None for r in rows] == [True, False, True]
    with pytest.raises(Exception, match="does not end"):
        warc.read_archives(archives).collect()

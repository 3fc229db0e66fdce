"""Archives: exact round trip, repeated payloads, and archives that are not sound."""

import io
from collections import Counter

import pytest
import zstandard

from tests.llm.data import empty, prose
from tidemark.llm import warc

PAGES = "page_id long, url string, html string"


def page_rows():
    menu = "<nav>" + prose(1, 40) + "</nav>"
    rows = [(i, f"http://h{i % 3}.example/{i}?q=é x", f"<html>{menu}<p>{prose(i, 30 + i)}</p></html>") for i in range(120)]
    rows += [(200 + i, f"http://copy.example/{i}", rows[7][2]) for i in range(50)] + [(-5, "http://first.example/", rows[9][2])]
    rows += [
        (300, None, None), (301, "", ""), (302, "http://a.example/\r\nWARC-Type: response", "x\r\n\r\ny"), (None, "u", rows[11][2]),
        (None, "u", "only here"), (None, "v", "only here"), (303, "u", "twice"), (303, "w", "twice"), (303, "w", "twice"),
        (304, "u", "\x00 ß 日本 🙂"), (305, "u", prose(9, 30_000)), (None, None, None),
    ]
    return rows


def expected_of(rows):
    order = lambda i: (i is None, i or 0)
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = Counter()
    for html, ids in groups.items():
        payload = html.encode()
        ids = sorted(ids, key=order)
        for nth, page_id in enumerate(ids):
            out[page_id, len(payload), warc.digest_of(payload), "revisit" if nth else "response", ids[0] if nth else None] += 1
    return out


@pytest.mark.parametrize("most", [warc.ARCHIVE_BYTES, 3000])
def test_round_trip(spark, most):
    rows = page_rows()
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS payload", "2 AS _row", "3 AS archive").repartition(2)
    manifest = warc.write_archives(frame, most=most, sample=400 if most > 3000 else 45)
    files = manifest.collect()
    assert sum(f.records for f in files) == len(rows) and (len(files) > 4 if most == 3000 else len(files) <= 2)
    records = warc.read_archives(manifest)
    got = records.collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected_of(rows)
    payloads = {r.payload_digest: r.payload for r in got if r.record_type == "response"}
    assert Counter((r.page_id, bytes(payloads[r.payload_digest]).decode()) for r in got) == Counter((i, h or "") for i, _, h in rows)
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, warc.encoded_url(u) if u else None) for i, u, _ in rows)
    assert len({r.record_id for r in got}) == len(rows)
    folder = files[0].archive.rsplit("/", 1)[0]
    assert warc.read_archives(warc.listed(spark, folder), payloads=False).count() == len(rows)


def test_small_payloads_are_all_responses(spark):
    rows = [(i, "u", "tiny" if i % 2 else "not so tiny") for i in range(10)]
    found = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, PAGES), least=5)).collect()
    assert Counter((r.record_type, r.refers_to) for r in found) == {("response", None): 6, ("revisit", 0): 4}


def test_empty_table(spark):
    assert warc.read_archives(warc.write_archives(empty(spark, PAGES))).count() == 0


def archive(records, dictionary=True):
    parts = [part for part, _ in warc.archive_parts(records)]
    return b"".join(parts if dictionary else parts[1:])


def records_of(count=100):
    return [warc.page_record("0" * 32, i, i, f"http://x.example/{i}", f"<p>{prose(i, 60)}</p>".encode()) for i in range(count)]


def test_dictionary_leads():
    records = records_of()
    content = archive(records)
    assert content[:4] == b"\x5d\x2a\x4d\x18"
    found = list(warc.frames(io.BytesIO(content)))
    assert [r for _, r in found] == records and all(content[at:at + 4] == warc.FRAME for at, _ in found)
    with pytest.raises(warc.BrokenArchive, match="frame at 0"):
        list(warc.frames(io.BytesIO(archive(records, dictionary=False))))
    # A dictionary may also lie there as it is.
    plain = warc.dictionary_of(io.BytesIO(content))[0].as_bytes()
    size = 8 + int.from_bytes(content[4:8], "little")
    again = content[:4] + len(plain).to_bytes(4, "little") + plain + content[size:]
    assert [r for _, r in warc.frames(io.BytesIO(again))] == records
    few = records[:5]
    assert [r for _, r in warc.frames(io.BytesIO(archive(few)))] == few and archive(few)[:4] == warc.FRAME
    assert list(warc.frames(io.BytesIO(b""))) == []


@pytest.mark.parametrize("cut", [3, 7, 40, -1, -20])
def test_cut_archives_fail(cut):
    with pytest.raises(warc.BrokenArchive):
        list(warc.frames(io.BytesIO(archive(records_of())[:cut])))


@pytest.mark.parametrize(
    "old, new, message",
    [
        (b"WARC/1.1", b"WARC/9.9", "no WARC record"), (b"WARC-Date: ", b"Date: ", "no warc-date"),
        (b"<p>", b"<p> ", "content-length"), (b"<p>", b"<b>", "block has another digest"),
        (b"Content-Length: ", b"Content-Length: x", "content-length"), (b"WARC-Type", b"WARC Type\x00\r\n:", "field|no "),
    ],
)
def test_unsound_records_fail(tmp_path, old, new, message):
    record = records_of(1)[0].replace(old, new)
    path = str(tmp_path / "a.warc.zst")
    with open(path, "wb") as file:
        file.write(archive(records_of(60)) + zstandard.ZstdCompressor().compress(record))
    with pytest.raises(warc.BrokenArchive, match=f"a.warc.zst at .*({message})"):
        list(warc.archive_records(path))


def test_other_payload_digest_fails():
    record = records_of(1)[0].replace(b"WARC-Block-Digest", b"Other").replace(b"<p>", b"<b>")
    with pytest.raises(warc.BrokenArchive, match="payload has another digest"):
        warc.page_of(record)


def test_foreign_records():
    """Other kinds of records, and fields in other letters, are read as they are."""
    record = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date:2020\r\ncontent-length: 5\r\n\r\na: b\n\r\n\r\n"
    page = warc.page_of(record)
    assert (page["record_type"], page["payload"], page["payload_bytes"], page["page_id"]) == ("warcinfo", b"a: b\n", 5, None)

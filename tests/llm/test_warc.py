"""Archives: round trips, revisits, and what filters skip."""

from __future__ import annotations

import base64
import hashlib

import pytest

from llm import warc
from llm.common import filesystem, new_dir
from llm_fixtures import tuned  # noqa: F401

PAGES = "page_id long, url string, html string, record_type string"


@pytest.fixture(scope="module")
def pages(tuned):
    rows = [
        (3, "http://a.example/x y%\r\nz", "<p>same</p>", "clash"),
        (1, "http://b.example/", "<p>same</p>", None),
        (2, None, "", "x"),
        (4, "http://c.example/", None, "x"),
        (None, "http://d.example/", "<p>same</p>", "x"),
        (None, "http://e.example/", "alone é", "x"),
        (5, " lead and trail ", "WARC/1.1\r\n\r\nnot a record\r\n", "x"),
        (6, "http://f.example/", "long " * 200_000, "x"),
        (1, "http://b.example/", "<p>same</p>", None),
    ]
    return tuned.createDataFrame(rows, PAGES)


def brute(rows, min_bytes=0):
    first: dict = {}
    for r in rows:
        if r.page_id is not None:
            first[r.html or ""] = min(r.page_id, first.get(r.html or "", r.page_id))
    out = []
    for r in rows:
        data = (r.html or "").encode()
        of = first.get(r.html or "")
        revisit = len(data) >= min_bytes and of is not None and r.page_id != of
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((r.page_id, len(data), digest, "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(pages, min_bytes):
    found = sorted((tuple(r) for r in warc.round_trip(pages, min_bytes).collect()), key=str)
    assert found == brute(pages.collect(), min_bytes)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_payloads_and_urls_survive(pages, tuned, compression):
    path = new_dir(tuned, "warc-test")
    warc.archive(pages.filter("page_id <> 1"), path, compression=compression)
    rows = {r.record_id: r for r in warc.read_archive(tuned, path).collect()}
    for p in pages.filter("page_id IN (3, 5, 6)").collect():
        r = rows[f"urn:page:{p.page_id}"]
        assert (r.payload.decode(), r.target_uri) == (p.html, p.url)
    light = warc.read_archive(tuned, path, payload=False).collect()
    assert len(light) == len(rows) and all(r.payload is None for r in light)


@pytest.mark.parametrize("damage", ["changed", "cut"])
def test_a_damaged_archive_is_seen(pages, tuned, damage):
    """Size and digest come from the payloads that are read, not from the headers that were written."""
    path = new_dir(tuned, "warc-test")
    warc.archive(pages.coalesce(1), path)
    want = {repr(tuple(r)) for r in warc.read_back(tuned, path).collect()}
    store, folder = filesystem(path)
    name = next(f.path for f in store.get_file_info(warc.pafs.FileSelector(folder)) if f.path.endswith(".warc"))
    with store.open_input_file(name) as file:
        data = file.read()
    at = data.index(b"<p>same</p>")
    with store.open_output_stream(name) as out:
        out.write(data.replace(b"<p>same</p>", b"<p>lame</p>") if damage == "changed" else data[: at + 4])
    try:
        got = warc.read_back(tuned, path).collect()
    except Exception as error:  # noqa: BLE001  a record that ends too early may also stop the read
        assert damage == "cut" and "WARC" in str(error) or "end" in str(error)
        return
    assert {repr(tuple(r)) for r in got} != want
    lost = [r for r in got if r.record_type == "revisit" and r.payload_digest is None]
    assert lost or damage == "cut"


def test_filters_reach_the_reader(pages, tuned):
    path = new_dir(tuned, "warc-test")
    warc.archive(pages, path)
    every = warc.read_archive(tuned, path)
    revisits = every.filter("record_type = 'revisit'")
    assert revisits.count() == every.collect().__len__() - every.filter("record_type = 'response'").count() > 0
    assert every.filter("target_uri LIKE 'http://b%'").count() == 2
    reader = warc.WarcReader({"path": path})
    kept = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert len(kept) == 1 and all(row[1] == "revisit" for part in reader.partitions() for b in reader.read(part) for row in zip(*[c.to_pylist() for c in b.columns], strict=True))


def test_unlisted_files_are_not_read(pages, tuned):
    path = new_dir(tuned, "warc-test")
    warc.archive(pages, path)
    store, folder = filesystem(path)
    with store.open_output_stream(folder + "/left-by-a-lost-attempt.warc") as out:
        out.write(b"WARC/1.1\r\nbroken")
    assert warc.read_archive(tuned, path).count() == pages.count()


def test_files_are_planned_by_size(pages, tuned):
    path = new_dir(tuned, "warc-test")
    warc.register(tuned)
    rows = warc.with_revisits(pages.repartition(5)).withColumn("payload_digest", warc.base32(warc.F.col("payload_digest")))
    rows.write.format("warc").option("max_file_bytes", "500").mode("append").save(path)
    parts = warc.WarcReader({"path": path, "partition_bytes": "1"}).partitions()
    assert len(parts) > 2 and all(len(p.paths) == 1 for p in parts)


def test_empty_table(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0

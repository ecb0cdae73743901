import gzip
import hashlib
import io
import random
import zipfile

import pytest
from conftest import SF_SMALL

from ledgerflow.llm import warc, zip_reader

SCHEMA = "page_id long, url string, html string, path string, records int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute(pages, min_bytes=0):
    out = []
    for i, url, html, *_ in pages:
        p = (html or "").encode()
        same = [j for j, _, h, *_ in pages if (h or "").encode() == p and j is not None]
        top = max(same, default=None)
        again = len(p) >= min_bytes and top is not None and (i is None or i < top)
        out.append((i, len(p), warc.digest(p), "revisit" if again else "response", top if again else None, url))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rnd = random.Random(2)
    bodies = ["", None, "<p>é😀</p>", "x" * 100_000, "a\r\n\r\nb", "WARC/1.1\r\n"]
    pages = [(i, rnd.choice([None, "http://a/%20b c\r\nd", f"http://x/{i}", "http://é/"]), rnd.choice(bodies), "p", 1) for i in range(60)]
    pages += [(None, "u", "only here", "p", 1), (None, "u", "", "p", 1), (59, "again", pages[59][2], "p", 1)]
    df = spark.createDataFrame(pages, SCHEMA)
    for least in (0, 5):
        assert rows(warc.round_trip(spark, df, least)) == brute(pages, least)
    assert warc.round_trip(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_packages_and_ranges(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    packages = warc.write(pages, f"file://{tmp_path}/w", package_bytes=20_000)
    assert packages.count() > 3
    found = warc.resolved(warc.read(packages, range_bytes=3000)).collect()
    page = lambda name: None if name is None else int(name[len("<urn:page:"):-1])
    wanted = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got = sorted(((page(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, page(r.refers_to)) for r in found), key=repr)
    assert got == sorted((w[:5] for w in brute(wanted)), key=repr)
    html = {i: (h or "").encode() for i, _, h in wanted}
    assert all(r.payload == html[page(r.record_id)] for r in found)  # revisits have their response's


def foreign(kind, uri, body, record_id, compress=True, **headers):
    """A record as others write it."""
    block = body if kind in ("warcinfo", "resource") else b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + body
    what = {"warcinfo": "application/warc-fields", "resource": "text/plain"}.get(kind, "application/http;msgtype=response")
    head = ["WARC/1.0", f"warc-type: {kind}", f"WARC-Record-ID:{record_id}", f"Content-Type: {what}", f"Content-Length: {len(block)}"]
    if uri:
        head.append(f"WARC-Target-URI: {uri}")
    head += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw) if compress else raw


def package(path, archives, indexes=(), **options):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}")
        for name, records in archives.items():
            with z.open(name, "w", force_zip64=options.get("force", False)) as f:
                f.write(b"".join(records))
        for name, text in indexes:
            z.writestr(name, text)


@pytest.mark.parametrize("force", [False, True])
def test_packages_of_others_are_read_whole(spark, tmp_path, force, monkeypatch):
    """Several archives, plain and compressed, some without an index, records without digests, uuids as ids."""
    info = foreign("warcinfo", None, b"software: x\r\n", "<urn:uuid:0>")
    one = foreign("response", "http://a/", b"body one", "<urn:uuid:1>", WARC_Payload_Digest="sha1:" + warc.digest(b"body one"))
    two = foreign("response", "http://b/", b"two " * 50_000, "<urn:uuid:2>", WARC_Payload_Digest="sha1:" + hashlib.sha1(b"two " * 50_000).hexdigest())
    plain = [foreign("resource", "urn:x", b"text\r\n\r\nmore", "<urn:uuid:3>", compress=False), foreign("response", "http://c/", b"", "<urn:uuid:4>", compress=False)]
    again = foreign("revisit", "http://a/2", b"", "<urn:uuid:5>", WARC_Refers_To="<urn:uuid:1>")
    lost = foreign("revisit", "http://z/", b"", "<urn:uuid:6>", WARC_Refers_To="<urn:uuid:99>")
    index = (f'!meta {{"format": "cdxj"}}\ncom,a)/ 2020 {{"filename": "a.warc.gz", "offset": "{len(info)}", "length": "{len(one)}"}}\n'
             f'com,a)/ 2019 {{"filename": "a.warc.gz", "offset": "0", "length": "{len(info)}"}}\n'
             f'com,b)/ 2019 {{"filename": "b.warc.gz", "offset": "0", "length": "{len(two)}"}}\n')  # b has another record: no full index
    path = f"{tmp_path}/p.wacz"
    package(path, {"archive/a.warc.gz": [info, one], "archive/b.warc.gz": [two, again], "archive/c.warc": plain, "archive/sub/d.warc.gz": [lost],
                   "archive/empty.warc.gz": []}, [("indexes/index.cdxj", index)], force=force)
    found = warc.resolved(warc.read(spark.createDataFrame([(f"file://{path}",)], "path string"), range_bytes=100)).collect()
    got = {r.record_id: (r.member, r.record_type, r.target_uri, r.payload) for r in found}
    assert got == {
        "<urn:uuid:0>": ("archive/a.warc.gz", "warcinfo", None, b"software: x\r\n"), "<urn:uuid:1>": ("archive/a.warc.gz", "response", "http://a/", b"body one"),
        "<urn:uuid:2>": ("archive/b.warc.gz", "response", "http://b/", b"two " * 50_000), "<urn:uuid:3>": ("archive/c.warc", "resource", "urn:x", b"text\r\n\r\nmore"),
        "<urn:uuid:4>": ("archive/c.warc", "response", "http://c/", b""), "<urn:uuid:5>": ("archive/b.warc.gz", "revisit", "http://a/2", b"body one"),
        "<urn:uuid:6>": ("archive/sub/d.warc.gz", "revisit", "http://z/", None)}
    assert next(r for r in found if r.record_id == "<urn:uuid:1>").headers["WARC-Payload-Digest"] == "sha1:" + warc.digest(b"body one")


def test_long_members_are_walked_in_steps(monkeypatch):
    monkeypatch.setattr(warc, "STEP", 37)
    monkeypatch.setattr(warc, "FIRST", 11)
    for compress in (True, False):
        records = [foreign("response", "http://a/", bytes([i]) * (i * 50), f"<urn:uuid:{i}>", compress=compress) for i in range(9)]
        data = b"".join(records)
        places = warc._walked(len(data), lambda at, n: data[at:at + n])
        assert [data[a:a + n] for a, n in places] == records
        assert [len(warc.parsed(data[a:a + n])["payload"]) for a, n in places] == [i * 50 for i in range(9)]
    with pytest.raises(zip_reader.BadArchive):
        warc._walked(len(records[0]), lambda at, n: b"nonsense"[:n])


def test_a_wrong_payload_is_an_error():
    bad = foreign("response", "http://a/", b"body", "<urn:uuid:1>", WARC_Payload_Digest="sha1:" + warc.digest(b"other"))
    with pytest.raises(zip_reader.BadArchive, match="urn:uuid:1"):
        warc.parsed(bad)
    assert warc.parsed(foreign("response", "http://a/", b"body", "<urn:uuid:1>", WARC_Payload_Digest="sha256:x"))["payload"] == b"body"


def reader(data):
    return len(data), lambda at, n: data[at:at + n]


@pytest.mark.parametrize("force", [False, True])
def test_directory_of_plain_and_zip64_archives(force):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(5):
            with z.open(f"é/{i}", "w", force_zip64=force) as f:
                f.write(bytes([i]) * (i * 10))
        z.comment = b"a PK\x05\x06 comment"
    size, read_at = reader(out.getvalue())
    found = zip_reader.members(size, read_at)
    assert [m.name for m in found] == [f"é/{i}" for i in range(5)]
    for i, m in enumerate(found):
        at = zip_reader.data_start(m, read_at)
        assert read_at(at, m.size) == bytes([i]) * (i * 10)


def test_more_entries_than_16_bits_and_wide_fields(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)  # everything beyond 10 bytes in ZIP64 fields
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(70_000):
            z.writestr(str(i), b"")
        z.writestr("last", b"0123456789abc")
    size, read_at = reader(out.getvalue())
    found = zip_reader.members(size, read_at)
    assert len(found) == 70_001
    assert read_at(zip_reader.data_start(found[-1], read_at), found[-1].size) == b"0123456789abc"


def test_bad_archives_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 1000)
    size, read_at = reader(out.getvalue())
    with pytest.raises(zip_reader.BadArchive):
        zip_reader.data_start(zip_reader.members(size, read_at)[0], read_at)
    for data in (b"", b"nothing here", out.getvalue()[:-30]):
        with pytest.raises(zip_reader.BadArchive):
            zip_reader.members(*reader(data))

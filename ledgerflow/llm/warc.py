"""Web archives in ZIP packages: writing pages as WARC records, reading them back by ranges.

Writing. Pages with equal payloads of at least ``min_bytes`` bytes keep one
``response``, the one of the largest page_id; the others are ``revisit`` records
that refer to it and carry no payload. Each task streams its records, one gzip
member each, into ZIP packages with two stored members: ``archive/data.warc.gz``
and ``indexes/index.cdxj``, a line per record with its offset and length. A
package is closed at ``package_bytes``. A task's attempt writes files of its own
names and only the files of the attempt that succeeded are listed, so a repeated
attempt or a lost executor leaves nothing half-read.

Reading. Any package: the central directory (ZIP64 too) gives the members. Every stored
``archive/`` member is read, gzip members or plain records. Its records are located by the
``indexes/`` members where their lines tile the whole of it, else by walking it once;
they are grouped into ranges of about ``range_bytes`` that are dealt over the cluster, and each range
is read with one call. Nothing is unpacked to disk. A record comes back with its id, type, all its
headers and its payload; a payload that is not the one of its SHA-1 is an error.
``resolved`` gives revisits the payload of the record they refer to, by record id.

Files are reached through pyarrow's file systems by their URI, the shared folder
of ``spark.checkpoint.dir`` by default.

Defined cases: null html is an empty payload; null page_id is kept, as a revisit if
an equal payload has an id, else as response; rows that repeat the largest page_id of
a payload are responses each; a null url leaves its header out; an empty table writes
no package; other columns are ignored. Of a foreign archive, records without an id, URL, digest or HTTP
head have null there and their block as payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir

from .common import shuffle_partitions, stored
from .zip_reader import BadArchive, data_start, members

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # of capture; the table has none
PACKAGES = pa.schema([("path", pa.string()), ("records", pa.int64())])
RECORD = ("path string, member string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
          "headers map<string,string>, payload_bytes long, payload_digest string, payload binary")
RECORD_SCHEMA = pa.schema([("path", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                           ("target_uri", pa.string()), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
GZIP = b"\x1f\x8b"
STEP = 1 << 20  # bytes read at once where a member is walked
FIRST = 1 << 14  # bytes of a record looked at first


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# --- records ----------------------------------------------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _fields(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    """First line and (name, value) of the others; a line that begins with a blank goes on with the one before."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return first, out


def parsed(data: bytes) -> dict:
    """One record, a gzip member or plain; its payload is checked against its digest where that is a SHA-1."""
    raw = gzip.decompress(data) if data[:2] == GZIP else data
    head, there, rest = raw.partition(b"\r\n\r\n")
    version, fields = _fields(head)
    if not there or not version.startswith("WARC/"):
        raise BadArchive("no WARC record where the index says")
    by_name = {k.lower(): v for k, v in fields}
    length = int(by_name.get("content-length", "0"))
    if len(rest) < length:
        raise BadArchive(f"the archive ends within {by_name.get('warc-record-id')}")
    payload, kind = rest[:length], by_name.get("warc-type")
    if by_name.get("content-type", "").replace(" ", "").startswith("application/http") and payload[:5] == b"HTTP/":
        payload = payload.partition(b"\r\n\r\n")[2]
    found, (how, _, said) = digest(payload), by_name.get("warc-payload-digest", "").partition(":")
    whole = kind != "revisit" and "warc-truncated" not in by_name
    if whole and how.lower() == "sha1" and said.upper() not in (found, hashlib.sha1(payload).hexdigest().upper()):
        raise BadArchive(f"the payload of {by_name.get('warc-record-id')} is not the one written")
    return {"record_id": by_name.get("warc-record-id"), "record_type": kind, "target_uri": by_name.get("warc-target-uri"),
            "refers_to": by_name.get("warc-refers-to"), "headers": fields, "payload_bytes": len(payload), "payload_digest": found, "payload": payload}


# --- writing ----------------------------------------------------------------------------------------------------------

class Package:
    """One ZIP package being written as a stream."""

    def __init__(self, folder: str):
        files, at = file_system(folder)
        files.create_dir(at, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.bytes, self.lines = f"{folder}/{name}", 0, []
        self.out = files.open_output_stream(f"{at}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA, (2000, 1, 1, 0, 0, 0)), "w", force_zip64=True)

    def add(self, data: bytes, url: str | None, kind: str) -> None:
        self.lines.append(json.dumps({"url": url, "offset": self.bytes, "length": len(data), "type": kind}))
        self.data.write(data)
        self.bytes += len(data)

    def close(self) -> pa.RecordBatch:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX, (2000, 1, 1, 0, 0, 0)), "".join(x + "\n" for x in self.lines))
        self.zip.close()
        self.out.close()
        return pa.RecordBatch.from_pylist([{"path": self.path, "records": len(self.lines)}], schema=PACKAGES)


def write(pages: DataFrame, folder: str, min_bytes: int = 0, package_bytes: int = 256 << 20) -> DataFrame:
    """Write the packages under ``folder`` (a URI); path and records of each."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1("html"))
    owners = p.groupBy("sha1").agg(F.max("page_id").alias("owner"))
    again = (F.octet_length("html") >= min_bytes) & F.col("owner").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("owner")))
    marked = p.join(owners, "sha1").select("page_id", "url", "html", F.when(again, F.col("owner")).alias("refers_to"))

    def packages(batches):
        package = None
        for batch in batches:
            for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                package = package or Package(folder)
                package.add(record(page_id, url, html.encode(), refers_to), url, "response" if refers_to is None else "revisit")
                if package.bytes >= package_bytes:
                    yield package.close()
                    package = None
        if package:
            yield package.close()

    return stored(marked.mapInArrow(packages, "path string, records long"), "packages")


# --- reading ----------------------------------------------------------------------------------------------------------

def _ahead(size: int, read_at):
    """``read_at`` that reads STEP bytes at once and serves what follows from them."""
    held = [0, b""]

    def read(offset: int, length: int) -> bytes:
        if not held[0] <= offset or offset + length > held[0] + len(held[1]):
            held[:] = offset, read_at(offset, min(max(length, STEP), size - offset))
        return held[1][offset - held[0]:offset - held[0] + length]

    return read


def _walked(size: int, read_at) -> list[tuple[int, int]]:
    """(offset, length) of each record of an archive member, found by going through it."""
    out, at, read_at = [], 0, _ahead(size, read_at)
    while at < size:
        piece = read_at(at, min(FIRST, size - at))
        if piece[:2] == GZIP:
            engine, taken = zlib.decompressobj(31), 0
            while True:
                engine.decompress(piece)
                taken += len(piece) - len(engine.unused_data)
                if engine.eof:
                    break
                if at + taken >= size:
                    raise BadArchive("the archive ends within a record")
                piece = read_at(at + taken, min(STEP, size - at - taken))
            length = taken
        else:
            while b"\r\n\r\n" not in piece and len(piece) < size - at:
                piece += read_at(at + len(piece), min(STEP, size - at - len(piece)))
            head, there, _ = piece.partition(b"\r\n\r\n")
            version, fields = _fields(head)
            if not there or not version.startswith("WARC/"):
                raise BadArchive("no WARC record where one should begin")
            block = int({k.lower(): v for k, v in fields}.get("content-length", "0"))
            length = min(len(head) + 4 + block + 4, size - at)  # two line ends close a record
        out.append((at, length))
        at += length
    return out


def _tiles(places: list[tuple[int, int]], size: int) -> bool:
    """Whether the places, ascending, cover the whole member without gap or overlap."""
    at = 0
    for offset, length in places:
        if offset != at or length <= 0:
            return False
        at += length
    return at == size


def _indexed(lines: list[str], archives: list[str]) -> dict[str, list[tuple[int, int]]]:
    """Places of records by archive member, from lines with a JSON object (offset, length and,
    where there are several archives, filename) behind whatever keys."""
    out: dict[str, set[tuple[int, int]]] = {}
    for line in lines:
        at = line.find("{")
        if line.startswith("!") or at < 0:
            continue
        entry = json.loads(line[at:])
        if "offset" not in entry or "length" not in entry:
            continue
        name = entry.get("filename")
        of = archives if name is None else [a for a in archives if a == name or a.rpartition("/")[2] == name]
        if len(of) == 1:
            out.setdefault(of[0], set()).add((int(entry["offset"]), int(entry["length"])))
    return {name: sorted(places) for name, places in out.items()}


def located(size: int, read_at) -> list[tuple[str, int, list[tuple[int, int]]]]:
    """(member, where it begins in the package, places of its records) of every archive of a package."""
    found = members(size, read_at)
    archives = [m for m in found if m.name.startswith("archive/") and m.name.endswith((".warc", ".warc.gz"))]
    lines: list[str] = []
    for m in found:
        if m.name.startswith("indexes/") and m.name.endswith((".cdx", ".cdxj")):
            lines += read_at(data_start(m, read_at), m.size).decode().splitlines()
    places = _indexed(lines, [m.name for m in archives])
    out = []
    for m in archives:
        start = data_start(m, read_at)
        inside = lambda offset, length, start=start: read_at(start + offset, length)
        known = places.get(m.name, [])
        out.append((m.name, start, known if _tiles(known, m.size) else _walked(m.size, inside)))
    return out


def read(packages: DataFrame, range_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """One row per record of the packages in column ``path``; without ``payloads`` only their sizes and digests."""

    def ranges(batches):
        schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("start", pa.int64()), ("offset", pa.int64()), ("lengths", pa.list_(pa.int64()))])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, at = file_system(path)
                with files.open_input_file(at) as f:
                    for name, start, places in located(f.size(), lambda offset, length: f.read_at(length, offset)):  # noqa: B023
                        first, lengths, held = 0, [], 0
                        for offset, length in places:
                            if lengths and held >= range_bytes:
                                yield pa.RecordBatch.from_pylist([{"path": path, "member": name, "start": start, "offset": first, "lengths": lengths}], schema=schema)
                                first, lengths, held = offset, [], 0
                            lengths.append(length)
                            held += length
                        if lengths:
                            yield pa.RecordBatch.from_pylist([{"path": path, "member": name, "start": start, "offset": first, "lengths": lengths}], schema=schema)

    def records(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, at = file_system(row["path"])
                with files.open_input_file(at) as f:
                    data, i, out = f.read_at(sum(row["lengths"]), row["start"] + row["offset"]), 0, []
                    for n in row["lengths"]:
                        found = parsed(data[i:i + n])
                        if not payloads:
                            found["payload"] = None
                        out.append(found | {"path": row["path"], "member": row["member"], "offset": row["offset"] + i})
                        i += n
                    yield pa.RecordBatch.from_pylist(out, schema=RECORD_SCHEMA)

    spark = packages.sparkSession
    n = shuffle_partitions(spark)
    located_ranges = packages.select("path").repartition(n).mapInArrow(ranges, "path string, member string, start long, offset long, lengths array<long>")
    return located_ranges.repartition(n, "path", "member", "offset").mapInArrow(records, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` in which a revisit has the payload, its size and its digest of the record it refers to
    (null where that is not among them)."""
    full = ["payload_bytes", "payload_digest", "payload"]
    whole = (records.where((F.col("record_type") != "revisit") & F.col("record_id").isNotNull())
             .select(F.col("record_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in full]).dropDuplicates(["__id"]))
    again = F.col("record_type") == "revisit"
    joined = records.where(again).join(whole, F.expr("refers_to = __id"), "left")
    return (records.where(~F.coalesce(again, F.lit(False)))
            .unionByName(joined.select(*[c for c in records.columns if c not in full], *[F.col(f"__{c}").alias(c) for c in full])))


def url_of(target_uri):
    """The url that ``record`` escaped."""
    return F.url_decode(F.replace(target_uri, F.lit("+"), F.lit("%2B")))


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` into a new folder of the shared one and read every record back."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-llm/{uuid.uuid4().hex}/packages"
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(.*)>$', 1) as long)")
    found = read(write(pages, folder, min_bytes), payloads=False)
    rows = resolved(stored(found.select("record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"), "records"))
    return rows.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"), url_of(F.col("target_uri")).alias("url"))

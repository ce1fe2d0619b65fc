"""Web archives packaged as ZIP files: written per task, read back by ranges without extraction.

A package holds a stored member of WARC records, each its own gzip member, and a stored index of
their places. The reader parses the ZIP's end record, its ZIP64 forms and the central directory,
finds both members, takes the records' places from the index and reads just those ranges.
"""

import gzip
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, maybe_broadcast, open_store, runs, text_of
from sunsieve.sources.shared import landed

#: Payloads from this size on are stored once.
LEAST_BYTES = 100
#: A task begins another package when one holds so many bytes.
PACKAGE_BYTES = 256 << 20
#: Records that lie together are read in ranges of about so many bytes, and tasks get about so many.
RANGE_BYTES, TASK_BYTES = 4 << 20, 32 << 20

# Names inside a package and the revisit profile of WARC 1.1.
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

# Signatures and layouts of the ZIP format.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def planned(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of every page.

    Of pages with equal payloads of at least `least` bytes the smallest page_id is the response
    and the others revisit it; rows that repeat that page_id are responses too. Null page_ids come
    last; if all are null, all are responses. Only digests are shuffled, pre-aggregated.
    """
    payload = text_of("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"))
    copies = rows.where(F.octet_length("payload") >= least).groupBy(F.col("digest").alias("same"))
    copies = copies.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    copies = landed(copies.drop("n"), "copies")
    rows = rows.join(maybe_broadcast(copies, copies.count()), F.col("digest") == F.col("same"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, first: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP header of its payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_id(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(first)}"]
    lines += [
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Package:
    """A package being written to a stream that cannot seek."""

    def __init__(self, out):
        self.out = out
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, key: str, raw: bytes) -> None:
        packed = gzip.compress(raw, 3, mtime=0)
        self.data.write(packed)
        place = {"offset": self.at, "length": len(packed), "filename": DATA.rpartition("/")[2]}
        self.index.append(f"{key} {DATE[:10].replace('-', '')}000000 {json.dumps(place)}\n")
        self.at += len(packed)

    def close(self) -> None:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("".join(sorted(self.index)).encode())
        self.zip.close()
        self.out.close()


def write_packages(plan: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write the planned records as packages into the shared `folder`; their names (`file`), landed.

    Names carry the attempt, and only packages of attempts that succeeded are named.
    """

    def step(batches: Batches) -> Batches:
        task, names, package = TaskContext.get(), [], None
        store, at = open_store(folder)
        store.create_dir(at, recursive=True)
        for batch in batches:
            for run in runs(batch, "payload"):
                for row in zip(*(c.to_pylist() for c in run.columns)):
                    if package and package.at >= package_bytes:
                        package.close()
                        package = None
                    if not package:
                        names.append(f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(names)}.wacz")
                        package = Package(store.open_output_stream(f"{at}/{names[-1]}"))
                    page, url, payload, digest, kind, first = row
                    package.add(f"page:{'' if page is None else page}", record(page, url, payload.encode(), digest, kind, first))
        if package:
            package.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    return landed(plan.mapInArrow(step, "file string"), "packages")


def members(file, size: int) -> Iterator[tuple[str, int, int, int]]:
    """(name, method, place of the data, stored size) of each member of a ZIP, from its central directory."""

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    tail_at = max(0, size - 22 - FULL16)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    count, length, start = struct.unpack("<10xHII", tail[end : end + 20])
    if FULL16 == count or FULL32 in (length, start):
        locator = tail_at + end - 20
        signature, place = struct.unpack("<4s4xQ4x", read(locator, 20))
        if signature == LOCATOR64:
            signature, count, length, start = struct.unpack("<4s28xQQQ", read(place, 56))
            if signature != END64:
                raise ValueError("broken ZIP64 end record")
    directory, at = read(start, length), 0
    for _ in range(count):
        fields = struct.unpack("<4s6xH8xIIHHH8xI", directory[at : at + 46])
        signature, method, stored, plain, n_name, n_extra, n_comment, place = fields
        if signature != CENTRAL:
            raise ValueError("broken central directory")
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        stored, place = _wide(extra, plain, stored, place)
        head = read(place, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        own_name, own_extra = struct.unpack("<26xHH", head)
        yield name, method, place + 30 + own_name + own_extra, stored
        at += 46 + n_name + n_extra + n_comment


def _wide(extra: bytes, plain: int, stored: int, place: int) -> tuple[int, int]:
    """Stored size and place, from the ZIP64 extra field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            wide = iter(struct.unpack(f"<{n // 8}Q", extra[at + 4 : at + 4 + n // 8 * 8]))
            if plain == FULL32:
                next(wide)
            stored = next(wide) if stored == FULL32 else stored
            place = next(wide) if place == FULL32 else place
        at += 4 + n
    return stored, place


def _index_lines(file, at: int, size: int) -> Iterator[bytes]:
    rest = b""
    while size:
        n = min(size, RANGE_BYTES)
        file.seek(at)
        *lines, rest = (rest + file.read(n)).split(b"\n")
        yield from lines
        at, size = at + n, size - n
    if rest:
        yield rest


def places(file, size: int) -> Iterator[tuple[int, int]]:
    """(place, length) of each WARC record in a package, from its stored index."""
    found = {name: (method, at, n) for name, method, at, n in members(file, size)}
    for name, (method, at, n) in found.items():
        if name.startswith("indexes/") and name.endswith(".cdxj"):
            if method != zipfile.ZIP_STORED:
                raise ValueError(f"{name} is compressed")
            for line in _index_lines(file, at, n):
                if line.strip():
                    entry = json.loads(line[line.index(b"{") :])
                    method, begin, _ = found[f"archive/{entry['filename']}"]
                    if method != zipfile.ZIP_STORED:
                        raise ValueError(f"archive/{entry['filename']} is compressed")
                    yield begin + int(entry["offset"]), int(entry["length"])


def parse(raw: bytes) -> dict:
    """Headers and payload of one record: page_id, record_type, refers_to, uri, digest, payload, payload_bytes."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)^content-length: *(\d+)", http, re.MULTILINE)[1])
    kind = fields["WARC-Type"]

    def page(x: str | None) -> int | None:
        number = re.fullmatch(r"<urn:page:(-?\d+)>", x or "")
        return int(number[1]) if number else None

    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "record_type": kind,
        "refers_to": page(fields.get("WARC-Refers-To")),
        "uri": fields.get("WARC-Target-URI"),
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
    }


RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("uri", pa.string()),
        ("digest", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
    ]
)


def read_packages(files: DataFrame, folder: str) -> DataFrame:
    """Every record of the named packages (`file`) in `folder`, as in `parse`; repeated names count once.

    A package without records has none. Ranges are dealt out by bytes, so neither a large package
    nor a large record group falls to one task; a task holds one range at a time.
    """

    def locate(batches: Batches) -> Batches:
        store, root = open_store(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                size = store.get_file_info(f"{root}/{name}").size
                with store.open_input_file(f"{root}/{name}") as file:
                    found = sorted(places(file, size))
                for k in range(0, len(found), 10_000):
                    at, n = zip(*found[k : k + 10_000])
                    columns = [pa.array([name] * len(at)), pa.array(at, pa.int64()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "place", "length"])

    def read(batches: Batches) -> Batches:
        store, root = open_store(folder)
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "place", "length"))))
            while rows:
                name, start, _ = rows[0]
                n = 1
                while n < len(rows) and rows[n][0] == name and sum(rows[n - 1][1:]) == rows[n][1] and rows[n][1] - start < RANGE_BYTES:
                    n += 1
                taken, rows = rows[:n], rows[n:]
                with store.open_input_file(f"{root}/{name}") as file:
                    file.seek(start)
                    held = memoryview(file.read(sum(taken[-1][1:]) - start))
                parsed = [parse(zlib.decompress(held[at - start : at - start + k], 31)) for _, at, k in taken]
                yield pa.RecordBatch.from_pylist(parsed, schema=RECORD)

    located = landed(files.select("file").distinct().mapInArrow(locate, "file string, place long, length long"), "places")
    total = located.agg(F.sum("length")).first()[0] or 0
    spread = F.floor(F.col("place") / RANGE_BYTES)
    located = located.repartition(1 + total // TASK_BYTES, "file", spread).sortWithinPartitions("file", "place")
    kinds = "page_id long, record_type string, refers_to long, uri string, digest string, payload binary, payload_bytes long"
    return located.mapInArrow(read, kinds)

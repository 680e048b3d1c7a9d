"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per capture and returns where each
one lies.  ``build_index`` sorts the captures by reversed-host URL key (and
capture id) into compressed blocks; every index file ends with a sparse
directory of the first key of each block, and the table of index files holds
the first key of each file.  ``lookup`` binary-searches the files, then the
directory, range-reads one block and searches it; ``fetch`` range-reads the
records that were found.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propmart.llm.common import OwnFile, open_input, pieces, scratch, written

MIN_REVISIT_BYTES = 1000  # smaller payloads are always stored
BLOCK_LINES = 1024  # captures in one block of the index
TRAILER = "<qq8s"  # offset and length of the directory, magic
MAGIC = b"PMCAPIX1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then port, path and query.

    ``http://a.example.net/x`` gives ``net,example,a)/x``.  A null URL or one
    without a host gives its text after ``)``; blanks and control characters
    become ``%20``.
    """
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(.*)$"
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20]", "%20")
    host = F.lower(F.regexp_extract(clean, parts, 1))
    rest = F.when(clean.rlike(parts), F.regexp_extract(clean, parts, 2)).otherwise(clean)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def classify(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages as captures: url_key, capture, payload, digest and what they refer to.

    Of equal payloads of at least ``min_bytes`` the one with the largest
    page_id is a response (all rows that repeat that id are) and the others
    revisit it; a null id is below any other, and a group without any id is
    all response.  A null html is an empty payload.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n_bytes"))
    groups = (
        rows.filter(F.col("n_bytes") >= min_bytes)
        .groupBy(F.col("digest").alias("d"))
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("kept").isNotNull())
        .select("d", "kept")
    )
    groups = written(groups, "warc-groups")
    joined = rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("n_bytes") >= min_bytes), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    return joined.select(
        url_key(F.col("url")).alias("url_key"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("capture"),
        "url",
        "digest",
        F.col("n_bytes").cast("long").alias("n_bytes"),
        refers.alias("refers_to"),
        F.when(refers.isNull(), F.col("payload")).alias("payload"),
    )


def _record(capture: str, url: str | None, digest: str, n_bytes: int, refers_to: int | None, payload: bytes | None) -> bytes:
    """One WARC record; the block is an HTTP response, of a revisit its header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"") if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{capture}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; the digest of a response is computed from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    n_bytes = int(http.decode().rpartition("Content-Length: ")[2])
    if fields["WARC-Type"] == "response":
        n_bytes, found = len(payload), hashlib.sha1(payload).hexdigest()
        if found != told:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    of = lambda name: fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else None
    page, refers = of("WARC-Record-ID"), of("WARC-Refers-To")
    return {
        "page_id": None if page == "null" else int(page),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": n_bytes,
        "payload_digest": told,
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
    }


CAPTURES = "url_key string, capture string, file string, offset long, length long, digest string"
LINE = ("url_key", "capture", "file", "offset", "length", "digest")


def write_archives(captures: DataFrame, folder: str) -> DataFrame:
    """Write the captures as WARC files into the shared ``folder``.

    One file per task, one gzip member per record.  Returns one row per
    capture (``CAPTURES``), already written.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in pieces(batches, "payload"):
            if out is None:
                out = OwnFile(folder, "captures", ".warc.gz")
            rows = []
            for r in batch.to_pylist():
                packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                member = packer.compress(_record(r["capture"], r["url"], r["digest"], r["n_bytes"], r["refers_to"], r["payload"])) + packer.flush()
                rows.append((r["url_key"], r["capture"], out.name, out.write(member), len(member), r["digest"]))
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(LINE))
        if out is not None:
            out.close()

    return written(captures.mapInArrow(write, CAPTURES), "warc-captures")


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures by (url_key, capture) into files of compressed blocks.

    A file is its blocks, then the directory (first key, offset and length of
    each block), then a trailer.  Returns one row per file (part, file,
    first_key, first_capture, n), already written.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, directory, held, total = None, [], [], 0

        def flush() -> None:
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode(), 6)
            directory.append([held[0][0], held[0][1], out.write(data), len(data)])
            held.clear()

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(LINE))), strict=True):
                out = out or OwnFile(folder, "index", ".cdx")
                held.append(row)
                total += 1
                if len(held) == block_lines:
                    flush()
        if out is not None:
            if held:
                flush()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            at = out.write(data)
            out.write(struct.pack(TRAILER, at, len(data), MAGIC))
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [out.name], "first_key": [directory[0][0]], "first_capture": [directory[0][1]], "n": pa.array([total], pa.int64())}
            )

    rows = captures.select(*LINE).repartitionByRange("url_key", "capture").sortWithinPartitions("url_key", "capture", "file", "offset")
    return written(rows.mapInArrow(write, "part int, file string, first_key string, first_capture string, n long"), "warc-index")


class IndexReader:
    """Searches one set of index files; keeps the directory and block used last."""

    def __init__(self, folder: str, files: list[tuple[str, str, str]]):
        self.folder, self.files = folder, files
        self.first = [(key, capture) for key, capture, _ in files]
        self.at = self.block_at = self.file = None
        self.directory: list = []
        self.block: list = []

    def _open(self, number: int) -> None:
        if self.at == number:
            return
        if self.file is not None:
            self.file.close()
        self.file, self.at, self.block_at = open_input(self.folder, self.files[number][2]), number, None
        size = self.file.size()
        at, length, magic = struct.unpack(TRAILER, self.file.read_at(struct.calcsize(TRAILER), size - struct.calcsize(TRAILER)))
        if magic != MAGIC:
            raise ValueError("not a complete index file")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, at)))
        self.keys = [(key, capture) for key, capture, _, _ in self.directory]

    def _load(self, number: int) -> None:
        if self.block_at != number:
            _, _, at, length = self.directory[number]
            self.block = [tuple(json.loads(x)) for x in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")]
            self.block_at = number

    def find(self, key: str, capture: str) -> Iterator[tuple]:
        """All captures of one (url_key, capture), which may pass a block's end."""
        number = bisect_right(self.first, (key, capture)) - 1
        if number < 0:
            return
        self._open(number)
        block = max(0, bisect_left(self.keys, (key, capture)) - 1)
        while block < len(self.keys) and self.keys[block] <= (key, capture):
            self._load(block)
            for row in self.block[bisect_left(self.block, (key, capture)) :]:
                if row[:2] != (key, capture):
                    break
                yield row
            block += 1


def lookup(wanted: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Captures of the rows (url_key, capture) of ``wanted``, which must be distinct.

    The driver passes one row per index file to the tasks; their number is
    that of the shuffle partitions, whatever the number of captures.  There are
    as many tasks as index files, or as cores.
    """
    files = [(r.first_key, r.first_capture, r.file) for r in index.orderBy("first_key", "first_capture").collect()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(folder, files)
        for batch in batches:
            found = [row for key, capture in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in reader.find(key, capture)]
            if found:
                types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=list(LINE))

    tasks = max(len(files), wanted.sparkSession.sparkContext.defaultParallelism)
    ordered = wanted.select("url_key", "capture").repartitionByRange(tasks, "url_key", "capture").sortWithinPartitions("url_key", "capture")
    return ordered.mapInArrow(search, CAPTURES)


FETCH_BYTES = 32 << 20  # compressed records that a task reads

RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def fetch(found: DataFrame, folder: str) -> DataFrame:
    """Range-read the records that ``lookup`` found, in the order of the archives.

    Tasks get about ``FETCH_BYTES`` of records each; left to adaptive execution,
    which sees only the small rows that name them, a few tasks would get all.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = file = None
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            rows = []
            for wanted, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if wanted != name:
                    if file is not None:
                        file.close()
                    name, file = wanted, open_input(folder, wanted)
                rows.append(parse_record(zlib.decompress(file.read_at(length, offset), 31)))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # written first: the range shuffle samples its input, and would search twice
    located = written(found, "warc-located").select("file", "offset", "length")
    n_bytes = located.agg(F.sum("length")).first()[0] or 0
    tasks = max(found.sparkSession.sparkContext.defaultParallelism, -(-n_bytes // FETCH_BYTES))
    ordered = located.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, RECORDS)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the archives and the index of all pages, then read every capture back through it."""
    folder = scratch(pages.sparkSession, "warc")
    captures = write_archives(classify(pages), folder)
    index = build_index(captures, folder)
    wanted = pages.select(
        url_key(F.col("url").cast("string")).alias("url_key"),
        F.coalesce(F.col("page_id").cast("long").cast("string"), F.lit("null")).alias("capture"),
    ).distinct()
    return fetch(lookup(wanted, index, folder), folder)

"""WARC archives: written with an index, read back by coalesced byte ranges of the index.

Every task writes its pages to a file of its own in the archive folder, one gzip member
per record, and returns an index row per record.  The index is stored before anything
is read; files of attempts that failed are in no index row and so are never read.
Files are opened through ``pyarrow.fs``, which takes the folder's URI.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.shared import forget, new_path, stored

MIN_REVISIT_BYTES = 1000
MAX_FILE_BYTES = 1 << 30
MAX_READ_BYTES = 8 << 20
MAX_GAP_BYTES = 64 << 10
CHUNK_BYTES = 16 << 20
#: Bytes of archives that one task reads.
TASK_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, url string, record_type string, digest string, file string, "
         "offset long, length long")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
_LINE_BREAKS = re.compile(r"[\r\n\x00]")


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record, uncompressed.

    The block is an HTTP response; a revisit has its headers without the payload.  Line
    breaks in a url are percent-encoded.
    """
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    identity = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{identity}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = _LINE_BREAKS.sub(lambda m: f"%{ord(m[0]):02X}", url)
        headers.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        headers += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names lower-cased) and the payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _headers(http), payload


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page(identity: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", identity or "")
    return int(found[1]) if found else None


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page in batch.to_pylist():
                    if out is None or offset > MAX_FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (page["html"] or "").encode()
                    refers_to = page["refers_to"]
                    raw = record_bytes(page["page_id"], page["url"], payload, page["digest"], refers_to)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    packed = packer.compress(raw) + packer.flush()
                    out.write(packed)
                    rows.append((
                        page["page_id"], page["url"], "response" if refers_to is None else "revisit",
                        page["digest"], name, offset, len(packed),
                    ))
                    offset += len(packed)
                yield _batch(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    return run


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields.split(", ")]
    return pa.record_batch({
        name: pa.array(list(values), kinds[kind])
        for (name, kind), values in zip((f.split(" ") for f in fields.split(", ")), columns, strict=True)
    })


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Write one record per page below ``folder``; the index ``(page_id, url, record_type,
    digest, file, offset, length)`` comes back as a stored table.

    The payload is the html in UTF-8, null counting as empty.  Of pages with equal
    payloads of at least ``min_revisit_bytes`` the one with the largest id is the
    response and the others revisit it; all other pages, and those without an id, are
    responses.  Pages that share id and payload are all responses.  No pages, no files.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    originals = rows.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("digest").agg(
        F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select(F.col("digest").alias("_digest"), "original")
    refers_to = F.when(F.col("page_id") < F.col("original"), F.col("original"))
    judged = rows.join(originals, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "html", "digest", refers_to.alias("refers_to"))
    _make_folder(folder)
    return stored(judged.mapInArrow(_writer(folder), INDEX), "warc-index")


def _make_folder(folder: str) -> None:
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)


def _ranges(places: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Neighbouring records of one file, up to the largest read, small gaps included."""
    run: list[tuple[str, int, int]] = []
    for place in places:
        file, offset, length = place
        if run and (
            file != run[0][0] or offset > run[-1][1] + run[-1][2] + MAX_GAP_BYTES
            or offset + length > run[0][1] + MAX_READ_BYTES
        ):
            yield run
            run = []
        run.append(place)
    if run:
        yield run


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            places = list(zip(*(batch[c].to_pylist() for c in ("file", "offset", "length")), strict=True))
            for wanted in _ranges(places):
                if wanted[0][0] != name:
                    name = wanted[0][0]
                    source = files.open_input_file(f"{root}/{name}")
                begin, end = wanted[0][1], wanted[-1][1] + wanted[-1][2]
                data = source.read_at(end - begin, begin)
                yield _batch([
                    _read(data[offset - begin: offset - begin + length], with_payload)
                    for _, offset, length in wanted
                ], RECORD)

    return run


def _read(packed: bytes, with_payload: bool) -> tuple:
    warc, http, payload = parse_record(zlib.decompress(packed, 31))
    stated = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = warc["warc-type"]
    if kind == "response":
        found = hashlib.sha1(payload).hexdigest()
        if found != stated:
            raise ValueError(f"payload of {warc['warc-record-id']} does not have its digest")
    return (
        _page(warc["warc-record-id"]), warc.get("warc-target-uri"), kind,
        _page(warc.get("warc-refers-to")), int(http["content-length"]), stated,
        payload if with_payload and kind == "response" else None,
    )


def read_archives(
    index: DataFrame, folder: str, wanted: Column | None = None, payload: bool = True
) -> DataFrame:
    """The records of the index rows for which ``wanted`` holds, all by default.

    Index rows go to tasks by stretches of a file and are read in the order of their
    places, neighbours in one read.  The number of tasks follows the bytes to be read, not
    the size of the index, and is at least that of the cores.  ``payload`` is null for revisits, and for all
    records where it is not asked for; digests of responses are checked in any case.
    """
    chosen = index if wanted is None else index.filter(wanted)
    stretch = F.floor(F.col("offset") / CHUNK_BYTES)
    total = chosen.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    places = chosen.select("file", "offset", "length", stretch.alias("stretch")).repartition(
        tasks, "file", "stretch").sortWithinPartitions("file", "offset")
    return places.mapInArrow(_reader(folder, payload), RECORD)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of archives
    written for ``pages`` in the shared folder and read back.

    A revisit gets size and digest of the response that it refers to.
    """
    folder = new_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    records = stored(read_archives(index, folder, payload=False).drop("payload"), "warc-records")
    forget(index)
    responses = records.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy(
        F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest")
    ).agg(F.max("payload_bytes").alias("_bytes"))
    revisits = records.filter("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    )
    columns = ["page_id", "payload_digest", "record_type", "refers_to"]
    return records.filter("record_type = 'response'").select("payload_bytes", *columns).unionByName(
        revisits.select(F.col("_bytes").alias("payload_bytes"), *columns)
    )

"""WARC archives compressed with Zstandard, one frame for each record, and their reader.

An archive is a leading skippable frame (magic 0x184D2A5D) with the dictionary, plain or itself compressed, then a
frame for each record. The reader loads the dictionary, walks the block headers of each frame to find its end, decodes
exactly one frame for each record, and checks the WARC version line, the headers, the record's length, the length and
the digest of the block, and for responses those of the payload too. Frames that can't be decoded and records that
fail a check raise an error that names the archive and the offset, or are reported as rows with `error`.

Of records with equal payloads of at least `min_bytes`, that with the largest page_id is the response and the others
are revisits that refer to it and carry only the HTTP head; the group's largest id is found by map-side maxima on the
digest, so a hot payload never meets in one task.

Archives are written by the tasks through a file-system interface that takes local and remote paths, under names that
depend on the partition alone and with the rows sorted, so a repeated attempt writes the same archives again. They are
written record by record; an archive is closed at `archive_bytes` of uncompressed records (a single longer record is
still one archive). The reader holds one archive as it is stored, and some megabytes of decoded records. The dictionary is
trained on a bounded sample (the DICT_PAGES pages of at most DICT_PAGE_BYTES bytes with the smallest hashes); archives
without one are written and read too.

Whether a row is a revisit is known only after all digests are, so the html goes through one shuffle by digest, unless
the table of repeated digests is small enough for adaptive execution to broadcast.

Defined results: a null html is an empty payload; a null page_id writes a record whose id comes from its content, reads
back as null and never is referred to; rows that tie on the largest page_id of a group are all responses; repeated rows
give a record each (responses equal in page_id and payload share a record id); control characters and spaces in urls are percent-encoded in the header; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import materialize, read_table, scratch_path

MIN_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
BATCH_BYTES, BATCH_RECORDS = 8 << 20, 1000
DICT_PAGES, DICT_PAGE_BYTES, DICT_SIZE = 400, 32_768, 65_536
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
SKIPPABLE = b"\x5d\x2a\x4d\x18"
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:page:(-?\d+)(?::[0-9a-z:-]+)?>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


class WarcError(ValueError):
    pass


def _b32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _hex(labelled: str) -> str:
    kind, _, value = labelled.partition(":")
    if kind != "sha1":
        raise WarcError(f"unknown digest {labelled!r}")
    return base64.b32decode(value).hex()


def record_id(page_id: int | None, digest: str, url: str | None, place: str = "") -> str:
    """Page, payload and, for records that none refers to, their place; so rows that share a page_id differ."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest} {url} {place}')}>"
    return f"<urn:page:{page_id}:{digest}{':' + place if place else ''}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = DATE, place: str = "") -> bytes:
    digest = hashlib.sha1(payload).hexdigest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, url, place if refers_to is not None or page_id is None else "")),
        ("WARC-Date", date),
        ("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "about:blank")),
        ("WARC-Payload-Digest", _b32(digest)),
        ("WARC-Block-Digest", _b32(hashlib.sha1(block).hexdigest())),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to, digest, None)), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, what: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"bad {what} header line {line[:80]!r}")
        out.setdefault(name.lower(), value.strip())
    return out


def parse_record(raw: bytes) -> dict:
    """A record's page_id, payload_bytes, payload_digest, record_type, refers_to, url and payload, after all checks."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"no WARC version line: {version[:40]!r}")
    h = _headers(lines, "WARC")
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in h:
            raise WarcError(f"header {need} is missing")
    if not h["content-length"].isdigit():
        raise WarcError("Content-Length is no number")
    n = int(h["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {n} doesn't fit a record with {len(rest)} bytes after its headers")
    block = rest[:n]
    if "warc-block-digest" in h and _hex(h["warc-block-digest"]) != hashlib.sha1(block).hexdigest():
        raise WarcError("the block's digest differs")
    kind = h["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"record type {kind!r}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise WarcError("the block is no HTTP response")
    size = int(_headers(lines, "HTTP").get("content-length", "-1"))
    digest = _hex(h["warc-payload-digest"]) if "warc-payload-digest" in h else hashlib.sha1(payload).hexdigest()
    if kind == "response" and (size not in (-1, len(payload)) or hashlib.sha1(payload).hexdigest() != digest):
        raise WarcError("the payload's length or digest differs")
    if kind == "revisit" and (payload or "warc-refers-to" not in h or size < 0):
        raise WarcError("a revisit needs WARC-Refers-To, the payload's length and no payload")
    own, to = _ID.fullmatch(h["warc-record-id"]), _ID.fullmatch(h.get("warc-refers-to", ""))
    return {
        "page_id": int(own[1]) if own else None, "payload_bytes": size if kind == "revisit" else len(payload),
        "payload_digest": digest, "record_type": kind, "refers_to": int(to[1]) if to else None,
        "url": h.get("warc-target-uri"), "payload": payload if kind == "response" else None,
    }


def dictionary_frame(dictionary: bytes, compress: bool = True) -> bytes:
    body = zstandard.ZstdCompressor(level=9).compress(dictionary) if compress else dictionary
    return SKIPPABLE + len(body).to_bytes(4, "little") + body


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts here ends: its header, its blocks by their headers, its checksum."""
    if bytes(data[at : at + 4]) != ZSTD_MAGIC:
        raise WarcError("no Zstandard frame")
    try:
        p = zstandard.get_frame_parameters(data[at : at + 18])
        end = at + zstandard.frame_header_size(data[at : at + 18])
    except zstandard.ZstdError as e:
        raise WarcError(f"bad frame header: {e}") from e
    last = False
    while not last:
        if end + 3 > len(data):
            raise WarcError("the frame is cut off")
        head = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3:
            raise WarcError("reserved block type")
        end += 3 + (1 if kind == 1 else size)
    end += 4 if p.has_checksum else 0
    if end > len(data):
        raise WarcError("the frame is cut off")
    return end


def read_archive(raw: bytes, on_error: str = "raise") -> Iterator[dict]:
    data, at, reader = memoryview(raw), 0, zstandard.ZstdDecompressor()
    if bytes(data[:4]) == SKIPPABLE:
        at = 8 + int.from_bytes(data[4:8], "little")
        if at > len(data):
            raise WarcError("the dictionary frame is cut off")
        body = bytes(data[8:at])
        if body[:4] == ZSTD_MAGIC:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        if body:
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
    while at < len(data):
        start = at
        try:
            if 0x184D2A50 <= int.from_bytes(data[at : at + 4], "little") <= 0x184D2A5F:
                at += 8 + int.from_bytes(data[at + 4 : at + 8], "little")
                continue
            end = frame_end(data, at)
            try:
                record = reader.decompressobj().decompress(data[at:end])
            except zstandard.ZstdError as e:
                at = end
                raise WarcError(f"the frame can't be decoded: {e}") from e
            at = end
            yield parse_record(record) | {"error": None}
        except (WarcError, ValueError) as e:
            if on_error == "raise":
                raise WarcError(f"at byte {start}: {e}") from e
            none = dict.fromkeys(("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"))
            yield none | {"error": f"at byte {start}: {e}"}
            if at == start:  # the frame's end is unknown
                return


def train_dictionary(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> bytes:
    """From DICT_PAGES pages with small hashes of id, url and length, so reruns train on the same ones.

    Pages are drawn by a threshold on the hash that lets about twice as many through, so the driver gets that many at most,
    whatever the number of partitions; rows with the same hash count once.
    """
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(url_col).cast("string"), F.octet_length(F.col(html_col).cast("string")))
    sample = pages.select(F.pmod(key, F.lit(1 << 40)).alias("k"), F.col(html_col).cast("string").alias("h")).where(F.octet_length("h").between(64, DICT_PAGE_BYTES))
    below = (2 * DICT_PAGES << 40) // max(1, sample.count())
    drawn = sample.where(F.col("k") < below).groupBy("k").agg(F.min("h").alias("h")).orderBy("k")
    texts = [r.h.encode() for r in drawn.limit(DICT_PAGES).collect()]
    records = [make_record(i, "https://www.example.org/", t) for i, t in enumerate(texts)]
    try:
        return zstandard.train_dictionary(DICT_SIZE, records).as_bytes() if len(records) >= 8 else b""
    except zstandard.ZstdError:  # too little to train on
        return b""


def planned_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, refers_to of every record to write."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    pages = pages.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    groups = pages.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    groups = materialize(groups.where("n > 1 and first is not null").drop("n"), "payloads")
    own = F.col("first").isNull() | F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    joined = pages.join(groups, "digest", "left")
    return joined.select("page_id", "url", "html", F.when(~own, F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, dictionary: bytes = b"", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives now; returns the list of them: path, records, bytes."""
    lead = dictionary_frame(dictionary) if dictionary else b""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        at = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        how = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True, **how)
        out, size, records, written, total, done = None, 0, 0, 0, 0, []

        def close() -> None:
            out.close()
            name = f"{root}/part-{at.partitionId():06d}-{len(done):05d}.warc.zst"
            store.move(f"{root}/_{at.taskAttemptId()}-{len(done)}", name)
            done.append((name, records, written))

        for b in batches:
            for page_id, url, html, refers_to in zip(*b.columns, strict=True):
                record = make_record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py(), place=f"{at.partitionId()}-{total}")
                if out is not None and size + len(record) > archive_bytes:
                    close()
                    out, size, records, written = None, 0, 0, 0
                if out is None:
                    out = store.open_output_stream(f"{root}/_{at.taskAttemptId()}-{len(done)}")
                    written = out.write(lead)
                written += out.write(packer.compress(record))
                size, records, total = size + len(record), records + 1, total + 1
        if out is not None:
            close()
        paths, counts, sizes = zip(*done, strict=True) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"]
        )

    ordered = records.select("page_id", "url", "html", "refers_to").sortWithinPartitions("page_id", "url", "html")
    return materialize(ordered.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(spark: SparkSession, path: str, on_error: str = "raise", payloads: bool = True) -> DataFrame:
    """Every record of the archives below a path."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "error"] + ["payload"] * payloads
    kinds = dict(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()], strict=False))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, held = [], 0
                try:
                    for r in read_archive(content.as_py(), on_error):
                        rows.append(r)
                        held += len(r["payload"] or b"")
                        if held >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in kinds.items()], names)
                            rows, held = [], 0
                except WarcError as e:
                    raise WarcError(f"{where}: {e}") from e
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in kinds.items()], names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, error string"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, schema + ", payload binary" * payloads)


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    manifest = write_archives(planned_records(pages), folder, train_dictionary(pages))
    found = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_archives(spark, folder, payloads=False).select(*found)


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest FROM p),
g AS (SELECT digest, max(page_id) AS first FROM d WHERE n >= 1000 GROUP BY digest HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN g.first IS NULL OR g.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.first IS NULL OR g.first = page_id THEN NULL ELSE g.first END AS refers_to
FROM d LEFT JOIN g USING (digest)
"""

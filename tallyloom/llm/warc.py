"""WARC archives and a two-level capture index (operator 2).

Pages become compressed WARC/1.1 records, one gzip member each. The index has one line a
capture, sorted by a key with the host reversed, in compressed blocks; the directory has
one row a block. A lookup searches the directory, reads the range of a block, searches
that, and reads the range of a record.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import BoundedMemo, read_range, shared_folder, write_whole
from tallyloom.session import checked_broadcast, stage

LEAST_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32_000_000
LINES_PER_BLOCK = 3000
MOST_BROADCAST_GROUPS = 500_000
#: Blocks of a directory that a lookup takes to the driver; of a longer one it filters the blocks first.
MOST_DIRECTORY_ROWS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
URN = "urn:page:"


def written_url(url: str) -> str:
    """The URL with white space, controls and other characters that a header can't hold percent-encoded."""
    return quote(url.strip(), safe="!#$%&()*+,/:;=?@[]~'", errors="surrogatepass")


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query``: host labels reversed and lower-cased, without scheme, port 80 or 443, and fragment.

    What isn't a URL with a host is its own key; none is the empty key.
    """
    url = written_url(url or "")
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = port = None
    if not host:
        return url
    labels = ",".join(reversed(host.rstrip(".").split(".")))
    at = f":{port}" if port not in (None, 80, 443) else ""
    return f"{labels}{at}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def compressed(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{URN}{'' if page is None else page}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {written_url(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}


def parse(data: bytes) -> tuple[dict, bytes | None]:
    """What the index needs of a record, and its payload (None for a revisit). A payload that differs from its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    told = fields(head)
    http, _, payload = rest[: int(told["content-length"])].partition(b"\r\n\r\n")
    digest, page = told["warc-payload-digest"].removeprefix("sha1:"), told["warc-record-id"][1 + len(URN) : -1]
    refers = told.get("warc-refers-to")
    if refers is None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {told['warc-record-id']} differs from its digest")
    found = {
        "page_id": int(page) if page else None, "url": told.get("warc-target-uri"), "payload_bytes": int(fields(http)["content-length"]),
        "payload_digest": digest, "record_type": told["warc-type"], "refers_to": int(refers[1 + len(URN) : -1]) if refers else None,
    }
    return found, payload if refers is None else None


def members(data: bytes):
    """Start, length and content of each gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        open_member, parts, stop = zlib.decompressobj(31), [], at
        while not open_member.eof and stop < len(data):  # in pieces, so that little is left over after a member
            parts.append(open_member.decompress(view[stop : stop + 16_384]))
            stop = min(stop + 16_384, len(data))
        length = stop - at - len(open_member.unused_data)
        yield at, length, b"".join(parts)
        at += length


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every row of ``page_id, url, html`` and return the archives (``uri, records``).

    A null html is empty. Of records with equal payloads of at least 1000 bytes, that
    with the largest page_id is a response and the others revisit it; rows that repeat
    its page_id are responses too, and without any page_id all are. The pages are read
    twice and don't move, unless there are too many groups of equal payloads to broadcast.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= LEAST_REVISIT_BYTES)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first")
    joined = rows.join(checked_broadcast(groups, MOST_BROADCAST_GROUPS), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    joined = joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def write(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            uri = write_whole(folder, f"pages-{part:06d}-{number:04d}.warc.gz", b"".join(held))
            return pa.record_batch({"uri": pa.array([uri]), "records": pa.array([len(held)], pa.int64())})

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))
            for row in zip(*columns):
                held.append(compressed(record(*row)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    return stage(joined.mapInArrow(write, "uri string, records long"))


CAPTURE = pa.schema([
    ("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
])
#: A line of the index also says where the payload of a revisit is; null for a response.
LINE = pa.schema([*CAPTURE, ("payload_archive", pa.string()), ("payload_start", pa.int64()), ("payload_length", pa.int64())])
CAPTURE_COLUMNS = "key string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, start long, length long"
LINE_COLUMNS = f"{CAPTURE_COLUMNS}, payload_archive string, payload_start long, payload_length long"


def read_archives(archives: DataFrame) -> DataFrame:
    """A capture for every record of the archives, its payload checked against its digest."""

    def read(batches):
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                found = []
                for start, length, data in members(read_range(uri)):
                    row, _ = parse(data)
                    found.append(row | {"key": url_key(row["url"]), "archive": uri, "start": start, "length": length})
                yield pa.RecordBatch.from_pylist(found, CAPTURE)

    spread = archives.select("uri").repartition(4 * archives.sparkSession.sparkContext.defaultParallelism, "uri")
    # Staged, as sorting by ranges reads its input twice.
    return stage(spread.mapInArrow(read, CAPTURE_COLUMNS))


def with_payload_places(captures: DataFrame) -> DataFrame:
    """The captures, a revisit with the archive, start and length of a response of its payload.

    The captures don't move, unless there are too many groups of equal payloads to broadcast.
    """
    groups = captures.where("record_type = 'revisit'").select("payload_digest").distinct()
    responses = captures.where("record_type = 'response'").join(checked_broadcast(groups, MOST_BROADCAST_GROUPS), "payload_digest", "left_semi")
    place = F.struct("archive", "start", "length")
    places = responses.groupBy("payload_digest").agg(F.min(place).alias("_place")).withColumnRenamed("payload_digest", "_digest")
    same = (F.col("record_type") == "revisit") & (F.col("payload_digest") == F.col("_digest"))
    joined = captures.join(checked_broadcast(places, MOST_BROADCAST_GROUPS), same, "left")
    return joined.select(*captures.columns, *[F.col(f"_place.{c}").alias(f"payload_{c}") for c in ("archive", "start", "length")])


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sort the captures by key into compressed blocks; return the directory: ``first_key, last_key, uri, start, length, lines``, a row a block."""
    ordered = with_payload_places(captures).repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "archive", "start")

    def write(batches):
        part, number, lines, keys, blocks, rows, size = TaskContext.get().partitionId(), 0, [], [], [], [], 0

        def close_block():
            blocks.append(zlib.compress("\n".join(lines).encode()))
            rows.append({"first_key": keys[0], "last_key": keys[-1], "start": size, "length": len(blocks[-1]), "lines": len(lines)})

        def flush():
            uri = write_whole(folder, f"index-{part:06d}-{number:04d}", b"".join(blocks))
            return pa.RecordBatch.from_pylist([r | {"uri": uri} for r in rows], made)

        for batch in batches:
            for row in batch.to_pylist():
                keys.append(row.pop("key"))
                lines.append(f"{keys[-1]}\t{json.dumps(row)}")
                if len(lines) == LINES_PER_BLOCK:
                    close_block()
                    size, lines, keys = size + len(blocks[-1]), [], []
                    if size >= ARCHIVE_BYTES:
                        yield flush()
                        number, blocks, rows, size = number + 1, [], [], 0
        if lines:
            close_block()
        if blocks:
            yield flush()

    made = pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("uri", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("lines", pa.int64())])
    return stage(ordered.mapInArrow(write, "first_key string, last_key string, uri string, start long, length long, lines long"))


def block_lines(uri: str, start: int, length: int) -> list[tuple[str, str]]:
    """Key and JSON of each line of a block."""
    text = zlib.decompress(read_range(uri, start, length)).decode()
    return [tuple(line.split("\t", 1)) for line in text.split("\n")]


def scan_index(directory: DataFrame) -> DataFrame:
    """All captures, from the blocks that the directory lists."""

    def scan(batches):
        for batch in batches:
            for uri, start, length in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "length"))):
                yield pa.RecordBatch.from_pylist([json.loads(text) | {"key": key} for key, text in block_lines(uri, start, length)], LINE)

    spread = directory.select("uri", "start", "length").repartition(4 * directory.sparkSession.sparkContext.defaultParallelism, "uri", "start")
    return spread.mapInArrow(scan, LINE_COLUMNS)


def lookup(directory: DataFrame, urls: list[str]) -> list[dict]:
    """The captures of each URL, with their payloads; a revisit has that of its response.

    The directory is searched for the blocks that may hold a key, each block is read and
    searched, and each record that holds a payload is read, by ranges. Of a directory too long for the driver
    only the rows of wanted keys are taken.
    """
    keys = sorted({url_key(u) for u in urls})
    if directory.count() > MOST_DIRECTORY_ROWS:
        wanted = directory.sparkSession.createDataFrame([(k,) for k in keys], "k string")
        near = (F.col("first_key") <= F.col("k")) & (F.col("k") <= F.col("last_key"))
        directory = directory.join(F.broadcast(wanted), near, "left_semi")
    blocks = sorted((r["first_key"], r["last_key"], r["uri"], r["start"], r["length"]) for r in directory.collect())
    firsts, lasts = [b[0] for b in blocks], [b[1] for b in blocks]
    read = BoundedMemo(lambda b: block_lines(*b), 100)
    out = []
    for key in keys:
        for block in blocks[bisect_left(lasts, key) : bisect_right(firsts, key)]:
            lines = read[block[2:]]
            held = [k for k, _ in lines]
            out += [json.loads(text) | {"key": key} for _, text in lines[bisect_left(held, key) : bisect_right(held, key)]]
    for row in out:
        place = ("archive", "start", "length") if row["payload_archive"] is None else ("payload_archive", "payload_start", "payload_length")
        _, row["payload"] = parse(zlib.decompress(read_range(*(row[c] for c in place)), 31))
    return out


def op2_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), shared_folder(spark, "warc"))
    directory = write_index(read_archives(archives), shared_folder(spark, "index"))
    return scan_index(directory).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Digests are of the UTF-8 bytes.
SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
    SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""

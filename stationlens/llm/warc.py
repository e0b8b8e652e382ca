"""WARC archives written from, and read into, a chunked record table.

A payload is never one value on the way: the table has a row per record identifier and chunk
number, cut inside the JVM, and each row carries the digest of its record up to and including
that chunk. So a task holds one chunk at a time whatever the payload's size, the last chunk's
digest is the payload's, and a reader sees at which chunk a damaged record departs.

Records of equal payloads of at least ``min_bytes`` are written once: the one of smallest id is a
``response``, the others are ``revisit`` records without payload that refer to it. Files hold one
gzip member per record and roll over at ``roll_bytes``; they lie in the shared folder and are
reached by ``pyarrow.fs``, so its scheme must be one that this library knows. A task that is run
again writes files of new names, and only files that the manifest lists are read.

Defined cases: a null or empty payload is one empty chunk; a null url leaves the target header
out; rows that repeat an id are records of their own, of which the first row of the smallest id
is the response; a null id is written as an empty one, sorts last and is read back as null; other
columns are not carried; an empty table gives an empty archive and no rows.
"""

import gzip
import hashlib
import io
import urllib.parse
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.scratch import Scratch

CHUNK_BYTES = 256 << 10
ROLL_BYTES = 256 << 20
MIN_BYTES = 100
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record_no long, page_id string, url string, chunk_no int, last boolean, data binary, end_offset long, running_digest string"
READ = "file string, record_id string, record_type string, page_id string, url string, refers_to_id string, declared_digest string, chunk_no int, last boolean, data binary, end_offset long, running_digest string, intact boolean"
LINE_LIMIT = 1 << 20


def _digests(batches):
    """Append offset and running digest to chunk rows that come record by record, chunks in order."""
    sha, size = hashlib.sha256(), 0
    for b in batches:
        ends, digests, data = [], [], b.column("data")
        for i, no in enumerate(b.column("chunk_no").to_pylist()):
            if no == 0:
                sha, size = hashlib.sha256(), 0
            piece = data[i].as_buffer()
            sha.update(piece)
            size += piece.size
            ends.append(size)
            digests.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.int64()), pa.array(digests, pa.string())], [*b.schema.names, "end_offset", "running_digest"])


def chunk_table(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per record and chunk of the payload's bytes, with the digest so far."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("record_no"), F.col(f"`{key}`").cast("string").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("raw"),
    )
    last = F.greatest(F.lit(0), F.ceil(F.octet_length("raw") / F.lit(chunk_bytes)).cast("int") - 1)
    cut = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    cut = cut.select("record_no", "page_id", "url", "chunk_no", (F.col("chunk_no") == last).alias("last"), F.expr(f"substring(raw, chunk_no * {chunk_bytes} + 1, {chunk_bytes})").alias("data"))
    return cut.mapInArrow(_digests, CHUNKS)


def classify(chunks: DataFrame, min_bytes: int = MIN_BYTES, id_type: str = "long") -> DataFrame:
    """(record_no, payload_bytes, digest, refers_to_no, refers_to_id): per record, the last two null for a response.

    Records meet the first of their payload by an inner join on the digest, whose hot keys
    adaptive execution splits; the firsts are aggregated before the shuffle.
    """
    records = chunks.filter("last").select("record_no", "page_id", F.col("end_offset").alias("payload_bytes"), F.col("running_digest").alias("digest"))
    key = F.col("page_id").cast(id_type)
    order = F.struct(key.isNull().alias("none"), key.alias("key"), "record_no", "page_id")
    firsts = records.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = records.filter(F.col("payload_bytes") >= min_bytes).select("record_no", "digest").join(firsts, "digest").filter(F.col("record_no") != F.col("first.record_no"))
    again = again.select("record_no", F.col("first.record_no").alias("refers_to_no"), F.col("first.page_id").alias("refers_to_id"))
    return records.drop("page_id").join(again, "record_no", "left")


def record_id(page_id, record_no) -> str:
    """The URI of a record: the page's id and the number of its row."""
    return f"<urn:page:{urllib.parse.quote(page_id or '', safe='')}:{record_no}:{int(page_id is not None)}>"


def page_of(uri: str):
    """The page id inside a record's URI; null for records of other writers."""
    part = uri[1:-1].split(":")
    return urllib.parse.unquote(part[2]) if len(part) == 5 and part[:2] == ["urn", "page"] and part[4] == "1" else None


def _head(row) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["refers_to_no"] is not None
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(row["page_id"], row["record_no"]),
        "WARC-Target-URI": None if row["url"] is None else urllib.parse.quote(row["url"], safe="".join(map(chr, range(33, 127)))),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": "sha256:" + row["digest"],
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": record_id(row["refers_to_id"], row["refers_to_no"]) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(http) + (0 if revisit else row["payload_bytes"]),
    }
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None).encode() + b"\r\n" + http


def _writer(folder: str, roll_bytes: int):
    """Write rows that come record by record, and name each finished file."""

    def write(batches):
        store, root = pa.fs.FileSystem.from_uri(folder)
        out = path = pack = None
        n, names = 0, ["record_no", "page_id", "url", "payload_bytes", "digest", "refers_to_no", "refers_to_id", "chunk_no", "last"]

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

        for b in batches:
            data = b.column("data")
            for i, row in enumerate(b.select(names).to_pylist()):
                if row["chunk_no"] == 0:
                    if out is not None and out.tell() >= roll_bytes:
                        yield done()
                        out, n = None, 0
                    if out is None:
                        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{path.rsplit('/', 1)[1]}", compression=None)
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(pack.compress(_head(row)))
                if row["refers_to_no"] is None:
                    out.write(pack.compress(data[i].as_buffer()))
                if row["last"] or row["refers_to_no"] is not None:
                    out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                    n += 1
        if out is not None:
            yield done()

    return write


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html", url: str = "url", min_bytes: int = MIN_BYTES, chunk_bytes: int = CHUNK_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row to ``folder``; returns the manifest (path, n_records)."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    id_type = dict(pages.dtypes)[key]
    chunks = scratch.put("chunks", chunk_table(pages, key, payload, url, chunk_bytes))
    kinds = scratch.put("kinds", classify(chunks, min_bytes, id_type))
    rows = chunks.drop("end_offset", "running_digest").join(kinds, "record_no").filter("refers_to_no is null or chunk_no = 0")
    files = rows.sortWithinPartitions("record_no", "chunk_no").mapInArrow(_writer(folder, roll_bytes), "path string, n_records long")
    manifest = scratch.put("manifest", files)
    scratch.drop(chunks, kinds)
    return manifest


def _fields(f, limit: int = LINE_LIMIT) -> dict:
    """Named fields up to the empty line, names lowered."""
    found = {}
    while (line := f.readline(limit)) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _records(f, chunk_bytes: int):
    """(fields, payload pieces) of each record of an open archive; pieces must be taken in turn."""
    while line := f.readline(LINE_LIMIT):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not at the start of a record")
        fields = _fields(f)
        left = int(fields["content-length"])

        def payload():
            nonlocal left
            if fields.get("content-type", "").startswith("application/http"):
                while left > 0:
                    line = f.readline(min(left, LINE_LIMIT))
                    left -= len(line)
                    if line in (b"\r\n", b"\n", b""):
                        break
            while left > 0:
                piece = f.read(min(left, chunk_bytes))
                if not piece:
                    raise ValueError("record ends before its length")
                left -= len(piece)
                yield piece

        yield fields, payload()


def _reader(chunk_bytes: int, data: bool):
    names = [c.split()[0] for c in READ.split(", ")]
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]) for n, c in zip(names, READ.split(", "))])

    def read(batches):
        rows, held = [], 0
        for b in batches:
            for path in b.column("path").to_pylist():
                store, at = pa.fs.FileSystem.from_uri(path)
                with store.open_input_stream(at, compression=None) as raw:
                    f = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw)
                    for fields, pieces in _records(f, chunk_bytes):
                        sha, size, uri = hashlib.sha256(), 0, fields.get("warc-record-id", "")
                        declared = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        about = (path, uri, fields.get("warc-type"), page_of(uri), fields.get("warc-target-uri"), fields.get("warc-refers-to"), declared)
                        piece, no = next(pieces, b""), 0
                        while True:
                            following = next(pieces, None)
                            sha.update(piece)
                            size += len(piece)
                            last = following is None
                            if data or last:
                                so_far = sha.hexdigest()
                                rows.append((*about, no, last, piece if data else None, size, so_far, declared is None or about[2] == "revisit" or so_far == declared if last else None))
                                held += len(piece) if data else 200
                            if held >= 8 << 20 or len(rows) >= 10_000:
                                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                                rows, held = [], 0
                            if last:
                                break
                            piece, no = following, no + 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return read


def read_archives(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, data: bool = True) -> DataFrame:
    """Chunk rows of all records of the archives in ``path``; without ``data`` the last row of each record.

    Files are dealt out one by one. ``intact`` tells on a record's last row whether what was read
    has the digest its header declares (a revisit has no payload to compare).
    """
    n = max(1, files.count())
    return files.select("path").repartition(n).mapInArrow(_reader(chunk_bytes, data), READ)


def archived_records(last_rows: DataFrame, id_type: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record; revisits take theirs from the record they refer to."""
    r = last_rows.select("record_id", "record_type", F.col("page_id").cast(id_type).alias("page_id"), "refers_to_id", F.col("end_offset").alias("payload_bytes"), F.col("running_digest").alias("payload_digest"))
    seen = r.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    again = r.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to_id").join(seen, "refers_to_id", "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return r.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast(id_type)).select(*out).unionByName(again.select(*out))


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str = None) -> DataFrame:
    """Archive ``pages`` below the shared folder, read the files back and describe each record."""
    scratch = Scratch(spark, "warc")
    manifest = write_archives(pages, folder or scratch.path("archives"))
    index = scratch.put("index", read_archives(manifest, data=False))
    return archived_records(index, dict(pages.dtypes)["page_id"])


def round_trip_sql(min_bytes: int = MIN_BYTES) -> str:
    """Check SQL of the query over ``pages``."""
    return f"""
    WITH r AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, CASE WHEN payload_bytes >= {min_bytes} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM r)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN first_id <> page_id THEN first_id END AS refers_to FROM f"""

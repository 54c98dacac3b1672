"""WARC archives written and read by Spark tasks, with a chunked record table.

Tasks write gzip members, one per record, to archives in the shared folder and return only a
manifest. Reading streams an archive and gives rows of record and chunk number with the
digest so far, so that neither side holds more than a chunk of a payload it need not hold.
Only archives a committed manifest names are read: what a lost or repeated task left behind is
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import hadoop_path
from .common import bitmap, marked, released, settled, shared_dir, ship

#: Payloads of fewer bytes are never stored as revisits.
REVISIT_BYTES = 1_000
#: Bytes per chunk row.
CHUNK = 1 << 16
EOL = b"\r\n"


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = REVISIT_BYTES,
) -> DataFrame:
    """Pages with ``payload`` (binary), ``record_type`` and ``refers_to``.

    Of equal payloads of at least ``least`` bytes the one with the largest id is the response
    and the others revisit it. Null payloads are empty. Digests are compared before payloads
    move: a bitmap of those that occur twice tells which rows meet them again.
    """
    rows = pages.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("_payload"),
    )
    big = F.octet_length("_payload") >= least
    again = settled(
        rows.where(big).select("_id", F.sha1("_payload").alias("_sha"))
        .groupBy("_sha")
        .agg(F.max("_id").alias("_response"), F.count(F.lit(1)).alias("_k"))
        .where("_k > 1")
        .drop("_k")
    )
    # a payload moves only if its digest may have come twice; small ones and all others stay
    keyed = rows.withColumn("_sha", F.when(big, F.sha1("_payload")))
    near = marked(keyed, F.col("_sha"), bitmap(again, "_sha"), "_may")
    hit = near.where(F.col("_may") & F.col("_sha").isNotNull()).join(again, "_sha", "left")
    alone = near.where(~F.col("_may") | F.col("_sha").isNull()).withColumn("_response", F.lit(None).cast(again.schema["_response"].dataType))
    met = alone.unionByName(hit)
    revisit = F.col("_response").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_response"))
    return met.select(
        "_id", "_url", F.when(~revisit, F.col("_payload")).alias("_payload"),
        F.octet_length("_payload").cast("bigint").alias("_n"), F.sha1("_payload").alias("_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("_type"),
        F.when(revisit, F.col("_response")).alias("_refers"),
    )


def _urn(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page}')}>"


def _head(row: dict) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["_digest"])).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {row['_type']}", f"WARC-Record-ID: {_urn(row['_id'])}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        # a line break in a URL must not become a header of its own
        "WARC-Target-URI: " + row["_url"].replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {'' if row['_id'] is None else row['_id']}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if row["_type"] == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_urn(row['_refers'])}", f"X-Refers-To-Page: {row['_refers']}",
        ]
    length = 0 if row["_type"] == "revisit" else row["_n"]
    return "\r\n".join([*lines, f"Content-Length: {length}"]).encode("utf-8") + EOL + EOL


def _writer(folder: str, chunk: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path, out, records = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            payloads = batch.column("_payload")
            heads = batch.drop_columns(["_payload"]).to_pylist()
            for k, row in enumerate(heads):
                out = out or store.open_output_stream(path, compression=None)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(member.compress(_head(row)))
                body = payloads[k].as_buffer()  # a view, not a copy
                for at in range(0, body.size if body is not None else 0, chunk):
                    out.write(member.compress(body.slice(at, min(chunk, body.size - at))))
                out.write(member.compress(EOL + EOL) + member.flush())
                records += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [path], "records": [records]})

    return released(run)


def write_archives(records: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """Writes the records of :func:`plan_records`; returns the settled manifest ``archive, records``."""
    return settled(records.mapInArrow(_writer(folder, chunk), "archive string, records bigint"))


class _Stream:
    """Bytes of a file of gzip members, a piece at a time."""

    def __init__(self, source, chunk: int):
        self.source, self.chunk, self.raw, self.ready = source, chunk, b"", b""
        self.member = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.member.eof:
                self.raw, self.member = self.member.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(self.chunk)
                if not self.raw:
                    return False
            data = self.member.decompress(self.raw, self.chunk)
            self.raw = b"" if self.member.eof else self.member.unconsumed_tail
            if data:
                self.ready += data
                return True

    def line(self) -> bytes | None:
        while (cut := self.ready.find(EOL)) < 0:
            if not self.more():
                return None
        line, self.ready = self.ready[:cut], self.ready[cut + 2 :]
        return line

    def take(self, most: int) -> bytes:
        if not self.ready and not self.more():
            raise ValueError("archive ends inside a record")
        piece, self.ready = self.ready[:most], self.ready[most:]
        return piece


CHUNK_SHAPE = (
    "record string, page_id bigint, record_type string, refers_to bigint, header_digest string, chunk_no int, "
    "offset bigint, bytes int, data binary, digest_so_far string, last boolean"
)


def _reader(folder: str, chunk: int, with_data: bool) -> Callable:
    def records(path: str, store) -> Iterator[tuple]:
        with store.open_input_stream(path, compression=None) as source:
            stream, place = _Stream(source, chunk), 0
            while (line := stream.line()) is not None:
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"no record where one should begin in {path}")
                head = {}
                while line := stream.line():
                    name, _, value = line.decode("utf-8").partition(": ")
                    head[name] = value
                left, number, offset, sha = int(head["Content-Length"]), 0, 0, hashlib.sha1()
                fixed = (
                    f"{path.rpartition('/')[2]}#{place}", int(head["X-Page-ID"]) if head["X-Page-ID"] else None, head["WARC-Type"],
                    int(head["X-Refers-To-Page"]) if "X-Refers-To-Page" in head else None,
                    base64.b32decode(head["WARC-Payload-Digest"][5:]).hex(),
                )
                while True:
                    data = stream.take(min(left, chunk)) if left else b""
                    sha.update(data)
                    left -= len(data)
                    yield (*fixed, number, offset, len(data), data if with_data else None, sha.hexdigest(), not left)
                    number, offset = number + 1, offset + len(data)
                    if not left:
                        break
                place += 1
                if stream.line() != b"" or stream.line() != b"":
                    raise ValueError(f"a record of {path} does not end as its length says")

    names = [part.split()[0] for part in CHUNK_SHAPE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["archive"]:
                rows, held = [], 0
                for row in records(path, store):
                    rows.append(row)
                    held += len(row[8] or b"") + 200
                    if held >= 16 * chunk:
                        yield framed(rows)
                        rows, held = [], 0
                if rows:
                    yield framed(rows)

    def framed(rows: list[tuple]) -> pd.DataFrame:
        # as objects first: ids beyond 53 bits must not pass through floats
        frame = pd.DataFrame(rows, columns=names, dtype=object)
        return frame.astype({"page_id": "Int64", "refers_to": "Int64", "chunk_no": "int32", "offset": "int64", "bytes": "int32", "last": "bool"})

    return released(run)


def read_chunks(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The record table: a row per record and chunk, numbered from 0.

    ``record`` names a record by its archive and place, as page ids may repeat. ``digest_so_far`` is the SHA-1 of the payload up to and including the chunk, so the
    ``last`` row holds that of all. Empty payloads and revisits have one row without bytes.
    ``with_data=False`` leaves the bytes themselves out.
    """
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "archive").mapInPandas(_reader(folder, chunk, with_data), CHUNK_SHAPE)


def qualified(spark, folder: str) -> str:
    """The folder with the scheme that Spark would read it by: that of its default file system."""
    where, files = hadoop_path(spark, folder)
    uri = where.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    folder: str | None = None, least: int = REVISIT_BYTES, chunk: int = CHUNK,
) -> DataFrame:
    """Writes all pages, reads the archives back, and describes each record as read.

    Archives go to ``folder`` and stay there; without one they are removed once they have been read.
    Returns id, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``. A digest read
    that differs from its header raises. Null html is an empty payload; an empty payload is a
    response. Rows that repeat an id get a record each, and one that shares the largest id of its
    group is a response too. A null id only refers or is referred to as null. No pages, no rows.
    """
    ship(pages.sparkSession)
    kept = folder is not None
    uri = qualified(pages.sparkSession, folder or shared_dir(pages.sparkSession))
    manifest = write_archives(plan_records(pages, id_col, url_col, html_col, least), uri, chunk)
    chunks = read_chunks(manifest, uri, chunk, with_data=False)
    # the record table folded back: all chunks' bytes, and the digest after the last of them
    last = settled(
        chunks.groupBy("record").agg(
            *[F.any_value(c).alias(c) for c in ("page_id", "record_type", "refers_to", "header_digest")],
            F.sum(F.col("bytes").cast("bigint")).alias("_n"), F.max_by("digest_so_far", "chunk_no").alias("digest_so_far"),
        )
    )
    if not kept:
        where, files = hadoop_path(pages.sparkSession, uri)
        files.delete(where, True)
    responses = last.where("record_type = 'response'")
    wrong = F.raise_error(F.concat(F.lit("digest of page "), F.col("page_id").cast("string"), F.lit(" differs")))
    whole = responses.select(
        "page_id", F.col("_n").alias("payload_bytes"),
        F.when(F.col("digest_so_far") == F.col("header_digest"), F.col("digest_so_far")).otherwise(wrong).alias("payload_digest"),
        "record_type", "refers_to",
    )
    # responses that someone refers to, once each; revisits take length and digest from them
    targets = whole.select(F.col("page_id").alias("_to"), "payload_bytes", "payload_digest")
    revisits = last.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "header_digest")
    targets = targets.groupBy("_to", "payload_digest").agg(F.first("payload_bytes").alias("payload_bytes"))
    same = (F.col("refers_to") == F.col("_to")) & (F.col("header_digest") == F.col("payload_digest"))
    told = revisits.join(targets, same).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return whole.unionByName(told).withColumnRenamed("page_id", id_col)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN g.top IS NULL OR g.top = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.top <> d.page_id THEN g.top END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 1000"""

"""WARC archives: writing, normalising of monolithic gzip files, and reading by offset.

Crawlers and converters leave `.warc.gz` files that are one gzip stream from end to end;
in such a file no record can be read without inflating all before it. `normalise` inflates
each file once as a stream, writes every record as a gzip member of its own, and beside the
new file an index with a line for each record: offset, length, type, id. `read_records`
then opens any record by its offset.

Files are the unit of work: `write_archives` makes one for each task and `file_bytes`, the
other steps deal files to tasks. Records of any length pass through in blocks.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import NewFile, located, new_folder, read_bytes, written

BLOCK = 1 << 20
FILES = "uri string, index_uri string, records long, bytes long"
RECORDS = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, offset long, payload binary"
)
#: Fixed by the format: how an HTTP response record and a repeat of its payload are named.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key) -> str:
    return f"<urn:x-page:{key}>"


# Writing ------------------------------------------------------------------------------


def with_first_copy(pages: DataFrame, id_col: str, payload_col: str, least: int) -> DataFrame:
    """Adds `_first`: the smallest id among equal payloads of at least `least` bytes.

    Payloads are compared by SHA-256, so only digests are grouped, after each task has
    kept one row of each; the join of a payload with many copies is split at run time.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    keyed = pages.withColumn("_payload", payload).withColumn(
        "_key", F.when(F.octet_length("_payload") >= least, F.unhex(F.sha2("_payload", 256)))
    )
    first = (
        keyed.where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min(id_col).alias("_first"))
        .where(F.col("_first").isNotNull())
    )
    return keyed.join(first, "_key", "left").drop("_key")


def record(kind: str, key, url: str | None, payload: bytes, first) -> bytes:
    digest = f"sha1:{base32_sha1(payload)}"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    target = " ".join((url or "").split())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {EPOCH}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {digest}",
        *(
            [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(first)}"]
            if kind == "revisit"
            else []
        ),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    file_bytes: int = 1 << 30,
    level: int = 1,
    folder: str | None = None,
) -> DataFrame:
    """Write a record for each row into monolithic gzip files; returns the list of files.

    Of records with equal payloads of at least `least_bytes`, the one with the smallest id
    is a response, the others are revisits of it; shorter ones are all responses. Rows that
    repeat an id with the same payload are all responses under that id. A null payload is
    empty, a null url has an empty target; a null id is written as `None` and is only ever
    a revisit of a numbered page.
    """
    folder = folder or new_folder(pages.sparkSession, "archives")
    rows = with_first_copy(
        pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("body")),
        "id",
        "body",
        least_bytes,
    ).select(
        "id",
        "url",
        F.col("_payload").alias("payload"),
        F.when(F.col("_first").isNull() | F.col("id").eqNullSafe(F.col("_first")), None)
        .otherwise(F.col("_first"))
        .alias("first"),
    )

    def write(batches):
        out, squeeze, n, size = None, None, 0, 0

        def close():
            nonlocal out, n, size
            out.write(squeeze.flush())
            out.__exit__(None, None, None)
            done, out = [out.uri, None, n, size], None
            n = size = 0
            return pa.RecordBatch.from_pydict(
                {
                    "uri": [done[0]],
                    "index_uri": pa.array([None], pa.string()),
                    "records": [done[2]],
                    "bytes": [done[3]],
                }
            )

        for batch in batches:
            for key, url, payload, first in zip(*(batch[c] for c in ("id", "url", "payload", "first")), strict=True):
                if out is None:
                    stem = f"pages-{TaskContext.get().partitionId():05d}"
                    out = NewFile(f"{folder}/monolithic", stem, ".warc.gz").__enter__()
                    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                first = first.as_py()
                data = record(
                    "response" if first is None else "revisit", key.as_py(), url.as_py(), payload.as_py(), first
                )
                out.write(squeeze.compress(data))
                n, size = n + 1, size + len(data)
                if size >= file_bytes:
                    yield close()
        if out is not None:
            yield close()

    return written(rows.mapInArrow(write, FILES), "written")


def dealt(files: DataFrame) -> DataFrame:
    """A task for each file, up to 10,000 tasks; rows this small would else be put together."""
    return files.repartition(min(max(files.count(), 1), 10_000))


# Normalising --------------------------------------------------------------------------


def inflated(uri: str) -> Iterator[bytes]:
    """The bytes of a gzip file in blocks, of one member or of many. A cut one is an error."""
    files, path = located(uri)
    with files.open_input_stream(path, compression=None) as f:
        inflate, begun = zlib.decompressobj(31), False
        while data := f.read(BLOCK):
            while data:
                begun = True
                yield inflate.decompress(data, BLOCK)
                if inflate.eof:
                    data, inflate = inflate.unused_data, zlib.decompressobj(31)
                    begun = bool(data)
                else:
                    data = inflate.unconsumed_tail
        if begun:
            # What the last bytes stand for may still be held back; only their end tells.
            if tail := inflate.flush():
                yield tail
            if not inflate.eof:
                raise ValueError(f"{uri}: the gzip stream is cut")


class Stream:
    """Bytes from blocks: up to a mark, or a number of them in blocks."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.kept = blocks, b""

    def until(self, mark: bytes, most: int = BLOCK) -> bytes:
        """With the mark, within `most` bytes; what is left if there is none."""
        while mark not in self.kept[: most + len(mark)]:
            if len(self.kept) > most:
                raise ValueError(f"no record: no end of its head within {most} bytes")
            more = next(self.blocks, None)
            if more is None:
                data, self.kept = self.kept, b""
                return data
            self.kept += more
        at = self.kept.index(mark) + len(mark)
        data, self.kept = self.kept[:at], self.kept[at:]
        return data

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.kept:
                self.kept = next(self.blocks, None)
                if self.kept is None:
                    raise ValueError("the archive ends inside a record")
            data, self.kept = self.kept[:n], self.kept[n:]
            n -= len(data)
            yield data


def fields(head: bytes) -> dict[str, str]:
    """Of a record's or response's head, by name in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def normalise(archives: DataFrame, level: int = 6, folder: str | None = None) -> DataFrame:
    """Rewrite each file of `archives` (column `uri`) with one gzip member for each record.

    Returns the list of new files, a written table; `index_uri` is the index beside each.
    A file is inflated once, in blocks; at any time a task holds one block. A file whose
    gzip stream is cut, that ends inside a record, holds something else than records, or
    another number of them than `archives` says in a column `records`, fails the job.
    """
    folder = folder or new_folder(archives.sparkSession, "normalised")
    expected = F.col("records") if "records" in archives.columns else F.lit(None)
    spread = dealt(archives.select("uri", expected.cast("long").alias("records")))

    def rewrite(batches):
        for batch in batches:
            for uri, wanted in zip(batch["uri"].to_pylist(), batch["records"].to_pylist(), strict=True):
                stem, offset, n = uri.rsplit("/", 1)[-1].split(".")[0], 0, 0
                with (
                    NewFile(f"{folder}/records", stem, ".warc.gz") as out,
                    NewFile(f"{folder}/records", stem, ".index") as index,
                ):
                    stream = Stream(inflated(uri))
                    while head := stream.until(b"\r\n\r\n"):
                        if not head.startswith(b"WARC/"):
                            raise ValueError(f"{uri}: no record after {n} records")
                        names = fields(head)
                        squeeze, start = zlib.compressobj(level, zlib.DEFLATED, 31), offset
                        # The block, and the two line ends behind it.
                        blocks = stream.take(int(names["content-length"]) + 4)
                        for data in itertools.chain([head], blocks):
                            out.write(done := squeeze.compress(data))
                            offset += len(done)
                        out.write(done := squeeze.flush())
                        offset, n = offset + len(done), n + 1
                        entry = {
                            "offset": start,
                            "length": offset - start,
                            "type": names["warc-type"],
                            "id": names["warc-record-id"],
                        }
                        index.write(json.dumps(entry).encode() + b"\n")
                    if wanted not in (None, n):
                        raise ValueError(f"{uri}: {n} records, not {wanted}")
                yield pa.RecordBatch.from_pydict(
                    {"uri": [out.uri], "index_uri": [index.uri], "records": [n], "bytes": [offset]}
                )

    return written(spread.mapInArrow(rewrite, FILES), "normalised")


# Reading ------------------------------------------------------------------------------


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row for each record, found by the index beside its file.

    The digest and the number of bytes are those of the payload that is read. A revisit has
    no payload: its digest is what its head says, its payload and bytes are null. See
    `resolved` for those of the record it refers to. An index with another number of lines
    than the file has records is an error.
    """
    spread = dealt(archives.select("uri", "index_uri", "records"))

    def read(batches):
        for batch in batches:
            for uri, index_uri, wanted in zip(*(batch[c].to_pylist() for c in ("uri", "index_uri", "records")), strict=True):
                files, path = located(uri)
                rows, held = [], 0
                lines = read_bytes(index_uri).splitlines()
                if len(lines) != wanted:
                    raise ValueError(f"{index_uri}: {len(lines)} entries, not {wanted}")
                with files.open_input_file(path) as f:
                    for line in lines:
                        entry = json.loads(line)
                        f.seek(entry["offset"])
                        data = zlib.decompress(f.read(entry["length"]), 31)
                        head, _, rest = data.partition(b"\r\n\r\n")
                        names = fields(head)
                        block = rest[: int(names["content-length"])]
                        payload = block.partition(b"\r\n\r\n")[2]
                        own = names["warc-type"] != "revisit"
                        rows.append(
                            {
                                "record_id": names["warc-record-id"],
                                "record_type": names["warc-type"],
                                "target_uri": names.get("warc-target-uri"),
                                "refers_to": names.get("warc-refers-to"),
                                "payload_digest": base32_sha1(payload)
                                if own
                                else names["warc-payload-digest"].removeprefix("sha1:"),
                                "payload_bytes": len(payload) if own else None,
                                "offset": entry["offset"],
                                "payload": payload if own and with_payload else None,
                            }
                        )
                        held += len(data)
                        if held > 4 * BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return spread.mapInArrow(read, RECORDS)


SCHEMA = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (f.split() for f in RECORDS.split(", "))
    ]
)


def resolved(records: DataFrame) -> DataFrame:
    """Gives revisits the bytes of the response they refer to.

    Responses that nothing refers to don't take part; a response with very many revisits is
    split at run time.
    """
    responses = (
        records.where(F.col("record_type") == "response")
        .groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    return (
        records.join(responses, "refers_to", "left")
        .withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes"))
        .drop("_bytes")
    )

"""WARC archives of pages, written and read as a table of record chunks.

Writing: the digest of every payload decides whether its record is the
response or a revisit of the response with the smallest id; payloads become
(record, chunk number) rows, and each task streams its rows into archives of
one gzip member per record.  Reading: each archive is streamed by one task
into chunk rows that carry the bytes and the digest so far, so the last chunk
of a record holds its length and digest; neither side holds a whole record.

Archives lie on the shared storage under names of their own for each attempt,
and a written manifest names those of the attempts that counted, so a repeated
task leaves no record twice.

Edge cases: a null payload is empty; payloads below the size bound are all
responses; a null id sorts after all others and is read back as null; repeated
rows are records of their own, of which one is the response; an empty table
gives no records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, placed, scratch_path, stage

MIN_REVISIT_BYTES = 100
CHUNK_BYTES = 256 << 10
FILE_BYTES = 1 << 30
DATE = "2000-01-01T00:00:00Z"
END = b"\r\n\r\n"
RECORD_ID = "urn:strata:page"

MANIFEST = "path string, n_records bigint, n_bytes bigint"
CHUNKS = ("path string, record_id string, record_type string, page_id string, url string, refers_to string, chunk int, payload binary, n_bytes bigint, "
          "bytes_so_far bigint, digest_so_far string, last boolean, payload_bytes bigint, payload_digest string")


def records(df: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page, url, payload, n_bytes, digest, record, refers_page, refers_record): one row per row of ``df``.

    ``refers_record`` is null for responses.  Only the digests that occur
    twice or more are joined back; they are written first, so a few of them
    are broadcast (their measured size decides) and many are shuffled.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    (record,) = fresh(df.columns, "record")
    base = placed(df.select(id_col, url_col, payload_col), record).select(F.col(id_col).cast("bigint").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                     F.octet_length(payload).cast("bigint").alias("n_bytes"), F.sha2(payload, 256).alias("digest"),
                     F.col(record).alias("record"))
    first = F.min(F.struct(F.col("page").isNull().alias("no_page"), "page", "record")).alias("first")
    twice = (base.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(first, F.count("*").alias("n")).where(F.col("n") > 1)
             .select("digest", F.col("first.page").alias("first_page"), F.col("first.record").alias("first_record")))
    out = base.join(stage(twice, "revisited"), "digest", "left")
    again = (F.col("n_bytes") >= min_bytes) & (F.col("first_record") != F.col("record"))
    return out.select("page", "url", "payload", "n_bytes", "digest", "record",
                      F.when(again, F.col("first_page")).alias("refers_page"), F.when(again, F.col("first_record")).alias("refers_record"))


def chunk_rows(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The records as rows of at most ``chunk_bytes`` payload bytes, in order; a revisit or empty payload is one empty chunk."""
    n = F.when(F.col("refers_record").isNull(), F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk_bytes))).otherwise(F.lit(1)).cast("int")
    body = F.when(F.col("refers_record").isNull(), F.col("payload")).otherwise(F.lit(b""))
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(body, i * chunk_bytes + 1, F.lit(chunk_bytes)))
    return rows.select("page", "url", "n_bytes", "digest", "record", "refers_page", "refers_record", F.posexplode(parts).alias("chunk", "body"))


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _name(page: int | None, record: int) -> str:
    return f"<{RECORD_ID}:{'' if page is None else page}:{record}>"


def _header(row: dict) -> bytes:
    revisit = row["refers_record"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(row["page"], row["record"])), ("WARC-Date", DATE)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _name(row["refers_page"], row["refers_record"]))]
    fields += [("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(http) + (0 if revisit else row["n_bytes"])))]
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode() + http


def write_warc(rows: DataFrame, folder: str | None = None, chunk_bytes: int = CHUNK_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of ``records()`` as archives below ``folder`` (shared storage) and return the written manifest."""
    spark = rows.sparkSession
    folder = folder or scratch_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, path, packer, n_records, n_bytes = TaskContext.get().partitionId(), None, "", None, 0, 0
        done: list[tuple[str, int, int]] = []

        def end_record() -> int:
            if packer is None:
                return 0
            return out.write(packer.compress(END)) + out.write(packer.flush())

        def end_file() -> None:
            out.close()
            done.append((path, n_records, n_bytes))

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    n_bytes += end_record()
                    packer = None
                    if out is not None and n_bytes >= file_bytes:
                        end_file()
                        out, n_records, n_bytes = None, 0, 0
                    if out is None:
                        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                        store, local = _opened(path)
                        store.create_dir(local.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(local, compression=None)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    n_records += 1
                    n_bytes += out.write(packer.compress(_header(row)))
                n_bytes += out.write(packer.compress(row["body"]))
        if out is not None:
            n_bytes += end_record()
            end_file()
        paths, records_, bytes_ = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(records_, pa.int64()), pa.array(bytes_, pa.int64())],
                                         names=["path", "n_records", "n_bytes"])

    return stage(chunk_rows(rows, chunk_bytes).mapInArrow(write, MANIFEST), "manifest")


class _Stream:
    """The inflated bytes of an archive, a bounded part at a time."""

    def __init__(self, source, step: int) -> None:
        self.source, self.step, self.buffer = source, step, b""
        self.inflate, self.waiting, self.plain = zlib.decompressobj(31), b"", None

    def _more(self) -> bytes:
        while True:
            if not self.waiting:
                self.waiting = self.source.read(self.step)
                if not self.waiting:
                    return b""
            if self.plain is None:
                self.plain = self.waiting[:2] != b"\x1f\x8b"
            if self.plain:
                out, self.waiting = self.waiting, b""
                return out
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            out = self.inflate.decompress(self.waiting, self.step)
            self.waiting = self.inflate.unconsumed_tail or self.inflate.unused_data
            if out:
                return out

    def read(self, most: int) -> bytes:
        """Up to ``most`` bytes; none at the end."""
        if not self.buffer:
            self.buffer = self._more()
        out, self.buffer = self.buffer[:most], self.buffer[most:]
        return out

    def block(self) -> bytes | None:
        """The bytes before the next empty line, of any length, or None at the end of the archive."""
        held = bytearray(self.buffer)
        while (at := held.find(END)) < 0:
            seen = max(0, len(held) - len(END) + 1)
            while True:  # only what is new is searched
                more = self._more()
                if not more:
                    if held.strip():
                        raise ValueError("an archive ends inside a header block")
                    self.buffer = b""
                    return None
                held += more
                if held.find(END, seen) >= 0:
                    break
                seen = max(0, len(held) - len(END) + 1)
        out, self.buffer = bytes(held[:at]), bytes(held[at + len(END):])
        return out


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(name: str | None) -> str | None:
    return (name.strip("<>").split(":")[3] or None) if name else None


def read_records(path: str, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = False) -> Iterator[dict]:
    """Chunk rows of one archive, streamed."""
    store, local = _opened(path)
    with store.open_input_stream(local, compression=None) as source:
        stream = _Stream(source, chunk_bytes)
        while (block := stream.block()) is not None:
            if not block.strip(b"\r\n"):  # the empty lines that end a record
                continue
            head = _fields(block.lstrip(b"\r\n"))
            kind, refers = head["warc-type"], head.get("warc-refers-to")
            http = stream.block() or b""
            left = int(head["content-length"]) - len(http) - len(END)
            digest, so_far, number = hashlib.sha256(), 0, 0
            stated = head.get("warc-payload-digest", "").partition(":")[2]
            same = {"path": path, "record_id": head["warc-record-id"], "record_type": kind, "page_id": _page(head["warc-record-id"]),
                    "url": head.get("warc-target-uri"), "refers_to": _page(refers)}
            while True:
                need, parts = min(left, chunk_bytes), []
                while need:
                    got = stream.read(need)
                    if not got:
                        raise ValueError(f"{path} ends inside record {head['warc-record-id']}")
                    parts.append(got)
                    need -= len(got)
                body = b"".join(parts)
                left -= len(body)
                so_far += len(body)
                digest.update(body)
                shown = digest.hexdigest()
                if left == 0 and kind == "response" and stated and shown != stated:
                    raise ValueError(f"{path}: the payload of {head['warc-record-id']} does not match its digest")
                full = kind != "revisit"
                yield same | {"chunk": number, "payload": body if with_payload else None, "n_bytes": len(body), "bytes_so_far": so_far,
                              "digest_so_far": shown, "last": left == 0,
                              "payload_bytes": so_far if full else int(_fields(http)["content-length"]), "payload_digest": shown if full else stated}
                number += 1
                if left == 0:
                    break


def read_warc(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = False) -> DataFrame:
    """Chunk rows of all archives of a manifest: one task streams an archive; see ``CHUNKS`` for the columns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, schema = [], 0, _chunk_schema()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in read_records(path, chunk_bytes, with_payload):
                    held.append(row)
                    size += 512 + (row["n_bytes"] if with_payload else 0)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    n = manifest.count()
    return manifest.select("path").repartition(max(1, n)).mapInArrow(read, CHUNKS)


def _chunk_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in CHUNKS.split(","))])

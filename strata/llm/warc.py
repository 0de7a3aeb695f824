"""WARC archives as a chunked record table.

Method. A payload is rows of (record identifier, chunk number, bytes): archives are written
from such rows and read back into them, so neither side holds a whole record. The reader
carries the digest and length from chunk to chunk; the last chunk's row has those of the
whole payload, which must equal what the record's header says.

Archives: one file a task, one gzip member a record, written under another name and renamed
when complete, so a task that is run again leaves the same files. They lie in the session's
shared folder and are opened through ``pyarrow.fs`` (local and mounted paths, HDFS, object
stores), on the executors only.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import mkdirs
from ..session import new_scratch
from .common import keep, text_of

CHUNK = 1 << 20
LEAST_BYTES = 1000  # smaller payloads are never revisits

RECORDS = ("record string, type string, uri string, refers_to string, bytes long, digest string, chunk int, data binary")
CHUNKS = ("file string, record string, type string, uri string, refers_to string, header_digest string, chunk int, last boolean, "
          "bytes_so_far long, digest_so_far string, data binary")


def chunk_rows(records: DataFrame, payload: str, chunk: int = CHUNK) -> DataFrame:
    """``records`` with binary ``payload`` replaced by ``chunk`` (from 0) and ``data``; an
    empty or null payload has one empty chunk."""
    size = F.coalesce(F.octet_length(payload), F.lit(0))
    rest = [c for c in records.columns if c != payload]
    c = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(size / chunk).cast("int") - 1, F.lit(0)))))
    return c.select(*rest, "chunk", F.coalesce(F.substring(payload, F.col("chunk") * chunk + 1, F.lit(chunk)), F.lit(b"")).alias("data"))


def _header(r: dict) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {r['type']}", f"WARC-Record-ID: <{r['record']}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if r["uri"]:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in r["uri"]))
    if r["refers_to"]:
        lines += [f"WARC-Refers-To: <{r['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(r['digest'])).decode()}",
              f"Content-Length: {0 if r['type'] == 'revisit' else r['bytes']}", "", ""]
    return "\r\n".join(lines).encode()


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write rows of RECORDS as archives in ``folder``. The chunks of a record must stand
    together, in order (as ``chunk_rows`` makes them). Returns a table of ``(file, records,
    bytes)``, made by the writing job itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        at = TaskContext.get()
        name = f"{root}/part-{at.partitionId():05d}.warc.gz"
        out, gz, n, size, left = None, None, 0, 0, 0
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                if out is None:
                    out = store.open_output_stream(f"{name}.{at.taskAttemptId()}", compression=None)
                if r["chunk"] == 0:
                    if left:
                        raise ValueError(f"{left} bytes of the record before {r['record']} are missing")
                    gz, left, n = zlib.compressobj(1, zlib.DEFLATED, 31), 0 if r["type"] == "revisit" else r["bytes"], n + 1
                    size += out.write(gz.compress(_header(r))) or 0
                size += out.write(gz.compress(r["data"])) or 0
                left -= len(r["data"])
                if left == 0:
                    out.write(gz.compress(b"\r\n\r\n"))
                    out.write(gz.flush())
        if out is not None:
            if left:
                raise ValueError(f"{left} bytes of the last record are missing")
            size = out.tell()
            out.close()
            store.move(f"{name}.{at.taskAttemptId()}", name)
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n], "bytes": [size]},
                                             schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return keep(chunks.selectExpr(*[c.split()[0] for c in RECORDS.split(", ")])
                .mapInArrow(run, "file string, records long, bytes long"), "archives")


class _Member:
    """The bytes of one archive file, unpacked piece by piece."""

    def __init__(self, stream, piece: int):
        self.stream, self.piece, self.gz, self.have = stream, piece, None, b""

    def more(self) -> bool:
        """Unpack up to one piece more; False at the end of the file."""
        while True:
            if self.gz is None or self.gz.eof:
                rest = self.gz.unused_data if self.gz else b""
                rest = rest or self.stream.read(self.piece)
                if not rest:
                    return False
                self.gz, raw = zlib.decompressobj(31), rest
            else:
                raw = self.gz.unconsumed_tail or self.stream.read(self.piece)
                if not raw:
                    raise ValueError("the archive ends inside a record")
            got = self.gz.decompress(raw, self.piece)
            if got:
                self.have += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.have.find(mark)) < 0:
            if not self.more():
                if self.have:
                    raise ValueError("the archive ends inside a header")
                return None
        out, self.have = self.have[:at], self.have[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        out, self.have = self.have[:n], self.have[n:]
        return out


def read_archives(files: DataFrame, folder: str, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """Rows of CHUNKS of the archives named in ``files(file)``, a task for each file.
    ``data`` False leaves the payload bytes out (digests and lengths stay)."""
    kinds = [pa.string()] * 6 + [pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip([c.split()[0] for c in CHUNKS.split(", ")], kinds)))

    def rows(name: str, store) -> Iterator[tuple]:
        with store.open_input_stream(name, compression=None) as stream:
            m = _Member(stream, 1 << 16)
            while (head := m.until(b"\r\n\r\n")) is not None:
                f = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                left, sha, done, k = int(f["Content-Length"]), hashlib.sha1(), 0, 0
                said = base64.b32decode(f["WARC-Payload-Digest"].split(":", 1)[1]).hex()
                ident, to = f["WARC-Record-ID"][1:-1], f.get("WARC-Refers-To")
                while True:
                    part = m.take(min(chunk, left))
                    left, done = left - len(part), done + len(part)
                    sha.update(part)
                    yield (name, ident, f["WARC-Type"], f.get("WARC-Target-URI"), to and to[1:-1], said, k, not left, done,
                           sha.hexdigest(), part if data else None)
                    k += 1
                    if not left:
                        break
                if f["WARC-Type"] != "revisit" and sha.hexdigest() != said:
                    raise ValueError(f"{ident}: the payload is not what its digest says")
                if m.take(4) != b"\r\n\r\n":
                    raise ValueError(f"{ident}: no end of record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                held, size = [], 0
                for r in rows(name, store):
                    held.append(r)
                    size += len(r[-1] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], schema=schema)

    files = files.select("file")
    n = max(1, files.count())
    return files.repartition(n, "file").mapInArrow(run, CHUNKS)


def records_of(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``pages`` as rows of RECORDS with binary ``payload`` in place of chunks.
    Of equal payloads of at least LEAST_BYTES that with the largest id is the response (all
    rows of that id, if it is repeated: they make the same record), the others revisit it; rows with a null id are
    responses. Null payloads are empty."""
    p = pages.select(F.col(id_col).alias("id"), F.col(url).cast("string").alias("uri"),
                     F.encode(text_of(payload), "UTF-8").alias("payload") if dict(pages.dtypes)[payload] != "binary"
                     else F.coalesce(payload, F.lit(b"")).alias("payload"))
    p = p.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("key", F.sha2("payload", 256))
    groups = (p.where(F.col("bytes") >= LEAST_BYTES).groupBy("key").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 AND top IS NOT NULL").select("key", "top"))
    p = p.join(groups, "key", "left")
    to = F.when(F.col("top") != F.col("id"), F.col("top"))
    # the digest in the name keeps apart pages of one id with different payloads
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(":"), F.sha1("payload"))
    return p.select(
        urn(F.col("id")).alias("record"), F.when(to.isNull(), "response").otherwise("revisit").alias("type"), "uri",
        F.when(to.isNotNull(), urn(to)).alias("refers_to"), "bytes", F.sha1("payload").alias("digest"),
        F.when(to.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives, read them back, and tell what is in them: one row for
    each row of ``pages`` with id, ``payload_bytes, payload_digest, record_type, refers_to``
    (for a revisit the response's length, which its digest must lead to). An empty table
    gives an empty table. Other columns are not read."""
    spark: SparkSession = pages.sparkSession
    folder = folder or new_scratch(spark, "llm-warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    mkdirs(spark, folder)
    kind = dict(pages.dtypes)[id_col]
    archives = write_archives(chunk_rows(records_of(pages, id_col, url, payload), "payload"), folder)
    back = keep(read_archives(archives, folder, data=False).where("last").drop("data", "chunk", "last"), "warc-read")
    number = lambda c: F.get(F.split(c, ":"), F.lit(2))
    back = back.withColumn("id", F.when(number(F.col("record")) != "", number(F.col("record"))).cast(kind))
    target = (back.where("type = 'response'").groupBy(F.col("record").alias("r_record"))
              .agg(F.max("bytes_so_far").alias("r_bytes"), F.max("digest_so_far").alias("r_digest")))
    revisit = (back.where("type = 'revisit'").join(target, F.col("refers_to") == F.col("r_record"), "left")
               .withColumn("r_digest", F.when(F.col("header_digest") == F.col("r_digest"), F.col("r_digest"))))
    out = [F.col("id").alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
           F.col("type").alias("record_type"), number(F.col("refers_to")).cast(kind).alias("refers_to")]
    plain = back.where("type = 'response'").withColumn("bytes", F.col("bytes_so_far")).withColumn("digest", F.col("digest_so_far"))
    return plain.select(*out).unionByName(revisit.withColumn("bytes", F.col("r_bytes")).withColumn("digest", F.col("r_digest")).select(*out))

"""WARC archives: a deterministic sharded writer and a reader.

Pages are ranged and sorted by id with one shuffle of their payloads; rows that
name revisits travel in the same shuffle. The range of ids is cut into
``ID_CELLS`` cells of equal width; their payload bytes are counted, and neighbours
make a shard until it is full. A cell that is fuller than a shard, such as one
often repeated id or all rows without an id, is dealt to several shards by payload.
Records are appended to their shard, one gzip member each, and roll to a new file
by compressed size. Headers, ids and digests are made anew from the content. So equal
input gives equal files, whatever the partitions of the input or the cluster.

Files are first written under ``_temporary`` with a name of the attempt. A task
returns manifest rows; only those of attempts that Spark accepts are kept. The
commit renames the files they name, by shard and sequence, and writes the
manifest last. What a lost attempt left is in no manifest and never read. A
repeated commit finds its files renamed and goes on.

The folder is any URI that ``pyarrow.fs`` opens and all executors share; one without
a scheme lies on Spark's default file system.

Of records with equal payloads of ``least`` bytes or more (by SHA-256) the
largest page id is the response, the others revisit it. Defined results: null
html is an empty payload; null URLs give no target header; rows that repeat the
largest id are responses all of them; rows without an id are responses; an empty
table writes a manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from gzip import GzipFile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import slices, stored

ROLL_BYTES = 256 << 20
# Payload bytes a shard is filled to, unless that made more than so many shards.
SHARD_BYTES = 32 << 20
MOST_SHARDS = 1 << 13
ID_CELLS = 1 << 14
LEAST_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
LEVEL = 4
# Fixed by the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "shard int, sequence int, temporary string, file string, records bigint, bytes bigint, sha256 string"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, intact boolean"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the file system that Spark takes it for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}:{digest}')}>"


def _labelled(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, not compressed. With ``refers_to`` it is a revisit without the payload."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
        ("WARC-Target-URI", url and url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", _labelled(digest)), ("WARC-Block-Digest", _labelled(hashlib.sha1(block).hexdigest())),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else record_id(refers_to, digest)),
        ("Page-ID", page_id), ("Refers-To-Page-ID", refers_to), ("Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """Appends gzip members to temporary files and rolls them by size."""

    def __init__(self, folder: str, roll_bytes: int):
        self.system, self.path = opened(folder)
        self.roll_bytes, self.done, self.stream = roll_bytes, [], None
        self.attempt = uuid.uuid4().hex

    def add(self, data: bytes) -> None:
        if self.stream is None:
            name = f"{self.path}/_temporary/{self.attempt}-{len(self.done):05d}"
            self.current = [name, 0, 0, hashlib.sha256()]
            self.stream = self.system.open_output_stream(name)
            self._write(_member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n"))
        self._write(_member(data))
        self.current[1] += 1
        if self.current[2] >= self.roll_bytes:
            self.close()

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.current[2] += len(data)
        self.current[3].update(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None
            self.done.append(self.current)


def sharded(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """``rows`` (page_id, payload, key) with their shard, which depends on the rows only, and the number of shards."""
    low, high = rows.agg(F.min("page_id"), F.max("page_id")).first()
    low, width = low or 0, ((high or 0) - (low or 0)) // ID_CELLS + 1
    by_cell = F.when(F.col("page_id").isNull(), F.lit(ID_CELLS)).otherwise(
        F.expr(f"cast((cast(page_id as decimal(20,0)) - {low}) div {width} as int)")
    )
    rows = rows.withColumn("cell", by_cell)
    held = rows.groupBy("cell").agg(F.sum(F.octet_length("payload").cast("decimal(38,0)")).alias("held"))
    counted = sorted((r["cell"], int(r["held"] or 0)) for r in held.collect())
    target = max(shard_bytes, sum(n for _, n in counted) // MOST_SHARDS)
    first, parts, shard, filled = [0] * (ID_CELLS + 1), [1] * (ID_CELLS + 1), 0, 0
    for cell, size in counted:
        if filled and filled + size > target:
            shard, filled = shard + 1, 0
        first[cell], parts[cell] = shard, max(1, -(-size // target))
        if parts[cell] > 1:
            shard, filled = shard + parts[cell], 0
        else:
            filled += size
    # A payload and the row that names its revisit have one hash, so they share a shard.
    split = F.expr("pmod(xxhash64(coalesce(key, sha2(payload, 256))), parts)").cast("int")
    cells = rows.sparkSession.createDataFrame(list(zip(range(ID_CELLS + 1), first, parts)), "cell int, first int, parts int")
    placed = rows.join(F.broadcast(cells), "cell").withColumn("shard", F.col("first") + F.when(F.col("parts") > 1, split).otherwise(0))
    return placed.drop("cell", "first", "parts"), shard + 1


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, least: int = LEAST_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as archives; returns the manifest."""
    folder = qualified(pages.sparkSession, folder)
    system, path = opened(folder)
    system.create_dir(f"{path}/_temporary", recursive=True)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    keys = stored(rows.where(F.octet_length("payload") >= least).select("page_id", F.sha2("payload", 256).alias("key")))
    chosen = keys.groupBy("key").agg(F.max("page_id").alias("chosen"), F.count("*").alias("held")).where("held > 1")
    revisits = keys.join(chosen, "key").where("page_id <> chosen").select("page_id", "key", F.col("chosen").alias("refers_to")).distinct()
    both = rows.withColumns({"key": F.lit(None).cast("string"), "refers_to": F.lit(None).cast("bigint")}).unionByName(
        revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "key", "refers_to")
    )
    placed, shards = sharded(both, shard_bytes)
    ranged = placed.repartition(shards, "shard").sortWithinPartitions(
        "shard", "page_id", F.col("key").asc_nulls_last(), "url", "payload"
    ).select("page_id", "url", "payload", "key", "refers_to", "shard")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers, page, revisit = {}, object(), {}
        for batch in slices(batches, "payload"):
            for number, url, payload, key, refers_to, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if shard not in rollers:
                    for finished in rollers.values():
                        finished.close()
                    rollers[shard], page = _Roller(folder, roll_bytes), object()
                if number != page:
                    page, revisit = number, {}
                if key is not None:
                    revisit[key] = refers_to
                    continue
                target = revisit.get(hashlib.sha256(payload).hexdigest()) if revisit and len(payload) >= least else None
                rollers[shard].add(record(number, url, payload, target))
        made = [
            (shard, i, name, f"{path}/shard-{shard:06d}-{i:05d}.warc.gz", records, size, digest.hexdigest())
            for shard, roller in rollers.items() if not roller.close()
            for i, (name, records, size, digest) in enumerate(roller.done)
        ]
        if made:
            types = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], [p.split()[0] for p in MANIFEST.split(", ")])

    written = stored(ranged.mapInArrow(write, MANIFEST))
    return commit(written, folder)


def commit(written: DataFrame, folder: str) -> DataFrame:
    """Give the files of the manifest rows their final names, then write the manifest."""
    folder = qualified(written.sparkSession, folder)

    def rename(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(folder)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("file").to_pylist()):
                if system.get_file_info(old).type == fs.FileType.NotFound and system.get_file_info(new).type != fs.FileType.NotFound:
                    continue  # an earlier attempt of this commit got here
                system.move(old, new)
            yield batch

    spark = written.sparkSession
    written.mapInArrow(rename, MANIFEST).drop("temporary").write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an opened archive."""
    with GzipFile(fileobj=stream) as unpacked:
        reader = io.BufferedReader(unpacked, 1 << 20)
        while line := reader.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"not the start of a record: {line[:40]!r}")
            fields = {}
            while (line := reader.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[name] = value
            block = reader.read(int(fields["Content-Length"]))
            if reader.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end as its length says")
            yield fields, block


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per page record of the files in the manifest; ``intact`` compares the digests."""
    folder = qualified(manifest.sparkSession, folder)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(folder)
        names = [p.split()[0] for p in RECORD.split(", ")]
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with system.open_input_file(file) as stream:
                    for fields, block in records_of(stream):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_row(fields, block))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = max(1, manifest.count())
    return manifest.select("file").repartition(min(files, 4096)).mapInArrow(run, RECORD)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    payload = block.partition(b"\r\n\r\n")[2]
    intact = _labelled(hashlib.sha1(block).hexdigest()) == fields["WARC-Block-Digest"]
    if fields["WARC-Type"] == "response":
        intact = intact and hashlib.sha1(payload).hexdigest() == digest and len(payload) == int(fields["Payload-Length"])
    page, refers_to = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
    return (
        None if page is None else int(page), fields.get("WARC-Target-URI"), int(fields["Payload-Length"]), digest, fields["WARC-Type"],
        None if refers_to is None else int(refers_to), intact,
    )


def archive_and_read(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages and read them back from the archives."""
    folder = folder or scratch_folder(pages.sparkSession)
    return read_archive(write_archive(pages, folder), folder)

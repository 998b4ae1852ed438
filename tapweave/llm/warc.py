"""WARC archives with a two-level capture index.

Writing: pages are dealt by ranges of their sort key (host labels reversed, then
the rest of the url, then the page id) and sorted. Each task writes its range as
gzip-per-record WARC files, an index shard beside them, and returns one manifest
row. A shard holds one line per record in key order, in compressed blocks
(level two), and a sparse directory with the first key and place of each block
(level one).

Reading: a request (key, page id) is dealt to its shard by binary search over
the shards' first keys (one per writing task), there by binary search over the
directory to a block, and the block's line gives file, offset and length for a
range read of the record. Requests come sorted, so each block is read once.

Files are named by a random id per attempt and only those of the manifest count,
so lost or repeated tasks leave nothing that is read. All files go to the shared
folder, through Arrow's file systems.

Of equal payloads of at least ``revisit_bytes`` bytes the one with the largest
page id is a response record, the others are revisit records without payload
that refer to it. Equality is by length, SHA-1 and SHA-256.

Defined results: a null html is an empty payload; a null url sorts first and has
no target line; characters that would break a header line are escaped; a null
page id sorts first, is never the largest, and reads back as null; of repeated
rows with the largest id each is a response; very long pages are one record; an
empty table writes nothing and gives no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages

_NO_ID = -(1 << 63)  # stands for a null page id inside the index
_BAD = re.compile(r"[\x00-\x20\x7f]")


@dataclass(frozen=True)
class WarcParams:
    """``block_lines``: index lines per compressed block; ``shard_rows`` and ``shard_bytes``: pages and payload aimed at per writing task."""

    revisit_bytes: int = 0
    file_bytes: int = 512 << 20
    block_lines: int = 256
    shard_rows: int = 20_000
    shard_bytes: int = 128 << 20
    level: int = 1
    date: str = "2024-01-01T00:00:00Z"


def sort_key(url: Column) -> Column:
    """com,example,www)/path?query: labels of the host from the right; the url itself where it has no host."""
    text = F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x20\\x7f]", "_")
    host = F.lower(F.regexp_extract(text, "(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(text, "(?s)^.*?://[^/?#]*(.*)$", 1)
    turned = F.array_join(F.reverse(F.split(host, "\\.")), ",")
    return F.when(F.contains(text, F.lit("://")), F.concat(turned, F.lit(")"), rest)).otherwise(text)


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system of a path; the short form of local urls is accepted too."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def planned(pages: DataFrame, stages: Stages, params: WarcParams) -> DataFrame:
    """Pages with key, payload, digest and the page they refer to (null: a response)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    named = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", sort_key(F.col("url")).alias("key"), payload.alias("payload")
    )
    digests = named.withColumns(
        {"sha1": F.sha1("payload"), "sha256": F.sha2("payload", 256), "size": F.length("payload").cast("bigint")}
    )
    same = ["sha1", "sha256", "size"]
    several = digests.where(F.col("size") >= params.revisit_bytes).groupBy(*same).agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    several = stages.write(several.where("n > 1").drop("n"), "payloads")  # Spark broadcasts it while it is small
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return digests.join(several, same, "left").withColumn("refers_to", refers).drop("last", "sha256")


def record(row: dict, params: WarcParams) -> bytes:
    """One record, uncompressed."""
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["size"]
    revisit = row["refers_to"] is not None
    body = http if revisit else http + row["payload"]
    kind = "revisit" if revisit else "response"
    page = "" if row["page_id"] is None else str(row["page_id"])
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {params.date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + _BAD.sub(lambda m: f"%{ord(m[0]):02X}", row["url"]))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


MANIFEST = "folder string, name string, files array<string>, records bigint, first_key binary, first_id bigint"


def write_archives(pages: DataFrame, folder: str, stages: Stages, params: WarcParams = WarcParams()) -> DataFrame:
    """Write archives and index below ``folder``; the manifest, a written table with one row per shard."""
    rows = planned(pages, stages, params)
    number, size = pages.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("html").cast("long")), F.lit(0))).first()
    shards = max(1, -(-number // params.shard_rows), -(-size // params.shard_bytes))
    dealt = rows.repartitionByRange(shards, "key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = uuid4().hex
        fs, root = _open(folder)
        files, lines, blocks, directory = [], [], [], []
        out, at, n, first, place = None, 0, 0, None, 0

        def close_block():
            nonlocal place, lines
            packed = zlib.compress("\n".join(line for _, line in lines).encode(), 6)
            directory.append((lines[0][0][0].decode("latin-1"), lines[0][0][1], place, len(packed)))
            blocks.append(packed)
            place, lines = place + len(packed), []

        for batch in batches:
            for row in batch.to_pylist():
                if out is None or at >= params.file_bytes:
                    if out is not None:
                        out.close()
                    files.append(f"{name}-{len(files):04d}.warc.gz")
                    fs.create_dir(root, recursive=True)
                    out, at = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                packed = _gzip(record(row, params), params.level)
                out.write(packed)
                where = (row["key"].encode(), _NO_ID if row["page_id"] is None else row["page_id"])
                first = first or where
                lines.append((where, json.dumps([where[0].decode("latin-1"), where[1], len(files) - 1, at, len(packed)])))
                at, n = at + len(packed), n + 1
                if len(lines) == params.block_lines:
                    close_block()
        if out is None:
            return
        out.close()
        if lines:
            close_block()
        with fs.open_output_stream(f"{root}/{name}.cdx", compression=None) as f:
            for b in blocks:
                f.write(b)
        with fs.open_output_stream(f"{root}/{name}.idx", compression=None) as f:
            f.write(zlib.compress(json.dumps(directory).encode()))
        yield pa.RecordBatch.from_pylist(
            [{"folder": folder, "name": name, "files": files, "records": n, "first_key": first[0], "first_id": first[1]}],
            schema=pa.schema(
                [("folder", pa.string()), ("name", pa.string()), ("files", pa.list_(pa.string())), ("records", pa.int64()),
                 ("first_key", pa.binary()), ("first_id", pa.int64())]
            ),
        )

    columns = ["page_id", "url", "key", "payload", "sha1", "size", "refers_to"]
    return stages.write(dealt.select(*columns).mapInArrow(run, MANIFEST), "manifest")


def parse(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a compressed record; digests are made anew."""
    whole = zlib.decompress(data, 31)
    head, _, body = whole.partition(b"\r\n\r\n")
    told = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = body[: int(told["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = told["WARC-Type"]
    digest = told["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response":
        made = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if made != digest or len(payload) != size:
            raise ValueError(f"damaged record {told['WARC-Record-ID']}")

    def page(text: str) -> int | None:
        number = text.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    refers = told.get("WARC-Refers-To")
    return {
        "page_id": page(told["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": page(refers) if refers else None,
    }


class Shard:
    """Directory of one index shard; keeps the last block it read."""

    def __init__(self, folder: str, name: str, files: list[str]):
        self.fs, self.root = _open(folder)
        self.name, self.files = name, files
        with self.fs.open_input_file(f"{self.root}/{name}.idx") as f:
            self.directory = json.loads(zlib.decompress(f.read()))
        self.firsts = [(k.encode("latin-1"), i) for k, i, _, _ in self.directory]
        self.index = self.fs.open_input_file(f"{self.root}/{name}.cdx")
        self.block, self.lines, self.archive, self.opened = -1, [], None, -1

    def close(self) -> None:
        self.index.close()
        if self.archive is not None:
            self.archive.close()

    def _lines(self, block: int) -> list:
        if block != self.block:
            _, _, at, size = self.directory[block]
            raw = zlib.decompress(self.index.read_at(size, at)).decode().split("\n")
            self.block, self.lines = block, [json.loads(x) for x in raw]
        return self.lines

    def find(self, key: bytes, page: int) -> Iterator[tuple[int, int, int]]:
        """File number, offset and length of every record with this key and page."""
        block = max(0, bisect.bisect_left(self.firsts, (key, page)) - 1)
        while block < len(self.firsts) and self.firsts[block] <= (key, page):
            lines = self._lines(block)
            at = bisect.bisect_left(lines, (key, page), key=lambda x: (x[0].encode("latin-1"), x[1]))
            while at < len(lines) and (lines[at][0].encode("latin-1"), lines[at][1]) == (key, page):
                yield tuple(lines[at][2:])
                at += 1
            block += 1

    def read(self, file: int, offset: int, length: int) -> bytes:
        if file != self.opened:
            if self.archive is not None:
                self.archive.close()
            self.archive, self.opened = self.fs.open_input_file(f"{self.root}/{self.files[file]}"), file
        return self.archive.read_at(length, offset)


RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_records(requests: DataFrame, manifest: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """The records of the requested (url, page_id) pairs, found through the index.

    The manifest has one row per writing task; it is the only thing that goes
    through the driver.
    """
    shards = sorted(((bytes(r["first_key"]), r["first_id"]), r["folder"], r["name"], list(r["files"])) for r in manifest.collect())
    shared = requests.sparkSession.sparkContext.broadcast(shards)
    wanted = requests.select(
        sort_key(F.col("url")).cast("binary").alias("key"), F.coalesce(F.col("page_id").cast("bigint"), F.lit(_NO_ID)).alias("page")
    ).distinct()
    # ranges of requests, as many as shards, so that a busy host is split like its records
    dealt = wanted.repartitionByRange(max(1, len(shards)), "key", "page").sortWithinPartitions("key", "page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        firsts = [s[0] for s in table]
        shard, number = None, -1
        schema = pa.schema(
            [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            out = []
            for key, page in zip(batch.column("key").to_pylist(), batch.column("page").to_pylist()):
                at = max(0, bisect.bisect_left(firsts, (key, page)) - 1)
                while at < len(firsts) and firsts[at] <= (key, page):  # equal rows may go on in the next shard
                    if at != number:
                        if shard is not None:
                            shard.close()
                        shard, number = Shard(*table[at][1:]), at
                    out += [parse(shard.read(*place)) for place in shard.find(key, page)]
                    at += 1
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if shard is not None:
            shard.close()

    return dealt.mapInArrow(run, RECORDS)

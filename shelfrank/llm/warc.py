"""WARC archives in Zstandard: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import pick, stored, whole
from shelfrank.scale import shared_folder

# Fixed values of the formats: magic number of the dictionary's skippable frame, and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
DICTIONARY_BYTES = 65_536
SAMPLE_RECORDS = 512
SAMPLE_CHARS = 32_768
REVISIT_FROM_BYTES = 100
ARCHIVE_BYTES = 256 * 1024 * 1024
READ_BYTES = 64 * 1024
URL_SAFE = "!#$%&'()*+,/:;=?@[]~"


@dataclass(frozen=True)
class Page:
    page_id: str | None
    url: str | None
    payload: bytes
    digest: str
    response_id: str | None  # of the page that holds the same payload, for a revisit
    revisit: bool


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}')}>"


def _headers(fields: list[tuple[str, str]], first: str = "WARC/1.1") -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields), "", ""]).encode("utf-8")


def record(page: Page, date: str) -> bytes:
    """The uncompressed record of a page; a revisit has its headers only."""
    http = _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(page.payload)))], "HTTP/1.1 200 OK")
    block = http if page.revisit else http + page.payload
    fields = [
        ("WARC-Type", "revisit" if page.revisit else "response"),
        ("WARC-Record-ID", record_id(page.page_id, page.digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{page.digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page.url is not None:
        fields.insert(2, ("WARC-Target-URI", quote(page.url, safe=URL_SAFE)))
    if page.page_id is not None:
        fields.append(("Page-Id", quote(page.page_id)))
    if page.revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(page.response_id, page.digest)),
            ("Refers-To-Page-Id", quote(page.response_id or "")),
            ("Payload-Length", str(len(page.payload))),
        ]
    return _headers(fields) + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the plain start of the samples where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size] or record(Page(None, None, b"", hashlib.sha256().hexdigest(), None, False), "")


class ArchiveWriter:
    """Writes archives ``name-0``, ``name-1``, ... in a folder; a new one begins beyond ``limit`` bytes."""

    def __init__(self, folder: str, name: str, dictionary: bytes, limit: int, level: int = LEVEL) -> None:
        self.fs, self.root = fs.FileSystem.from_uri(folder)
        self.name, self.dictionary, self.limit = name, dictionary, limit
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(dict_data=data, write_checksum=True)
        self.done: list[tuple[str, int, int]] = []
        self.file = None

    def _begin(self) -> None:
        self.path = f"{self.root}/{self.name}-{len(self.done)}.warc.zst"
        self.file = self.fs.open_output_stream(self.path)
        self.file.write(struct.pack("<II", DICTIONARY_MAGIC, len(self.dictionary)) + self.dictionary)
        self.size, self.records = 8 + len(self.dictionary), 0

    def add(self, raw: bytes) -> None:
        if self.file is None:
            self._begin()
        frame = self.compressor.compress(raw)
        self.file.write(frame)
        self.size, self.records = self.size + len(frame), self.records + 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.path, self.records, self.size))
            self.file = None


def read_records(file) -> Iterator[bytes]:
    """The uncompressed records of an open archive, one after the other."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(file.read(size)))
    rest = file.read(READ_BYTES)
    while rest:
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else file.read(READ_BYTES)
        yield b"".join(parts)
        rest = rest or file.read(READ_BYTES)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write_archives(
    df: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every row as a record and return the list of archives (path, records, bytes).

    ``folder`` must be one that all executors see; by default it is a new one below ``spark.checkpoint.dir``.  Of rows with equal
    payloads of at least 100 bytes the one with the smallest id is a response, the others are revisits; repeated rows of that id
    all are responses.  A null id counts as the largest; if a payload has null ids only, all its rows are responses.  A null
    payload is empty, a null url leaves its header out.  Other columns are ignored; an empty table gives no archive.

    Only digests of repeated payloads are joined back; the join splits a payload that many rows share.  The dictionary
    is trained on at most 512 records of at most 32,768 characters, chosen by a hash of the id.  A task that runs twice writes
    files of another name, and only those in the returned, stored list count.
    """
    spark = df.sparkSession
    pages = pick(df, id=id_col, url=url_col, html=html_col).select(
        F.col("id").cast("string").alias("id"),
        F.col("id").alias("ordered"),
        F.col("url").cast("string").alias("url"),
        whole(F.col("html")).alias("html"),
    )
    pages = pages.withColumn("digest", F.sha2("html", 256))
    repeated = (
        pages.where(F.octet_length("html") >= REVISIT_FROM_BYTES)
        .groupBy("digest")
        .agg(F.min("ordered").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", F.col("first"))
    )
    repeated = stored(repeated, "warc-repeated")
    # Names first, so that only the chosen payloads travel.
    keys = [F.xxhash64("id", "digest").alias("h1"), F.xxhash64(F.lit(1), "id", "digest").alias("h2")]
    chosen = F.broadcast(pages.select(*keys).distinct().orderBy("h1", "h2").limit(SAMPLE_RECORDS))
    sample = (
        pages.select("id", "url", "digest", F.substring("html", 1, SAMPLE_CHARS).alias("html"), *keys)
        .join(chosen, ["h1", "h2"])
        .groupBy("h1", "h2")
        .agg(*[F.first(c).alias(c) for c in ("id", "url", "digest", "html")])
        .orderBy("h1", "h2")
        .collect()
    )
    dictionary = build_dictionary([record(Page(r.id, r.url, r.html.encode("utf-8"), r.digest, None, False), date) for r in sample])
    shared = spark.sparkContext.broadcast(dictionary)
    target = folder or shared_folder(spark, "warc")
    filesystem, root = fs.FileSystem.from_uri(target)
    filesystem.create_dir(root)
    is_revisit = F.coalesce(~F.col("first").eqNullSafe(F.col("ordered")) & F.col("first").isNotNull(), F.lit(False))
    planned = pages.join(repeated, "digest", "left").select(
        "id", "url", "html", "digest", F.col("first").cast("string").alias("first"), is_revisit.alias("revisit")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{uuid.uuid4().hex}"
        writer = ArchiveWriter(target, name, shared.value, archive_bytes)
        for batch in batches:
            for row in batch.itertuples(index=False):
                writer.add(record(Page(row.id, row.url, row.html.encode("utf-8"), row.digest, row.first, bool(row.revisit)), date))
        writer.close()
        yield pd.DataFrame(writer.done, columns=["path", "records", "bytes"])

    base = target[: len(target) - len(root)] if target.endswith(root) else ""
    archives = planned.mapInPandas(write, "path string, records long, bytes long")
    return stored(archives.withColumn("path", F.concat(F.lit(base), "path")), "warc-archives")


def read_archives(archives: DataFrame, id_type: str = "bigint", payloads: bool = False) -> DataFrame:
    """One row per record of the listed archives; digest and size of a response are taken from the payload itself.

    Each archive is read as a stream by one task, and archives are dealt evenly to tasks.  The payload as text is returned on demand,
    null for a revisit.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                filesystem, name = fs.FileSystem.from_uri(path)
                with filesystem.open_input_stream(name) as file:
                    rows = []
                    for raw in read_records(file):
                        rows.append(_row(raw, payloads))
                        if len(rows) == 500:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                    yield pd.DataFrame(rows, columns=names)

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    schema += ", payload string" * payloads
    tasks = max(1, archives.count())
    made = archives.select("path").repartition(tasks).mapInPandas(read, schema)
    return made.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _row(raw: bytes, payloads: bool) -> tuple:
    fields, payload = parse_record(raw)
    page_id, url, kind = fields.get("Page-Id"), fields.get("WARC-Target-URI"), fields["WARC-Type"]
    row = (None if page_id is None else unquote(page_id), None if url is None else unquote(url))
    if kind == "revisit":
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        row += (int(fields["Payload-Length"]), digest, kind, unquote(fields["Refers-To-Page-Id"]))
        return row + (None,) * payloads
    row += (len(payload), hashlib.sha256(payload).hexdigest(), kind, None)
    return row + (payload.decode("utf-8"),) * payloads

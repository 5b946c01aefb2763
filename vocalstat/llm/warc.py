"""WARC archives of Zstandard frames: a writer with a dictionary, and the reader.

An archive is a leading skippable frame that holds the dictionary, then one frame per record
(the layout of ``.warc.zst``). The reader loads the dictionary from the first frame, decodes
frame by frame, and checks each record's version line, headers, lengths, end and, for responses,
the payload's digest.

Archives are files in a folder that all executors share. A task writes its files under names of
its own attempt; their names are written to a table, and only then are the files in it moved to
the archive folder, so that files of failed attempts are never read. Reading goes through Spark's
binaryFile source. An archive is closed after ``ARCHIVE`` bytes, which bounds the memory of a
reading task.

Of pages with equal payloads the one with the largest page_id is stored whole; the others are
revisit records with its headers only.

Defined cases: null html is the empty payload; null ids and urls leave out their headers; pages
repeated with their id are stored whole each time if theirs is the largest id; line ends in a url
are escaped; an empty table gives no archive and no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalstat.llm.common import load
from vocalstat.session import materialize, scratch_path

DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
ARCHIVE = 8 << 20
LEVEL = 3
CHUNK = 1 << 16
DICTIONARY_BYTES = 32 << 10
TRAIN_PAGES = 200
TRAIN_BYTES = 1 << 14
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha: str, date: str = DATE) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of the page ``refers_to``."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <{URN}{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError("a header line without a name")
        out[name.strip().decode().lower()] = value.strip().decode("utf-8", "surrogatepass")
    return out


def parse(data: bytes) -> dict:
    """The checked fields of one record; ValueError names what is wrong."""
    top, sep, rest = data.partition(b"\r\n\r\n")
    lines = top.split(b"\r\n")
    if not sep or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC version line")
    h = _headers(lines[1:])
    if missing := [k for k in ("warc-type", "warc-date", "content-length") if k not in h]:
        raise ValueError(f"no {missing[0]}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block's length differs from Content-Length")
    http, sep, payload = rest[:-4].partition(b"\r\n\r\n")
    status, *fields = http.split(b"\r\n")
    if not sep or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP head")
    size, sha, kind = _headers(fields).get("content-length", ""), h.get("warc-payload-digest", "").removeprefix("sha1:"), h["warc-type"]
    if not size.isdigit() or kind not in ("response", "revisit"):
        raise ValueError("no payload length, or an unknown type")
    if kind == "response" and (len(payload) != int(size) or digest(payload) != sha):
        raise ValueError("the payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in h):
        raise ValueError("a revisit with a payload, or of nothing")
    page = lambda v: int(v.removeprefix(f"<{URN}").removesuffix(">")) if v else None
    return {"page_id": page(h.get("warc-record-id")), "url": h.get("warc-target-uri"), "payload": payload if kind == "response" else None,
            "payload_bytes": int(size), "payload_digest": sha, "record_type": kind, "refers_to": page(h.get("warc-refers-to"))}


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples; their own start where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decoded frame by frame by the dictionary of its first frame."""
    if archive[:4] != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    size = int.from_bytes(archive[4:8], "little")
    own = archive[8:8 + size]
    if len(own) != size:
        raise ValueError("the dictionary frame is cut off")
    if own[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may be a frame itself
        own = zstandard.decompress(own)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own) if own else None)
    at = 8 + size
    while at < len(archive):
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            if not (chunk := archive[at:at + CHUNK]):
                raise ValueError("the last frame is cut off")
            out.append(frame.decompress(chunk))
            at += len(chunk) - len(frame.unused_data)
        yield b"".join(out)


def _files(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_archives(records: DataFrame, folder: str, dictionary: bytes, limit: int = ARCHIVE) -> None:
    """Write rows (page_id, url, payload, refers_to, sha) as archives into ``folder``/archives."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _files(folder)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        head = DICTIONARY_FRAME + len(dictionary).to_bytes(4, "little") + dictionary
        names, held, size = [], [head], 0

        def close() -> None:
            nonlocal held, size
            names.append(f"{uuid.uuid4().hex}.warc.zst")
            with store.open_output_stream(f"{root}/written/{names[-1]}", compression=None) as f:
                for part in held:
                    f.write(part)
            held, size = [head], 0

        for batch in batches:
            for r in batch.to_pylist():
                held.append(packer.compress(record(r["page_id"], r["url"], r["payload"], r["refers_to"], r["sha"])))
                size += len(held[-1])
                if size >= limit:
                    close()
        if size:
            close()
        yield pa.RecordBatch.from_pydict({"name": names}, schema=pa.schema([("name", pa.string())]))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _files(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                to = f"{root}/archives/{name}"
                if store.get_file_info(to).type == pyarrow.fs.FileType.NotFound:  # else an earlier attempt has moved it
                    store.move(f"{root}/written/{name}", to)
            yield batch

    store, root = _files(folder)
    for part in ("written", "archives"):
        store.create_dir(f"{root}/{part}")
    materialize(materialize(records.mapInArrow(write, "name string"), "archive-names").mapInArrow(move, "name string"), "archives-moved")


READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, error string"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives at ``path``; a record that fails its checks has an ``error`` only,
    and so has, once, what follows a damaged frame of an archive."""
    names = [c.split()[0] for c in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows = []
                try:
                    for data in frames(archive.as_py()):
                        try:
                            row = parse(data)
                        except ValueError as e:
                            row = {"error": str(e)}
                        rows.append(row if payloads else row | {"payload": None})
                except (ValueError, zstandard.ZstdError) as e:
                    rows.append({"error": f"damaged archive: {e}"})
                yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(spark.createDataFrame([], READ).schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select("content").mapInArrow(run, READ)


def archive_pages(pages: DataFrame, folder: str) -> str:
    """Write the pages as archives, equal payloads once; returns the archives' folder."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("hex", F.sha1("payload"))
    shared = p.groupBy("hex").agg(F.max("page_id").alias("whole"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    told = p.join(shared, "hex", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("whole")), F.col("whole")))
    sample = (p.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_PAGES))
    texts = p.join(F.broadcast(sample), "page_id").select(F.substring("payload", 1, TRAIN_BYTES).alias("t")).limit(TRAIN_PAGES)
    dictionary = train_dictionary(sorted(bytes(r["t"]) for r in texts.collect()))  # TRAIN_PAGES x TRAIN_BYTES at most
    named = with_base32(told)
    write_archives(named, folder, dictionary)
    return f"{folder}/archives"


def with_base32(told: DataFrame) -> DataFrame:
    """The SHA-1 as base32, from its hex digits: five bits a letter."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    part = lambda k: F.lpad(F.conv(F.substring("hex", 10 * k + 1, 10), 16, 2), 40, "0")
    five = lambda b: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(
        letters, F.conv(F.substring(b, i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1)))
    return told.withColumn("sha", F.array_join(F.concat(*[five(part(k)) for k in range(4)]), "")).select("page_id", "url", "payload", "refers_to", "sha")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back, over the whole ``pages``."""
    at = archive_pages(load(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archives(spark, at, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")

"""WARC archives in Zstandard with an embedded dictionary.

An archive starts with a skippable frame that holds a dictionary built from records of that archive;
then each record is a frame of its own, compressed with it, so any record can be read alone.
A payload that several pages share is stored once: in the page with the largest id; the other pages
become revisit records that name it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import exact_ids, frame_of, fresh_path, map_slices, stored

MAGIC = 0x184D2A5D
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
ROLL_BYTES = 32 << 20
TASK_BYTES = 64 << 20
#: Shared payloads (about 80 bytes each) that a task may hold; beyond that, pages are joined to them by digest and salt.
MAX_HELD = 200_000
SALT = 32
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}/{digest}'.encode()).digest())}>"


def b32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = b32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url:
        head.append(f"WARC-Target-URI: {one_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on an even sample of the records, of each at most its first 64 KiB; the first bytes of records where that is too little.

    The sample decides how well records compress, never what they hold.
    """
    size = sum(map(len, records))
    stride = max(1, -(-size // SAMPLE_BYTES))
    sample = [r[: 64 << 10] for r in records[::stride]]
    try:
        if len(sample) >= 16:
            return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, sample)) // 8)), sample, k=512, d=8)
    except zstandard.ZstdError:
        pass
    return zstandard.ZstdCompressionDict(b"".join(r[:4096] for r in sample[:16])[:DICT_BYTES].ljust(64, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def build_archive(records: list[bytes]) -> bytes:
    words = build_dictionary(records)
    out = io.BytesIO()
    raw = words.as_bytes()
    out.write(struct.pack("<II", MAGIC, len(raw)))
    out.write(raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=True, write_checksum=True)
    for r in records:
        out.write(packer.compress(r))
    return out.getvalue()


def read_records(source: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, as a stream."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != MAGIC:
        raise ValueError("the archive doesn't start with a dictionary frame")
    raw = source.read(size)
    trained = raw[:4] == struct.pack("<I", 0xEC30A437)
    words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=words).stream_reader(source, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name] = value.strip()
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        yield fields, block


def filesystem(uri: str):  # noqa: ANN201
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write all pages; the table of archives (path, records, bytes), stored, so that archives are written once.

    Digests are counted before they move.  The digests that several pages share are held by each task if
    there are at most ``MAX_HELD``, and then no payload moves: pages are written in the order of their
    scan.  Otherwise pages move once, by digest and salt, to a partition for each ``TASK_BYTES`` of
    payloads, so that a frequent payload fills no task.  An archive's name has its task attempt in it;
    archives of lost attempts are in no row of the table and are never read.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    digest = F.unhex(F.sha1(payload.cast("binary")))
    shareable = F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes)
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("html"), digest.alias("digest"))
    rows = plain.withColumn("digest", F.when(shareable, F.col("digest")))
    counted = rows.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("least"), F.max("page_id").alias("refers_to"))
    first = stored(counted.where("least < refers_to").select("digest", "refers_to"), "shared-payloads")
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    tasks = int(max(pages.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))
    if first.count() <= MAX_HELD:
        joined = rows.join(F.broadcast(first), "digest", "left").coalesce(tasks)  # fewer tasks only: else small ones make small archives
    else:
        salt = F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int")
        salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = rows.withColumn("salt", F.coalesce(salt, F.lit(0))).repartition(tasks, "digest", "salt").join(salted.repartition(tasks, "digest", "salt"), ["digest", "salt"], "left")
    marked = joined.select("page_id", "url", "html", F.when(F.col("page_id") != F.col("refers_to"), F.col("refers_to")).alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        disk, root = filesystem(folder)
        disk.create_dir(root, recursive=True)
        records: list[bytes] = []
        size = number = 0

        def roll() -> pd.DataFrame:
            nonlocal records, size, number
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.zst"
            data = build_archive(records)
            with disk.open_output_stream(f"{root}/{name}.part", compression=None) as f:
                f.write(data)
            disk.move(f"{root}/{name}.part", f"{root}/{name}")
            found = pd.DataFrame({"path": [f"{folder}/{name}"], "records": [len(records)], "bytes": [len(data)]})
            records, size, number = [], 0, number + 1
            return found

        for pdf in batches:
            for page_id, url, html, ref in zip(exact_ids(pdf["page_id"]), pdf["url"], pdf["html"], exact_ids(pdf["refers_to"]), strict=True):
                records.append(build_record(page_id, url if isinstance(url, str) else None, html.encode("utf-8", "replace"), ref))
                size += len(records[-1])
                if size >= ROLL_BYTES:
                    yield roll()
        if records:
            yield roll()

    return stored(map_slices(marked, write, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of the archives named in the column ``path``; digests and sizes are of what was read.

    A revisit's size and digest come from the HTTP and WARC fields that it carries for the full payload.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                disk, at = filesystem(path)
                rows = []
                with disk.open_input_stream(at, compression=None) as source:
                    for fields, block in read_records(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))
                        if kind == "response" and (b32_sha1(payload), len(payload)) != (digest, size):
                            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                        page, ref = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                        rows.append((page and int(page), size, digest, kind, ref and int(ref), fields.get("WARC-Target-URI")))
                yield frame_of(rows, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"], ("page_id", "refers_to"))

    return map_slices(archives.select("path"), read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string")


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write every page to archives in the shared folder and read them back: one row per page.

    A null html counts as empty.  A page without an id is a response of its own; ids of any size are exact.
    Repeated rows of the largest id of a payload are all responses.  A very long page is one record, in an
    archive that may exceed ROLL_BYTES by it.  An empty table gives no archive and no row.  Other columns,
    whatever their names, are neither read nor kept.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, id_col, url_col, html_col, min_bytes))

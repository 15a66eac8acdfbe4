"""Web archives (WARC 1.1): records written as gzip members, read back by byte ranges.

Writing. Every row is one record in a gzip member of its own. Rows of equal payloads (compared by
length and SHA-256) of at least ``min_bytes`` are one resource: the row of the largest key is its
``response``, all others are ``revisit`` records without the payload that refer to it. A first scan
finds the payloads that occur more than once; where these are few (``sent``, counted) they are sent to the
rows, else rows and payloads meet in a join, whose hot keys Spark parts by itself. A task writes files
of its own names; the manifest, a table written by Spark, lists those of the attempts that count,
so that a repeated attempt or a lost executor leaves no record twice.

Reading. Archives are cut into byte ranges, each read by a task that opens the file where it needs it.
A range looks for gzip magic, decodes the header of what may be a member, and trusts it when it and all
members after it are whole up to the end of the range; it owns the records that start inside, the last
one to its end beyond the range. Where no candidate holds (a member longer than the range, or damage), the
members are walked from the start of the file instead. What would deceive a range is a stretch of
whole WARC members stored inside a payload that outlasts the range. Checksums of members and digests of payloads
are checked: damage stops the job, or with ``on_damage="skip"`` gives a row of type ``damaged``, and
reading goes on at the next whole member.

Files are opened through ``pyarrow.fs``, which knows local (shared) folders, HDFS and object stores.

Defined cases: a null or empty text is an empty payload, a record like any other; a null key stands
below all others and its field is left out, where all keys of a payload are null each of its rows is a response; rows
that share the largest key of their payload are all responses (so are equal rows); a null address
becomes ``about:blank``, blanks and control characters in one are percent-encoded; an empty
table gives an empty manifest and no records; bytes that are no UTF-8 are archived as they are; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.llm.common import map_batches, strings, written
from plumbline.scratch import scratch_path

#: Payloads that occur more than once, as many as are sent to all rows (about 100 bytes each).
SENT = 200_000
FILE_BYTES = 1 << 30
RANGE_BYTES = 32 << 20
CHUNK = 1 << 18
#: A record's header ends within this many bytes, or the member is none of ours.
HEADER_BYTES = 1 << 16

#: Fixed by the formats.
MAGIC = b"\x1f\x8b\x08"
EOL, END = b"\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

KEY_FIELD, REFERS_FIELD = "X-Source-Key", "X-Refers-To-Source-Key"
_ADDRESS = "".join(map(chr, range(0x21, 0x7F)))

MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("records", T.LongType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("refers_to_key", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    ]
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {digest}')}>"


def head(first: str, fields: list[tuple[str, str]]) -> bytes:
    return "".join([first, "\r\n", *(f"{n}: {v}\r\n" for n, v in fields), "\r\n"]).encode()


def record(key: str | None, url: str | None, payload: bytes, refers: str | None, date: str) -> bytes:
    """A response, or with ``refers`` a revisit of the response of that key."""
    digest = digest_of(payload)
    block = head(
        "HTTP/1.1 200 OK",
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
    )
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "about:blank", safe=_ADDRESS)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if key is not None:
        fields.append((KEY_FIELD, quote(key, safe="")))
    if refers is None:
        block += payload
    else:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers, digest)),
            (REFERS_FIELD, quote(refers, safe="")),
        ]
    fields.append(("Content-Length", str(len(block))))
    return head("WARC/1.1", fields) + block + END


class Archive:
    """The files one task writes, a new one whenever the last is full."""

    def __init__(self, folder: str, file_bytes: int):
        self.files, self.root = pafs.FileSystem.from_uri(folder)
        self.folder, self.file_bytes = folder, file_bytes
        self.out, self.done = None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{uuid.uuid4().hex}.warc.gz"
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.size = self.records = 0
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.out.write(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.size, self.records))
            self.out = None


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tasks need it."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def write_archives(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    folder: str | None = None,
    min_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    date: datetime | None = None,
    sent: int = SENT,
) -> DataFrame:
    """Writes a record a row below ``folder`` (else the scratch folder); the manifest ``path, bytes, records``."""
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    pafs_root, place = pafs.FileSystem.from_uri(folder)
    pafs_root.create_dir(place, recursive=True)
    when = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(html).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("content", F.struct(F.octet_length("payload").alias("n"), F.unhex(F.sha2("payload", 256)).alias("h")))
    repeated = written(
        rows.where(F.col("content.n") >= min_bytes)
        .groupBy("content")
        .agg(F.max("key").alias("top"), F.count(F.lit(1)).alias("times"))
        .where("times > 1 AND top IS NOT NULL")
        .select("content", "top"),
        "warc_repeated",
    )
    few = repeated.limit(sent + 1).count() <= sent
    joined = rows.join(F.broadcast(repeated) if few else repeated, "content", "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "payload",
        F.when(~F.col("key").eqNullSafe(F.col("top")), F.col("top").cast("string")).alias("refers"),
    )

    def make():
        archive = Archive(folder, file_bytes)

        def work(batch):
            if batch is None:
                archive.close()
                paths, sizes, records = zip(*archive.done) if archive.done else ((), (), ())
                return {"path": paths, "bytes": sizes, "records": records}
            columns = strings(batch.column(0)), strings(batch.column(1)), batch.column(2), strings(batch.column(3))
            for name, address, data, refers in zip(*columns):
                archive.add(record(name, address, data.as_py(), refers, when))
            return None

        return work

    manifest = map_batches(joined, make, MANIFEST, finish=True, as_stored=True)
    manifest.write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``path, bytes`` of the archives below a folder, from wherever they come."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.warc.gz")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", F.col("length").alias("bytes"))
    )


class Damaged(Exception):
    """Bytes that are no whole member with a WARC record."""


class Members:
    """The gzip members of one file."""

    def __init__(self, path: str):
        files, place = pafs.FileSystem.from_uri(path)
        self.path, self.file = path, files.open_input_file(place)
        self.size = self.file.size()

    def read(self, at: int, n: int = CHUNK) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def member(self, at: int, keep: bool) -> tuple[bytes, int]:
        """The member's content (its first bytes if it is not kept) and where the next one starts."""
        unpack, parts, begun = zlib.decompressobj(31), [], False
        while not unpack.eof:
            data = self.read(at)
            if not data:
                raise Damaged("ends early")
            try:
                part = unpack.decompress(data)
            except zlib.error as error:
                raise Damaged(str(error)) from None
            if part and not begun:
                begun = True
                if not b"WARC/1.".startswith(part[:7]):
                    raise Damaged("no record")
            if keep:
                parts.append(part)
            at += len(data)
        if not begun:
            raise Damaged("no record")
        return b"".join(parts), at - len(unpack.unused_data)

    def candidates(self, begin: int, end: int) -> Iterator[int]:
        """Places of gzip magic from begin on and before end whose content starts like a record."""
        at = begin
        while at < end:
            data = self.read(at, CHUNK + len(MAGIC) - 1)
            found = data.find(MAGIC)
            while 0 <= found < CHUNK:
                if at + found < end and self.header(at + found):
                    yield at + found
                found = data.find(MAGIC, found + 1)
            at += CHUNK

    def header(self, at: int) -> bool:
        try:
            return zlib.decompressobj(31).decompress(self.read(at, 4096), 64).startswith(b"WARC/1.")
        except zlib.error:
            return False

    def holds(self, at: int, end: int) -> bool:
        """Whether whole members follow each other from here to the end of the range."""
        try:
            while at < end:
                at = self.member(at, keep=False)[1]
        except Damaged:
            return False
        return True

    def next_whole(self, at: int) -> int:
        """The next place that starts a whole member, or the file's end."""
        for found in self.candidates(at, self.size):
            try:
                self.member(found, keep=False)
            except Damaged:
                continue
            return found
        return self.size

    def first(self, begin: int, end: int, skip: bool) -> int:
        """Where the first record that the range owns starts."""
        if begin == 0:
            return 0
        for found in self.candidates(begin, end):
            if self.holds(found, end):
                return found
        at = 0
        while at < begin:
            try:
                at = self.member(at, keep=False)[1]
            except Damaged as why:
                if not skip:
                    raise ValueError(f"{self.path} is damaged at {at}: {why}") from None
                at = self.next_whole(at + 1)
        return at

    def owned(self, begin: int, end: int, skip: bool) -> Iterator[tuple[int, bytes | Damaged]]:
        end = min(end, self.size)
        at = self.first(begin, end, skip)
        while at < end:
            try:
                data, after = self.member(at, keep=True)
                yield at, data
            except Damaged as why:
                yield at, why
                after = self.next_whole(at + 1)
            at = after


def fields_of(lines: bytes) -> dict[str, str]:
    """Header lines as a map, with continued lines joined."""
    out, last = {}, None
    for line in lines.split(EOL)[1:]:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:
            out[last] += " " + text.strip()
        elif ":" in text:
            last, value = text.split(":", 1)
            out[last] = value.strip()
    return out


def parsed(data: bytes) -> dict:
    """A record's columns."""
    at = data.find(END, 0, HEADER_BYTES)
    if at < 0:
        raise Damaged("no header")
    fields = fields_of(data[:at])
    low = {n.lower(): v for n, v in fields.items()}
    size = low.get("content-length", "")
    block = data[at + len(END) :]
    if not size.isdecimal() or block[int(size) :] != END:
        raise Damaged("length and content differ")
    payload = block[: int(size)]
    kind_, claimed = low.get("warc-type"), low.get("warc-payload-digest", "")
    http: dict[str, str] = {}
    if low.get("content-type", "").startswith("application/http") and END in payload:
        lines, payload = payload.split(END, 1)
        http = {n.lower(): v for n, v in fields_of(lines).items()}
    claimed = claimed.removeprefix("sha1:") if claimed.startswith("sha1:") else None
    if kind_ == "revisit":
        length = http.get("content-length", "")
        n, digest, payload = int(length) if length.isdecimal() else None, claimed, None
    else:
        n, digest = len(payload), digest_of(payload)
        if claimed and claimed.upper() != digest:
            raise Damaged("digest and payload differ")
    key, refers = low.get(KEY_FIELD.lower()), low.get(REFERS_FIELD.lower())
    return {
        "record_type": kind_,
        "record_id": low.get("warc-record-id"),
        "target_uri": low.get("warc-target-uri"),
        "key": None if key is None else unquote(key),
        "refers_to_key": None if refers is None else unquote(refers),
        "payload_bytes": n,
        "payload_digest": digest,
        "headers": list(fields.items()),
        "payload": payload,
    }


def read_archives(
    spark: SparkSession,
    archives: DataFrame,
    range_bytes: int = RANGE_BYTES,
    on_damage: str = "fail",
    with_payload: bool = True,
) -> DataFrame:
    """A row per record of the archives (``path, bytes``): its place, fields, digest and payload.

    Of a revisit, ``payload`` is null, its length and digest are those of the payload it stands for.
    """
    if on_damage not in ("fail", "skip"):
        raise ValueError("on_damage is fail or skip")
    skip = on_damage == "skip"
    schema = T.StructType([*RECORD, *([T.StructField("payload", T.BinaryType())] if with_payload else [])])
    ranges = archives.where("bytes > 0").select(
        "path", F.explode(F.expr(f"sequence(0, bytes - 1, {range_bytes})")).alias("begin")
    )
    tasks = max(1, min(ranges.count(), 100_000))

    def make():
        def rows_of(path: str, begin: int) -> Iterator[dict]:
            for at, data in Members(path).owned(begin, begin + range_bytes, skip):
                row = dict.fromkeys(schema.names)
                try:
                    if isinstance(data, Damaged):
                        raise data
                    row |= parsed(data)
                except Damaged as why:
                    if not skip:
                        raise ValueError(f"{path} is damaged at {at}: {why}") from None
                    row |= {"record_type": "damaged", "headers": [("damage", str(why))]}
                yield row | {"path": path, "offset": at}

        def work(batch):
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, size = [], 0
                for row in rows_of(path, begin):
                    held.append(row)
                    size += 500 + (len(row.get("payload") or b"") if with_payload else 0)
                    if size > 16 << 20:
                        yield {n: [r[n] for r in held] for n in schema.names}
                        held, size = [], 0
                if held:
                    yield {n: [r[n] for r in held] for n in schema.names}

        return work

    return map_batches(ranges.repartition(tasks), make, schema, as_stored=True)

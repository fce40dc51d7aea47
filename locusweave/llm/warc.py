"""Operator 6: WARC archives with revisit records, and a salvage reader."""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, materialise, table

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: A writer starts a new file after so many compressed bytes.
ROLL = 64 << 20
CHUNK = 1 << 16
#: Bytes that a member gives at a time.
BLOCK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
MARK = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
#: Rows that refer back up to which their table is broadcast (under 50 MB).
MOST_REFERENTS = 300_000
URL_SAFE = "!#$%&'()*+,/:;=?@[]~"


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit that has the HTTP head only."""
    revisit = refers_to is not None
    block = HTTP % len(payload) + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {urllib.parse.quote(url or '', safe=URL_SAFE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_32(block)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    pass


@dataclass
class Salvage:
    """What a reader found: records are yielded; gaps are (byte offset, length, reason) of what it had to leave out."""

    gaps: list[tuple[int, int, str]] = field(default_factory=list)


class _Window:
    """The bytes of a stream from `base` on, as far as they have been asked for."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.base, self.data, self.over = read, 0, bytearray(), False

    def more(self) -> bool:
        got = b"" if self.over else self.read(CHUNK)
        self.over = self.over or not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.base += n


def parse(data: bytes, start: int, final: bool) -> tuple[dict, bytes, int] | int:
    """Headers, block and end of the record at `start`; if more bytes are needed (never when `final`), how many there must be."""
    end = data.find(b"\r\n\r\n", start)
    if end < 0:
        if final or len(data) - start > CHUNK:
            raise Damaged("no end of the headers")
        return len(data) + 1
    head = bytes(data[start:end]).split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d", head[0]):
        raise Damaged("no version line")
    fields = {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, sep, v in (x.partition(b":") for x in head[1:]) if sep}
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no length")
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Damaged("no type or id")
    stop = end + 4 + int(fields["content-length"])
    if len(data) < stop + 4:
        if final:
            raise Damaged("cut short")
        return stop + 4
    block = bytes(data[end + 4 : stop])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    want = fields.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != sha1_32(block):
        raise Damaged("wrong block digest")
    return fields, block, stop + 4


class _Member:
    """The gzip member at the window's start: its records that pass all checks, as they come out of the inflater.

    After a failed check the search goes on at the next version line; `lost` counts the bytes of content between, `why` says what
    failed first. `broken` says why the member itself is damaged. Raw bytes are dropped once a record behind them has passed
    its checks: the search after a fault starts from there, or from the member's start if it gave none. Content is held up to the
    end of one record; one that states too great a length holds what is left of its member.
    """

    def __init__(self, window: _Window):
        self.window, self.start, self.engine = window, window.base, zlib.decompressobj(31)
        self.content, self.need, self.found, self.lost = bytearray(), 0, 0, 0
        self.why, self.broken, self.size = "", "", 0

    def _parsed(self, final: bool) -> Iterator[tuple[dict, bytes]]:
        at = self.need = 0
        while at < len(self.content):
            try:
                got = parse(self.content, at, final)
            except Damaged as e:
                self.why = self.why or str(e)
                begin = self.content.find(b"WARC/1.", at + 1)
                if begin < 0:
                    begin = len(self.content) if final else max(at + 1, len(self.content) - len(b"WARC/1"))
                self.lost, at = self.lost + begin - at, begin
                continue
            if isinstance(got, int):
                self.need = got - at
                break
            self.found, at = self.found + 1, got[2]
            yield got[:2]
        del self.content[:at]

    def records(self) -> Iterator[tuple[dict, bytes]]:
        fed, over = 0, False
        while not self.engine.eof and not over:
            piece = bytes(self.window.data[fed : fed + CHUNK])
            if not piece:
                if self.window.more():
                    continue
                over = True
            before, rest = self.found, piece
            while rest or over:
                saved = self.engine.copy()
                try:
                    self.content += self.engine.flush() if over else self.engine.decompress(rest, BLOCK)
                except zlib.error as e:
                    self.broken = str(e)
                    self.content += _up_to_fault(saved, rest)
                rest = self.engine.unconsumed_tail
                done = over or self.engine.eof or bool(self.broken)
                if done or len(self.content) >= self.need:
                    yield from self._parsed(done)
                if done:
                    break
            if self.broken:
                return
            if self.found > before:
                self.window.drop(fed)
                fed = 0
            fed += len(piece)
        self.size = fed - len(self.engine.unused_data)
        self.broken = "" if self.engine.eof else "cut short"


def _up_to_fault(engine, data: bytes) -> bytes:
    """What comes out of `data` before the fault that is known to be in it."""
    out = []
    for lo in range(0, len(data), 256):
        try:
            out.append(engine.decompress(data[lo : lo + 256]))
        except zlib.error:
            break
    return b"".join(out)


def _seek(window: _Window) -> int:
    """Bytes from the window's start to where, after its first byte, the next member or record may begin; all it has if nowhere."""
    if found := MARK.search(window.data, 1):
        return found.start()
    if not window.more():
        return len(window.data)
    return max(1, len(window.data) - CHUNK - len(b"WARC/1."))


def read_records(read: Callable[[int], bytes], log: Salvage, peek: Callable[[int, int], bytes] | None = None) -> Iterator[tuple[dict, bytes]]:
    """Records of an archive, compressed by members or plain. After a failed check the reader goes to the next member or
    version line from which a record can be read, and logs the bytes between as one quarantined gap.

    A record that passes its checks stands, whatever its payload holds, be it records; only a failed check brings one inside it
    forward. `peek(n, offset)` gives n bytes of a file that can be read at any place: with it a plain record whose stated end is
    not followed by the record's closing lines fails at once. Without it the reader has to hold such a record up to that end.
    """
    window, lost, why = _Window(read), 0, ""

    def close() -> None:
        nonlocal lost
        if lost:
            log.gaps.append((window.base - lost, lost, why))
        lost = 0

    while window.data or window.more():
        while len(window.data) < 8 and window.more():
            pass
        packed = window.data.startswith(MAGIC[:2])
        try:
            if packed:
                member = _Member(window)
                for found in member.records():
                    close()
                    yield found
                if member.broken or (member.lost and not member.found):  # where a broken member ends is for the search to find
                    raise Damaged(member.broken or member.why)
                close()
                if member.lost:
                    log.gaps.append((member.start, window.base + member.size - member.start, f"{member.lost} bytes inside the member: {member.why}"))
                size = member.size
            else:
                while isinstance(got := parse(window.data, 0, window.over), int):
                    if peek and got > len(window.data) + CHUNK and peek(4, window.base + got - 4) != b"\r\n\r\n":
                        raise Damaged("wrong length")
                    while len(window.data) < got and window.more():
                        pass
                close()
                yield got[:2]
                size = got[2]
        except Damaged as e:
            why = why if lost else str(e)
            skip = _seek(window)
            lost += skip
            window.drop(skip)
            continue
        window.drop(size)
    close()


def _open(path: str):
    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path)
    return where, inner


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        where.create_dir(root, recursive=True)
        out, name, size, done = None, "", 0, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(k).to_pylist() for k in ("page_id", "url", "html", "refers_to")), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                data = member(record(page_id, url, payload, sha1_32(payload), refers_to))
                if out is not None and size + len(data) > ROLL:
                    out.close()
                    done.append(name)
                    out = None
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = where.open_output_stream(f"{root}/{name}", compression=None)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            done.append(name)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in done], pa.string())], ["path"])

    return run


def _number(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, gap_offset long, gap_bytes long, gap_reason string"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in ROW.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in ROW.split(", ")]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            where, inner = _open(path)
            log, rows = Salvage(), []
            with where.open_input_file(inner) as stream:
                end = stream.size()
                peek = lambda n, at: stream.read_at(n, at) if at + n <= end else b""  # noqa: B023, E731
                for fields, block in read_records(stream.read, log, peek):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    kind, page = fields.get("warc-type"), _number(fields.get("warc-record-id"))
                    if kind == "response" and digest and sha1_32(payload) != digest:
                        rows.append((None, None, None, None, None, path, None, len(block), f"wrong payload digest of {fields.get('warc-record-id')}"))
                        continue
                    size = re.search(rb"(?i)content-length: *(\d+)", head)
                    rows.append((page, int(size[1]) if kind == "revisit" and size else len(payload), digest, kind, _number(fields.get("warc-refers-to")), path, None, None, None))
                    if len(rows) >= 5000:
                        yield pack(rows)
                        rows = []
            rows += [(None, None, None, None, None, path, *gap) for gap in log.gaps]
            if rows:
                yield pack(rows)


def with_referents(pages: DataFrame, least: int = 0) -> DataFrame:
    """Adds refers_to: for each page but the first (smallest page_id) of those with an equal payload of `least` bytes or more, that first one.

    Payloads meet by digest and length, and only those go through a shuffle: rows that refer back are joined to the pages by
    page and digest, by broadcast while they are few. A digest that a third of all pages share is counted map-side first.
    """
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
    keyed = pages.withColumn("__size", size).withColumn("__sha", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")))
    slim = materialise(keyed.select("page_id", "__sha", "__size"), "warc-digests")
    twice = slim.where(F.col("__size") >= least).groupBy("__sha", "__size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    back = materialise(slim.join(twice, ["__sha", "__size"]).where("page_id > refers_to").distinct(), "warc-referents")
    back = F.broadcast(back) if back.count() <= MOST_REFERENTS else back
    return keyed.join(back, ["page_id", "__sha", "__size"], "left").drop("__sha", "__size")


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) as gzipped archives under `folder`; returns the table of their paths.

    A task names its files by itself and reports them when it is done, so files of a lost or repeated task are never read.
    Null html is an empty payload. Rows that repeat the smallest page_id of their payload are responses too. A null page_id
    is never referred to and is always a response.
    """
    return materialise(with_referents(pages.select("page_id", "url", "html"), least).mapInArrow(_writer(folder), "path string"), "warc-paths")


def read_archives(paths: DataFrame) -> DataFrame:
    """One row per record read, and one with gap_reason per quarantined gap. Files are streamed; each row of `paths` is one."""
    return paths.mapInArrow(_reader, ROW)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = write_archives(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    tasks = max(1, min(1000, spark.sparkContext.defaultParallelism * 4))
    lost = F.raise_error(F.concat(F.lit("quarantined bytes in an archive just written: "), F.coalesce("gap_reason", F.lit(""))))
    rows = read_archives(paths.repartition(tasks)).withColumn("page_id", F.when(F.col("gap_reason").isNotNull(), lost.cast("long")).otherwise(F.col("page_id")))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM p
), b AS (
  SELECT *, list_reduce(list_transform(range(1, 33), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0b' || substr(bits, 5 * i - 4, 5)) AS INTEGER), 1)), lambda x, y: x || y) AS payload_digest
  FROM (SELECT *, list_reduce(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(hex, i, 1) AS INTEGER)), 4, '0')), lambda x, y: x || y) AS bits FROM f)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM b
"""

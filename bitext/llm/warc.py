"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

Writing.  Each page is one record in a gzip member of its own.  Of pages with
equal payloads of at least ``min_bytes`` the one with the largest id holds the
payload, the others are ``revisit`` records that name it.  Members are saved by
Spark's own text writer, so files appear only when a task commits and a lost
executor leaves no half archive: the writer ends each row with a separator, and
a zero byte is the last byte of every gzip member below 16 MiB (the high byte of
its length field), so a row holds the member without that byte and the separator
puts it back.  Longer members get an empty member after them, which ends so too.

Reading.  Every check that fails (gzip checksum, version line, header fields,
record length, payload digest) quarantines bytes up to the next place where a
valid member, or outside gzip a version line, starts; later records of the file
are recovered, and each gap is logged as a row of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.llm.common import map_slices, pick

MIN_REVISIT_BYTES = 1000
#: Payload bytes that an archive file holds on average, at most.
ARCHIVE_BYTES = 24 << 20
_GZIP = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_READ = 1 << 14  # compressed bytes handed to zlib at a time
_EMPTY_MEMBER = zlib.compress(b"", wbits=31)
_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_DATE = "2024-01-01T00:00:00Z"  # records are dated alike: the same pages give the same archive


# ---- one record -------------------------------------------------------------


def _fields(pairs: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs).encode()


def record_uri(page_id: int | None) -> str:
    """A record id made from the page id, so that a revisit can name its response."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _one_line(url: str | None) -> str:
    return re.sub(r"[\r\n]+", " ", url or "").strip()


def build_record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    kind = "response" if refers_to is None else "revisit"
    block = http + (payload if refers_to is None else b"")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if refers_to is not None:
        head += [
            ("WARC-Refers-To", record_uri(refers_to)),
            ("X-Refers-To-Page-ID", str(refers_to)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + block + _END


def gzip_member(data: bytes, level: int = 4) -> bytes:
    """A gzip member that ends in a zero byte."""
    packer = zlib.compressobj(level, wbits=31)
    member = packer.compress(data) + packer.flush()
    return member if member[-1] == 0 else member + _EMPTY_MEMBER


# ---- reading one file -------------------------------------------------------


class Bad(Exception):
    """A check failed; the text says which."""


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at`` and where it ends; ``Bad`` if a check fails."""
    if not _VERSION.match(data, at):
        raise Bad("version line")
    end = data.find(_END, at)
    if end < 0:
        raise Bad("header end")
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("header field")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not (size := head.get("content-length", "")).isdigit():
        raise Bad("content length")
    start = end + len(_END)
    stop = start + int(size)
    if data[stop : stop + 4] != _END:
        raise Bad("record length")
    block = data[start:stop]
    if (said := head.get("warc-block-digest", "")).startswith("sha1:"):
        if base64.b32encode(hashlib.sha1(block).digest()).decode() != said[5:]:
            raise Bad("block digest")
    payload = None
    if head.get("warc-type") == "response":
        cut = block.find(_END)
        payload = block[cut + len(_END) :] if cut >= 0 else block
        if (said := head.get("warc-payload-digest", "")).startswith("sha1:"):
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != said[5:]:
                raise Bad("payload digest")
    return {"head": head, "payload": payload}, stop + len(_END)


def _plain(data: bytes) -> Iterator[tuple]:
    """('record', start, end, record) and ('gap', start, end, reason) of uncompressed bytes."""
    at = 0
    while at < len(data):
        try:
            got, end = parse_record(data, at)
            yield "record", at, end, got
            at = end
        except Bad as why:
            nxt = next((m.start() for m in _VERSION.finditer(data, at + 1)), len(data))
            yield "gap", at, nxt, str(why)
            at = nxt


def salvage(data: bytes) -> Iterator[tuple]:
    """All records of an archive file, and the byte gaps that no check passed.

    Offsets are those of the file.  Adjoining gaps are logged as one, with the
    reason of the first.
    """
    held = None

    def walk():
        at = 0
        while at < len(data):
            if data[at : at + 3] != _GZIP:
                # a plain record may hold members: only a failed check starts a search
                try:
                    got, end = parse_record(data, at)
                    yield "record", at, end, got
                except Bad as why:
                    end = _next_start(data, at + 1)
                    yield "gap", at, end, str(why)
                at = end
                continue
            body, end, why = _member(data, at)
            if body is None:
                end = _next_start(data, at + 1)
                yield "gap", at, end, why
            elif body:
                for kind, _, _, x in _plain(body):
                    yield kind, at, end, x
            at = end

    for kind, a, b, x in walk():
        if kind == "gap" and held and held[2] == a:
            held = ("gap", held[1], b, held[3])
            continue
        if held:
            yield held
            held = None
        if kind == "gap":
            held = (kind, a, b, x)
        else:
            yield kind, a, b, x
    if held:
        yield held


def _member(data: bytes, at: int) -> tuple[bytes | None, int, str]:
    """The member at ``at``: its content and end, or None and the reason."""
    unpack, body, pos = zlib.decompressobj(wbits=31), [], at
    try:
        while not unpack.eof and pos < len(data):
            body.append(unpack.decompress(data[pos : pos + _READ]))
            pos += _READ
    except zlib.error:
        return None, at, "gzip member"
    if not unpack.eof:
        return None, at, "gzip member cut short"
    return b"".join(body), min(pos, len(data)) - len(unpack.unused_data), ""


def _next_start(data: bytes, at: int) -> int:
    """The next valid member or version line."""
    version = _VERSION.search(data, at)
    stop = version.start() if version else len(data)
    while (at := data.find(_GZIP, at, stop)) >= 0:
        if _member(data, at)[0] is not None:
            return at
        at += 1
    return stop


# ---- Spark ------------------------------------------------------------------


def _row_key() -> Column:
    return F.coalesce("page_id", F.xxhash64("html")).alias("row_key")


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(row_key, held array<struct<sha1, holder>>) of pages whose payload another page holds.

    Works on ids and digests only.  A payload that very many pages share is one
    row on one side of a join that Spark splits when it is skewed.  ``row_key``
    is the id, or 64 bits of the payload where there is none.
    """
    rows = pages.select("page_id", _row_key(), F.octet_length("html").alias("size"), F.sha1(F.col("html").cast("binary")).alias("sha1"))
    rows = rows.where(F.col("size") >= min_bytes).select("page_id", "row_key", "sha1")
    shared = rows.groupBy("sha1").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n")
    others = rows.join(shared, "sha1").where("holder is not null and not page_id <=> holder")
    return others.groupBy("row_key").agg(F.collect_set(F.struct("sha1", "holder")).alias("held"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record per page below ``path``.

    Null html is an empty payload; a row without an id gives a record without
    one, which no revisit names: a revisit if a row with an id holds its payload,
    else a response.  Rows that repeat the holder's id are responses too; an empty
    table writes no record.
    """
    spark = pages.sparkSession
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("html", F.coalesce("html", F.lit("")))
    total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    # archives of a bounded size, dealt by id: the join needs no other shuffle of the
    # pages (at fewer partitions than its own, Spark would deal them again)
    archives = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // archive_bytes))
    dealt = rows.select("*", _row_key()).repartition(archives, "row_key")
    marked = dealt.join(revisits(rows, min_bytes).repartition(archives, "row_key"), "row_key", "left")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            members = []
            for page_id, url, html, held in zip(*[batch[c].to_pylist() for c in ("page_id", "url", "html", "held")]):
                body = html.encode()
                digest = hashlib.sha1(body).hexdigest()
                holder = next((x["holder"] for x in held or () if x["sha1"] == digest and x["holder"] != page_id), None)
                members.append(gzip_member(build_record(page_id, url, body, digest, holder))[:-1])
            return {"member": members}

        return run

    members = map_slices(marked.select("page_id", "url", "html", "held"), make, "member binary", 64)
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


READ_SCHEMA = (
    "file string, kind string, start long, stop long, reason string, page_id long, url string, "
    "record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Rows of kind 'record' and rows of kind 'gap' (``start`` to ``stop``: bytes of
    ``file`` that were quarantined, and why).  ``payload_digest`` is the bare
    lower-case hex SHA-1 of the full payload, also for revisits.

    ``payloads=False`` leaves the payload column null (all checks still run).
    """

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("file", "kind", "start", "stop", "reason", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")}
            for file, data in zip(batch["path"].to_pylist(), batch["content"]):
                for kind, a, b, x in salvage(data.as_py()):
                    head = {} if kind == "gap" else x["head"]
                    payload = None if kind == "gap" else x["payload"]
                    digest = head.get("warc-payload-digest", "")[5:]
                    size = head.get("x-payload-length") or (None if payload is None else str(len(payload)))
                    for name, value in (
                        ("file", file), ("kind", kind), ("start", a), ("stop", b), ("reason", x if kind == "gap" else None),
                        ("page_id", _number(head.get("x-page-id"))), ("url", head.get("warc-target-uri")),
                        ("record_type", head.get("warc-type")), ("refers_to", _number(head.get("x-refers-to-page-id"))),
                        ("payload_bytes", _number(size)),
                        ("payload_digest", base64.b32decode(digest).hex() if digest else None),
                        ("payload", payload if payloads else None),
                    ):
                        out[name].append(value)
            return out

        return run

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_slices(files, make, READ_SCHEMA, 1)


def _number(text: str | None) -> int | None:
    return int(text) if text else None

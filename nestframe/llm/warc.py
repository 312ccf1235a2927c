"""Writing web archives and reading them back, damaged ones included.

``write_warc`` writes a gzip member per record. ``read_warc`` reads such files, plain ones and mixtures. A record
counts if its version line, header, length, end and digest are right. Where one of these fails, the reader looks for
the next place from which a whole record can be read - a gzip member that unpacks with the right checksum, or a
version line with a record behind it - goes on there, and logs the bytes between as a gap. So each byte of a file is
part of a record, of an empty member or of one gap.

What can be unpacked of a damaged gzip member of several records is searched in the same way: its whole records count,
and the bytes between are gaps with their place inside the member. A damaged member of one record is one gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestframe.operators.durable import shared_path

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member of no bytes, which may stand between members. Text files need something between lines.
EMPTY_MEMBER = MAGIC + b"\0\0\0\0\0\0\x03\x03\0\0\0\0\0\0\0\0\0"
_START = re.compile(rb"WARC/\d\.\d\r?\n")
_FIELD = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+)[ \t]*:[ \t]*(.*)")

RECORD = (
    "path string, offset long, length long, gap string, type string, record_id string, uri string, refers_to string, "
    "digest string, payload_bytes long, payload binary, inner_offset long, inner_length long"
)


def mark_revisits(pages: DataFrame, id_column: str = "page_id", text_column: str = "html", least: int = 100) -> DataFrame:
    """``id, url, payload, digest, refers_to``: rows with a payload that a smaller id has refer to the smallest such id.

    Payloads of fewer than ``least`` bytes refer to none. Rows that share the smallest id all count as first; a null
    id refers to the others but nothing refers to it. A null text is empty.
    """
    payload = F.coalesce(F.col(text_column), F.lit(""))
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"),
        (F.col("url") if "url" in pages.columns else F.lit(None)).cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    # Minima of the digests are taken before any row is moved; only digests seen twice take part in the join.
    first = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("known"), "first")
    )
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    joined = rows.join(first, F.col("digest") == F.col("known"), "left")
    return joined.select("id", "url", "payload", "digest", refers.alias("refers_to"))


def write_warc(rows: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z", records_per_file: int = 5000) -> None:
    """Writes ``id, url, payload, digest, refers_to``, a record per row, as archives in the folder ``path``.

    Files go through Spark's text writer, so any store will do. Records of a file lie one after the other, with an
    empty gzip member between them. A file is read as a whole, which ``records_per_file`` bounds.
    """

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [gzip_member(record(*row, date)) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_pydict({"value": pa.array(made, pa.binary())})

    made = rows.select("id", "url", "payload", "digest", "refers_to").mapInArrow(members, "value binary")
    (
        made.select(F.col("value").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit that leaves the payload out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    uri = re.sub(r"[\r\n]", " ", url or "about:blank")
    fields = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}:{digest[:16]}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}:{digest[:16]}>"]
    return VERSION + b"\r\n" + "\r\n".join(fields).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record and per gap of the archives in ``path``; ``gap`` says why a gap is one, and is null in records.

    Offsets and lengths are bytes of the file as stored; records within one gzip member share its place. The payload
    is what follows the HTTP header, and null in revisits, whose ``payload_bytes`` comes from that header. A gap within a
    gzip member has its place in the unpacked bytes as ``inner_offset`` and ``inner_length``, the latter null where unpacking broke off.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for found in salvage(content.as_py()):
                    rows.append({"path": name, **found})
                    size += len(found.get("payload") or b"")
                    if size > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return files.mapInArrow(parse, RECORD)


_ARROW = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (part.split() for part in RECORD.split(", "))
    ]
)


def salvage(content: bytes) -> Iterator[dict]:
    """The records and gaps of an archive, in order."""
    at = 0
    while at < len(content):
        records, after, fault = unit(content, at)
        if fault is None:
            yield from ({"offset": at, "length": after - at, **found} for found in records)
            at = after
            continue
        # What was to be read ends where the next whole unit begins; its own end is tried first.
        onward = after if after is not None and (after == len(content) or unit(content, after)[2] is None) else None
        onward = next_valid(content, at + 1) if onward is None else onward
        inner = list(salvage_member(content[at:onward])) if content.startswith(MAGIC, at) else []
        if sum(found.get("inner_length", 1) is not None for found in inner) > 1 and any("gap" not in found for found in inner):
            yield from ({"offset": at, "length": onward - at, **found} for found in inner)
            at = onward
            continue
        yield {"offset": at, "length": onward - at, "gap": fault}
        at = onward


def salvage_member(member: bytes) -> Iterator[dict]:
    """The records and gaps of what can be unpacked of a gzip member; a gap has its place in the unpacked bytes."""
    data, fault = unpacked(member)
    at = 0
    while at < len(data):
        found, after, wrong = plain_record(data, at)
        if wrong is None:
            yield found
            at = after
            continue
        whole = lambda place: place == len(data) or plain_record(data, place)[2] is None
        if after is None or not whole(after):
            after = next((m.start() for m in _START.finditer(data, at + 1) if whole(m.start())), len(data))
        yield {"gap": wrong, "inner_offset": at, "inner_length": after - at}
        at = after
    if fault:  # what follows could not be unpacked
        yield {"gap": fault, "inner_offset": len(data), "inner_length": None}


def unpacked(member: bytes) -> tuple[bytes, str | None]:
    """What can be unpacked of a member, damaged or cut short, and what is wrong."""
    for step in (len(member), 1):  # an error takes all that its step would have given
        unpacker, data = zlib.decompressobj(31), []
        try:
            for begin in range(0, len(member), step):
                data.append(unpacker.decompress(member[begin : begin + step]))
                if unpacker.eof:
                    return b"".join(data), None
            return b"".join([*data, unpacker.flush()]), "gzip member cut short"
        except zlib.error as error:
            fault = f"gzip member broken: {str(error)[:60]}"
    return b"".join(data), fault


def next_valid(content: bytes, begin: int) -> int:
    """The next place from which a gzip member or a record can be read whole, or the end."""
    member, plain = content.find(MAGIC, begin), _START.search(content, begin)
    while member >= 0 or plain:
        if plain is None or 0 <= member < plain.start():
            place, member = member, content.find(MAGIC, member + 1)
        else:
            place = plain.start()
            plain = _START.search(content, place + 1)
        if unit(content, place)[2] is None:
            return place
    return len(content)


def unit(content: bytes, at: int) -> tuple[list[dict], int | None, str | None]:
    """Records of the gzip member or the record at a place, where it ends as far as known, and what is wrong."""
    if content[at : at + len(EMPTY_MEMBER)] == EMPTY_MEMBER:
        return [], at + len(EMPTY_MEMBER), None
    if content.startswith(MAGIC, at):
        unpacker = zlib.decompressobj(31)
        try:
            data, window = [], memoryview(content)
            for begin in range(at, len(content), 1 << 16):
                data.append(unpacker.decompress(window[begin : begin + (1 << 16)]))
                if unpacker.eof:
                    after = min(begin + (1 << 16), len(content)) - len(unpacker.unused_data)
                    break
            else:
                return [], None, "gzip member cut short"
        except zlib.error as error:
            return [], None, f"gzip member broken: {str(error)[:60]}"
        records, data, place = [], b"".join(data), 0
        while place < len(data):
            found, end, fault = plain_record(data, place)
            if fault:
                return [], after, fault
            records.append(found)
            place = end
        return records, after, None
    found, after, fault = plain_record(content, at)
    return [found] if fault is None else [], after, fault


def plain_record(data: bytes, at: int) -> tuple[dict | None, int | None, str | None]:
    start = _START.match(data, at)
    if not start:
        return None, None, "no version line"
    # Line by line, so that no more is read than up to the first fault.
    fields: dict[str, str] = {}
    place = start.end()
    while True:
        end = data.find(b"\n", place)
        if end < 0:
            return None, None, "header without end"
        line, place = data[place:end].removesuffix(b"\r"), end + 1
        if not line:
            break
        if line[:1] in (b" ", b"\t") and fields:
            last = next(reversed(fields))
            fields[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        field = _FIELD.fullmatch(line)
        if not field:
            return None, None, "header line broken"
        name = field[1].decode().lower()
        if name in fields and name != "warc-concurrent-to":
            return None, None, "header field twice"  # as where a record breaks off and another one follows
        fields[name] = field[2].strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,15}", fields.get("content-length", "")):
        return None, None, "no content length"
    begin = place
    after = begin + int(fields["content-length"])
    if after > len(data):
        return None, None, "block cut short"
    close = 4 if data.startswith(b"\r\n\r\n", after) else 2 if data.startswith(b"\n\n", after) else 0
    if not close:
        return None, None, "record end missing"
    block = data[begin:after]
    after += close
    if not {"warc-type", "warc-record-id", "warc-date"} <= fields.keys():
        return None, after, "required field missing"
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest")
    head, cut, payload = block.partition(b"\r\n\r\n") if "application/http" in fields.get("content-type", "") else (b"", b"", block)
    size = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d{1,15})", head)
    for claimed, data_of in ((fields.get("warc-block-digest"), block), (digest if kind != "revisit" else None, payload)):
        name, _, value = (claimed or "").partition(":")
        if name.lower() == "sha256" and hashlib.sha256(data_of).hexdigest() != value.lower():
            return None, after, "digest differs"
    whole = kind != "revisit"
    return (
        {
            "type": kind,
            "record_id": fields["warc-record-id"],
            "uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"),
            "digest": digest.partition(":")[2].lower() if digest else None,
            "payload_bytes": len(payload) if whole else int(size[1]) if size else None,
            "payload": payload if whole else None,
        },
        after,
        None,
    )


def page_of(record_id: Column | str) -> Column:
    """The page that a record id of ``record`` names; null for a page without id."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+):", 1), F.lit("")).cast("long")


def archived(pages: DataFrame, id_column: str = "page_id", text_column: str = "html") -> DataFrame:
    """Writes the pages as archives into the shared folder and reads these: records and gaps as of ``read_warc``."""
    spark = pages.sparkSession
    path = shared_path(spark)
    write_warc(mark_revisits(pages, id_column, text_column), path)
    return read_warc(spark, path)

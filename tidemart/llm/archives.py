"""Legacy archive converter: ARC files (version 1 and 2) to WARC 1.1, and a reader of the result.

ARC: a file is a series of blocks, each a header line, the declared number of bytes, and a line feed. A ``filedesc``
block says by its second line which version the following header lines have: version 1 has URL, IP address, date,
content type and length; version 2 adds result code, checksum, location, offset and file name before the length.
The payload of a record is what follows the HTTP header. Lengths are always taken from the header line, never found
by searching, so payloads may hold anything.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["arc_archives", "parse_arc", "convert", "write_warc", "read_warc", "warc_round_trip"]

ARC_FIELDS = {  # fixed values: the field lists of the two versions
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ID_HEADER = b"X-Page-Id: "
END = b"\r\n\r\n"


def filedesc(version: int, name: str) -> bytes:
    """The version block that opens an ARC archive."""
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n\n".encode()
    url = f"filedesc://{name}"
    head = [url, "0.0.0.0", "19960101000000", "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", name]
    return " ".join([*head, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, date: str, status: int, content: bytes, offset: int, name: str) -> bytes:
    checksum = hashlib.md5(content).hexdigest()
    head = [url, "0.0.0.0", date, "text/html"]
    if version == 2:
        head += [str(status), checksum, "-", str(offset), name]
    return " ".join([*head, str(len(content))]).encode("utf-8", "surrogatepass") + b"\n" + content + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an archive as dicts of header fields plus ``content``; version blocks are applied and left out."""
    at, fields = 0, None
    while at < len(data):
        line_end = data.index(b"\n", at)
        values = data[at:line_end].decode("utf-8", "surrogatepass").split(" ")
        size = int(values[-1])
        content = data[line_end + 1:line_end + 1 + size]
        if len(content) != size:
            raise ValueError(f"ARC block at byte {at} is cut short")
        at = line_end + 1 + size
        if data[at:at + 1] == b"\n":
            at += 1
        if values[0].startswith("filedesc://"):
            version = int(content.split(b" ", 1)[0])
            fields = content.split(b"\n")[1].decode().split(" ")
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        if fields is None or len(values) != len(fields):
            raise ValueError(f"ARC header line at byte {at} does not have the fields of its version")
        yield dict(zip(fields, values, strict=True)) | {"content": content}


def _safe_url(url: str | None, page_id) -> str:
    """A URL for a blank-separated header line: blanks and control characters percent-encoded, null as a URN."""
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def arc_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 archive_bytes: int = 4 << 20) -> DataFrame:
    """Pages as ARC archives: rows of ``arc`` (BINARY), each a complete archive of about ``archive_bytes``.

    Even ids go to version 2 archives, all others to version 1, so both forms are always converted.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: dict[int, list[bytes]] = {}
        size = {1: 0, 2: 0}
        number = 0
        for frame in frames:
            done = []
            for page_id, url, html in zip(frame["id"].array, frame["url"].array, frame["html"].array, strict=True):
                page_id = None if pd.isna(page_id) else int(page_id)
                version = 2 if page_id is not None and page_id % 2 == 0 else 1
                name = f"part-{number}.arc"
                block = open_.setdefault(version, [filedesc(version, name)])
                payload = (html or "").encode("utf-8", "surrogatepass")
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
                if page_id is not None:
                    head += ID_HEADER + str(page_id).encode() + b"\r\n"
                date = f"{1996 + (page_id or 0) % 30:04d}0101000000"
                block.append(arc_record(version, _safe_url(url, page_id), date, 200, head + b"\r\n" + payload,
                                        size[version], name))
                size[version] += len(block[-1])
                if size[version] >= archive_bytes:
                    done.append(b"".join(open_.pop(version)))
                    size[version], number = 0, number + 1
            if done:
                yield pd.DataFrame({"arc": done})
        if open_:
            yield pd.DataFrame({"arc": [b"".join(b) for b in open_.values()]})

    return pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).mapInPandas(run, "arc binary")


def record_id(page_id: int | None) -> str:
    """A version 8 UUID (free content) that holds the id, so that the id can be read from it."""
    n = (page_id or 0) & (1 << 64) - 1
    value = (n >> 16) << 80 | 8 << 76 | (n >> 4 & 0xFFF) << 64 | 2 << 62 | (n & 0xF) << 58 | (page_id is None)
    h = f"{value:032x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def page_id_of(record: str) -> int | None:
    value = int(record.strip("<>").rsplit(":", 1)[1].replace("-", ""), 16)
    if value & 1:
        return None
    n = (value >> 80) << 16 | (value >> 64 & 0xFFF) << 4 | (value >> 58 & 0xF)
    return n - (1 << 64) if n >> 63 else n


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PARSED = "page_id bigint, url string, date string, digest string, size bigint, http binary"


def convert(archives: DataFrame, arc_col: str = "arc", with_content: bool = True) -> DataFrame:
    """ARC archives to records: page id, URL, WARC date, payload digest and size, and the HTTP message (compressed)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for arc in frame["arc"]:
                rows = []
                for r in parse_arc(bytes(arc)):
                    head, _, payload = r["content"].partition(END)
                    page = next((x[len(ID_HEADER):] for x in head.split(b"\r\n") if x.startswith(ID_HEADER)), None)
                    d = r["Archive-date"]
                    rows.append((None if page is None else int(page), r["URL"],
                                 f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", _digest(payload),
                                 len(payload), zlib.compress(r["content"], 1) if with_content else None))
                out = pd.DataFrame(rows, columns=["page_id", "url", "date", "digest", "size", "http"])
                out["page_id"] = pd.array(out["page_id"], dtype="Int64")
                yield out

    return archives.select(F.col(arc_col).alias("arc")).mapInPandas(run, PARSED)


def warc_record(kind: str, page_id, url: str, date: str, digest: str, content: bytes, refers_to=None) -> bytes:
    """One record without the two line ends that close it."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [f"WARC-Block-Digest: sha1:{_digest(content)}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(content)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + END + content


def write_warc(records: DataFrame, path: str, records_per_file: int = 4000) -> None:
    """Records (with ``type`` and ``refers_to``) as gzipped WARC files, by Spark's own writer to any file system.

    A revisit has the HTTP header only. Each output row is one record; the writer's line end closes it.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page, url, date, digest, http, kind, refers in zip(
                    frame["page_id"].array, frame["url"], frame["date"], frame["digest"], frame["http"], frame["type"],
                    frame["refers_to"].array, strict=True):
                content = zlib.decompress(http)
                if kind == "revisit":
                    content = content.partition(END)[0] + END
                out.append(warc_record(kind, None if pd.isna(page) else int(page), url, date, digest, content,
                                       None if pd.isna(refers) else int(refers)))
            yield pd.DataFrame({"value": out})

    cols = records.select("page_id", "url", "date", "digest", "http", "type", "refers_to")
    # BINARY to STRING keeps the bytes as they are
    (cols.mapInPandas(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file)
     .option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip"))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a WARC file by their declared lengths."""
    at = 0
    while at < len(data):
        stop = data.index(END, at)
        lines = data[at:stop].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        content = data[stop + 4:stop + 4 + size]
        if len(content) != size:
            raise ValueError(f"WARC record at byte {at} is cut short")
        at = stop + 4 + size + 4
        yield head, content


def read_warc(spark, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri``: one row per record.

    A response's size and digest come from the payload read; a revisit has no payload, so its digest is the declared
    one and its size null (:func:`warc_round_trip` takes it from the response).
    """
    schema = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
              "target_uri string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                rows = []
                for head, block in parse_warc(zlib.decompress(bytes(content), 47)):
                    declared = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, size, refers = head["WARC-Type"], None, None
                    if kind == "revisit":
                        refers = page_id_of(head["WARC-Refers-To"])
                    else:
                        payload = block.partition(END)[2]
                        size = len(payload)
                        if _digest(payload) != declared:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
                    rows.append((page_id_of(head["WARC-Record-ID"]), size, declared, kind, refers,
                                 head["WARC-Target-URI"]))
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type",
                                                  "refers_to", "target_uri"])
                for c in ("page_id", "payload_bytes", "refers_to"):
                    out[c] = pd.array(out[c], dtype="Int64")
                yield out

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def mark_revisits(records: DataFrame, digests: DataFrame, min_bytes: int) -> DataFrame:
    """Adds ``type`` and ``refers_to``: of equal payloads of at least ``min_bytes``, the largest id is the response."""
    best = (digests.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("bd"))
            .agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    r = records.join(best, F.col("digest") == F.col("bd"), "left")
    revisit = F.coalesce(F.col("page_id").isNull() | (F.col("page_id") < F.col("best")), F.lit(False)) & F.col(
        "best").isNotNull()
    return (r.withColumn("type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("best"))).drop("bd", "best", "n"))


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                    min_bytes: int = 0, scratch: Scratch | None = None) -> DataFrame:
    """Pages to ARC archives, those converted to WARC files in the shared folder, those read back.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to`` per row of ``pages``. Null html is an
    empty payload, a null URL a URN, null ids are kept and never the response of a group that has an id. Rows that
    repeat the largest id of a group are all responses. Payloads below ``min_bytes`` are all responses. Empty table:
    empty result; extra columns are ignored.

    Scale: payloads are shuffled once (compressed) to meet their group's largest id, in a join whose hot keys can be
    split; groups are found by a partial aggregate over digests. Archives and WARC files have bounded sizes.
    """
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    archives = arc_archives(pages, id_col, url_col, html_col)
    digests = scratch.table(convert(archives, with_content=False).select("page_id", "digest", "size"), "digests")
    path = scratch.path("warc")
    write_warc(mark_revisits(convert(archives), digests, min_bytes), path)
    back = read_warc(pages.sparkSession, path)
    back = scratch.table(back, "read")
    sizes = back.where("payload_bytes is not null").groupBy(F.col("payload_digest").alias("pd")).agg(
        F.max("payload_bytes").alias("full"))
    revisits = back.where("payload_bytes is null").drop("payload_bytes").join(
        sizes, F.col("payload_digest") == F.col("pd")).withColumnRenamed("full", "payload_bytes")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return back.where("payload_bytes is not null").select(*cols).unionByName(revisits.select(*cols))

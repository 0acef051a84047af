"""WARC archives with a two-level capture index.

Every page is a record of its own gzip member. Of pages with equal payloads the one with the largest id is
stored as a response, the others as revisits that refer to it and hold no payload. Repeated rows of that one
page are responses each.

The index is sorted by the URL with its host reversed, then by page id. Entries are put into compressed blocks;
a sparse directory holds the first key and the byte range of each block, one directory per index file, and a
short list names the first key of each file. A lookup finds the file, then the block by binary search, reads
that byte range, and then reads the byte range of the record.

Null payloads count as empty. Null URLs have an empty key and null ids sort first; pages without a readable
host are filed under their URL as it stands. Empty tables give an empty result. Other columns are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.cluster import new_folder
from matchboard.llm.common import stored
from matchboard.llm.files import Readers, create, new_name, read_all

URN = "urn:matchboard:page:"
DATE = "2000-01-01T00:00:00Z"
BLOCK_ENTRIES = 512
FILE_BYTES = 512 << 20  # an archive file is closed beyond this
NO_ID = -(1 << 63)

CAPTURES = "surt string, page_id long, file string, offset long, length long"
CAPTURE_KINDS = [("surt", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
RECORD_KINDS = [
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
]


def surt(url: str | None) -> str:
    """The URL sorted by host from the right: http://www.a.example/b?c -> example,a)/b?c"""
    url = (url or "").strip()
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    name = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        name += f":{port}"
    return f"{name}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<{URN}{'' if page_id is None else page_id}>"


def _id(urn: str) -> int | None:
    number = urn.removeprefix(f"<{URN}").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%{:02X}".format(ord(c)) for c in url))
    if revisit:
        head.append(f"WARC-Refers-To: {_urn(refers_to)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse(member: bytes) -> tuple:
    """The values of RECORDS from a gzip member; a response is measured, a revisit says what it stands for."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        size, found = len(payload), digest(payload)
        if found != stated:
            raise ValueError(f"record {fields['warc-record-id']} does not have the digest it states")
    else:
        size, found = int(_headers(http)["content-length"]), stated
    refers = _id(fields["warc-refers-to"]) if kind == "revisit" else None
    return _id(fields["warc-record-id"]), fields.get("warc-target-uri"), size, found, kind, refers


def _batch(rows: list[tuple], kinds) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per page; rows (surt, page_id, file, offset, length), stored."""
    folder = new_folder(pages.sparkSession, "warc")
    html = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"), F.sha1(html).alias("sha"))
    keys = rows.select("page_id", "sha")
    groups = keys.groupBy("sha").agg(F.max("page_id").alias("chosen"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # only pages that have a copy; the payloads are then dealt by page, so a much copied one stays spread out
    twins = keys.join(stored(groups.drop("n"), "warc-copies"), "sha").distinct().select(F.col("page_id").alias("twin"), F.col("sha").alias("twin_sha"), "chosen", F.lit(True).alias("copied"))
    known = rows.join(twins, F.col("page_id").eqNullSafe(F.col("twin")) & (F.col("sha") == F.col("twin_sha")), "left")
    revisit = F.coalesce(F.col("copied"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("chosen"))

    def write(batches):
        name, out, at = "", None, 0
        for batch in batches:
            done = []
            for page_id, url, payload, chosen, again in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = new_name(folder, "pages", ".warc.gz"), 0
                    out = create(name)
                member = record(page_id, url, payload, chosen, again)
                out.write(member)
                done.append((surt(url), page_id, name, at, len(member)))
                at += len(member)
            yield _batch(done, CAPTURE_KINDS)
        if out is not None:
            out.close()

    return stored(known.select("page_id", "url", "payload", "chosen", revisit.alias("again")).mapInArrow(write, CAPTURES), "warc-captures")


def _key(surt_key: str, page_id: int | None) -> tuple[str, int]:
    return surt_key, NO_ID if page_id is None else page_id


def build_index(captures: DataFrame) -> list[tuple[tuple[str, int], str, str]]:
    """Write the index; (first key, block file, directory file) of each index file in order of keys."""
    folder = new_folder(captures.sparkSession, "warc-index")

    def write(batches):
        name, out, at, blocks, waiting = "", None, 0, [], []

        def flush():
            nonlocal at
            data = zlib.compress("\n".join(json.dumps(e) for e in waiting).encode())
            out.write(data)
            blocks.append([waiting[0][0], waiting[0][1], at, len(data)])
            at += len(data)
            waiting.clear()

        for batch in batches:
            for entry in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    name = new_name(folder, "captures", ".cdx")
                    out = create(name)
                waiting.append(entry)
                if len(waiting) == BLOCK_ENTRIES:
                    flush()
        if out is not None:
            if waiting:
                flush()
            out.close()
            directory = name.removesuffix(".cdx") + ".idx"
            with create(directory) as file:
                file.write(zlib.compress(json.dumps(blocks).encode()))
            yield _batch([(blocks[0][0], blocks[0][1], name, directory)], [("surt", pa.string()), ("page_id", pa.int64()), ("blocks", pa.string()), ("directory", pa.string())])

    order = ["surt", "page_id", "file", "offset"]
    files = captures.select("surt", "page_id", "file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stored(files.mapInArrow(write, "surt string, page_id long, blocks string, directory string"), "warc-index-files")
    return sorted((_key(r.surt, r.page_id), r.blocks, r.directory) for r in parts.collect())  # a row per index file


class Index:
    """Lookups in a written index; the directory and the block used last are kept."""

    def __init__(self, files: list[tuple[tuple[str, int], str, str]]):
        self.files = files
        self.firsts = [f[0] for f in files]
        self.readers = Readers()
        self.directory: tuple[int, list, list] = (-1, [], [])
        self.block: tuple[tuple[int, int], list] = ((-1, -1), [])

    def _directory(self, f: int) -> tuple[list, list]:
        if self.directory[0] != f:
            blocks = json.loads(zlib.decompress(read_all(self.files[f][2])))
            self.directory = (f, blocks, [_key(b[0], b[1]) for b in blocks])
        return self.directory[1:]

    def _block(self, f: int, b: int) -> list:
        if self.block[0] != (f, b):
            _, _, offset, length = self._directory(f)[0][b]
            lines = zlib.decompress(self.readers.read(self.files[f][1], offset, length)).decode().split("\n")
            self.block = ((f, b), [json.loads(line) for line in lines])
        return self.block[1]

    def find(self, surt_key: str, page_id: int | None) -> list[tuple[str, int, int]]:
        """(file, offset, length) of every capture with this key."""
        key, found = _key(surt_key, page_id), []
        f = max(0, bisect_right(self.firsts, key) - 1)
        while f >= 0:  # equal keys may begin at the end of an earlier block or file
            blocks, firsts = self._directory(f)
            b = bisect_right(firsts, key) - 1
            while b >= 0:
                found += [tuple(e[2:]) for e in self._block(f, b) if _key(e[0], e[1]) == key]
                if firsts[b] < key:
                    return found
                b -= 1
            f -= 1
        return found


def read_archives(captures: DataFrame, index: list) -> DataFrame:
    """Every capture by way of the index: the values of its record as read from the archive."""
    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the keys are few bytes, the records are not
    keys = captures.select("surt", "page_id").distinct()
    wanted = keys.repartitionByRange(tasks, "surt", "page_id").sortWithinPartitions("surt", "page_id")

    def read(batches):
        lookups, records = Index(index), Readers()
        for batch in batches:
            out = []
            for key, page_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += [parse(records.read(*at)) for at in lookups.find(key, page_id)]
            yield _batch(out, RECORD_KINDS)
        lookups.readers.close()
        records.close()

    return wanted.mapInArrow(read, RECORDS)


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages, index them, and read every record back."""
    captures = write_archives(pages)
    return read_archives(captures, build_index(captures))

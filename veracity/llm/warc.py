"""WARC archives: one gzip member per record, written and read in tasks.

The writer streams a partition's records into archives of a bounded size in a
folder that all executors share. An archive's name is unique to the task
attempt, and only names that a successful attempt returned are read, so lost
executors and second attempts leave nothing that counts.

The reader goes through an archive once, with one incremental decompressor a
member: header lines up to the empty line, then as many bytes as
Content-Length says, then the two line ends; block and payload digests are
verified. It holds one record and a buffer.

Payloads of at least ``min_bytes`` that are equal (SHA-1 and length) are stored
once, with the largest page id; the others are revisits that refer to it and
give the full length in their HTTP header.

Archives of other writers are read too (:func:`read_records`): record ids are
any text, digests may be missing, in base 16 or 32 and of any algorithm that
Python has, a resource's payload is its block, and records that hold no page
(``warcinfo``, ``request``, ``metadata`` and others) are passed over.

Defined results: a null html is an empty payload, a null url has no target, a
null page id is written as ``none`` and read as null, and is a revisit if
another page has its payload. Rows that repeat a page are records of their
own; among rows of the largest id all are responses. An empty table writes no
archive and reads as none. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.base import arrow_batches, arrow_rows
from veracity.operators.features import broadcast_within
from veracity.session import materialize

MIN_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
BUFFER = 1 << 16
#: A header without an end is an error from here on; a record's longest line is its target.
HEADER_LIMIT = 1 << 28
# fixed values of the format
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    pass


# --- one record ------------------------------------------------------------------------
def _digest(sha1) -> str:
    return "sha1:" + base64.b32encode(sha1.digest()).decode()


def _page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(urn: str | None) -> int | None:
    """The page of one of our record ids; other writers' ids are no pages."""
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def _checked(given: str | None, data: bytes, what: str) -> None:
    """Verifies a labelled digest, if there is one of an algorithm known here."""
    name, _, value = (given or "").partition(":")
    if name.lower() in hashlib.algorithms_guaranteed and not name.lower().startswith("shake"):
        digest = hashlib.new(name.lower(), data).digest()
        if value.rstrip("=").upper() not in (base64.b32encode(digest).decode().rstrip("="), digest.hex().upper()):
            raise WarcError(what)


def _sha1_hex(given: str | None) -> str | None:
    """A labelled SHA-1 as hexadecimal digits."""
    name, _, value = (given or "").partition(":")
    if name.lower() != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()


def _target(url: str) -> str:
    """Control characters and spaces can't stand in a header line."""
    return re.sub(r"[\x00-\x20\x7F\x85  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A response, or a revisit if ``refers_to`` is given, before compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _page_urn(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _target(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _page_urn(refers_to))]
    fields += [("WARC-Block-Digest", _digest(hashlib.sha1(block))), ("WARC-Payload-Digest", _digest(hashlib.sha1(payload))),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in fields)])
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class _Members:
    """Bytes of a stream of gzip members, one member at a time."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.plain, self.inflate = stream, b"", bytearray(), None

    def begin(self) -> bool:
        """Go to the next member; False at the end of the stream."""
        self.raw = self.raw or self.stream.read(BUFFER)
        self.plain, self.inflate = bytearray(), zlib.decompressobj(31)
        return bool(self.raw)

    def _more(self) -> bool:
        """Inflate a little more; False at the end of the member."""
        if self.inflate.eof:
            return False
        self.raw = self.raw or self.stream.read(BUFFER)
        out = self.inflate.decompress(self.raw, BUFFER)
        if not self.raw and not out and not self.inflate.eof:
            raise WarcError("the archive ends within a record")
        self.plain += out
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.plain.find(mark, seen)) < 0:
            seen = max(len(self.plain) - len(mark) + 1, 0)
            if len(self.plain) > HEADER_LIMIT or not self._more():
                raise WarcError(f"no {mark!r} where a header must end")
        out = bytes(self.plain[:at])
        del self.plain[:at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.plain) < n:
            if not self._more():
                raise WarcError(f"a record is {n - len(self.plain)} bytes short")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out

    def end(self) -> None:
        while self._more():
            pass
        if self.plain:
            raise WarcError(f"{len(self.plain)} bytes after a record")


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(first):
        raise WarcError(f"a header begins with {lines[0][:40]!r}")
    return {k.decode(errors="replace").strip().lower(): v.decode(errors="replace").strip() for k, _, v in (x.partition(b":") for x in lines[1:])}


#: Records that hold a page or refer to one.
PAGES = ("response", "resource", "revisit")


def read_records(stream: BinaryIO) -> Iterator[dict | None]:
    """The records of an archive in order, digests verified where there are any; None for one that holds no page.

    A revisit's length is that of its HTTP header, null without one; its digest is that of what it revisits."""
    members = _Members(stream)
    while members.begin():
        fields = _fields(members.until(b"\r\n\r\n"), b"WARC/")
        if not fields.get("content-length", "").isdigit():
            raise WarcError("a record without its length")
        block = members.take(int(fields["content-length"]))
        if members.take(4) != b"\r\n\r\n":
            raise WarcError("no line ends after a record")
        members.end()
        kind, name = fields.get("warc-type", "").lower(), fields.get("warc-record-id")
        _checked(fields.get("warc-block-digest"), block, f"block digest of {name}")
        if kind not in PAGES:
            yield None
            continue
        http = block.startswith(b"HTTP/")
        head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        revisit, given = kind == "revisit", fields.get("warc-payload-digest")
        length = _fields(head, b"HTTP/").get("content-length", "") if http else ""
        length = int(length) if length.isdigit() else None
        if not revisit:
            _checked(given, payload, f"payload digest of {name}")
            if _page_id(name) is not None and length != len(payload):
                raise WarcError(f"payload length of {name}")
        yield {
            "record_id": name, "page_id": _page_id(name), "url": fields.get("warc-target-uri"), "payload_bytes": length if revisit else len(payload),
            "payload_digest": _sha1_hex(given) if revisit else hashlib.sha1(payload).hexdigest(),
            "record_type": kind, "refers_to": _page_id(fields.get("warc-refers-to")) if revisit else None,
            "payload": None if revisit else payload,
        }


# --- Spark -----------------------------------------------------------------------------
def _store(folder: str):
    """File system and path of a folder's address; a scheme chooses the store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def with_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, html, refers_to``: the page that holds an equal payload, or null.

    A payload's holder is found by aggregation, so many copies cost one row a
    task, and holders are stored. While their rows, once counted, are few, they
    are broadcast and pages don't move. Else pages of ``min_bytes`` or more
    meet them in a join whose sides come straight from exchanges, which
    adaptive execution can split; smaller ones, empty ones too, stay where they are."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"), F.octet_length(html).alias("bytes"))
    large = rows.filter(F.col("bytes") >= min_bytes)
    holders = materialize(large.groupBy("digest", "bytes").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).filter("n > 1 and holder is not null").drop("n"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to")
    known = broadcast_within(holders)
    if known is not holders:
        return rows.join(known, ["digest", "bytes"], "left").select("page_id", "url", "html", refers)
    small = rows.filter(F.col("bytes") < min_bytes).select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"))
    return large.join(holders, ["digest", "bytes"], "left").select("page_id", "url", "html", refers).unionByName(small)


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> DataFrame:
    """Write rows of :func:`with_revisits`; returns ``path, records, bytes`` of the archives."""
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        store, base = _store(folder)

        def archives():
            out, path, n, size = None, "", 0, 0
            for page_id, url, html, refers_to in arrow_rows(batches, "page_id", "url", "html", "refers_to"):
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, n, size = store.open_output_stream(f"{base}/{name}", compression=None), name, 0, 0
                member = compressed(record(page_id, url, html.encode(), refers_to), level)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield (path, n, size), 100
            if out is not None:
                out.close()
                yield (path, n, size), 100
        yield from arrow_batches(archives(), schema)

    return materialize(rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long, bytes long"))


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives (``path, records``; null: unknown), an archive being read by one task."""
    fields = [("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}

    def run(batches):
        store, base = _store(folder)

        def records():
            for path, expected in arrow_rows(batches, "path", "records"):
                with store.open_input_stream(f"{base}/{path}", compression=None) as stream:
                    n = 0
                    for r in read_records(stream):
                        n += 1
                        if r is not None:
                            yield tuple(r[c] for c in schema.names), 200 + len(r["payload"] or b"") * with_payload
                if expected is not None and n != expected:
                    raise WarcError(f"{path} has {n} records instead of {expected}")
        yield from arrow_batches(records(), schema)

    n = max(1, archives.count())
    return archives.repartition(n).mapInArrow(run, ", ".join(f"{c} {kinds[k]}" for c, k in fields))

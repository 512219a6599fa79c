"""WARC archives written from, and read into, a chunked record table.

A payload is never handled whole in Python: writing explodes it on the JVM side
into rows of (record, chunk number, bytes), and the writer streams them into one
gzip member per record. Reading decompresses piece by piece and yields the same
rows, each with the bytes so far and the digest so far, so that the last row of a
record carries the length and digest of the whole payload.

Of equal payloads of some size only one is stored, under the smallest page id;
the others are revisit records that refer to it.

Defined results: a null payload is empty; a null url leaves its field out; a null
``page_id`` has an empty place in the record name; repeated rows are separate
records; pages of one id and payload are all stored if theirs is the smallest id;
an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from textlake.llm.files import create, materialize, one_each, open_stream, scratch_path

CHUNK = 1 << 20
LEAST_SHARED = 100
FILE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Header of a stored answer, up to the length of its payload.
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

CHUNK_SCHEMA = (
    "file string, record_id string, page_id long, record_type string, refers_to long, chunk long, "
    "last boolean, payload_bytes long, payload_digest string, intact boolean, bytes binary"
)


def record_chunks(pages: DataFrame, payload: str = "html", chunk: int = CHUNK, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, refers_to, chunk, last, bytes).

    Who refers to whom is settled on ids and digests; the payloads then move once,
    by ``page_id``. Revisit records have one row without bytes.
    """
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", data.alias("data")).withColumns(
        {"payload_digest": F.sha2("data", 256), "payload_bytes": F.octet_length("data").cast("long")})
    named = materialize(rows.select("page_id", "payload_digest", "payload_bytes").distinct(), "digests")
    shared = materialize(
        named.filter(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "shared")
    later = materialize(
        named.join(shared, "payload_digest").filter(F.col("page_id") > F.col("first"))
        .select(F.col("page_id").alias("id"), F.col("payload_digest").alias("digest"), F.col("first").alias("refers_to")),
        "revisits")
    known = rows.join(
        later, (F.col("page_id") == F.col("id")) & (F.col("payload_digest") == F.col("digest")), "left")
    stored = F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(0)
    last = F.greatest(F.lit(0), F.floor((stored - 1) / chunk)).cast("int")
    return known.withColumn("last_chunk", last).withColumn("chunk", F.explode(F.sequence(F.lit(0), "last_chunk"))).select(
        "page_id", "url", "payload_bytes", "payload_digest", "refers_to", F.col("chunk").cast("long").alias("chunk"),
        (F.col("chunk") == F.col("last_chunk")).alias("last"),
        F.when(F.col("refers_to").isNull(), F.substring("data", F.col("chunk") * chunk + 1, F.lit(chunk)))
        .otherwise(F.lit(b"")).alias("bytes"),
    )


def _name(page_id, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def _header(row, date: str) -> bytes:
    length = str(row.payload_bytes).encode()
    http = HTTP + length + b"\r\n\r\n"
    lines = ["WARC/1.1", "WARC-Type: " + ("response" if row.refers_to is None else "revisit"),
             f"WARC-Record-ID: <{_name(row.page_id, row.payload_digest)}>", f"WARC-Date: {date}"]
    if row.url is not None:
        safe = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", row.url)
        lines.append(f"WARC-Target-URI: {safe}")
    if row.refers_to is not None:
        lines += [f"WARC-Refers-To: <{_name(row.refers_to, row.payload_digest)}>", f"WARC-Profile: {PROFILE}"]
    body = len(http) + (row.payload_bytes if row.refers_to is None else 0)
    lines += [f"WARC-Payload-Digest: sha256:{row.payload_digest}", "Content-Type: application/http;msgtype=response",
              f"Content-Length: {body}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write(chunks: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Write archives of gzip members; the manifest has (file, n_records) of each."""
    target = folder or scratch_path(chunks.sparkSession, "warc")

    def to_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, url, n, written, done = None, None, 0, 0, []
        member = None
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["page_id"]]
            refers = [None if pd.isna(x) else int(x) for x in batch["refers_to"]]
            for row in batch.assign(page_id=pd.Series(ids, dtype=object, index=batch.index),
                                    refers_to=pd.Series(refers, dtype=object, index=batch.index)).itertuples(index=False):
                if out is None:
                    url, out = create(target, ".warc.gz")
                    n = written = 0
                if row.chunk == 0:
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    written += out.write(member.compress(_header(row, date)))
                written += out.write(member.compress(row.bytes))
                if row.last:
                    written += out.write(member.compress(b"\r\n\r\n") + member.flush())
                    n += 1
                    if written >= file_bytes:
                        out.close()
                        out = None
                        done.append((url, n))
        if out is not None:
            out.close()
            done.append((url, n))
        yield pd.DataFrame(done, columns=["file", "n_records"])

    return materialize(chunks.mapInPandas(to_files, "file string, n_records long"), "warc-manifest")


class Source:
    """Bytes of an archive, plain or of gzip members, a piece at a time."""

    def __init__(self, raw, piece: int = CHUNK):
        self._raw, self._piece, self._held = raw, piece, bytearray()
        self._rest = raw.read(piece)
        self._zip = self._rest[:2] == b"\x1f\x8b"
        self._member = zlib.decompressobj(31) if self._zip else None

    def _more(self) -> bool:
        """Take in at most about one piece more; False at the end."""
        if not self._rest:
            self._rest = self._raw.read(self._piece)
            if not self._rest:
                return False
        if not self._zip:
            self._held += self._rest
            self._rest = b""
            return True
        if self._member.eof:
            self._member = zlib.decompressobj(31)
        self._held += self._member.decompress(self._rest, self._piece)
        self._rest = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        at = 0
        while (end := self._held.find(b"\r\n", at)) < 0:
            at = max(0, len(self._held) - 1)
            if not self._more():
                return None
        found = bytes(self._held[:end])
        del self._held[: end + 2]
        return found

    def take(self, most: int) -> bytes:
        while not self._held and self._more():
            pass
        found = bytes(self._held[:most])
        del self._held[:most]
        return found

    def headers(self, first: str) -> dict[str, str] | None:
        """Fields up to the empty line; the line that opens them must start with ``first``."""
        opening = self.line()
        while opening == b"":
            opening = self.line()
        if opening is None:
            return None
        if not opening.startswith(first.encode()):
            raise ValueError(f"expected {first}, found {opening[:40]!r}")
        fields = {}
        while line := self.line():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
            fields["size"] = int(fields.get("size", 0)) + len(line) + 2
        fields["size"] = int(fields.get("size", 0)) + len(opening) + 4
        return fields


def _page(name: str | None):
    found = re.match(r"<?urn:page:(-?\d*):", name or "")
    return int(found[1]) if found and found[1] else None


def rows_of(source: Source, url: str, chunk: int, with_bytes: bool) -> Iterator[tuple]:
    """Chunk rows of one archive."""
    while (warc := source.headers("WARC/")) is not None:
        kind, left = warc.get("warc-type", ""), int(warc.get("content-length", 0))
        said = warc.get("warc-payload-digest", "").removeprefix("sha256:")
        http: dict = {}
        if kind in ("response", "revisit") and left:
            http = source.headers("HTTP/") or {}
            left -= http["size"]
        page, refers = _page(warc.get("warc-record-id")), _page(warc.get("warc-refers-to"))
        head = (url, warc.get("warc-record-id"), page, kind, refers)
        if kind == "revisit":
            yield (*head, 0, True, int(http.get("content-length", 0)), said, None, b"")
            left = max(0, left)
        digest, seen, number = hashlib.sha256(), 0, 0
        while kind != "revisit":
            part = bytearray()
            while len(part) < min(chunk, left):
                piece = source.take(min(chunk, left) - len(part))
                if not piece:
                    raise EOFError(f"{url} ends inside a record")
                part += piece
            left -= len(part)
            seen += len(part)
            digest.update(part)
            so_far = digest.copy().hexdigest()
            yield (*head, number, left == 0, seen, so_far, (so_far == said) if left == 0 else None,
                   bytes(part) if with_bytes else b"")
            number += 1
            if left == 0:
                break


def read(manifest: DataFrame, chunk: int = CHUNK, with_bytes: bool = True) -> DataFrame:
    """The chunked record table of the archives named in ``file``; see CHUNK_SCHEMA.

    ``intact`` tells on the last row of a stored record whether its payload has
    the digest that its header states.
    """
    names = [part.split()[0] for part in CHUNK_SCHEMA.split(", ")]

    def from_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["file"]:
                with open_stream(url) as raw:
                    rows, held = [], 0
                    for row in rows_of(Source(raw), url, chunk, with_bytes):
                        rows.append(row)
                        held += len(row[-1]) + 500
                        if held >= 8 * CHUNK:
                            yield _frame(rows, names)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows, names)

    return one_each(manifest.select("file")).mapInPandas(from_files, CHUNK_SCHEMA)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for name in ("page_id", "refers_to"):
        out[name] = out[name].astype("Int64")
    out["intact"] = out["intact"].astype("boolean")
    return out

"""Web archives: records written by tasks, a globally ordered capture index, and reading back.

Every page becomes a WARC/1.1 record, a gzip member of its own, in a file below the shared folder.
Among records with equal payloads of at least `min_bytes` bytes the one with the largest id is a
`response`; the others are `revisit` records without payload that refer to it and keep its digest
and its HTTP header. Each file comes with a sorted run of index rows; `captureindex` merges all
runs into one order by URL key and timestamp, in which the captures of a URL stand together in
the order they were made. `read_records` goes through that index and reads each record at its
offset.

Equal payloads are found by SHA-1 and length: ids are reduced to one row per digest before they
meet the pages, and a payload that very many pages share is split by the adaptive skewed join.

Cases: a null payload is empty; null urls have the key "" and no target; null timestamps stand at
the epoch; a null id is smaller than any other, and null among its equals only if all are; rows
that share payload and the largest id are responses all; repeated rows give records each; control
characters in a url are percent-encoded; an empty table gives no files and no rows; other columns
are not read. A payload must fit a task's memory.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import captureindex
from clickloom.llm.captureindex import BATCHES, write_run
from clickloom.llm.files import new_folder, open_input, partitions_of, write_file
from clickloom.session import materialize

RECORDS = 50_000  # records of a file and its run at most
FILE_BYTES = 1 << 26  # a file is closed beyond that; a task holds one
SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) not in "<>\"{}|\\^`")  # of a url, as it is
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort-friendly key: host reversed, lower case, no scheme, `www.`, default port or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = host.removeprefix("www.")
    key = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        key += f":{port}"
    return f"{key}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def _name(page) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page, url, stamp: str, payload: bytes, response, digest: str) -> bytes:
    """One gzip member; `response` is the page this one repeats, or None if it is a response."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    kind = "response" if response is None else "revisit"
    date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    block = http + payload
    if response is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(response)}"]
        block = http
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=6, mtime=0)


def parse(member: bytes) -> dict:
    """Headers, HTTP headers and payload of a record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return {"headers": headers, "http": fields, "payload": payload}


def mark_revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(id, payload, ...) with `repeats`: whether the page repeats another, and `response`."""
    keyed = pages.withColumns(
        {"sha": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")}
    )
    first = (
        keyed.where(F.col("bytes") >= min_bytes)
        .groupBy(F.col("sha").alias("of_sha"), F.col("bytes").alias("of_bytes"))
        .agg(F.max("id").alias("response"))
    )
    same = (F.col("sha") == F.col("of_sha")) & (F.col("bytes") == F.col("of_bytes"))
    return keyed.join(first, same, "left").withColumn(
        "repeats", F.col("of_sha").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    )


def _writer(folder: str):
    def write(frames):
        task, number = TaskContext.get().partitionId(), 0
        index: list[tuple] = []
        chunks: list[bytes] = []
        size = 0

        def close():
            nonlocal number, size
            path = f"{folder}/pages-{task:05d}-{number:04d}"
            write_file(f"{path}.warc.gz", chunks)
            rows = [(*r[:6], f"{path}.warc.gz", *r[6:]) for r in index]
            found = write_run(f"{path}.arrow", sorted(rows, key=captureindex.key_of))
            index.clear()
            chunks.clear()
            number, size = number + 1, 0
            return pd.DataFrame(found, columns=[c.split()[0] for c in BATCHES.split(", ")]).astype(
                {"first_id": "Int64", "last_id": "Int64"}
            )

        for frame in frames:
            for row in frame.itertuples():
                page = None if pd.isna(row.id) else int(row.id)
                response = None
                if row.repeats:
                    response = None if pd.isna(row.response) else int(row.response)
                payload = bytes(row.payload)
                digest = base32_sha1(payload)
                member = record(page, row.url, row.ts, payload, response, digest)
                kind = "revisit" if row.repeats else "response"
                index.append((url_key(row.url), row.ts, page, row.url, digest, kind, size, len(member)))
                chunks.append(member)
                size += len(member)
                if len(index) == RECORDS or size > FILE_BYTES:
                    yield close()
        if index:
            yield close()

    return write


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    ts: Column | None = None,
    min_bytes: int = 0,
) -> DataFrame:
    """Write the archives and their index; returns the index in global order (see captureindex).

    `ts` is the time of capture; without one, captures are a second apart in order of their ids
    (modulo 2 * 10^11, which keeps the years below 10000).
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    # Years stay within four digits, whatever the ids.
    since = F.pmod(F.col(id_col).cast("long"), F.lit(200_000_000_000))
    when = F.timestamp_seconds(F.lit(1_577_836_800) + since) if ts is None else ts
    stamp = F.date_format(F.coalesce(when, F.timestamp_seconds(F.lit(0))), "yyyyMMddHHmmss")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
        stamp.alias("ts"),
    )
    marked = mark_revisits(rows, min_bytes).select("id", "url", "payload", "ts", "repeats", "response")
    placed = marked.sortWithinPartitions("id", "url", "ts")
    batches = materialize(placed.mapInPandas(_writer(folder), BATCHES), "runs")
    return captureindex.merge_runs(batches, folder)


def read_records(index: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """Each record of the index, read from its archive: id, payload_bytes, payload_digest,
    record_type, refers_to (and payload), with urlkey, ts and position of its capture."""
    schema = (
        "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "urlkey string, ts string, position long"
    )

    def read(frames):
        path, source = None, None
        for frame in frames:
            out = []
            for row in frame.itertuples():
                if row.file != path:
                    if source is not None:
                        source.close()
                    path, source = row.file, open_input(row.file)
                found = parse(bytes(source.read_at(row.length, row.offset)))
                headers, payload = found["headers"], found["payload"]
                kind = headers["WARC-Type"]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"damaged record at {row.file}:{row.offset}")
                refers = _page(headers["WARC-Refers-To"]) if kind == "revisit" else None
                out.append(
                    (
                        _page(headers["WARC-Record-ID"]),
                        int(found["http"]["Content-Length"]),
                        digest,
                        kind,
                        refers,
                        row.urlkey,
                        row.ts,
                        row.position,
                        *([payload] if with_payload else []),
                    )
                )
            names = [c.split()[0] for c in schema.split(", ")] + ["payload"] * with_payload
            yield pd.DataFrame(out, columns=names).astype({"id": "Int64", "refers_to": "Int64"})
        if source is not None:
            source.close()

    rows = index.select("file", "offset", "length", "urlkey", "ts", "position")
    placed = rows.repartitionByRange(partitions_of(index), "file", "offset").sortWithinPartitions(
        "file", "offset"
    )
    return placed.mapInPandas(read, schema + (", payload binary" if with_payload else ""))

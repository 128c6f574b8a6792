"""Web archives: WARC files of captured pages, and the merge of their sorted index runs.

A folder holds ``capture-N.warc.gz``, one per writing task: a warcinfo record and one gzip member per
page, so a record can be read by its offset alone. Each task also yields its own captures sorted by URL
key and timestamp: a run. The runs are merged range by range into one globally ordered index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import common

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
SPAN = 10 * 365 * 86_400
#: Index rows merged by one task.
RANGE = 200_000
#: Fixed value of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "run int, seq long, urlkey string, ts string, page_id long, file string, offset long, length long, digest string"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "urlkey string, ts string"
)


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: captures of one site and page lie together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url.strip().lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{host}{port}){parts.path or '/'}{query}".lower()


def captured(page_id: int | None) -> datetime:
    """Without a capture time in the table, one second per page id, round and round within ten years."""
    return EPOCH + timedelta(seconds=(page_id or 0) % SPAN)


def _header(lines: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit keeps the HTTP head, with the length of the whole payload, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response")]
    if page_id is not None:
        head.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    head.append(("WARC-Date", captured(page_id).strftime("%Y-%m-%dT%H:%M:%SZ")))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        head.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            head.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _header(head) + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record; a response's digest and length are taken from its payload, and checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda name: int(fields[name][len("<urn:page:") : -1]) if name in fields else None
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(named["Content-Length"])
    if fields["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return {
        "page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": payload,
    }


class LoserTree:
    """Merges k sorted iterators: each step replays one path of log2(k) matches from the last winner's leaf."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.size = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.size
        self.winner = self._build(1) if self.size > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.winner]) is not None:
            yield head
            w = self.winner
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.size) // 2
            while node:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def write_archives(
    pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html",
    revisit_from: int = 0,
) -> DataFrame:
    """Write a record for every page and return the locally sorted index runs (a staged table).

    Of the pages with equal payloads of at least ``revisit_from`` bytes the one with the largest id is a
    response and the others revisit it; smaller payloads are all responses. NULL payloads are empty. Each of
    several rows with that largest id is a response; rows with a NULL id come last. Payloads are exchanged
    once, by their digest; a digest that many pages share is pre-aggregated on one side and split by
    adaptive execution on the other.
    """
    path = common.mounted(folder)
    os.makedirs(path, exist_ok=True)
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload")
    ).withColumn("sha", F.sha1("payload"))
    latest = rows.groupBy("sha").agg(F.max("page_id").alias("response"))
    rows = rows.join(latest, "sha").select("page_id", "url", "payload", "sha", "response")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        run, attempt = context.partitionId(), context.taskAttemptId()
        name = f"capture-{run:06d}.warc.gz"
        index, out, at = [], None, 0
        for batch in batches:
            for key, link, data, sha, response in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    os.makedirs(path, exist_ok=True)
                    out = open(f"{path}/{name}.{attempt}", "wb")
                    note = b"software: panelspark\r\nformat: WARC File Format 1.1\r\n"
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{run}>"), ("WARC-Filename", name),
                            ("Content-Type", "application/warc-fields"), ("Content-Length", len(note))]
                    at = out.write(gzip.compress(_header(info) + note + b"\r\n\r\n", 5, mtime=0))
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                revisit = len(data) >= revisit_from and key != response
                raw = gzip.compress(record(key, link, data, digest, response, revisit), 5, mtime=0)
                stamp = captured(key).strftime("%Y%m%d%H%M%S")
                index.append((url_key(link), stamp, -1 if key is None else key, name, at, len(raw), digest, key))
                at += out.write(raw)
        if out is None:
            return
        out.close()
        os.replace(f"{path}/{name}.{attempt}", f"{path}/{name}")
        index.sort(key=lambda x: x[:3])
        for lo in range(0, len(index), 20_000):
            keys, stamps, _, files, offsets, lengths, digests, ids = zip(*index[lo : lo + 20_000])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([run] * len(keys), pa.int32()), pa.array(range(lo, lo + len(keys)), pa.int64()),
                    pa.array(keys), pa.array(stamps), pa.array(ids, pa.int64()), pa.array(files),
                    pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(digests),
                ],
                names=["run", "seq", "urlkey", "ts", "page_id", "file", "offset", "length", "digest"],
            )

    return common.stage(rows.mapInArrow(write, CAPTURES), "index-runs")


def merge_runs(runs: DataFrame) -> DataFrame:
    """One index in the order of URL key, timestamp and page id, from sorted runs.

    Ranges of the whole key are cut from a sample, so a URL with a third of all captures fills several
    ranges. A range gets a sorted slice of each run and merges the slices with a loser tree; ``range`` and
    ``position`` give the global order.
    """
    count = runs.count()
    names = runs.columns
    key = ["urlkey", "ts", "page_id"]
    if count > RANGE:
        dealt = runs.repartitionByRange(-(-count // RANGE), *key)
    else:
        dealt = runs.repartitionByRange(*key)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns = {n: table.column(n).to_pylist() for n in ("run", *key)}
        slices: dict[int, list] = {}
        for i, (run, *k) in enumerate(zip(*columns.values())):
            slices.setdefault(run, []).append((k[0], k[1], -1 if k[2] is None else k[2], i))
        order = [x[3] for x in LoserTree([iter(s) for s in slices.values()])]
        part = TaskContext.get().partitionId()
        out = table.take(pa.array(order, pa.int64()))
        out = out.append_column("range", pa.array([part] * len(order), pa.int32()))
        out = out.append_column("position", pa.array(range(len(order)), pa.int64()))
        yield from out.combine_chunks().to_batches(max_chunksize=20_000)

    return dealt.select(*names).sortWithinPartitions("run", "seq").mapInArrow(
        merge, f"{CAPTURES}, range int, position long"
    )


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records an index names, read from the archives at their offsets, in the index's own partitions."""
    path = common.mounted(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = sorted(zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length", "urlkey", "ts"))))
            rows, name, f = [], None, None
            for file, offset, length, key, stamp in spots:
                if file != name:
                    if f:
                        f.close()
                    name, f = file, open(f"{path}/{file}", "rb")
                f.seek(offset)
                found = parse(zlib.decompress(f.read(length), 31))
                rows.append((*(found[n] for n in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")), key, stamp))
            if f:
                f.close()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "ts"],
            )

    return index.select("file", "offset", "length", "urlkey", "ts").mapInArrow(read, RECORDS)

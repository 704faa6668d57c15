"""WARC archives of pages, and their external index merge.

Pages go to gzipped WARC 1.1 records in files of the shared folder, written through pyarrow's file systems, each under a
name of its own attempt; only names that a finished task reports are read. Each file gives one locally sorted run of index
lines (URL key, timestamp, digest, place). Runs are cut at sampled key bounds, and each range merges its runs with a loser
tree, so the ranges in order hold every URL's captures in the order of time. Records are read back by the merged index's
file, offset and length. A revisit names the URL and the time of the capture that it repeats, and no page: which page that
is, the merged index says.
"""

from __future__ import annotations

import base64
import bisect
import datetime as dt
import gzip
import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import new_folder, spread_join, staged

LEAST = 0  # bytes of a payload from which equal payloads are revisits
FILE_BYTES = 32 << 20  # of payload in a WARC file, about
RANGE_ROWS = 20_000  # index lines of a merged range, about
FEW_ROWS, FEW_RANGES = 500, 64  # small indexes have smaller ranges, up to so many
PER_RANGE = 10  # sampled lines for each range's bound, about
TASK_BYTES = 64 << 20  # of records that a task reads back, about
EPOCH = dt.datetime(2024, 1, 1)
FAR = 6 * 10**16  # microseconds from EPOCH that a time may be
HOT_SHARE = 1000
_LINE = "url_key string, ts string, page_id long, digest string, type string, file string, offset long, length long"


def clean_url(url: str | None) -> str:
    """A URL as it stands in a header."""
    return re.sub(r"[\r\n]", " ", url or "")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, a leading `www.` or `m.` and the fragment dropped, lower case."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^#]*)", clean_url(url))
    host = re.sub(r"^(?:www\d*|m)\.", "", m[1].rpartition("@")[2].lower())
    host, _, port = host.partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (m[2].lower() or "/")


def capture_time(page_id: int | None) -> str:
    """Pages carry no time of capture: it follows from the page's number, a microsecond for each; null counts as 0."""
    return (EPOCH + dt.timedelta(microseconds=max(-FAR, min(FAR, page_id or 0)))).isoformat(timespec="microseconds") + "Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One WARC record. A revisit has no payload and names the capture that has it."""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>", f"WARC-Date: {capture_time(page_id)}",
        "WARC-Target-URI: " + clean_url(url), f"WARC-Payload-Digest: sha1:{sha1}", f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Bytes: {len(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        body += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Date: {capture_time(refers_to)}", "WARC-Refers-To-Target-URI: " + clean_url(refers_url)]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _identity(payload: bytes) -> bytes:
    """What equal payloads share: SHA-1 and a part of SHA-256."""
    return hashlib.sha1(payload).digest() + hashlib.sha256(payload).digest()[:12]


def _digests(batches):
    for batch in batches:
        raw = [(text or "").encode() for text in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(map(_identity, raw), pa.binary()), pa.array(map(len, raw), pa.int64())], ["page_id", "url", "sha", "size"])


def _written(folder: str):
    def write(batches):
        """Writes files of records; gives a row for each record: the sorted run of its file.

        marks: what rows with this page_id revisit, by payload; a row whose payload isn't among them is a response.
        """
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, at, filled, lines = None, "", 0, 0, []

        def run():
            lines.sort(key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2]))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines), _TYPES)], _NAMES)

        for batch in batches:
            for page_id, url, html, marks in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "marks"))):
                if out is None:
                    name, at, filled, lines = f"{uuid.uuid4().hex}.warc.gz", 0, 0, []
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                payload = (html or "").encode()
                mark = next((m for m in marks if m["sha"] == _identity(payload)), None) if marks else None
                sha1 = digest(payload)
                member = gzip.compress(record(page_id, url, payload, sha1, *((mark["refers_to"], mark["refers_url"]) if mark else (None, None))), 6, mtime=0)
                out.write(member)
                lines.append((url_key(url), capture_time(page_id), page_id, sha1, "revisit" if mark else "response", name, at, len(member)))
                at, filled = at + len(member), filled + len(payload)
                if filled >= FILE_BYTES:
                    out.close()
                    out = None
                    yield run()
        if out is not None:
            out.close()
            yield run()

    return write


_NAMES = [x.split()[0] for x in _LINE.split(", ")]
_TYPES = [{"string": pa.string(), "long": pa.int64()}[x.split()[1]] for x in _LINE.split(", ")]


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Writes pages(page_id, url, html) to WARC files in folder; url_key, ts, page_id, digest, type, file, offset, length of each record.

    Null html is the empty payload. Of equal payloads of at least `least` bytes the one with the smallest page_id is the
    response and the others revisit it; rows that repeat its page_id and payload are a response each. Equal means equal
    SHA-1 and equal part of SHA-256. A row is told by its page_id and payload: a page_id may come with several payloads or
    be null. A null page_id is never what others revisit; where all equal payloads have none, each is a response.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    known = staged(rows.mapInArrow(_digests, "page_id long, url string, sha binary, size long"), "warc-digests")
    groups = known.where(F.col("size") >= least).groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.min_by("url", "page_id").alias("refers_url"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    groups = staged(groups, "warc-groups")
    refers = spread_join(known, groups, ["sha"], known.count(), "inner").where("page_id is null or page_id <> refers_to").select("page_id", "sha", "refers_to", "refers_url").distinct()
    # Only page_ids that revisit something are joined; the html of the others stays where it is read. One page_id has few payloads.
    marks = refers.groupBy("page_id").agg(F.collect_list(F.struct("sha", "refers_to", "refers_url")).alias("marks"))
    marks = staged(marks, "warc-revisits")
    joined = rows.join(marks, rows.page_id.eqNullSafe(marks.page_id), "left").select(rows.page_id, "url", "html", "marks")
    return joined.mapInArrow(_written(folder), _LINE)


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, so the next winner takes one path to the root."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = 1 << max(0, (len(runs) - 1)).bit_length()
        self.tree = [-1] * self.k
        self.winner = self._play(1)

    def _head(self, i: int):
        return self.runs[i][self.at[i]] if 0 <= i < len(self.runs) and self.at[i] < len(self.runs[i]) else None

    def _beats(self, i: int, j: int) -> bool:
        a, b = self._head(i), self._head(j)
        return a is not None and (b is None or (a, i) < (b, j))

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        i, j = self._play(2 * node), self._play(2 * node + 1)
        i, j = (i, j) if self._beats(i, j) else (j, i)
        self.tree[node] = j
        return i

    def __iter__(self):
        while (head := self._head(self.winner)) is not None:
            yield head
            i = self.winner
            self.at[i] += 1
            node = (i + self.k) // 2
            while node:
                if self._beats(self.tree[node], i):
                    i, self.tree[node] = self.tree[node], i
                node //= 2
            self.winner = i


def _merged(key, table):
    """Of one range, its runs merged; at: the record's number in the range."""
    runs: dict = {}
    for row in zip(*(table.column(c).to_pylist() for c in _NAMES)):
        runs.setdefault(row[5], []).append((row[0], row[1], -1 if row[2] is None else row[2], *row[5:7], row))
    ordered = []
    for run in runs.values():  # a shuffle may hand over a run's blocks in any order
        ordered.append(run if all(a[:5] <= b[:5] for a, b in zip(run, run[1:])) else sorted(run, key=lambda r: r[:5]))
    rows = [r[-1] for r in LoserTree(ordered)]
    out = {c: pa.array(x, k) for c, x, k in zip(_NAMES, zip(*rows), _TYPES)}
    return pa.table({"part": pa.array([key[0].as_py()] * len(rows), pa.int64()), "at": pa.array(np.arange(len(rows)))} | out)


def merged_index(lines: DataFrame) -> DataFrame:
    """The columns of lines, and place: the number of each in the order of (url_key, ts, page_id), a null page_id first.

    Bounds are sampled over the whole key, the page's number included, so that one URL with many captures is cut too.
    Captures that are alike in all three, as of repeated rows, stay in one range. The driver holds PER_RANGE sampled lines
    for each range.
    """
    n = lines.count()
    parts = max(1, -(-n // RANGE_ROWS), min(FEW_RANGES, -(-n // FEW_ROWS)))
    rate = min(1.0, PER_RANGE * parts / max(1, n))
    sample = sorted(tuple(r) for r in lines.select("url_key", "ts", F.coalesce("page_id", F.lit(-1))).where(F.pmod(F.xxhash64("url_key", "ts", "page_id"), F.lit(1_000_000)) < F.lit(max(1, int(1_000_000 * rate)))).collect())
    bounds = [sample[i * len(sample) // parts] for i in range(1, parts)] if sample else []

    def placed(batches):
        for batch in batches:
            at = [bisect.bisect_right(bounds, (u, t, -1 if p is None else p)) for u, t, p in zip(*(batch.column(c).to_pylist() for c in ("url_key", "ts", "page_id")))]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *batch.columns], ["part", *batch.schema.names])

    ranged = lines.mapInArrow(placed, "part long, " + _LINE).repartition(min(parts, max(FEW_RANGES, parts // 8)), "part")
    merged = staged(ranged.groupBy("part").applyInArrow(_merged, "part long, at long, " + _LINE), "warc-index")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    bases = merged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return merged.join(bases, "part").select(*_NAMES, (F.col("base") + F.col("at")).alias("place"))


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_key string, refers_ts string, url_key string, ts string, place long"


def _read(folder: str):
    def read(batches):
        """Reads each line's record: so many bytes of its file from its offset on. The lines come by file."""
        fs, base = pafs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    name, source = file, fs.open_input_file(f"{base}/{file}")
                out.append(_row(gzip.decompress(source.read_at(length, offset))))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols, kinds), *(batch.column(c) for c in ("url_key", "ts", "place"))], [x.split()[0] for x in _READ.split(", ")])

    return read


def _row(raw: bytes) -> tuple:
    fields, block = parse(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    page, size, sha1 = fields["X-Page-Id"], int(fields["X-Payload-Bytes"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        size, sha1 = len(payload), digest(payload)  # of what was read, not of what a header says
        return int(page) if page else None, size, sha1, "response", None, None
    return int(page) if page else None, size, sha1, "revisit", url_key(fields["WARC-Refers-To-Target-URI"]), fields["WARC-Refers-To-Date"]


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, ts, place of every line of the index.

    Records are read by the index's file, offset and length. A revisit's page is the one of the index whose response has
    its digest and the URL key and time that it names.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(FEW_RANGES // 2, -(-size // TASK_BYTES))
    read = staged(index.select("file", "offset", "length", "url_key", "ts", "place").repartition(tasks, "file", F.floor(F.col("offset") / F.lit(TASK_BYTES // 16))).sortWithinPartitions("file", "offset").mapInArrow(_read(folder), _READ), "warc-read")
    copies = index.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    found = index.where("type = 'response'").groupBy("digest", "url_key", "ts").agg(F.min("page_id").alias("refers_to")).join(copies, "digest")
    found = staged(found.select(F.col("digest").alias("payload_digest"), F.col("url_key").alias("refers_key"), F.col("ts").alias("refers_ts"), "refers_to", "n"), "warc-found")
    revisits = spread_join(read.where("record_type = 'revisit'"), found, ["payload_digest", "refers_key", "refers_ts"], read.count(), "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "ts", "place"]
    return read.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*names).unionByName(revisits.select(*names))


def archived(pages: DataFrame) -> DataFrame:
    """Writes pages to archives, merges their index and reads them back through it: see write_archives and read_archives.

    An empty table gives no rows; columns other than page_id, url and html are ignored.
    """
    folder = new_folder(pages.sparkSession, "warc")
    lines = staged(write_archives(pages, folder), "warc-lines")
    return read_archives(merged_index(lines), folder)

"""WARC archives: written and read as a data source, and put together to one nested row for each capture.

``spark.write.format("docmill_warc")`` writes records to ``.warc.gz`` files, each record a gzip member, files closed near
``max_bytes``. A task writes into a folder of its own attempt; the files of the attempts that count are moved at commit, so a lost
executor or a second attempt leaves nothing behind. Reading deals files out by their bytes and streams each one, so a task
holds one record and one batch at a time. Places are any that Arrow's file systems open (local and shared folders, S3, HDFS, GCS).

``assemble`` joins request, response and metadata records through WARC-Concurrent-To. A response (or revisit, resource,
conversion) is a capture; other records belong to the capture that they name or that names them, the smallest if there are several;
those that reach one only over others go to the smallest of their connected component. ``resolved`` joins revisits with the response
that they refer to by target, date and payload digest.

Scale: only identifiers are shuffled to find what belongs together; a record's nested parts are shuffled once. A capture with more
than ``NESTED`` side records goes on in further rows (``part`` 1, 2, ...), so no group is unbounded. Joins on a
hot identifier have one row for it on one side, and adaptive execution can split the other. Nothing is collected.

Defined cases: a null payload is empty; a null url leaves out the target; blanks and control characters of a url are
written as %20, line ends in values as a blank; equal payloads are those with the same SHA-256; of rows that share the largest id
and the payload each is a response; a null id is smaller than all others; records without an id, file headers and what a broken
file gives after its last whole record are no captures, the break is a row with ``error``; copies of a record count once; side
records that reach no capture are rows of their own without a response; empty tables and folders give no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..places import opened
from ._store import matched, materialize, small
from .components import components

FORMAT = "docmill_warc"
PAIRS = "array<struct<name:string,value:string>>"
SCHEMA = (
    "file string, place long, type string, record_id string, concurrent_to array<string>, refers_uri string, refers_date string, "
    f"target_uri string, date string, digest string, headers {PAIRS}, http_status int, http_headers {PAIRS}, fields {PAIRS}, "
    "payload binary, payload_bytes long, payload_sha1 string, error string"
)
_PAIRS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
_ARROW = pa.schema(
    [("file", pa.string()), ("place", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string()))]
    + [(c, pa.string()) for c in ("refers_uri", "refers_date", "target_uri", "date", "digest")]
    + [("headers", _PAIRS), ("http_status", pa.int32()), ("http_headers", _PAIRS), ("fields", _PAIRS)]
    + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string()), ("error", pa.string())]
)
CAPTURES = ("response", "revisit", "resource", "conversion")
#: Side records that one row nests at most, near enough.
NESTED = 1_000
#: Bytes of payloads that a batch gathers.
BATCH = 8_000_000


# reading


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: list[str]


def _lines(lines: Iterable[bytes]) -> tuple[list[tuple[str, str]], int]:
    """(name, value) of the header lines up to the empty one, and the bytes of all of them; folded lines are joined."""
    found: list[tuple[str, str]] = []
    n = 0
    for line in lines:
        n += len(line)
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not text:
            break
        if text[0] in " \t" and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {text.strip()}")
        else:
            name, _, value = text.partition(":")
            found.append((name.strip(), value.strip()))
    return found, n


def _dechunked(body: bytes) -> bytes:
    """A chunked body put together; as it is where its framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.match(rb"[0-9A-Fa-f]+", body[at:end]) if end >= 0 else None
        if not size:
            return body
        n = int(size[0], 16)
        if n == 0:
            return b"".join(out)
        if end + 2 + n > len(body):
            return body
        out.append(body[end + 2 : end + 2 + n])
        at = end + n + 4


def _bare(digest: str | None) -> str | None:
    """Hexadecimal digest of a labelled one in base 32 or 16."""
    if not digest:
        return None
    label, _, value = digest.rpartition(":")
    if label.lower() == "sha1" and len(value) == 32:
        return base64.b32decode(value.upper()).hex() if re.fullmatch("[A-Z2-7]{32}", value.upper()) else value
    return value.lower()


def _row(file: str, place: int, headers: list[tuple[str, str]], block: bytes, keep: bool, error: str | None) -> dict:
    values: dict[str, str] = {}
    for n, v in headers:
        values.setdefault(n.lower(), v)
    of = values.get
    ident = lambda v: v.strip("<>") if v else v
    kind, content = of("warc-type"), (of("content-type") or "").lower()
    status, http, fields, payload = None, None, None, block
    if content.startswith("application/http") and kind in ("request", "response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        first, _, rest = head.partition(b"\r\n")
        http, _ = _lines(rest.split(b"\n"))
        code = re.match(rb"HTTP/\S+ +(\d{3})", first)
        status = int(code[1]) if code else None
        if any(n.lower() == "transfer-encoding" and "chunked" in v.lower() for n, v in http):
            payload = _dechunked(payload)
    elif content.startswith("application/warc-fields"):
        fields, _ = _lines(block.strip(b"\r\n").split(b"\n"))
    return {
        "file": file, "place": place, "type": kind, "record_id": ident(of("warc-record-id")), "concurrent_to": [ident(v) for n, v in headers if n.lower() == "warc-concurrent-to"],
        "refers_uri": of("warc-refers-to-target-uri"), "refers_date": of("warc-refers-to-date"), "target_uri": of("warc-target-uri"), "date": of("warc-date"), "digest": _bare(of("warc-payload-digest")),
        "headers": headers, "http_status": status, "http_headers": http, "fields": fields,
        "payload": payload if keep else None, "payload_bytes": len(payload), "payload_sha1": hashlib.sha1(payload).hexdigest(), "error": error,
    }


def records_of(file: str, stream: io.BufferedIOBase, keep: bool) -> Iterator[dict]:
    """Rows of the records of one open archive, and a last one with ``error`` where it breaks off."""
    place, lost = 0, None
    try:
        while line := stream.readline(1 << 16):
            if not line.startswith(b"WARC/"):
                if line.strip() and lost is None:
                    lost = place
                place += len(line)
                continue
            if lost is not None:
                yield dict.fromkeys(_ARROW.names) | {"file": file, "place": lost, "error": "no record"}
                lost = None
            began = place
            headers, n = _lines(iter(stream.readline, b""))
            size = next((v for name, v in headers if name.lower() == "content-length"), "")
            if not size.isdigit():
                yield _row(file, began, headers, b"", keep, "no length") | {"type": None}
                place += len(line) + n
                continue
            block = stream.read(int(size))
            if len(block) < int(size):
                yield _row(file, began, headers, block, keep, "cut off") | {"type": None}
                return
            place += len(line) + n + len(block)
            yield _row(file, began, headers, block, keep, None)
        if lost is not None:
            yield dict.fromkeys(_ARROW.names) | {"file": file, "place": lost, "error": "no record"}
    except (OSError, EOFError, zlib.error) as broken:
        yield dict.fromkeys(_ARROW.names) | {"file": file, "place": place, "error": f"{type(broken).__name__}: {broken}"[:200]}


class Inflated(io.RawIOBase):
    """The bytes of gzip members one behind the other."""

    def __init__(self, raw: io.RawIOBase) -> None:
        self.raw, self.left, self.member = raw, b"", None

    def readable(self) -> bool:
        return True

    def readinto(self, into: memoryview) -> int:
        while True:
            if not self.left:
                # little at once: at the end of each member what is left is copied
                self.left = self.raw.read(1 << 14)
                if not self.left:
                    if self.member is not None:
                        raise EOFError("the file ends inside a member")
                    return 0
            if self.member is None:
                self.left = self.left.lstrip(b"\0")
                if not self.left:
                    continue
                self.member = zlib.decompressobj(31)
            got = self.member.decompress(self.left, len(into))
            self.left = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if self.member.eof:
                self.member = None
            if got:
                into[: len(got)] = got
                return len(got)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.keep = options["path"], options.get("payload", "true").lower() == "true"
        self.split = int(options.get("split_bytes", 16_000_000))

    def partitions(self) -> list[Files]:
        store, path = opened(self.path)
        info = store.get_file_info(path)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        hidden = lambda f: any(p[:1] in "._" for p in f.path[len(path) :].split("/") if p)
        files = sorted((f.path, f.size) for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.path) and (info.is_file or not hidden(f)))
        parts, room = [], 0
        for name, size in files:
            if not parts or room < size:
                parts, room = [*parts, Files([])], self.split
            parts[-1].paths.append(name)
            room -= size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_stream(path, compression=None, buffer_size=1 << 18) as raw:
                stream = io.BufferedReader(Inflated(raw) if path.endswith(".gz") else raw, 1 << 18)
                for row in records_of(path, stream, self.keep):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 2000
                    if held > BATCH:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


# writing


@dataclass
class Written(WriterCommitMessage):
    """Files of one task's attempt, below the folder of the write."""

    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows (headers, block) as records; the folder ``_w-<id>`` holds attempts until the commit."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite, self.id = options["path"], overwrite, uuid.uuid4().hex
        self.max_bytes, self.level = int(options.get("max_bytes", 1_000_000_000)), int(options.get("level", 6))

    def _folder(self) -> tuple[fs.FileSystem, str, str]:
        store, path = opened(self.path)
        return store, path.rstrip("/"), f"{path.rstrip('/')}/_w-{self.id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, _, folder = self._folder()
        store.create_dir(folder, recursive=True)
        task, files, out, size = TaskContext.get(), [], None, 0
        try:
            for batch in iterator:
                for headers, block in self.rows(batch):
                    if out is None:
                        files.append(f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                        size += out.write(self.member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    size += out.write(self.member(headers, block or b""))
                    if size >= self.max_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    @staticmethod
    def rows(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[str, str | None]], bytes | None]]:
        headers = batch.column("headers")
        names, values, ends = (x.to_pylist() for x in (headers.values.field("name"), headers.values.field("value"), headers.offsets))
        for k, block in enumerate(batch.column("block")):
            at = slice(ends[k], ends[k + 1])
            yield list(zip(names[at], values[at])), block.as_py()

    def member(self, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
        """One record as a gzip member; headers without a value are left out."""
        lines = ["WARC/1.1", *(f"{n}: {self.written(n, v)}" for n, v in headers if v is not None), f"Content-Length: {len(block)}"]
        record = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        # a small record needs no large window and no codes of its own, and making them would cost more than packing it
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 16 + 11, 4, zlib.Z_FIXED) if len(record) < 2000 else zlib.compressobj(self.level, zlib.DEFLATED, 31)
        return packer.compress(record) + packer.flush()

    @staticmethod
    def written(name: str, value: str) -> str:
        if name == "WARC-Payload-Digest" and re.fullmatch("sha1:[0-9a-f]{40}", value):
            return "sha1:" + base64.b32encode(bytes.fromhex(value[5:])).decode()
        return re.sub(r"[\r\n]+", " ", value) if "\n" in value or "\r" in value else value

    def commit(self, messages: list[Written | None]) -> None:
        store, path, folder = self._folder()
        old = [f for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.is_file and re.search(r"\.warc(\.gz)?$", f.path)] if self.overwrite else []
        store.create_dir(path, recursive=True)
        for m in messages:
            for name in m.files if m else []:
                store.move(f"{folder}/{name}", f"{path}/{name}")
        for f in old:
            store.delete_file(f.path)
        self._drop(store, folder)

    def abort(self, messages: list[Written | None]) -> None:
        store, _, folder = self._folder()
        self._drop(store, folder)

    @staticmethod
    def _drop(store: fs.FileSystem, folder: str) -> None:
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class WarcSource(DataSource):
    """``format("docmill_warc")``; options: payload, split_bytes; for writing max_bytes, level."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives below ``path``; without ``payload`` only its size and digest."""
    spark.dataSource.register(WarcSource)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).load(path)


# records of captures


def _named(**headers: Column) -> Column:
    return F.array(*[F.struct(F.lit(n.replace("_", "-")).alias("name"), v.cast("string").alias("value")) for n, v in headers.items()])


def capture_records(captures: DataFrame) -> DataFrame:
    """(headers, block): request, response or revisit, and metadata record of every capture.

    ``captures`` has (target_uri, date, payload binary, fields map<string,string>, refers struct<uri,date>); a capture with ``refers`` is a revisit.
    """
    salt = uuid.uuid4().hex
    uri = F.regexp_replace("target_uri", r"[\x00-\x20\x7f]", "%20")
    c = captures.select("*", uri.alias("uri"), F.octet_length("payload").alias("n"), F.sha1("payload").alias("sha1"), F.monotonically_increasing_id().alias("uid"))

    def ident(kind: str) -> Column:
        digits = F.md5(F.concat_ws(":", F.lit(salt), F.lit(kind), "uid").cast("binary"))
        return F.regexp_replace(digits, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "<urn:uuid:$1-$2-3$3-a$4-$5>")

    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n")).cast("binary")
    revisit = F.col("refers").isNotNull()
    http = lambda kind: F.lit(f"application/http; msgtype={kind}")
    again = lambda name: F.when(revisit, F.regexp_replace(F.col("refers")[name], r"[\x00-\x20\x7f]", "%20"))
    main = _named(
        WARC_Type=F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        WARC_Record_ID=ident("response"),
        WARC_Target_URI=F.col("uri"),
        WARC_Date=F.col("date"),
        WARC_Payload_Digest=F.concat(F.lit("sha1:"), "sha1"),
        WARC_Profile=F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        WARC_Refers_To_Target_URI=again("uri"),
        WARC_Refers_To_Date=again("date"),
        Content_Type=http("response"),
    )
    side = lambda kind, content: _named(WARC_Type=F.lit(kind), WARC_Record_ID=ident(kind), WARC_Concurrent_To=ident("response"), WARC_Target_URI=F.col("uri"), WARC_Date=F.col("date"), Content_Type=content)
    asked = F.regexp_extract(F.coalesce("uri", F.lit("")), r"^[^:]*://([^/?#]*)([^#]*)", 1), F.regexp_extract(F.coalesce("uri", F.lit("")), r"^[^:]*://([^/?#]*)([^#]*)", 2)
    request = F.concat(F.lit("GET "), F.when(asked[1].startswith("/"), asked[1]).otherwise(F.concat(F.lit("/"), asked[1])), F.lit(" HTTP/1.1\r\nHost: "), asked[0], F.lit("\r\n\r\n")).cast("binary")
    lines = F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit(": "), F.regexp_replace(e["value"], r"[\r\n]+", " "), F.lit("\r\n")))
    records = F.array(
        F.struct(side("request", http("request")).alias("headers"), request.alias("block")),
        F.struct(main.alias("headers"), F.when(revisit, head).otherwise(F.concat(head, "payload")).alias("block")),
        F.struct(side("metadata", F.lit("application/warc-fields")).alias("headers"), F.array_join(lines, "").cast("binary").alias("block")),
    )
    return c.select(F.explode(records).alias("r")).select("r.headers", "r.block")


def write_warc(captures: DataFrame, path: str, **options: str) -> None:
    """Write the records of ``captures`` below ``path``, one set of files for each task."""
    captures.sparkSession.dataSource.register(WarcSource)
    capture_records(captures).write.format(FORMAT).options(**options).mode("append").save(path)


def page_captures(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Captures of pages; of equal payloads of ``least`` bytes or more all revisit the page with the largest id. Fields: pageId."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("sha", F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256))))
    groups = keyed.filter("sha is not null").groupBy("sha").agg(F.count("*").alias("copies"), F.max(F.struct("id", "url")).alias("keep")).filter("copies > 1").select("sha", "keep")
    joined = matched(keyed, F.col("sha"), materialize(groups.withColumnRenamed("sha", "__of"), "warc-groups"), "__of", "left")
    again = F.col("keep").isNotNull() & ~F.col("keep.id").eqNullSafe(F.col("id"))
    known = F.when(F.col("id").isNotNull(), F.create_map(F.lit("pageId"), F.col("id").cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    return joined.select(
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), "payload", known.alias("fields"), F.when(again, F.struct(F.col("keep.url").alias("uri"), F.lit(date).alias("date"))).alias("refers")
    )


# captures of records


def value_of(pairs: Column, name: str) -> Column:
    """First value of a name, whatever its case."""
    return F.get(F.filter(pairs, lambda p: F.lower(p["name"]) == name.lower()), 0)["value"]


def owners(records: DataFrame) -> DataFrame:
    """(record_id, capture_id) of the side records of ``records`` (record_id, type, concurrent_to); of themselves where they reach no capture."""
    heads = records.filter(F.col("type").isin(*CAPTURES)).select(F.col("record_id").alias("to")).distinct()
    sides = records.filter(~F.col("type").isin(*CAPTURES)).select("record_id", "concurrent_to")
    named = sides.select("record_id", F.explode("concurrent_to").alias("to"))
    naming = records.filter(F.col("type").isin(*CAPTURES)).select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("to"))
    direct = named.unionByName(naming).join(heads, "to").groupBy("record_id").agg(F.min("to").alias("capture_id"))
    own = materialize(sides.select("record_id").distinct().join(direct, "record_id", "left"), "warc-owners")
    left = own.filter("capture_id is null").select("record_id")
    if left.isEmpty():
        return own
    # over other records: the whole component, and its smallest capture
    links = records.select("record_id", F.explode("concurrent_to").alias("to"))
    parts = components(links, "record_id", "to")
    first = parts.join(heads, F.col("node") == F.col("to")).groupBy("root").agg(F.min("to").alias("far"))
    far = parts.join(first, "root").select(F.col("node").alias("record_id"), "far")
    return own.join(far, "record_id", "left").select("record_id", F.coalesce("capture_id", "far", "record_id").alias("capture_id"))


def assemble(records: DataFrame) -> DataFrame:
    """(capture_id, part, response, requests, metadata): nested rows of ``records`` as ``read_warc`` gives them; they are read twice, once for their identifiers."""
    whole = records.filter("error is null and record_id is not null and type <> 'warcinfo'")
    own = materialize(owners(materialize(whole.select("record_id", "type", "concurrent_to"), "warc-ids")), "warc-owned")
    many = small(materialize(own.groupBy("capture_id").count().filter(F.col("count") > NESTED), "warc-many"))
    placed = own.join(many, "capture_id", "left").select("record_id", "capture_id", F.when(F.col("count").isNull(), 0).otherwise(F.pmod(F.xxhash64("record_id"), F.ceil(F.col("count") / NESTED))).cast("int").alias("part"))
    parts = "record_id type target_uri date http_status http_headers headers fields refers_uri refers_date digest payload payload_bytes payload_sha1".split()
    main = whole.filter(F.col("type").isin(*CAPTURES)).select(F.col("record_id").alias("capture_id"), F.lit(0).alias("part"), F.struct("file", "place").alias("at"), F.struct(*parts).alias("main"))
    some = F.struct("record_id", "type", "target_uri", "date", "headers", "http_headers", "fields", "payload")
    side = whole.filter(~F.col("type").isin(*CAPTURES)).dropDuplicates(["record_id"]).join(placed, "record_id").select("capture_id", "part", some.alias("side"))
    both = main.unionByName(side, allowMissingColumns=True)
    of = lambda request: F.array_sort(F.collect_list(F.when((F.col("side.type") == "request") == request, F.col("side"))))
    return both.groupBy("capture_id", "part").agg(F.min_by("main", "at").alias("response"), of(True).alias("requests"), of(False).alias("metadata"))


def resolved(captures: DataFrame) -> DataFrame:
    """``captures``, a table of them, with ``original``, the response that a revisit refers to (the smallest id if several fit); null for others."""
    key = lambda uri, date, digest: F.struct(F.coalesce(uri, F.lit("")).alias("uri"), F.coalesce(date, F.lit("")).alias("date"), digest.alias("digest"))
    r = lambda name: F.col(f"response.{name}")
    revisit = F.coalesce(r("type") == "revisit", F.lit(False))
    asked = captures.filter(revisit).withColumn("__to", key(r("refers_uri"), r("refers_date"), r("digest")))
    known = captures.filter(r("type") == "response").select(key(r("target_uri"), r("date"), r("payload_sha1")).alias("__to"), F.struct("capture_id", "response", "metadata").alias("original"))
    known = known.join(asked.select("__to").distinct(), "__to", "left_semi").groupBy("__to").agg(F.min_by("original", "original.capture_id").alias("original"))
    # a table, so that the join has an exchange of its own, whose hot keys adaptive execution can split
    found = asked.join(materialize(known, "warc-originals"), "__to", "left").drop("__to")
    return found.unionByName(captures.filter(~revisit).withColumn("original", F.lit(None).cast(known.schema["original"].dataType)))

"""WARC archives: writing captures, reading records, and assembling transactions.

Writing makes four kinds of gzip members: a warcinfo record a file, and per capture a request, a response (or, for a
payload that an earlier capture has, a revisit) and a metadata record. Request and metadata name the response's or
revisit's record in WARC-Concurrent-To. Reading turns each record into a row; assembly follows the concurrent-to
identifiers, in either direction and over several steps, and gives one nested row per capture, whatever order or files the
records came in.

Which record is the response of equal payloads is settled before writing, over (page_id, digest) only: the smallest
page_id of a digest, by a partial aggregate and a join of narrow rows; the payloads themselves are shuffled once, by
page_id, so copies of one payload are spread. Files are named at random and listed by the tasks that commit.

Defined cases: a null html is an empty payload; rows with the same page_id and payload are all responses if theirs is
the smallest page_id; rows with a null page_id are captures without id and revisits of the smallest id, if any; null
urls are written without WARC-Target-URI; columns other than page_id, url and html are ignored, whatever their names; an
empty table gives no archives. Reading: a header that repeats keeps its first value, WARC-Concurrent-To all of them; a
Content-Length that is no number counts as 0; a record that a file's end cuts off is a row with complete = false.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialise, open_fs, shared_dir

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: WARC-Date of records made from tables that hold none.
NO_DATE = "1970-01-01T00:00:00Z"


def _members(record_type: str, record_id: str, uri: str | None, fields: dict[str, str], content_type: str, block: bytes) -> bytes:
    """One record as a gzip member."""
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {NO_DATE}"]
    head += ["WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", uri)] if uri else []
    head += [f"{k}: {v}" for k, v in fields.items()] + [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Writes all pages (page_id, url, html) to archives; returns the list of files: folder, name, records.

    Of captures with equal payloads of at least least_bytes bytes, the one with the smallest page_id is the response.
    """
    folder = folder or shared_dir(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    # hex here; the archive's own digests are base32
    digests = rows.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("n")).where(F.col("n") >= least_bytes).select("page_id", "digest")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = digests.join(first, "digest").where("page_id is null or page_id > first").select("page_id", "first", "digest").distinct()
    later = later.select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "first")
    told = rows.withColumn("digest", F.sha1("html")).join(later, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left").select("page_id", "url", "html", "first")

    def run(batches):
        from pyspark import TaskContext

        fs, base = open_fs(folder)
        name, out, records = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                for r in range(batch.num_rows):
                    page_id, url, html, ref = (batch.column(k)[r].as_py() for k in range(4))
                    if out is None:
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                        out.write(_members("warcinfo", f"urn:uuid:{uuid.uuid4()}", None, {"WARC-Filename": name}, "application/warc-fields", b"format: WARC File Format 1.1\r\n"))
                    payload = html.encode()
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    own = f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}/{name}/{r}/{records}')}"
                    target = {"WARC-Payload-Digest": f"sha1:{digest}"}
                    host, _, path = (url or "").partition("://")[2].partition("/")
                    host, path = re.sub(r"\s", "", host), re.sub(r"\s", "%20", path)
                    get = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
                    status = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                    info = f"page-id: {'' if page_id is None else page_id}\r\npayload-bytes: {len(payload)}\r\n" + (f"refers-to-page-id: {ref}\r\n" if ref is not None else "")
                    out.write(_members("request", f"urn:uuid:{uuid.uuid4()}", url, {"WARC-Concurrent-To": f"<{own}>"}, "application/http; msgtype=request", get))
                    if ref is None:
                        out.write(_members("response", own, url, target, "application/http; msgtype=response", status + payload))
                    else:
                        out.write(_members("revisit", own, url, target | {"WARC-Profile": PROFILE}, "application/http; msgtype=response", status))
                    out.write(_members("metadata", f"urn:uuid:{uuid.uuid4()}", url, {"WARC-Concurrent-To": f"<{own}>"}, "application/warc-fields", info.encode()))
                    records += 3
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pylist([{"folder": folder, "name": name, "records": records}], pa.schema([("folder", pa.string()), ("name", pa.string()), ("records", pa.int64())]))

    return materialise(told.mapInArrow(run, "folder string, name string, records long"))


def parse(stream):
    """(header fields in lower case, concurrent-to ids, block, whether it is whole) of every record of a gzip or plain WARC stream, one at a time."""
    buffer, z, member = bytearray(), None, None

    def plain():
        """The uncompressed bytes, some at a time."""
        nonlocal z, member
        while raw := stream.read(1 << 18):
            if member is None:
                member = raw[:2] == b"\x1f\x8b"
            if not member:
                yield raw
                continue
            while raw:
                z = z or zlib.decompressobj(31)
                yield z.decompress(raw, 1 << 20)
                raw, z = (z.unused_data, None) if z.eof else (z.unconsumed_tail, z)

    source = plain()

    def more() -> bool:
        part = next(source, None)
        if part is None:
            return False
        buffer.extend(part)
        return True

    while True:
        while buffer[:2] == b"\r\n":
            del buffer[:2]
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                return
        while buffer[:2] == b"\r\n":
            del buffer[:2]
        end = buffer.find(b"\r\n\r\n")
        if end < 0:
            continue
        lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
        fields, links = {}, []
        for k, _, v in (x.partition(":") for x in lines[1:]):
            fields.setdefault(k.strip().lower(), v.strip())
            links += [v.strip().strip("<>")] if k.strip().lower() == "warc-concurrent-to" else []
        length = fields.get("content-length", "")
        size = int(length) if length.isascii() and length.isdigit() else 0
        while len(buffer) < end + 4 + size and more():
            pass
        yield fields, links, bytes(buffer[end + 4 : end + 4 + size]), len(buffer) >= end + 4 + size
        del buffer[: end + 4 + size]


_RECORD = "record_id string, record_type string, concurrent_to string, target_uri string, date string, payload_digest string, payload_bytes long, computed_digest string, concurrent array<string>, complete boolean, info map<string,string>"


def records(files: DataFrame, payload: bool = False) -> DataFrame:
    """One row per record of the listed archives (folder, name). payload: adds the payload itself as a column.

    payload is what follows the HTTP header in responses and requests, and the whole block elsewhere; computed_digest
    and payload_bytes are of that.
    """
    kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("computed_digest", pa.string()), ("concurrent", pa.list_(pa.string())), ("complete", pa.bool_()), ("info", pa.map_(pa.string(), pa.string()))]
    schema = pa.schema(kinds + [("payload", pa.binary())] * payload)

    def run(batches):
        for batch in batches:
            for f in batch.to_pylist():
                fs, base = open_fs(f["folder"])
                held, size = [], 0
                with fs.open_input_stream(f"{base}/{f['name']}", compression=None) as stream:
                    for h, links, block, whole in parse(stream):
                        body = block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else block
                        info = [tuple(y.strip() for y in x.split(":", 1)) for x in body.decode("utf-8", "replace").splitlines() if ":" in x] if h.get("content-type") == "application/warc-fields" else []
                        row = {"record_id": h.get("warc-record-id", "").strip("<>"), "record_type": h.get("warc-type"), "concurrent_to": links[0] if links else None, "target_uri": h.get("warc-target-uri"), "date": h.get("warc-date"), "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload_bytes": len(body), "computed_digest": base64.b32encode(hashlib.sha1(body).digest()).decode(), "concurrent": links, "complete": whole, "info": info}
                        held.append(row | {"payload": body} if payload else row)
                        size += len(body) if payload else 300
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    n = max(1, files.count())
    return files.select("folder", "name").repartition(min(n, 10_000)).mapInArrow(run, _RECORD + ", payload binary" * payload)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, structs request and response (a response or revisit), metadata (an array of
    structs) and others (an array: further requests and responses, and records of other types that are linked).

    A capture is named after its response (the smallest record_id of its responses and revisits; of its records, if it has none). A request
    or metadata record with one link to a response belongs to it at once. Other links (of responses, several of one record, to
    records of other types or to none) join what they connect, by connected components over such links only. Records that
    repeat are kept each. A capture's records make one row, so they should fit a task. recs is written once, as it is read more than once.
    """
    recs = materialise(recs.where("record_type <> 'warcinfo'"))
    whole = F.col("record_type").isin("response", "revisit")
    plain = ~whole & (F.size("concurrent") == 1)
    links = recs.select(F.col("record_id").alias("u"), F.explode("concurrent").alias("v"), plain.alias("plain"))
    hubs = recs.where(whole).select(F.col("record_id").alias("v")).distinct()
    odd = materialise(links.where("not plain").select("u", "v").unionByName(links.where("plain").join(hubs, "v", "left_anti").select("u", "v")))
    rooted = recs.withColumn("root", F.when(plain, F.col("concurrent")[0]).otherwise(F.col("record_id")))
    if odd.limit(1).count():
        loose = odd.select(F.col("u").alias("loose")).distinct()
        rooted = rooted.join(loose, F.col("record_id") == F.col("loose"), "left").withColumn("root", F.when(F.col("loose").isNull(), F.col("root")).otherwise(F.col("record_id"))).drop("loose")
        ends = rooted.select(F.col("record_id").alias("v"), F.col("root").alias("end")).distinct()
        joined = materialise(components(odd.join(ends, "v", "left").select("u", F.coalesce("end", "v").alias("v"))).select(F.col("node").alias("root"), "component"))
        names = rooted.join(joined, "root").groupBy("component").agg(F.coalesce(F.min(F.when(whole, F.col("record_id"))), F.min("record_id")).alias("name"))
        rooted = rooted.join(joined.join(names, "component").select("root", "name"), "root", "left")
        df = rooted.withColumn("capture_id", F.coalesce("name", "root"))
    else:
        df = rooted.withColumn("capture_id", F.col("root"))
    r = F.struct("record_id", *[c for c in recs.columns if c not in ("record_id", "info")], "info")
    kind = F.when(whole, F.lit("response")).when(F.col("record_type").isin("request", "metadata"), F.col("record_type")).otherwise(F.lit("other"))
    # maps cannot be ordered, so arrays are ordered by record_id
    by_id = lambda c: F.array_sort(c, lambda x, y: F.when(x["record_id"] < y["record_id"], -1).when(x["record_id"] > y["record_id"], 1).otherwise(0))
    all_of = lambda k: by_id(F.collect_list(F.when(F.col("kind") == k, F.col("r"))))
    df = df.select("capture_id", kind.alias("kind"), r.alias("r")).groupBy("capture_id").agg(*[all_of(k).alias(k) for k in ("request", "response", "metadata", "other")])
    first = lambda c: F.try_element_at(c, F.lit(1))
    rest = F.concat(F.slice("request", 2, F.greatest(F.size("request"), F.lit(1))), F.slice("response", 2, F.greatest(F.size("response"), F.lit(1))), F.col("other"))
    return df.select("capture_id", first("request").alias("request"), first("response").alias("response"), "metadata", rest.alias("others"))

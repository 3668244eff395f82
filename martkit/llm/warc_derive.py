"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

A response record has WARC headers and a block (HTTP head and payload).  For each one the
builder makes a ``metadata`` record (warc-fields: title, language, links, source digests and
headers) and a ``conversion`` record (text/plain), both with WARC-Refers-To, target URI and
date of the response, and with digests of their own.  Records are written one gzip member
each, so a file can be cut at any record, and read back by offset or as a stream.

Defined cases: null html is an empty payload and converts to an empty text; a null url
gives a response without target URI; a payload whose digest differs from its header is
marked ``digest-mismatch`` in the metadata, never dropped; rows that repeat give equal
records with equal identifiers; an empty table gives no records; only page_id, url and html
are read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder, ship, table

CRAWL_DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 32 << 20
RECORD = "page_id bigint, type string, headers array<struct<name:string,value:string>>, block binary"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122

_OPEN = re.compile(r"<!--|<(script|style|noscript|template|svg|head)(?=[\s/>])[^>]*>", re.I)
_CLOSE = {"": re.compile("-->"), **{k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "noscript", "template", "svg")}}
_TO_END = ("", "script", "style")  # comments and raw text: what is not closed runs to the end of the page
# what stands in a head besides the elements of _OPEN; anything else ends it, closed or not
_IN_HEAD = re.compile(
    r"(?:\s+|</(?!(?:body|html|br)\b)[a-z][^>]*>|<(?:meta|link|base|basefont|bgsound)(?=[\s/>])[^>]*>|<!(?!--)[^>]*>|<\?[^>]*>|"
    r"<(title|noframes)(?=[\s/>])[^>]*>.*?</\1\s*>)*+", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|"
    r"pre|section|table|tbody|td|tfoot|th|thead|tr|ul|body|html)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_BLANK = re.compile(r"[ \t\r\f\v\xa0]+")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def shown(page: str) -> str:
    """The page without comments, head, and elements that show no text.

    A head ends where its metadata ends, with or without ``</head>``; a self-closed svg is
    empty; an unclosed noscript, template or svg loses only its tag.
    """
    parts, at, head, unclosed = [], 0, False, set()
    while True:
        if head:
            at = _IN_HEAD.match(page, at).end()
        m = _OPEN.search(page, at)
        if m is None:
            return " ".join([*parts, page[at:]])
        parts.append(page[at:m.start()])
        name = (m[1] or "").lower()
        head = name == "head" or head and m.start() == at and name != "svg"
        at = m.end()
        if name == "head" or name == "svg" and m[0].endswith("/>") or name in unclosed:
            continue
        if end := _CLOSE[name].search(page, at):
            at = end.end()
        elif name in _TO_END:
            return " ".join(parts)
        else:
            unclosed.add(name)


def plain_text(page: str) -> str:
    """Visible text of a page: one line per block element, white space collapsed."""
    text = _TAG.sub("", _BREAK.sub("\n", shown(page)))
    lines = (_BLANK.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def _one_line(text: str) -> str:
    return re.sub(r"\s+", " ", html.unescape(text)).strip()


def response(page_id: int | None, url: str | None, page: str | None) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of a response record for a stored page."""
    payload = (page or "").encode("utf-8", "surrogatepass")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    return [
        ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {url}')}>"),
        *([("WARC-Target-URI", _one_line(url))] if url else []), ("WARC-Date", CRAWL_DATE),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))], block


def derive(headers: list[tuple[str, str]], block: bytes) -> Iterator[tuple[str, list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of a response record."""
    h = dict(headers)
    head, _, payload = block.partition(b"\r\n\r\n")
    page = payload.decode("utf-8", "replace")
    source = h.get("WARC-Record-ID", "")
    own = digest(payload)
    text = plain_text(page).encode("utf-8", "replace")
    title, lang = _TITLE.search(page), _LANG.search(page)
    fields = [
        ("title", _one_line(title[1]) if title else ""), ("language", lang[1].lower() if lang else ""),
        ("payload-digest", own), ("payload-length", str(len(payload))),
        ("digest-mismatch", str(h.get("WARC-Payload-Digest", own) != own).lower()),
        ("text-digest", digest(text)), ("text-length", str(len(text))),
        *[(f"http-{k.strip().lower().decode('latin-1')}", v.strip().decode("latin-1"))
          for k, c, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]) if c],
        *[(f"source-{k}", v) for k, v in headers],
        *[("outlink", _one_line(a or b or c)) for a, b, c in _LINK.findall(page)]]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    linked = [("WARC-Refers-To", source), *[(k, h[k]) for k in ("WARC-Target-URI", "WARC-Date") if k in h]]
    for kind, mime, data, more in (
        ("metadata", "application/warc-fields", meta, []),
        ("conversion", "text/plain; charset=utf-8", text, [("WARC-Source-Payload-Digest", h.get("WARC-Payload-Digest", own))]),
    ):
        yield kind, [
            ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, f'{source} {kind}')}>"), *linked, *more,
            ("Content-Type", mime), ("WARC-Block-Digest", digest(data)), ("Content-Length", str(len(data)))], data


def pack(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


#: compressed bytes handed to the decompressor at once; what a member leaves over is copied
READ_BYTES = 16 << 10


def unpack(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and blocks of the records of a file."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(view):
                raise ValueError("the file ends inside a record")
            piece = view[at: at + READ_BYTES]
            parts.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = [(k, v) for k, _, v in (x.partition(": ") for x in lines[1:])]
        n = int(dict(headers)["Content-Length"])
        if len(rest) < n:
            raise ValueError("a record is shorter than its Content-Length")
        yield headers, rest[:n]


def derivatives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, type, headers, block): two derived records per page."""
    ship(spark)
    schema = pa.schema([("page_id", pa.int64()), ("type", pa.string()),
                        ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))), ("block", pa.binary())])

    def build(batches):
        for b in batches:
            rows = []
            for page_id, url, page in zip(*b.columns):
                for kind, headers, block in derive(*response(page_id.as_py(), url.as_py(), page.as_py())):
                    rows.append({"page_id": page_id.as_py(), "type": kind, "headers": [{"name": k, "value": v} for k, v in headers], "block": block})
                if len(rows) >= 256:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(build, RECORD)


def write_warc(spark: SparkSession, records: DataFrame, root: str) -> DataFrame:
    """Write records as ``.warc.gz`` files; returns the manifest (path, records, bytes).

    A task writes to a temporary name and renames, so a repeated task leaves the same file.
    """
    ship(spark)
    fs, place = pafs.FileSystem.from_uri(root)
    fs.create_dir(place, recursive=True)

    def write(batches):
        part, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def done():
            path = f"{root}/{part:06d}-{number:06d}.warc.gz"
            fs, place = pafs.FileSystem.from_uri(path)
            temporary = f"{place}.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(temporary, compression=None) as f:
                f.write(b"".join(parts))
            fs.move(temporary, place)
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([len(parts)], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

        for b in batches:
            for headers, block in zip(b.column(0), b.column(1)):
                parts.append(pack([(x["name"], x["value"]) for x in headers.as_py()], block.as_py()))
                size += len(parts[-1])
                if size >= FILE_BYTES:
                    yield done()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield done()

    schema = "path string, records bigint, bytes bigint"
    records.select("headers", "block").mapInArrow(write, schema).write.parquet(f"{root}/manifest")
    return spark.read.schema(schema).parquet(f"{root}/manifest")


def read_warc(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(type, record_id, refers_to, target_uri, source_digest, block_digest, block) of the files."""
    ship(spark)
    names = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Source-Payload-Digest", "WARC-Block-Digest"]

    def read(batches):
        for b in batches:
            for path in b.column(0):
                fs, place = pafs.FileSystem.from_uri(path.as_py())
                with fs.open_input_file(place) as f:
                    data = f.read()
                cols: list[list] = [[] for _ in range(7)]
                for headers, block in unpack(data):
                    h = dict(headers)
                    if digest(block) != h["WARC-Block-Digest"]:
                        raise ValueError("a block differs from its digest")
                    for c, k in zip(cols, names):
                        c.append(h.get(k))
                    cols[6].append(block)
                    if len(cols[6]) >= 256:
                        yield batch(cols)
                        cols = [[] for _ in range(7)]
                yield batch(cols)

    def batch(cols):
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.string()) for c in cols[:6]], pa.array(cols[6], pa.binary())],
            ["type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "block"])

    return manifest.select("path").mapInArrow(
        read, "type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, block binary")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derive both records of every page, write them, and return what is read back."""
    manifest = write_warc(spark, derivatives(spark, table(spark, sf_dir, "pages")), fresh_folder(spark, "warc"))
    files = manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return read_warc(spark, files).select(
        "type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest",
        F.octet_length("block").cast("bigint").alias("n_bytes"))

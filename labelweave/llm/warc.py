"""Web archives: a writer of deduplicated gzip records, and a reader that
salvages what it can of damaged archives.

A record is one gzip member. Of pages with equal payloads the first is written
as a response, the others as revisits that refer to it. The reader checks every
member and record; after a failed check it searches for the next valid member or
version line, goes on there, and reports the bytes between as a quarantined gap.
"""

import base64
import hashlib
import re
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelweave.llm.common import table
from labelweave.session import fresh_dir, materialise

RECORDS_PER_FILE = 4000
DATE = "2000-01-01T00:00:00Z"
RECORD_ID = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_START = b"\x1f\x8b\x08"
_EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_CHUNK = 1 << 16
_READ = ("kind string, path string, start long, end long, reason string, type string, record_id string, "
         "target_uri string, payload_digest string, refers_to string, payload_bytes long, payload binary")


# Writing

def find_revisits(pages, min_bytes=0):
    """page_id, digest (hex) and the page each revisit refers to.

    Digests are counted before they are shuffled; only digests met twice are
    joined back, against a written table, so that a payload with very many pages
    can be split by adaptive execution.
    """
    slim = pages.select("page_id", "digest", "size").where(F.col("size") >= min_bytes)
    repeated = materialise(
        slim.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null").drop("n"), "payloads")
    return (slim.join(repeated, "digest").where("page_id <> first_id")
            .groupBy("page_id", "digest").agg(F.min("first_id").alias("first_id")))


def warc_member(page_id, url, payload, digest, first_id):
    """One page as a gzip member."""
    number = lambda n: f"<{RECORD_ID}{'none' if n is None or n != n else int(n)}>"
    revisit = first_id is not None and first_id == first_id
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    uri = url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {number(page_id)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {uri or number(page_id)[1:-1]}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
             f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"]
    if revisit:
        lines += [f"WARC-Refers-To: {number(first_id)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


@F.pandas_udf(T.BinaryType())
def _members(page_id: pd.Series, url: pd.Series, payload: pd.Series, digest: pd.Series,
             first_id: pd.Series) -> pd.Series:
    # The text writer ends every row with its separator. Set to a zero byte, it
    # supplies the last byte of the member: the top byte of a size below 16 MB.
    # A larger record is followed by an empty member, whose size is zero.
    out = []
    for row in zip(page_id, url, payload, digest, first_id):
        member = warc_member(*row)
        out.append((member if member[-1] == 0 else member + _EMPTY_MEMBER)[:-1])
    return pd.Series(out)


def write_archives(pages, folder, min_bytes=0, records_per_file=RECORDS_PER_FILE):
    """Writes page_id, url, html as gzip archives below ``folder``.

    A null html is an empty payload, a null url is replaced by the record's own
    id. Payloads of fewer than ``min_bytes`` are always responses. Rows with the
    same page_id and payload are responses both. Rows without page_id are
    responses that nothing refers to. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"),
                            F.length(payload).alias("size"))
    joined = digested.drop("size").join(find_revisits(digested, min_bytes), ["page_id", "digest"], "left")
    member = _members("page_id", "url", "payload", "digest", "first_id")
    (joined.select(member.cast("string").alias("value"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).text(folder))


# Reading

class Damaged(ValueError):
    pass


def _inflate(data, at):
    """The content of the member at ``at`` and where it ends."""
    unpacker, out, fed = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            chunk = data[fed:fed + _CHUNK]
            if not chunk:
                raise Damaged("member is cut short")
            out.append(unpacker.decompress(chunk))
            fed += len(chunk)
    except zlib.error as error:
        raise Damaged(f"member: {error}") from None
    return b"".join(out), fed - len(unpacker.unused_data)


def _digest_holds(stated, data):
    kind, _, value = stated.partition(":")
    return kind.lower() != "sha1" or value.upper() == base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(data, at):
    """Headers, block and end of the record whose version line is at ``at``."""
    if not _VERSION.match(data, at):
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("header has no end")
    headers = {}
    for line in data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdecimal():
        raise Damaged("no content length")
    begin = stop + 4
    end = begin + int(headers["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("record has no end where its length says")
    block = data[begin:end]
    if not _digest_holds(headers.get("warc-block-digest", ""), block):
        raise Damaged("block digest differs")
    if headers.get("warc-type") == "response":
        if not _digest_holds(headers.get("warc-payload-digest", ""), _http(block)[1]):
            raise Damaged("payload digest differs")
    return headers, block, end + 4


def _http(block):
    """Stated length and content of an HTTP response; anything else is content."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return None, block
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return int(stated[1]) if stated else None, body


def salvage(data):
    """("record", start, end, headers, block) of every sound record of an
    archive, and ("gap", start, end, reason, None) of the bytes between."""
    at, bad_from, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(GZIP_START, at):
                content, end = _inflate(data, at)
                records, inner = [], 0
                while inner < len(content):
                    headers, block, inner = _record(content, inner)
                    records.append((headers, block))
            else:
                headers, block, end = _record(data, at)
                records = [(headers, block)]
        except Damaged as error:
            if bad_from is None:
                bad_from, reason = at, str(error)
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if bad_from is not None:
            yield "gap", bad_from, at, reason, None
            bad_from = None
        for headers, block in records:
            yield "record", at, end, headers, block
        at = end
    if bad_from is not None:
        yield "gap", bad_from, len(data), reason, None


def read_archives(spark, folder):
    """Rows of kind ``record`` and of kind ``gap`` of all archives of a folder.

    Archives may hold gzip members or plain records. A gap tells its bytes and
    the check that failed; a record of a damaged member is not returned, for its
    bytes cannot be trusted. A file is read in one task, so archives should be
    as small as web archives are; the writer bounds the records of each.
    """
    def read(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for kind, start, end, what, block in salvage(bytes(content)):
                    if kind == "gap":
                        rows.append((kind, path, start, end, what, *[None] * 7))
                        continue
                    stated, payload = _http(block)
                    revisit = what.get("warc-type") == "revisit"
                    rows.append((kind, path, start, end, None, what.get("warc-type"),
                                 what.get("warc-record-id"), what.get("warc-target-uri"),
                                 what.get("warc-payload-digest"), what.get("warc-refers-to"),
                                 stated if revisit else len(payload), None if revisit else payload))
                    if len(rows) >= 500:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    return (spark.read.format("binaryFile").load(folder).select("path", "content")
            .mapInPandas(read, _READ))


def _frame(rows):
    out = pd.DataFrame(rows, columns=[f.split()[0] for f in _READ.split(", ")], dtype=object)
    return out.astype({"start": "Int64", "end": "Int64", "payload_bytes": "Int64"})


def op2_warc_salvage(spark, sf_dir):
    folder = fresh_dir(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), folder)
    number = lambda c: F.regexp_extract(c, RECORD_ID + r"(\d+)", 1)
    records = read_archives(spark, folder).where("kind = 'record'")
    as_long = lambda c: F.when(number(c) != "", number(c).cast("long"))
    return records.select(
        as_long("record_id").alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        F.col("type").alias("record_type"), as_long("refers_to").alias("refers_to"))


ORACLE = """
with d as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
b as (
  select *, array_to_string(list_transform(range(1, 41), lambda i:
    lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') as bits from d),
e as (
  select *, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + 16 * cast(substr(bits, 5 * i + 1, 1) as int) + 8 * cast(substr(bits, 5 * i + 2, 1) as int)
        + 4 * cast(substr(bits, 5 * i + 3, 1) as int) + 2 * cast(substr(bits, 5 * i + 4, 1) as int)
        + cast(substr(bits, 5 * i + 5, 1) as int), 1)), '') as payload_digest,
    min(page_id) over (partition by hex) as first_id
  from b)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from e
"""

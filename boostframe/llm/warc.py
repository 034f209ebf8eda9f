"""Archives of WARC records under a Zstandard dictionary (operator 3).

An archive is the content of one ``.warc.zst`` file: a leading skippable frame that holds the dictionary, then one frame
per record, each compressed by itself. The dictionary is trained from records of the archive itself. Archives are the
rows of a table (``archive``, ``records``, ``data``): Spark's writer commits them, so it works on any store that Spark
writes to and a lost executor costs a retry. Copies are found by digest before any payload moves; only the ids of
revisits are joined to the pages, by page id.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, cut, prepare, shared_path, table

DICT_MAGIC = 0x184D2A5D                      # the skippable frame that the WARC format reserves for a dictionary
ARCHIVE_BYTES, DICT_BYTES, SAMPLE_BYTES, LEVEL = 16 << 20, 64 << 10, 2 << 20, 3
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, payload_digest: str, revisit: bool, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit holds no payload, only its size, digest and the record it refers to."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else "urn:page:unknown"
    block = HTTP % len(payload) + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}",
            f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{payload_digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack(records: list[bytes], dict_bytes: int = DICT_BYTES, level: int = LEVEL) -> bytes:
    """A whole archive. Training reads records spread evenly over it, ``SAMPLE_BYTES`` at most; with too little to train
    from, the dictionary is raw content: the start of those records."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[:SAMPLE_BYTES // 8] for r in records[::step]]
    dict_bytes = min(dict_bytes, max(1024, total // 16))              # a small archive gets a small dictionary
    try:
        made = zstandard.train_dictionary(dict_bytes, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        made = b"".join(samples)[:dict_bytes]
    out = [DICT_MAGIC.to_bytes(4, "little"), len(made).to_bytes(4, "little"), made]
    compress = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(made) if made else None)
    out += [compress.compress(r) for r in records]
    return b"".join(out)


def unpack(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(headers, block) of every record of an archive."""
    if int.from_bytes(data[:4], "little") != DICT_MAGIC:
        raise ValueError("not an archive with a leading dictionary frame")
    end = 8 + int.from_bytes(data[4:8], "little")
    made = data[8:end]
    read = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(made) if made else None)
    plain = read.stream_reader(io.BytesIO(data[end:]), read_across_frames=True).read()
    view, at = memoryview(plain), 0
    while at < len(plain):
        stop = plain.index(b"\r\n\r\n", at)
        lines = plain[at:stop].decode("utf-8", "surrogatepass").split("\r\n")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        yield head, view[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, refers_to) of the pages whose payload, of at least ``min_bytes``, a larger page_id holds as well."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    slim = cut(pages.select("page_id", F.sha1(payload).alias("sha1"), F.length(payload).alias("n"))
               .where(F.col("n") >= min_bytes), "digests")
    kept = (slim.groupBy("sha1", "n").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
            .where("copies > 1").drop("copies"))
    return (slim.join(cut(kept, "kept"), ["sha1", "n"])
            .where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())
            .select("page_id", "sha1", "refers_to").distinct())


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One record per row of ``pages`` (page_id, url, html); the payload is the html in UTF-8, null html is empty.

    Of equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is the response, rows that repeat
    that id with it included; the others are revisits that refer to it. Null page_ids are smaller than any other; if all
    ids of a payload are null, each is a response. Null urls become ``urn:page:unknown``. Other columns are ignored; an
    empty table gives no archive. An archive closes at ``archive_bytes`` of records; one long record may exceed that.
    """
    prepare(pages.sparkSession)
    refers = cut(revisits(pages, min_bytes), "revisits").select(
        F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "refers_to")
    rows = pages.select("page_id", "url", "html").join(
        refers, F.col("page_id").eqNullSafe(F.col("_id"))
        & (F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8")) == F.col("_sha1")), "left")

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            return pa.RecordBatch.from_pydict({"archive": [f"part-{part:05d}-{number:05d}.warc.zst"],
                                               "records": pa.array([len(held)], pa.int32()), "data": [pack(held)]})

        for batch in batches:
            for page_id, url, html, revisit, to in zip(*(batch.column(c) for c in range(5))):
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                held.append(record(page_id.as_py(), url.as_py(), payload, digest(payload), revisit.as_py(), to.as_py()))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
                    held, size, number = [], 0, number + 1
        if held:
            yield close()

    (rows.select("page_id", "url", "html", F.col("refers_to").isNotNull().alias("revisit"), "refers_to")
     .mapInArrow(run, "archive string, records int, data binary").write.option("compression", "none").parquet(path))


def read_archives(spark, path: str, id_type: str = "bigint") -> DataFrame:
    """Per record of the archives at ``path``: page_id, url, payload (null for revisits), payload_bytes,
    payload_digest (computed anew for responses), record_type and refers_to."""
    prepare(spark)
    schema = (f"page_id {id_type}, url string, payload binary, payload_bytes bigint, payload_digest string, "
              f"record_type string, refers_to {id_type}")
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):

        def key(name: str | None):
            value = None if name is None or name == "<urn:page:null>" else name[10:-1]
            return value if value is None or id_type == "string" else int(value)

        for batch in batches:
            for data in batch.column("data"):
                rows, size = [], 0
                for head, block in unpack(data.as_py()):
                    http, _, payload = bytes(block).partition(b"\r\n\r\n")
                    revisit = head["WARC-Type"] == "revisit"
                    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    assert revisit or n == len(payload)
                    said = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    uri = head["WARC-Target-URI"]
                    rows.append((key(head["WARC-Record-ID"]), None if uri == "urn:page:unknown" else uri,
                                 None if revisit else payload, n, said if revisit else digest(payload),
                                 head["WARC-Type"], key(head.get("WARC-Refers-To"))))
                    size += len(payload)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return spark.read.parquet(path).select("data").mapInArrow(run, schema)


def query(spark, sf_dir):
    path = shared_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return (read_archives(spark, path)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT hex, max(page_id) AS keeper FROM p GROUP BY hex),
b AS (SELECT hex, array_to_string([lpad(bin(strpos('0123456789abcdef', hex[i]) - 1), 4, '0') FOR i IN range(1, 41)], '') AS bits
      FROM m)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + bits[i * 5 + 1]::INT * 16 + bits[i * 5 + 2]::INT * 8
         + bits[i * 5 + 3]::INT * 4 + bits[i * 5 + 4]::INT * 2 + bits[i * 5 + 5]::INT, 1) FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN m USING (hex) JOIN b USING (hex)
"""

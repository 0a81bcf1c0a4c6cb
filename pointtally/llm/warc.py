"""WARC archives with one Zstandard frame per record and a shared dictionary.

Every archive file starts with a skippable frame (magic ``5D 2A 4D 18``) that
holds a Zstandard dictionary built from the file's first records; each record
follows as a frame of its own, compressed with that dictionary.  Records are
``response`` (HTTP head and payload) or ``revisit`` (HTTP head only, refers to
the response with the equal payload).

Spark decides which record is which (grouping by payload digest) and deals the
pages to tasks; each task streams its rows into one file of the shared folder
and returns one row that names it.  A retried task writes a new file name, and
only files named by a committed row are read.
"""

from __future__ import annotations

import re
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointtally.llm.common import fresh_path, open_fs, stored

# Skippable frame magic of a dictionary, revisit profile.
DICT_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 100
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3
SALTS = 32
DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = "file string, n_records bigint, n_bytes bigint, dict_bytes bigint"
RECORD_SCHEMA = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url string, payload binary"
)


def _urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _from_urn(text: str):
    value = text[len("<urn:page:") : -1]
    return None if value == "null" else int(value)


def _target(url: str) -> str:
    """A URL as target URI: control characters and spaces percent-encoded, the rest as it is."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _exact(url: str) -> str:
    """A URL as a header of its own, from which :func:`_from_exact` gives every character back."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def _from_exact(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One uncompressed WARC record; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_target(url)}")
        if _target(url) != url:  # not a valid URI: the row's text beside it
            head.append(f"X-Page-URL: {_exact(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary from records; raw content where training has too little."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8, f=18, accel=4).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _load_dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data)


def _write_fn(folder: str, dict_bytes: int, sample_bytes: int, level: int):
    def run(batches):
        import pyarrow as pa
        import zstandard

        fs, root = open_fs(folder)
        out, cctx, held, size, n, dict_size = None, None, [], 0, 0, 0
        name = f"part-{uuid.uuid4().hex}.warc.zst"

        def begin():
            nonlocal out, cctx, dict_size
            data = train_dictionary(held, dict_bytes)
            dict_size = len(data)
            fs.create_dir(root, recursive=True)
            out = fs.open_output_stream(f"{root}/{name}", compression=None)
            out.write(struct.pack("<II", DICT_MAGIC, len(data)) + data)
            cctx = zstandard.ZstdCompressor(level=level, dict_data=_load_dictionary(data))
            for rec in held:
                out.write(cctx.compress(rec))
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (c[i].as_py() for c in batch.columns)
                rec = record_bytes(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)
                n += 1
                if out is not None:
                    out.write(cctx.compress(rec))
                    continue
                held.append(rec)
                size += len(rec)
                if size >= sample_bytes:
                    begin()
        if n:
            if out is None:
                begin()
            end = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"file": [f"{folder}/{name}"], "n_records": [n], "n_bytes": [end], "dict_bytes": [dict_size]}
            )

    return run


def write_warc(
    pages: DataFrame, dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Archive every row of ``pages``; returns the index ``(file, n_records, n_bytes, dict_bytes)``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are
    ignored.  The payload is the html in UTF-8 (null: empty).  Among records of
    equal payload of at least ``MIN_REVISIT_BYTES`` bytes those with the
    smallest non-null ``page_id`` are responses (repeated rows of that id all
    are) and the others revisit it; where every id is null all are responses.
    An empty table gives an empty index.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    keys = keyed.select("page_id", "digest", F.octet_length("html").alias("n_bytes")).filter(
        F.col("n_bytes") >= MIN_REVISIT_BYTES
    )
    firsts = (
        keys.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .filter((F.col("copies") > 1) & F.col("refers_to").isNotNull())
        .select("digest", "refers_to")
    )
    # A payload's rows are spread over salts: one with very many copies fills no task.
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    revisits = (
        keys.withColumn("salt", salt)
        .join(firsts.withColumn("salt", salts), ["digest", "salt"])
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to")
        .distinct()
    )
    marked = keyed.join(
        revisits, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left"
    ).select("page_id", "url", "html", "digest", "refers_to")
    folder = fresh_path(spark, "warc")
    return stored(marked.mapInArrow(_write_fn(folder, dict_bytes, sample_bytes, level), INDEX_SCHEMA), "warc-index")


def parse_archive(stream):
    """Yield ``(page_id, payload_bytes, digest, record_type, refers_to, url, payload)`` of an archive stream."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    dctx = zstandard.ZstdDecompressor(dict_data=_load_dictionary(stream.read(size)))
    with dctx.stream_reader(stream, read_across_frames=True) as reader:
        buf = b""

        def more() -> bool:
            nonlocal buf
            got = reader.read(1 << 20)
            buf += got
            return bool(got)

        while buf or more():
            while (end := buf.find(b"\r\n\r\n")) < 0:
                if not more():
                    raise ValueError("truncated archive")
            head = dict(
                line.split(": ", 1) for line in buf[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]
            )
            start, length = end + 4, int(head["Content-Length"])
            parts, have = [buf[start : start + length + 4]], len(buf) - start
            buf = buf[start + length + 4 :]
            while have < length + 4:  # a long record: gather pieces, join once
                got = reader.read(max(1 << 20, length + 4 - have))
                if not got:
                    raise ValueError("truncated archive")
                need = length + 4 - have
                parts.append(got[:need])
                buf = got[need:]
                have += len(got)
            block = b"".join(parts)[:length]
            http, _, payload = block.partition(b"\r\n\r\n")
            declared = int(re.search(rb"Content-Length: (\d+)", http)[1])
            refers = head.get("WARC-Refers-To")
            url = head.get("WARC-Target-URI")
            if "X-Page-URL" in head:
                url = _from_exact(head["X-Page-URL"])
            yield (
                _from_urn(head["WARC-Record-ID"]),
                declared,
                head["WARC-Payload-Digest"].removeprefix("sha256:"),
                head["WARC-Type"],
                None if refers is None else _from_urn(refers),
                url,
                payload if head["WARC-Type"] == "response" else None,
            )


def _read_fn(with_payload: bool):
    import hashlib

    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def block(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = open_fs(file)
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for rec in parse_archive(stream):
                        if rec[6] is not None and (
                            len(rec[6]) != rec[1] or hashlib.sha256(rec[6]).hexdigest() != rec[2]
                        ):
                            raise ValueError(f"payload of record {rec[0]} in {file} does not match its digest")
                        held += len(rec[6] or b"")
                        rows.append(rec if with_payload else (*rec[:6], None))
                        if len(rows) >= 5_000 or held > (4 << 20):
                            yield block(rows)
                            rows, held = [], 0
                if rows:
                    yield block(rows)

    return run


def read_warc(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives an index names, one row each (``RECORD_SCHEMA``).

    Each file is streamed by one task; response payloads are checked against
    their digest.  Revisits carry the full payload's size and digest, and a
    null payload.
    """
    n = index.count()
    return index.select("file").repartition(max(1, n)).mapInArrow(_read_fn(with_payload), RECORD_SCHEMA)


ORACLE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d
      WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id OR (page_id IS NULL AND first_id IS NOT NULL)
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id OR (page_id IS NULL AND first_id IS NOT NULL)
            THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

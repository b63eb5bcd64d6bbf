"""WARC archives as a table of chunks.

A payload stands whole only where it is a value of the table of pages, in Spark's scan. It is cut there; everything
behind it, Python included, sees one chunk of a record at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barflow.session import new_path, stage

CHUNK = 1 << 16  # bytes of one chunk, hence of one archive segment
LEAST_BYTES = 100  # shorter payloads are never revisits
DATE = "1970-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CRLF = "\r\n"


def revisits(pages: DataFrame, page_id: str, payload: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, first) of the pages whose payload a page with a smaller id has, too.

    Only ids, digests and lengths are shuffled; equal payloads meet as one partial minimum per task.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    keyed = pages.select(F.col(page_id).alias("page_id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("n"))
    keyed = keyed.where(F.col("n") >= least_bytes)
    first = keyed.groupBy(F.col("digest").alias("_digest")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("k"))
    return keyed.join(first.where("k > 1"), F.col("digest") == F.col("_digest")).where(
        F.col("page_id") > F.col("first")
    ).select("page_id", "digest", "first").distinct()


CHUNKS = (
    "record_id string, chunk long, last boolean, record_type string, refers_to string, uri string, "
    "payload_bytes long, running_digest string, payload_digest string, data binary"
)


def _arrow() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in CHUNKS.split(", ")])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lengths and digests of what came so far of a record, whose chunks follow each other; revisits know theirs."""
    digest, size, arrow = hashlib.sha256(), 0, _arrow()
    for batch in batches:
        sizes, running, uris = [], [], []
        for chunk, kind, uri, whole, n, data in zip(
            *(batch.column(c).to_pylist() for c in ("chunk", "record_type", "uri", "payload_digest", "n", "data"))
        ):
            if not chunk:
                digest, size = hashlib.sha256(), 0
            digest.update(data)
            size += len(data)
            sizes.append(n if kind == "revisit" else size)
            running.append(whole if kind == "revisit" else digest.hexdigest())
            uris.append(re.sub(r"\s+", "%20", uri) if uri else None)
        new = {"payload_bytes": sizes, "running_digest": running, "uri": uris}
        columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name).cast(f.type) for f in arrow]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)


def chunk_table(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", chunk: int = CHUNK
) -> DataFrame:
    """Pages as rows of (record_id, chunk, ...), chunks of a record behind each other and in order.

    ``data`` are ``chunk`` bytes of the payload, which may end within a character, and fewer in the last row. Null
    payloads are empty. Revisits have one row without data. Pages without an id, repeated ids with
    equal payloads and payloads under 100 bytes are responses. Other columns are not read, whatever their names;
    an empty table has no chunk. While the staged table of revisits is under Spark's broadcast threshold no
    payload is shuffled.
    """
    again = stage(revisits(pages, page_id, payload), "revisits")
    again = again.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), F.col("first").alias("_first"))
    rows = pages.select(
        F.col(page_id).alias("page"), F.col(url).alias("uri"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("body")
    )
    rows = rows.withColumns({"payload_digest": F.sha2("body", 256), "n": F.octet_length("body").cast("long")})
    same = (F.col("page") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    joined = rows.join(again, same, "left")
    first = F.col("_first").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    final = F.when(first | (F.col("n") == 0), F.lit(0)).otherwise(F.floor((F.col("n") - 1) / chunk).cast("int"))
    # the body is bound to a variable and left behind: evaluated or copied once per part, long payloads cost their square
    part = lambda body: F.transform(F.sequence(F.lit(0), final), lambda at: F.substring(body, at * chunk + 1, F.lit(chunk)))
    parts = F.when(first, F.array(F.lit(b""))).otherwise(F.flatten(F.transform(F.array("body"), part)))
    numbered = joined.select("page", "uri", "payload_digest", "n", "_first", final.alias("_final"), F.posexplode(parts).alias("_at", "_part"))
    cut = numbered.select(
        name("page").alias("record_id"), F.col("_at").cast("long").alias("chunk"), (F.col("_at") == F.col("_final")).alias("last"),
        F.when(first, "revisit").otherwise("response").alias("record_type"), F.when(first, name("_first")).alias("refers_to"),
        "uri", "n", "payload_digest", F.col("_part").alias("data"),
    )
    return cut.mapInArrow(_running, CHUNKS)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows to archive records: the first chunk a response or revisit, further ones continuations."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            first = row["chunk"] == 0
            head = HTTP if first and row["record_type"] == "response" else ""
            kind = row["record_type"] if first else "continuation"
            name = row["record_id"] if first else f"{row['record_id'][:-1]}#{row['chunk'] + 1}>"
            lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
            if row["uri"]:
                lines.append(f"WARC-Target-URI: {row['uri']}")
            if kind == "revisit":
                lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                          f"WARC-Refers-To: {row['refers_to']}", f"X-Payload-Length: {row['payload_bytes']}"]
            if first:
                lines.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
            if not first or not row["last"]:
                lines.append(f"WARC-Segment-Number: {row['chunk'] + 1}")
            if not first:
                lines.append(f"WARC-Segment-Origin-ID: {row['record_id']}")
                if row["last"]:
                    lines.append(f"WARC-Segment-Total-Length: {row['payload_bytes'] + len(HTTP)}")
            lines += ["Content-Type: application/http; msgtype=response",
                      f"Content-Length: {len(row['data']) + len(head)}", "", head]
            out.append(CRLF.join(lines).encode("utf-8") + row["data"] + CRLF.encode())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_archives(chunks: DataFrame, path: str) -> None:
    """One gzipped WARC file per task, every record whole in one file, written by Spark's text sink."""
    records = chunks.mapInArrow(_records, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", CRLF).option("compression", "gzip").text(path)


READ = (
    "record_id string, chunk long, last boolean, record_type string, refers_to string, uri string, "
    "payload_bytes long, running_digest string, payload_digest string, data binary"
)


class _Reader:
    """Puts lines of an archive together to chunk rows; holds one chunk and a running digest."""

    def __init__(self, with_data: bool):
        self.with_data, self.out = with_data, []
        self.header, self.left, self.part = None, None, []
        self.digest, self.size, self.origin, self.pending = None, 0, {}, None

    def line(self, line: bytes) -> None:
        if self.left is not None:
            self.body(line)
        elif self.header is None:
            if line:
                if not line.startswith(b"WARC/"):
                    raise ValueError("not at the start of a WARC record")
                self.header = {}
        elif line:
            name, _, value = line.decode("utf-8").partition(": ")
            self.header[name] = value
        else:
            self.left, self.part = int(self.header["Content-Length"]), []
            if not self.left:
                self.finish()

    def body(self, line: bytes) -> None:
        self.part.append(line)
        self.left -= len(line)
        if self.left >= 2:
            self.part.append(b"\r\n")
            self.left -= 2
        elif self.left:
            raise ValueError("a record ends within its payload")
        if not self.left:
            self.finish()

    def finish(self) -> None:
        h, data = self.header, b"".join(self.part)
        self.header, self.left, self.part = None, None, []
        kind = h["WARC-Type"]
        if kind == "continuation":
            number = int(h["WARC-Segment-Number"])
            if h["WARC-Segment-Origin-ID"] != self.origin.get("WARC-Record-ID"):
                raise ValueError("a continuation does not follow its record")
        else:
            self.origin, self.digest, self.size, number = h, hashlib.sha256(), 0, 1
            if kind == "response":
                data = data.partition(b"\r\n\r\n")[2]
        self.digest.update(data)
        self.size += len(data)
        last = "WARC-Segment-Number" not in h or "WARC-Segment-Total-Length" in h
        o, told = self.origin, self.origin["WARC-Payload-Digest"].removeprefix("sha256:")
        again = o["WARC-Type"] == "revisit"
        if last and not again and told != self.digest.hexdigest():
            raise ValueError(f"payload of {o['WARC-Record-ID']} does not match its digest")
        self.out.append((
            o["WARC-Record-ID"], number - 1, last, o["WARC-Type"], o.get("WARC-Refers-To"), o.get("WARC-Target-URI"),
            int(o["X-Payload-Length"]) if again else self.size, told if again else self.digest.hexdigest(), told,
            data if self.with_data else None,
        ))

    def rows(self) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.bool_(), *[pa.string()] * 3, pa.int64(), pa.string(), pa.string(), pa.binary()]
        names = [f.split()[0] for f in READ.split(", ")]
        columns = list(zip(*self.out)) or [[]] * len(names)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_chunks(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """Chunk rows of all archives under ``path``; payload digests are checked at each record's last chunk.

    An archive is read by one task, line by line as its bytes arrive.
    """
    def run(batches):
        reader = _Reader(with_data)
        for batch in batches:
            for line in batch.column(0).to_pylist():
                reader.line(line)
            yield reader.rows()
        if reader.header is not None:
            raise ValueError("an archive ends within a record")

    lines = spark.read.option("lineSep", CRLF).text(path).select(F.col("value").cast("binary"))
    return lines.mapInArrow(run, READ)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages as WARC archives to the shared folder, read them back: one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to as the archives state them. Equal payloads
    of 100 bytes or more are stored once, with the smallest id; see ``chunk_table`` for the other cases. Very long
    payloads are as many records as they have chunks; an empty table gives no row.
    """
    path = new_path(pages.sparkSession, "warc")
    write_archives(chunk_table(pages), path)
    kind = pages.schema["page_id"].dataType
    number = lambda c: F.nullif(F.regexp_extract(c, r"<urn:page:(.*)>", 1), F.lit("")).cast(kind)
    return read_chunks(pages.sparkSession, path, with_data=False).where("last").select(
        number("record_id").alias("page_id"), "payload_bytes", F.col("running_digest").alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )


def archive_pages_sql() -> str:
    return f"""
    WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    keyed AS (SELECT page_id, octet_length(encode(body)) AS n, sha256(body) AS digest FROM bodies),
    firsts AS (SELECT digest, min(page_id) AS first FROM keyed WHERE n >= {LEAST_BYTES} GROUP BY digest)
    SELECT k.page_id, k.n AS payload_bytes, k.digest AS payload_digest,
        CASE WHEN k.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN k.page_id > f.first THEN f.first END AS refers_to
    FROM keyed k LEFT JOIN firsts f ON k.digest = f.digest AND k.n >= {LEAST_BYTES}"""

"""WARC archives: written by Spark's text writer, read back in splits.

*Writing.*  A page becomes one record whose block is its html in UTF-8.  Of pages
with equal payloads of at least ``revisit_from`` bytes the one with the largest id
is a response, the others are revisits without a block that name it.  A part file
is an archive: the records' own end is the writer's line separator.

*Reading.*  The magic that starts a record is the reader's line separator, so
archives of any size are read in splits, and every occurrence of the magic gives a
candidate record.  A payload may hold the magic too; what is a record is settled by
boundary chains:

1. A task knows the lengths of the segments between magics, so the offset of each
   candidate within its split, and from its header the offset of its successor.
2. Within a split, chains are followed to the first offset beyond it.
3. Between splits, pointers are doubled from offset 0 of each file until nothing
   new is reached; only candidates that some chain leaves a split for take part.
4. Each split marks the candidates on the chain from where it is entered.

All else is payload.  Records that hold the magic consist of several segments;
those few are read again and put together.

Null html is an empty payload; null urls and ids leave their header out.  A page
without id is a response unless another page with that payload has one.  Rows with
equal ids and payloads are alike: if theirs is the largest id, all are responses.
After a damaged record the rest of its file is not reachable and not returned.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brinkcast.llm.arrow import runs_of
from brinkcast.llm.storage import shared_path, stored

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "1970-01-01T00:00:00Z", revisit_from: int = 1000,
) -> None:
    """Archives below ``path``, one for each part of ``pages``."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("body")
    ).withColumns({"digest": F.sha1("body"), "bytes": F.octet_length("body")})
    long = rows.where(F.col("bytes") >= revisit_from).groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    # only payloads that occur again: usually a small table, which Spark then broadcasts
    shared = stored(long.where("n > 1 and first is not null").select("digest", "first"), "payloads")
    marked = rows.join(shared, "digest", "left").withColumn("again", F.expr("first is not null and not (id <=> first)"))
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    page = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    record = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "),
        F.when(F.col("again"), "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Date: {date}\r\n"),
        field("WARC-Record-ID", page("id")),
        field("WARC-Target-URI", F.translate("url", "\r\n", "")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Profile", F.when(F.col("again"), PROFILE)),
        field("WARC-Refers-To", F.when(F.col("again"), page("first"))),
        F.lit("Content-Type: text/html\r\nContent-Length: "),
        F.when(F.col("again"), 0).otherwise(F.col("bytes")).cast("string"),
        F.lit(END),
        F.when(F.col("again"), "").otherwise(F.col("body")),
    )
    marked.select(record.alias("value")).write.option("lineSep", END).text(path)


def _header(segment: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of a header with its end, and its fields; None if it is none."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in segment[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not fields.get(b"content-length", b"").isdigit():
        return None
    return end + 4, fields


def _page(urn: bytes | None) -> int | None:
    digits = (urn or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits.lstrip(b"-").isdigit() else None


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics, in the order of the file within each split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("segment")
    )


#: ``at``: offset of the magic within the split's segments; ``leaves``: where the
#: chain from here leaves the split (null: it breaks); ``body``: offset of the block.
CANDIDATES = (
    "file string, split long, at long, size long, next long, leaves long, page_id long, kind string, refers_to long, "
    "stated string, body long, length long, digest string"
)


def _candidates(batches):
    """One row a segment; segments without a header are no candidates, but have a size."""
    held, place = [], None
    for batch in batches:
        for file, split, segment in zip(*[c.to_pylist() for c in batch.columns]):
            if place is None or place[:2] != (file, split):
                if held:
                    yield _chained(held)
                held, place = [], (file, split, 0)
            at = place[2]
            place = (file, split, at + len(segment) + len(MAGIC))
            row = {"file": file, "split": split, "at": at - len(MAGIC), "size": len(segment) + len(MAGIC)}
            found = None if at == 0 and split == 0 else _header(segment)  # nothing stands before the first magic
            if found:
                body, fields = found
                length = int(fields[b"content-length"])
                digest = hashlib.sha1(segment[body : body + length]).hexdigest() if body + length <= len(segment) else None
                row |= {
                    "next": at + body + length + len(END), "page_id": _page(fields.get(b"warc-record-id")),
                    "kind": fields.get(b"warc-type", b"").decode(errors="replace"), "refers_to": _page(fields.get(b"warc-refers-to")),
                    "stated": fields.get(b"warc-payload-digest", b"").decode(errors="replace").removeprefix("sha1:"),
                    "body": body, "length": length, "digest": digest,
                }
            held.append(row)
    if held:
        yield _chained(held)


SCHEMA = pa.schema(
    [(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in CANDIDATES.split(", "))]
)


def _chained(rows: list[dict]) -> pa.RecordBatch:
    """``leaves`` of each candidate of a split."""
    beyond = rows[-1]["at"] + rows[-1]["size"]
    leaves: dict[int, int | None] = {}
    for row in reversed(rows):
        if "next" in row:
            row["leaves"] = leaves[row["at"]] = row["next"] if row["next"] >= beyond else leaves.get(row["next"])
    return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)


def _entries(placed: DataFrame) -> DataFrame:
    """(file, start) of candidates at which a chain from the file's start enters a
    split, by doubling of pointers."""
    targets = placed.where("leaves is not null").select("file", F.col("leaves").alias("start")).distinct()
    nodes = placed.where("next is not null").select("file", "start", "leaves")
    taking = nodes.join(targets, ["file", "start"], "left_semi").union(nodes.where("start = 0")).distinct()
    one = jump = stored(taking.select("file", "start", F.col("leaves").alias("to")), "jump")
    reached = stored(nodes.where("start = 0").select("file", "start"), "reached")
    n = reached.count()
    while True:
        ahead = reached.join(jump, ["file", "start"]).select("file", F.col("to").alias("start"))
        # the end of a file is no candidate
        reached = stored(reached.union(ahead.join(one, ["file", "start"], "left_semi")).distinct(), "reached")
        more = reached.count()
        if more == n:
            return reached
        n = more
        further = jump.select("file", F.col("start").alias("to"), F.col("to").alias("beyond"))
        jump = stored(jump.join(further, ["file", "to"]).select("file", "start", F.col("beyond").alias("to")), "jump")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, page_id, kind, refers_to, stated, length, digest) of the records
    of the archives at ``path``; length and digest are those of the record's block."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(_segments(spark, path).mapInArrow(_candidates, CANDIDATES), "candidates")
    sizes = found.groupBy("file", "split").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # splits of one file
    bases = sizes.select("file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    placed = found.join(bases, ["file", "split"]).withColumns(
        {"start": F.col("base") + F.col("at"), "next": F.col("base") + F.col("next"), "leaves": F.col("base") + F.col("leaves")}
    )
    placed = stored(placed, "placed")
    entries = _entries(placed).withColumn("entered", F.lit(True))

    def mark(rows):
        rows = sorted(rows, key=lambda r: r[2])
        on = None  # where the chain stands
        out = []
        for block, entered, start, following in rows:
            if following is not None and (entered or start == on):
                on = following
                out.append((block["file"], block["split"], start, following))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                ["file", "split", "start", "to"],
            )

    pointers = placed.join(entries, ["file", "start"], "left").select(F.struct("file", "split").alias("block"), "entered", "start", "next")
    reached = (
        pointers.repartition(parts, "block")
        .sortWithinPartitions("block")
        .mapInArrow(lambda batches: runs_of(batches, 0, mark), "file string, split long, start long, to long")
    )
    reached = stored(reached, "records")
    records = placed.join(reached.select("file", "start"), ["file", "start"])
    whole = records.where("digest is not null")
    kept = ["file", "start", "page_id", "kind", "refers_to", "stated", "length", "digest"]
    cut = records.where("digest is null").select("file", "start", F.col("next").alias("to"), "body", "length")
    if not cut.limit(1).count():
        return whole.select(*kept)
    # segments of the records that hold the magic: each belongs to the record before it
    owner = F.last(F.when(F.col("record").isNotNull(), F.col("start")), ignorenulls=True).over(Window.partitionBy("file").orderBy("start"))
    owned = (
        placed.join(reached.select("file", "start", F.lit(True).alias("record")), ["file", "start"], "left")
        .withColumn("owner", owner)
        .join(cut.select("file", F.col("start").alias("owner"), F.col("body").alias("skip"), F.col("length").alias("whole")), ["file", "owner"])
        .select("file", "split", "at", "start", "owner", "skip", "whole")
    )
    segments = _segments(spark, path).mapInArrow(_located, "file string, split long, at long, segment binary")
    pieces = segments.join(owned, ["file", "split", "at"]).select(F.struct("file", "owner").alias("record"), "start", "skip", "whole", "segment")

    def join(rows):
        rows = sorted(rows, key=lambda r: r[1])
        body, whole = rows[0][2], rows[0][3]
        joined = MAGIC.encode().join(r[4] for r in rows)
        record = rows[0][0]
        digest = hashlib.sha1(joined[body : body + whole]).hexdigest()
        yield pa.RecordBatch.from_pydict({"file": [record["file"]], "start": [record["owner"]], "digest": [digest]})

    joined = (
        pieces.repartition(parts, "record")
        .sortWithinPartitions("record")
        .mapInArrow(lambda batches: runs_of(batches, 0, join), "file string, start long, digest string")
    )
    again = records.where("digest is null").drop("digest").join(joined, ["file", "start"])
    return whole.select(*kept).unionByName(again.select(*kept))


def _located(batches):
    """Segments with their offset within the split, as ``_candidates`` counts."""
    place = None
    for batch in batches:
        at = []
        for file, split, segment in zip(*[c.to_pylist() for c in batch.columns]):
            if place is None or place[:2] != (file, split):
                place = (file, split, 0)
            at.append(place[2] - len(MAGIC))
            place = (file, split, place[2] + len(segment) + len(MAGIC))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(at, pa.int64()), batch.column(2)], ["file", "split", "at", "segment"]
        )


def resolved(records: DataFrame) -> DataFrame:
    """Records with the size and digest of their full payload: revisits take them from
    the response with the digest they state."""
    known = records.where("kind = 'response'").groupBy("digest").agg(F.max("length").alias("full"))
    revisits = records.where("kind = 'revisit'").join(known.withColumnRenamed("digest", "stated"), "stated", "left")
    plain = records.where("kind <> 'revisit'").select("page_id", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
    return plain.union(revisits.select("page_id", "full", "stated", "kind", "refers_to"))


def archive_pages(pages: DataFrame, revisit_from: int = 1000) -> DataFrame:
    """``pages`` written to the shared folder and read back."""
    spark = pages.sparkSession
    path = shared_path(spark, "archives")
    write_archives(pages, path, revisit_from=revisit_from)
    return resolved(stored(read_archives(spark, path), "read"))

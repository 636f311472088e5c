"""WARC writing and reading with boundary-chain verification (operator 6).

Writing: one uncompressed record a page, written by Spark's text writer with the
record end as line separator. Pages with the same payload refer to one response.

Reading: archives are cut at every occurrence of the magic line, inside payloads too.
Each task emits, for the cuts of its split that look like a header, where the record
would begin and where its successor would. Chains are shortened inside each split;
between splits pointers are jumped in doubling steps from the start of the file. Only
records that the chain reaches are kept, so a magic line in a payload is never taken
for a record. A reached record that holds magic lines or crosses into other splits is
put together from its pieces in a second pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import scratch, written

MAGIC = b"WARC/1.0\r\n"
_END = b"\r\n\r\n"
#: payloads below this size are always written in full, fixed by the query's contract
LEAST_REVISIT = 100
#: rows of a table that is sent to all tasks (about 150 bytes each); above it, a shuffled join
BROADCAST_ROWS = 200_000


def _line(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows; ``df`` is a written table."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_archives(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a record for each page below ``path``.

    The payload is the html in UTF-8, a null one is empty. Of pages with equal payloads
    of at least 100 bytes those with the smallest id are responses; the others are
    revisits without a payload. A null id is written as an empty one and revisits
    none; a null URL has no header line; line ends in a URL are escaped.
    """
    payload = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(
        pages[id_col].alias("id"), pages[url_col].alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"),
    )
    large = rows.where((F.col("bytes") >= LEAST_REVISIT) & F.col("id").isNotNull()).select("id", "digest")
    first = large.groupBy("digest").agg(F.min("id").alias("refers"), F.max("id").alias("last")).where("refers < last").select("digest", "refers")
    revisits = written(large.join(first, "digest").where("id > refers").distinct(), "warc-revisits")
    marked = rows.join(small(revisits), ["id", "digest"], "left")
    kind = F.when(F.col("refers").isNull(), "response").otherwise("revisit")
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    body = F.when(F.col("refers").isNull(), F.col("payload")).otherwise("")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC.decode()),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", name),
        _line("WARC-Date", date),
        F.coalesce(_line("WARC-Target-URI", url), F.lit("")),
        F.coalesce(_line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers").cast("string"), F.lit(">"))), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Payload-Bytes", F.col("bytes")),
        _line("Content-Type", "text/html; charset=utf-8"),
        _line("Content-Length", F.octet_length(body)),
        F.lit("\r\n"),
        body,
    )
    marked.select(record.alias("value")).write.option("lineSep", _END.decode()).text(path)


_CUT_FIELDS = [
    ("file", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("start", pa.int64()), ("succ", pa.int64()), ("leaves", pa.int64()),
    ("whole", pa.bool_()), ("head", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
    ("stated_digest", pa.string()), ("stated_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("payload", pa.binary()),
]
_CUTS = (
    "file string, block bigint, total bigint, start bigint, succ bigint, leaves bigint, whole boolean, head bigint, record_type string, "
    "record_id string, refers_to string, stated_digest string, stated_bytes bigint, payload_bytes bigint, payload_sha256 string, payload binary"
)


def header_of(cut: bytes) -> tuple[int, dict[str, str]] | None:
    """Header bytes (with the empty line) and fields of a cut; None if it is no header."""
    end = cut.find(_END)
    if end < 0:
        return None
    fields = {}
    for line in cut[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return end + len(_END), fields


@dataclass
class _Block:
    """The cuts of one split of a file; places count from its first cut."""

    file: str
    block: int
    with_payload: bool
    total: int = 0
    rows: list[dict] = field(default_factory=list)

    def add(self, cut: bytes) -> None:
        start, self.total = self.total, self.total + len(cut) + len(MAGIC)
        if self.block == 0 and start == 0:
            return  # what is before the first magic line
        found = header_of(cut)
        if not found:
            return
        head, fields = found
        length = int(fields["content-length"])
        whole = len(cut) == head + length + len(_END) and cut.endswith(_END)
        payload = cut[head : head + length] if whole else None
        self.rows.append({
            "start": start, "succ": start + head + length + len(_END) + len(MAGIC), "whole": whole, "head": head,
            "record_type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
            "stated_digest": fields.get("warc-payload-digest"), "stated_bytes": int(fields["x-payload-bytes"]) if fields.get("x-payload-bytes", "").isdigit() else None,
            "payload_bytes": length if whole else None, "payload_sha256": hashlib.sha256(payload).hexdigest() if whole else None,
            "payload": payload if self.with_payload else None,
        })

    def batch(self) -> pa.RecordBatch:
        """All cuts, each with the place where its chain leaves this split (-1: it breaks)."""
        start = np.array([r["start"] for r in self.rows], dtype=np.int64)
        succ = np.array([r["succ"] for r in self.rows], dtype=np.int64)
        leaves = chain_ends(start, succ, self.total)
        out = [{"file": self.file, "block": self.block, "total": self.total}]
        out += [{"file": self.file, "block": self.block, "leaves": int(e)} | r for e, r in zip(leaves, self.rows, strict=True)]
        return pa.RecordBatch.from_pylist(out, schema=pa.schema(_CUT_FIELDS))


def chain_ends(start: np.ndarray, succ: np.ndarray, total: int) -> np.ndarray:
    """For each cut the first place at or beyond ``total`` on its chain, by pointer jumping; -1 if none."""
    n = len(start)
    if not n:
        return succ
    place = np.minimum(np.searchsorted(start, succ), n - 1)
    end = np.where(succ >= total, succ, -1)
    step = np.where((succ < total) & (start[place] == succ), place, np.arange(n))
    for _ in range(max(1, math.ceil(math.log2(n + 1)))):
        end = np.where((end < 0) & (end[step] >= 0), end[step], end)
        step = step[step]
    return end


def cuts_of(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    text = spark.read.option("lineSep", MAGIC.decode()).text(path)
    source = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for file, block, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or (now.file, now.block) != (file, block):
                    if now:
                        yield now.batch()
                    now = _Block(file, block, with_payload)
                now.add(cut)
        if now:
            yield now.batch()

    return source.mapInArrow(run, _CUTS)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(record_type, record_id, refers_to, payload_bytes, payload_sha256[, payload]) of all records.

    A record that breaks the chain, and what follows it in its file, is not returned.
    Revisits have the bytes and digest that they state; other records those of the
    payload that was read. An archive without records gives no rows.
    """
    cuts = written(cuts_of(spark, path, with_payload), "warc-cuts")
    order = Window.partitionBy("file").orderBy("block")
    blocks = written(
        cuts.where("total IS NOT NULL").select("file", "block", "total")
        .withColumn("base", F.sum("total").over(order) - F.col("total")).withColumn("nth", F.row_number().over(order)),
        "warc-blocks",
    )
    placed = cuts.where("start IS NOT NULL").drop("total").join(small(blocks), ["file", "block"])
    for c in ("start", "succ", "leaves"):
        value = F.col("base") + F.col(c)
        placed = placed.withColumn(c, F.when(F.col("leaves") < 0, F.lit(-1)).otherwise(value) if c == "leaves" else value)

    # doubling: after round i a pointer jumps 2^i splits, and those reached double too
    jump = placed.where("leaves >= 0").select("file", F.col("start").alias("from"), F.col("leaves").alias("to"))
    entry = blocks.where("block = 0").select("file", F.lit(len(MAGIC)).cast("long").alias("at"))
    most = blocks.agg(F.max("nth")).first()[0] or 0
    for k in range(math.ceil(math.log2(most)) if most > 1 else 0):
        entry = written(entry.unionByName(entry.join(jump.withColumnRenamed("from", "at"), ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(), f"warc-entry{k}")
        onward = jump.select("file", F.col("from").alias("to"), F.col("to").alias("next"))
        jump = written(jump.join(onward, ["file", "to"]).select("file", "from", F.col("next").alias("to")), f"warc-jump{k}")
    starts = entry.withColumnRenamed("at", "start").withColumn("entered", F.lit(True))
    shape = "file string, start bigint"

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        """The cuts of a split that its entry's chain passes."""
        group = group.sort_values("start")
        start, succ = group["start"].to_numpy(), group["succ"].to_numpy()
        entered = np.flatnonzero(group["entered"].to_numpy())
        on = np.zeros(len(start), dtype=bool)
        i = int(entered[0]) if len(entered) else len(start)
        while i < len(start):
            on[i] = True
            j = int(np.searchsorted(start, succ[i]))
            i = j if j < len(start) and start[j] == succ[i] else len(start)
        return group.loc[on, ["file", "start"]]

    reached = (
        placed.select("file", "block", "start", "succ").join(starts, ["file", "start"], "left")
        .withColumn("entered", F.coalesce("entered", F.lit(False)))
        .groupBy("file", "block").applyInPandas(follow, shape)
    )
    ends = blocks.groupBy("file").agg(F.sum("total").alias("end"))
    records = written(placed.join(reached, ["file", "start"]).join(ends, "file").where("succ <= end").drop("block", "base", "nth", "leaves"), "warc-records")
    whole = records.where("whole")
    parts = written(records.where("NOT whole").select("file", "start", "succ", "head"), "warc-parts")
    if parts.limit(1).count():
        joined = _assembled(spark, path, blocks, parts, with_payload)
        made = records.where("NOT whole").drop("payload_bytes", "payload_sha256", "payload").join(joined, ["file", "start"])
        whole = whole.unionByName(made)
    revisit = F.col("record_type") == "revisit"
    stated = F.regexp_replace("stated_digest", "^sha256:", "")
    out = whole.select(
        "record_type", "record_id", "refers_to",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(F.col("payload_sha256")).alias("payload_sha256"),
        "payload",
    )
    return out if with_payload else out.drop("payload")


#: bytes of a cell of an archive, for finding the cuts of records that cross splits
CELL = 1 << 20


def _assembled(spark: SparkSession, path: str, blocks: DataFrame, parts: DataFrame, with_payload: bool) -> DataFrame:
    """Payloads of the records in ``parts`` from all the cuts between their ends."""
    text = spark.read.option("lineSep", MAGIC.decode()).text(path)
    source = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("cut"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in batches:
            spots = []
            for file, block, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (file, block):
                    now, at = (file, block), 0
                spots.append(at)
                at += len(cut) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spots, pa.int64())], names=["file", "block", "cut", "spot"])

    spots = source.mapInArrow(place, "file string, block bigint, cut binary, spot bigint").join(small(blocks.select("file", "block", "base")), ["file", "block"])
    # a part is looked for in the cells of the file that it spans, and a cut stands in one of them
    cell = lambda c: F.floor(F.col(c) / CELL)
    spanned = parts.withColumn("cell", F.explode(F.sequence(cell("start"), F.floor((F.col("succ") - 1) / CELL))))
    spots = spots.withColumn("spot", F.col("base") + F.col("spot")).withColumn("cell", cell("spot"))
    inside = spots.join(small(spanned), ["file", "cell"]).where("spot >= start AND spot < succ")

    def put_together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("spot")
        first = group.iloc[0]
        size = int(first["succ"] - first["start"] - len(MAGIC))
        data = MAGIC.join(map(bytes, group["cut"]))
        payload = data[int(first["head"]) : size - len(_END)]
        made = pd.DataFrame({
            "file": [first["file"]], "start": [first["start"]], "payload_bytes": [len(payload)],
            "payload_sha256": [hashlib.sha256(payload).hexdigest()], "payload": [payload if with_payload else None],
        })
        return made if len(data) == size and data.endswith(_END) else made.iloc[:0]

    return inside.groupBy("file", "start").applyInPandas(put_together, "file string, start bigint, payload_bytes bigint, payload_sha256 string, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", **cols: str) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back.

    Returns (id, payload_bytes, payload_digest, record_type, refers_to), a row a page.
    """
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, id_col=id_col, **cols)
    kind = pages.schema[id_col].dataType.simpleString()
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast(kind)
    return read_archives(pages.sparkSession, path).select(
        number("record_id").alias(id_col), "payload_bytes", F.col("payload_sha256").alias("payload_digest"), "record_type", number("refers_to").alias("refers_to")
    )

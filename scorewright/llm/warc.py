"""Deterministic sharded WARC writer, and its reader.

Records are range-sorted into shards (cut points come from a sample chosen by
a hash of the records' keys, so the same table gives the same shards), every
shard is streamed by one task into files that are rolled when their
compressed size reaches a limit.  Headers and digests are regenerated; a
record is a gzip member of its own.  Files are committed through temporary
names and a manifest.

Of records with equal payloads the one with the smallest id is a response,
the others are revisits that name it.  Which these are is found on a narrow
table of digests; the answers travel to the shards as small notes that sort
right before their records, so payloads are shuffled once.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.llm.common import shared_dir, ship_package, small_frame, written
from scorewright.llm.store import StoredFile, clear_temporary, open_stored

MIN_REVISIT_BYTES = 100
SHARD_BYTES = 256 << 20
MIN_SHARDS = 48
ROLL_BYTES = 64 << 20
SAMPLE_KEYS = 16_384
TIE_CHARS = 16  # of a digest, to cut between rows of one id
# records carry no capture time: a fixed one keeps archives reproducible
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "shard int, seq int, file string, records bigint, bytes bigint, sha256 string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_NAMES = uuid.UUID("00000000-0000-5000-8000-000000000000")


def _uri(url: str | None, page_id: int | None) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~") if url else f"urn:page:{'' if page_id is None else page_id}"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """Response record of a page, or the revisit that names ``refers_to``."""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", DATE),
              ("WARC-Target-URI", _uri(url, page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    head = HTTP_HEAD.format(len(payload)).encode("ascii")
    if refers_to is None:
        block = head + payload
    else:
        block = head
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)),
                   ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
               ("Content-Type", "application/http; msgtype=response")]
    return record(fields, block)


def _head_record(name: str) -> bytes:
    return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>"),
                   ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                  b"format: WARC File Format 1.1\r\n")


def _write_shards(folder: str, roll_bytes: int):
    """Stream the sorted records of a task's shards into rolled files."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        out, done, at, note, told = None, [], None, None, False

        def finish():
            nonlocal out
            if out is not None:
                shard, seq, file, n = out
                done.append((shard, seq, file.name, n, file.size, file.close()))
                out = None

        for batch in batches:
            cols = [batch.column(c) for c in ("shard", "page_id", "digest", "first", "url", "html")]
            for shard, page_id, digest, first, url, html in zip(*(c.to_pylist() for c in cols)):
                if first is not None:  # the note before the records it is about
                    note, told = (page_id, digest, first), False
                    continue
                refers_to = None
                if note is not None and note[:2] == (page_id, digest):
                    # of the records with the smallest id the first is the response
                    refers_to = note[2] if told or page_id != note[2] else None
                    told = True
                if out is None or out[0] != shard or out[2].size >= roll_bytes:
                    seq = out[1] + 1 if out is not None and out[0] == shard else 0
                    finish()
                    name = f"part-{shard:06d}-{seq:05d}.warc.gz"
                    out = [shard, seq, StoredFile(folder, name), 0]
                    out[2].write(_head_record(name))
                out[2].write(page_record(page_id, url, (html or "").encode("utf-8"), digest, refers_to))
                out[3] += 1
        finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*done), (pa.int32(), pa.int32(), pa.string(), pa.int64(),
                                                             pa.int64(), pa.string()))],
                names=["shard", "seq", "file", "records", "bytes", "sha256"])
    return run


def cut_points(sample: DataFrame, n_shards: int) -> list[tuple[int, int, str]]:
    """``(shard, id, tie)``: the first key of every shard, at even shares of
    the sampled bytes.  ``sample``: id, tie, size, one row per key.  Sorted
    and summed in Spark; the driver gets one key per shard and one sum per
    partition."""
    spark = sample.sparkSession
    keys = written(sample.repartitionByRange("id", "tie").select("id", "tie", "size", F.spark_partition_id().alias("part")),
                   "warc-sample")
    sums = {r["part"]: r["n"] for r in keys.groupBy("part").agg(F.sum(F.col("size") + 1).alias("n")).collect()}
    total, before, at = sum(sums.values()), [], 0
    for part in sorted(sums):
        before.append((part, at))
        at += sums[part]
    inside = Window.partitionBy("part").orderBy("id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.col("offset") + F.coalesce(F.sum(F.col("size") + 1).over(inside), F.lit(0))
    shard = F.expr(f"cast(cast(seen AS decimal(20,0)) * {n_shards} div {max(total, 1)} AS int)")
    first = (keys.join(F.broadcast(small_frame(spark, before, "part int, offset long")), "part")
             .withColumn("seen", seen).select(shard.alias("shard"), F.struct("id", "tie").alias("key")).where("shard > 0")
             .groupBy("shard").agg(F.min("key").alias("key")))
    return sorted((r["shard"], r["key"]["id"], r["key"]["tie"]) for r in first.collect())


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          shard_bytes: int = SHARD_BYTES, min_shards: int = MIN_SHARDS, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write one record per row into ``folder`` and return the manifest
    (``shard, seq, file, records, bytes, sha256``), itself committed there.

    Null texts have an empty payload; payloads under 100 bytes are always
    responses.  A longer payload has one response, a row with its smallest
    id; all its other rows, those without an id too, are revisits of it.
    Where no row of a payload has an id, all are responses.  Rows without an
    id sort first.  Archives do not depend on the layout of the table.
    """
    spark = pages.sparkSession
    ship_package(spark)
    payload = F.coalesce(F.col(html_col), F.lit(""))
    page_id = F.col(id_col).cast("long")
    digest = F.sha2(payload, 256)
    tie = digest
    keyed = pages.select(page_id.alias("page_id"), digest.alias("digest"), tie.alias("tie"),
                         F.octet_length(payload).cast("long").alias("size"))
    narrow = written(keyed, "warc-digests")
    firsts = (narrow.where(F.col("size") >= MIN_REVISIT_BYTES)
              .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
              .where("rows > 1 AND first IS NOT NULL").select("digest", "first"))
    notes = written(narrow.select("page_id", "digest", "tie").distinct().join(firsts, "digest")
                    .select("page_id", "digest", "tie", "first"), "warc-notes")
    n, total = narrow.agg(F.count(F.lit(1)), F.sum("size")).first()
    n_shards = max(min_shards, -(-(total or 0) // shard_bytes))
    # a hash chooses about max(SAMPLE_KEYS, 64 per shard) keys
    keys = max(SAMPLE_KEYS, 64 * n_shards)
    slots = 1 << 30
    keep = slots if n <= keys else int(slots * keys / n)
    least = F.lit(-(1 << 63))
    prefix = F.substring("tie", 1, TIE_CHARS)
    sample = (narrow.where(F.pmod(F.xxhash64("page_id", "tie"), F.lit(slots)) < keep)
              .groupBy(F.coalesce("page_id", least).alias("id"), prefix.alias("tie")).agg(F.sum("size").alias("size")))
    found = cut_points(sample, n_shards)
    # proven bound: a number, an id and TIE_CHARS characters per shard of SHARD_BYTES
    cuts = spark.sparkContext.broadcast((np.array([0, *(c[0] for c in found)], dtype=np.int32),
                                         np.array([c[1] for c in found], dtype=np.int64),
                                         np.array([c[2].encode() for c in found], dtype=f"S{TIE_CHARS}")))

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        shards, cut_ids, cut_ties = cuts.value
        keys = ids.to_numpy()
        first, at = np.searchsorted(cut_ids, keys, side="left"), np.searchsorted(cut_ids, keys, side="right")
        for i in np.nonzero(first < at)[0].tolist():  # an id with cuts inside of its rows
            at[i] = first[i] + np.searchsorted(cut_ties[first[i]:at[i]], ties.iat[i].encode(), side="right")
        return pd.Series(shards[at])

    def placed(df: DataFrame, url: Column, html: Column, first: Column) -> DataFrame:
        return df.select("page_id", "digest", "tie", first.cast("long").alias("first"),
                         url.cast("string").alias("url"), html.cast("string").alias("html"),
                         shard_of(F.coalesce("page_id", least), prefix).alias("shard"))

    full = pages.select(page_id.alias("page_id"), digest.alias("digest"), tie.alias("tie"),
                        F.col(url_col).alias("u"), F.col(html_col).alias("h"))
    rows = placed(full, F.col("u"), F.col("h"), F.lit(None)).union(
        placed(notes, F.lit(None), F.lit(None), F.col("first")))
    dealt = rows.repartitionById(n_shards, F.col("shard")).sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_first(), "tie", F.col("first").asc_nulls_last(), "url")
    manifest = f"{folder}/manifest"
    dealt.mapInArrow(_write_shards(folder, roll_bytes), MANIFEST).write.parquet(manifest)
    clear_temporary(folder)
    return spark.read.schema(MANIFEST).parquet(manifest)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of every record of an archive."""
    with gzip.GzipFile(fileobj=stream) as raw, io.BufferedReader(raw, 1 << 20) as source:
        while True:
            line = source.readline()
            if not line:
                return
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"not a record: {line[:40]!r}")
            fields = {}
            while (line := source.readline()) != b"\r\n":
                name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
                fields[name.lower()] = value
            block = source.read(int(fields["content-length"]))
            if source.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield fields, block


def _read_files(folder: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string())])
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with open_stored(folder, name) as stream:
                    for fields, block in records(stream):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                            raise ValueError(f"{name}: a block does not match its digest")
                        digest, size = fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-length"])
                        if fields["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                                raise ValueError(f"{name}: a payload does not match its digest")
                        page, first = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                        rows.append((None if page is None else int(page), size, digest, fields["warc-type"],
                                     None if first is None else int(first), name))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)
    return run


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every response and revisit of the committed files: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to, file``.  Digests
    are verified."""
    n = max(1, manifest.count())
    return manifest.select("file").repartition(min(n, 10_000)).mapInArrow(
        _read_files(folder), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                             "refers_to bigint, file string")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages into the cluster's shared folder and read them back."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read(write(pages, folder, **options), folder)

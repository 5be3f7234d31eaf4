"""Media columns: content-defined chunking of payloads, deduplicated by Spark joins.

A text's UTF-8 bytes, padded with zero bytes to a positive multiple of 64, are the samples of an 8-bit mono
wave file (``RATE`` Hz, 44 bytes of header).  A rolling gear hash over the last 32 bytes cuts the samples into chunks; a
chunk is named by its SHA-256, and an object (a distinct payload) by the SHA-256 of its ordered chunk list.

* ``plan``: one pass names chunks and objects; joins and aggregates over names alone choose the row that stores each
  object and the object that stores each chunk.
* ``write_store``: a second pass writes each object once, with the chunks it owns in place and references, in order, to
  the chunks that others own.  Payload bytes are not shuffled; the plan rows of the few documents that share anything are
  broadcast while their counted number is small, and joined by shuffle beyond.
* ``read_store``: objects are rebuilt from the stored bytes (only those with references fetch chunks by a join),
  every chunk is verified against its name and the object against its list, and features are computed.

Edge cases: null and empty texts are 64 zero bytes; repeated rows share one object; null ids are kept; an empty table
gives an empty result; other columns are ignored.  Equal texts have equal values.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, new_path, stored, table
from .textnp import slices

BLOCK, RATE = 64, 8000
MEAN_BITS, LEAST, MOST = 11, 512, 8192
_GEAR = np.random.Generator(np.random.PCG64(91)).integers(0, 1 << 32, 256, dtype=np.uint32)


def wave_header(samples: int) -> bytes:
    """The header of an 8-bit mono PCM wave file."""
    return b"RIFF" + struct.pack("<I", (36 + samples) & 0xFFFFFFFF) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", samples & 0xFFFFFFFF)


def gear(buf: np.ndarray) -> np.ndarray:
    """The gear hash at every byte: its last 32 bytes, each shifted by its distance."""
    h = _GEAR[buf]
    for m in (1, 2, 4, 8, 16):
        h[m:] = h[m:] + (h[:-m] << np.uint32(m))
    return h


def payloads(column: pa.Array):
    """(row, unpadded size, payload, chunk ends) of every text."""
    for s in slices(column):
        size = np.diff(s.offs)
        padded = np.maximum(-(-size // BLOCK), 1) * BLOCK
        at = np.concatenate([[0], np.cumsum(padded)])
        buf = np.zeros(int(at[-1]), np.uint8)
        for d, (a, b, c) in enumerate(zip(s.offs.tolist(), s.offs[1:].tolist(), at.tolist(), strict=False)):
            buf[c : c + b - a] = s.buf[a:b]
        marks = np.flatnonzero(gear(buf) >> np.uint32(32 - MEAN_BITS) == 0) + 1  # none counts within LEAST bytes of a start, so no hash spans two texts
        first = np.searchsorted(marks, at, side="right")
        raw = buf.tobytes()
        for d in range(len(s)):
            start, end, last, ends = int(at[d]), int(at[d + 1]), int(at[d]), []
            for m in [*marks[first[d] : first[d + 1]].tolist(), end]:
                while m - last > MOST:
                    last += MOST
                    ends.append(last - start)
                if m - last >= LEAST or (m == end and m > last):
                    last = m
                    ends.append(m - start)
            yield s.first + d, int(size[d]), raw[start:end], ends


def _named(payload: bytes, ends: list[int]) -> tuple[list[bytes], bytes]:
    names = [hashlib.sha256(payload[a:b]).digest() for a, b in zip([0, *ends], ends, strict=False)]
    return names, hashlib.sha256(b"".join(names)).digest()


def _survey(batches):
    for batch in batches:
        size, objects, names = [], [], []
        for _, n, payload, ends in payloads(batch.column(2)):
            chunk, whole = _named(payload, ends)
            size.append(n)
            objects.append(whole)
            names.append(chunk)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(objects, pa.binary()), pa.array(names, pa.list_(pa.binary()))], names=["doc_id", "key", "n_bytes", "object", "names"])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text")


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The manifest (doc_id, n_bytes, object) and, for rows that share anything, what they do not or must store.

    Second table: key, keep (the row stores its object), foreign and lent (positions of chunks that another object
    owns, and of chunks that others take from here).  Rows without an entry store everything.
    """
    survey = stored(_rows(docs).mapInArrow(_survey, "doc_id long, key long, n_bytes long, object binary, names array<binary>"), "media-survey")
    objects = stored(survey.groupBy("object").agg(F.min("key").alias("key"), F.first("names").alias("names")), "media-objects")
    chunks = objects.select("object", "key", F.posexplode("names").alias("pos", "name"))
    owners = chunks.groupBy("name").agg(F.min(F.struct("key", "pos")).alias("own"), F.count("*").alias("c")).where("c > 1")
    shared = chunks.join(owners, "name")
    mine = (F.col("own.key") == F.col("key")) & (F.col("own.pos") == F.col("pos"))
    roles = shared.groupBy("key").agg(F.sort_array(F.collect_list(F.when(~mine, F.col("pos")))).alias("foreign"), F.sort_array(F.collect_list(F.when(mine, F.col("pos")))).alias("lent"))
    copies = survey.select("object", "key").distinct().join(objects.select("object", F.col("key").alias("rep")), "object").where("key <> rep").select("key")
    entries = copies.select("key", F.lit(False).alias("keep"), F.array().cast("array<int>").alias("foreign"), F.array().cast("array<int>").alias("lent")).unionByName(roles.select("key", F.lit(True).alias("keep"), "foreign", "lent"))
    return survey.select("doc_id", "n_bytes", "object"), stored(entries, "media-plan")


_STORE = "object binary, whole boolean, chunks array<struct<name:binary,lent:boolean,data:binary>>"
_CHUNK = pa.struct([("name", pa.binary()), ("lent", pa.bool_()), ("data", pa.binary())])


def _write(batches):
    for batch in batches:
        keep, foreign, lent = (batch.column(i).to_pylist() for i in (1, 2, 3))
        objects, whole, chunks, held = [], [], [], 0
        for row, _, payload, ends in payloads(batch.column(0)):
            if keep[row] is False:
                continue
            names, name = _named(payload, ends)
            away, given = set(foreign[row] or ()), set(lent[row] or ())
            objects.append(name)
            whole.append(not away)
            chunks.append([{"name": n, "lent": i in given, "data": None if i in away else payload[a:b]} for i, (n, a, b) in enumerate(zip(names, [0, *ends], ends, strict=False))])
            held += len(payload)
            if held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(objects, pa.binary()), pa.array(whole), pa.array(chunks, pa.list_(_CHUNK))], names=["object", "whole", "chunks"])
                objects, whole, chunks, held = [], [], [], 0
        if objects:
            yield pa.RecordBatch.from_arrays([pa.array(objects, pa.binary()), pa.array(whole), pa.array(chunks, pa.list_(_CHUNK))], names=["object", "whole", "chunks"])


def write_store(docs: DataFrame, entries: DataFrame, path: str) -> str:
    rows = _rows(docs).join(bounded(entries, entries.count()), "key", "left").select("text", "keep", "foreign", "lent")
    rows.mapInArrow(_write, _STORE).write.option("compression", "zstd").parquet(path)
    return path


def features(samples: np.ndarray) -> str:
    """Mean, root mean square, crossings of the middle, and the share of distinct values."""
    n = len(samples)
    wide = samples.astype(np.int64)
    above = samples >= 128
    return f"mean={int(wide.sum()) / n:.4f};rms={(int((wide * wide).sum()) / n) ** 0.5:.4f};crossings={int((above[1:] != above[:-1]).sum())};values={int((np.bincount(samples, minlength=256) > 0).sum())}"


_OUT = "object binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _read(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            out: list[list] = [[] for _ in range(7)]
            for name, chunks, extra in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for x in extra or ():
                    chunks[x["pos"]]["data"] = x["data"]
                parts = [c["data"] for c in chunks]
                if any(hashlib.sha256(d).digest() != c["name"] for d, c in zip(parts, chunks, strict=True)) or hashlib.sha256(b"".join(c["name"] for c in chunks)).digest() != name:
                    raise ValueError("a stored object does not match its chunk list")
                payload = b"".join(parts)
                header = wave_header(len(payload))
                media = hashlib.sha256(header)
                media.update(payload)
                row = (name, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(header) + len(payload), media.hexdigest(), features(np.frombuffer(payload, np.uint8)))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=[c.split()[0] for c in _OUT.split(", ")])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row of verified features per stored object."""
    store = spark.read.schema(_STORE).parquet(path)
    extra = "array<struct<pos:int,data:binary>>"
    plain = store.where("whole").select("object", "chunks", F.lit(None).cast(extra).alias("extra"))
    asked = store.where("NOT whole").select("object", F.posexplode("chunks.data").alias("pos", "data"), "chunks.name")
    asked = asked.where("data IS NULL").select("object", "pos", F.element_at("name", F.col("pos") + 1).alias("name"))
    lent = store.select(F.explode(F.filter("chunks", lambda c: c["lent"])).alias("c")).select("c.name", "c.data").dropDuplicates(["name"])
    got = asked.join(lent, "name").groupBy("object").agg(F.collect_list(F.struct("pos", "data")).alias("extra"))
    mixed = store.where("NOT whole").select("object", "chunks").join(got, "object").select("object", "chunks", F.col("extra").cast(extra).alias("extra"))
    return plain.mapInArrow(_read, _OUT).unionByName(mixed.mapInArrow(_read, _OUT))


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest, entries = plan(docs)
    path = write_store(docs, entries, new_path(spark, "media-store"))
    objects = stored(read_store(spark, path), "media-features").dropDuplicates(["object"])
    return manifest.join(objects, "object").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")

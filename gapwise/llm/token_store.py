"""Token-ID output: a content-addressed store of id streams.

Layout under one folder, all Parquet:

* ``chunks``   (digest, n, ids): each distinct chunk once; ids are little-endian, 16 bits wide where the
  vocabulary fits, else 32; the digest is the SHA-256 of those bytes.
* ``recipes``  (doc_id, row, n_tokens, recipe, part, place): one row per document in ascending doc_id order
  (null first), ``place`` in its part; the recipe lists chunk digests, lengths and the ids that follow, in order.
* ``manifest`` (part, level, place, hash, docs, tokens): a Merkle tree over each part's documents.  A leaf (not stored) is the SHA-256 of a
  document's id, length and recipe; a node hashes up to ``FANOUT`` neighbours of the level below; each part's last level is its root.

Readers compute leaves and nodes again from the recipes and compare every node with the manifest, so a recipe that was altered, lost,
added or moved raises; chunks are joined from the left, so a missing one raises too, as does one that does not match its digest or length.

A rolling hash over the last ``WINDOW`` ids cuts streams into chunks, so equal passages give equal chunks
wherever they stand.  Texts are tokenized once into a staging table; only one copy of a chunk per task carries
its ids into the shuffle by digest, and partial aggregation drops further copies, so a chunk shared by a
third of all documents stays cheap.  Documents are checked without gathering their ids: each stored chunk is
read back, its digest verified, and its CRC-32 shifted to its place; contributions XOR to the document's.

Edge cases: null and empty texts hold the end id alone; repeated rows stay separate documents and share
chunks; rows with a null doc_id come first; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, table
from .textnp import crc_shift, mix64

WINDOW, MEAN, LEAST, MOST = 16, 512, 128, 4096
#: Children of a node of the Merkle tree.
FANOUT = 64
_STAGE = "doc_id long, row long, pos int, n int, after long, digest binary, ids binary"


def with_end(flat: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each run of ids followed by the end id, and the new bounds."""
    n = len(bounds) - 1
    out = np.full(len(flat) + n, end_id, dtype=flat.dtype)
    out[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(bounds))] = flat
    return out, bounds + np.arange(n + 1)


def cut_points(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """For each document, the ends of its chunks, by a rolling hash of the last WINDOW ids."""
    h = mix64(ids.astype(np.uint64) + np.uint64(0x51ED270B))
    mult = np.uint64(0x9E3779B97F4A7C15)
    roll = np.zeros(len(ids), np.uint64)
    for k in range(WINDOW):  # Horner's rule over shifted copies: the same for the same last ids
        shift = WINDOW - 1 - k
        roll *= mult
        if shift < len(h):
            roll[shift:] += h[: len(h) - shift]
    marks = np.flatnonzero(mix64(roll) & np.uint64(MEAN - 1) == 0) + 1
    first = np.searchsorted(marks, bounds, side="right")
    out = []
    for d in range(len(bounds) - 1):
        start, end, ends = int(bounds[d]), int(bounds[d + 1]), []
        last = start
        for m in marks[first[d] : first[d + 1]].tolist():
            if m - last < LEAST:
                continue
            while m - last > MOST:
                last += MOST
                ends.append(last)
            last = m
            ends.append(m)
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if last < end:
            ends.append(end)
        out.append(ends)
    return out


def _stage(tokenizer_path: str, end_id: int, remembered: int = 100_000):
    def run(batches):
        from .tokens import tokenizer

        tok = tokenizer(tokenizer_path)
        seen: OrderedDict[bytes, None] = OrderedDict()
        for batch in batches:
            doc_ids, rows = batch.column(0), batch.column(1)
            for s, flat, bounds in tok.encode(batch.column(2)):
                ids, at = with_end(flat, bounds, end_id)
                raw, width = ids.tobytes(), ids.dtype.itemsize
                doc, pos, size, after, digest, data = [], [], [], [], [], []
                for d, ends in enumerate(cut_points(ids, at)):
                    last = int(at[d])
                    for k, end in enumerate(ends):
                        piece = raw[last * width : end * width]
                        key = hashlib.sha256(piece).digest()
                        doc.append(s.first + d)
                        pos.append(k)
                        size.append(end - last)
                        after.append(int(at[d + 1]) - end)
                        digest.append(key)
                        data.append(None if key in seen else piece)
                        seen[key] = None
                        if len(seen) > remembered:
                            seen.popitem(last=False)
                        last = end
                at_rows = pa.array(doc, pa.int64())
                yield pa.RecordBatch.from_arrays([doc_ids.take(at_rows), rows.take(at_rows), pa.array(pos, pa.int32()), pa.array(size, pa.int32()), pa.array(after, pa.int64()), pa.array(digest, pa.binary()), pa.array(data, pa.binary())], names=["doc_id", "row", "pos", "n", "after", "digest", "ids"])

    return run


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> str:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    texts.mapInArrow(_stage(tokenizer_path, end_id), _STAGE).write.option("compression", "zstd").parquet(f"{path}/staging")
    staged = spark.read.schema(_STAGE).parquet(f"{path}/staging")
    staged.where("ids IS NOT NULL").groupBy("digest").agg(F.first("n").alias("n"), F.first("ids").alias("ids")).write.option("compression", "zstd").parquet(f"{path}/chunks")
    recipes = staged.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "after", "digest"))).alias("recipe"), F.sum("n").cast("long").alias("n_tokens"))
    recipes = recipes.withColumn("recipe", F.transform("recipe", lambda x: F.struct(x["digest"].alias("digest"), x["n"].alias("n"), x["after"].alias("after"))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    recipes = recipes.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    recipes = recipes.withColumn("place", (F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1).cast("long"))
    recipes.write.option("compression", "zstd").parquet(f"{path}/recipes")
    tree(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")
    _drop(spark, f"{path}/staging")
    return path


def tree(recipes: DataFrame) -> DataFrame:
    """The Merkle nodes (part, level, place, hash, docs, tokens) over the documents of each part.

    Every level is one aggregate of at most ``FANOUT`` hashes a group, so no node and no task gathers a part.
    """
    steps = F.transform("recipe", lambda x: F.concat_ws(",", F.hex(x["digest"]), x["n"], x["after"]))
    text = F.concat_ws(";", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "row", "n_tokens", F.array_join(steps, ";"))
    level = recipes.select("part", "place", F.sha2(text.cast("binary"), 256).alias("hash"), F.lit(1).cast("long").alias("docs"), F.col("n_tokens").alias("tokens"))
    most, nodes, number = recipes.groupBy("part").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0, None, 0
    while number == 0 or most > 1:
        number, most = number + 1, -(-most // FANOUT)
        groups = level.groupBy("part", F.floor(F.col("place") / FANOUT).alias("place"))
        hashes = F.transform(F.sort_array(F.collect_list(F.struct("place", "hash"))), lambda x: x["hash"])
        level = groups.agg(F.sha2(F.array_join(hashes, "").cast("binary"), 256).alias("hash"), F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        step = level.select("part", F.lit(number).alias("level"), "place", "hash", "docs", "tokens")
        nodes = step if nodes is None else nodes.unionByName(step)
    return nodes


def verified(spark: SparkSession, path: str) -> DataFrame:
    """The recipes of a store, after every node of their tree was found equal to the manifest's."""
    recipes, kept = spark.read.parquet(f"{path}/recipes"), spark.read.parquet(f"{path}/manifest")
    names = ["part", "level", "place", "hash", "docs", "tokens"]
    both = tree(recipes).select(*names, F.lit(1).alias("side")).unionByName(kept.select(*names, F.lit(2).alias("side")))
    if both.groupBy(*names).agg(F.sum("side").alias("s")).where("s <> 3").head(1):
        raise ValueError("the recipes do not match the store's manifest")
    return recipes


def _drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _summaries(width: int):
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches):
        for batch in batches:
            crc = []
            for digest, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if hashlib.sha256(ids).digest() != digest or len(ids) != n * width:
                    raise ValueError("a stored chunk does not match its digest")
                crc.append(zlib.crc32(np.frombuffer(ids, kind).astype("<u4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crc, pa.int64())], names=["digest", "n", "crc"])

    return run


def _shifted(batches):
    for batch in batches:
        part = crc_shift(batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(part.astype(np.int64)), batch.column(3)], names=["row", "crc", "n"])


def id_width(path: str) -> int:
    from .tokens import tokenizer

    return np.dtype(tokenizer(path).dtype).itemsize


def read_store(spark: SparkSession, path: str, width: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the chunks' own bytes; a damaged store raises."""
    recipes, chunks = verified(spark, path), spark.read.parquet(f"{path}/chunks")
    summary = chunks.select("digest", "n", "ids").mapInArrow(_summaries(width), "digest binary, n int, crc long")
    parts = recipes.select("row", F.explode("recipe").alias("x")).select("row", "x.digest", F.col("x.n").alias("size"), (4 * F.col("x.after")).alias("after"))
    whole = F.when(F.col("n") == F.col("size"), F.col("n")).otherwise(F.raise_error(F.lit("a stored chunk is missing or has another length")).cast("int"))
    parts = parts.join(summary, "digest", "left").select("row", "crc", "after", whole.alias("n")).mapInArrow(_shifted, "row long, crc long, n int")
    sums = parts.groupBy("row").agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("n").alias("n_tokens"))
    starts = recipes.groupBy("part").agg(F.sum("n_tokens").alias("__s"))
    starts = starts.select("part", F.coalesce(F.sum("__s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inner = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = recipes.select("doc_id", "row", "part", F.col("n_tokens").alias("__n")).join(F.broadcast(starts), "part")
    placed = placed.withColumn("start", (F.col("__before") + F.coalesce(F.sum("__n").over(inner), F.lit(0))).cast("long"))
    return placed.join(sums, "row").select("doc_id", "start", "n_tokens", F.col("ids_crc32").cast("long").alias("ids_crc32"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, row and the id bytes of every document, rebuilt from its recipe; a damaged store raises.

    One value holds a whole document, as its text did.
    """
    steps = verified(spark, path).select("doc_id", "row", F.posexplode("recipe").alias("pos", "x")).select("doc_id", "row", "pos", "x.digest")
    chunks = spark.read.parquet(f"{path}/chunks").select("digest", "ids")
    good = F.unhex(F.sha2("ids", 256)) == F.col("digest")
    sound = F.when(good, F.col("ids")).otherwise(F.raise_error(F.lit("a stored chunk is missing or does not match its digest")).cast("binary"))
    whole = steps.join(chunks, "digest", "left").withColumn("ids", sound)
    whole = whole.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("p"))
    return whole.select("doc_id", "row", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def op4(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tok = public_tokenizers.path("byte_bpe_50k.json")
    path = write_store(table(spark, sf_dir, "documents"), new_path(spark, "token-store"), tok, end_id=0)
    return read_store(spark, path, id_width(tok))

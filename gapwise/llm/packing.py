"""Best-fit packing by large-item matching.

Documents become pieces of at most ``capacity`` ids; only longer documents are cut, into full pieces and a first,
shorter one.  Pieces are packed by length alone: the histogram of lengths, at most ``capacity`` numbers however
large the corpus, goes to the driver, which plans bins for whole multiplicities at once.

* A piece above one third of the capacity is large; no sequence holds three of them.  From the longest down,
  each takes the longest large partner that still fits, if any.
* Smaller pieces, longest first, go where they leave the least gap; only what fits no gap opens new sequences.

The plan is a list of segments (length, ranks, first sequence, offset).  A piece finds its segment by its rank
among the pieces of its length; ranks come from counts by (stored part, length), so no task ranks more than its
own part even if one length holds a third of all pieces.

Edge cases: null and empty texts are one piece of the end id; repeated rows are packed separately; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table
from .token_store import with_end

_PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, first rank, count, first sequence, offset) that pack so many pieces of each length."""
    left, rank = dict(counts), {}
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, count)
    order: list[int] = []
    sequence = 0

    def put(length: int, count: int, first: int, offset: int) -> None:
        out.append((length, rank.get(length, 0), count, first, offset))
        rank[length] = rank.get(length, 0) + count
        left[length] -= count

    def open_gap(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((first, count))

    large = sorted((x for x in counts if 3 * x > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((b for b in large if b <= min(a, capacity - a) and left[b] >= 1 + (b == a)), None)
            count = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            put(a, count, sequence, 0)
            if b is not None:
                put(b, count, sequence, a)
            open_gap(capacity - a - (b or 0), sequence, count)
            sequence += count
    for s in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        while left[s]:
            i = bisect_left(order, s)
            if i < len(order):
                gap = order[i]
                first, have = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[i]
                count = min(have, left[s])
                put(s, count, first, capacity - gap)
                open_gap(gap, first + count, have - count)
                open_gap(gap - s, first, count)
                continue
            slots = capacity // s
            bins = left[s] // slots
            for k in range(slots if bins else 0):
                put(s, bins, sequence, k * s)
            open_gap(capacity - slots * s, sequence, bins)
            sequence += bins
            if left[s]:
                last = left[s]
                for k in range(last):
                    put(s, 1, sequence, k * s)
                open_gap(capacity - last * s, sequence, 1)
                sequence += 1
    return out


def _pieces(tokenizer_path: str, end_id: int, capacity: int):
    def run(batches):
        from .tokens import tokenizer

        tok = tokenizer(tokenizer_path)
        for batch in batches:
            for s, flat, bounds in tok.encode(batch.column(2)):
                ids, at = with_end(flat, bounds, end_id)
                size = np.diff(at)
                number = (size + capacity - 1) // capacity
                doc = np.repeat(np.arange(len(size)), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                first = size - (number - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip((at[doc] + start).tolist(), (at[doc] + start + length).tolist(), strict=True)]
                take = pa.array(s.first + doc)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return run


def _placed(segments: list[tuple[int, int, int, int, int]]):
    table_ = np.array(sorted(segments), dtype=np.int64).reshape(-1, 5)
    stride = np.int64(1) << np.int64(44)  # ranks stay far below
    keys = table_[:, 0] * stride + table_[:, 1]

    def run(batches):
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns, strict=True))
            length, rank = cols["length"].to_numpy(), cols.pop("rank").to_numpy()
            at = np.searchsorted(keys, length * stride + rank, side="right") - 1
            cols["sequence_id"] = pa.array(table_[at, 3] + rank - table_[at, 1])
            cols["offset"] = pa.array(table_[at, 4])
            yield pa.RecordBatch.from_pydict(cols)

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """docs(doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    pieces = stored(texts.mapInArrow(_pieces(tokenizer_path, end_id, capacity), _PIECES).withColumn("part", F.spark_partition_id()), "pieces")
    by_part = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("c")), "piece-counts")
    counts = {r["length"]: r["c"] for r in by_part.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # at most `capacity` rows
    before = F.coalesce(F.sum("c").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.withColumn("__r", F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "row", "piece")) - 1)
    ranked = ranked.join(by_part.select("part", "length", before.alias("__before")), ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("__before") + F.col("__r")).cast("long").alias("rank"))
    return ranked.mapInArrow(_placed(plan_bins(counts, capacity)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

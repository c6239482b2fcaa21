"""Packing documents into fixed-length training sequences by the sum-of-squares rule.

Only a document's first piece can be shorter than a sequence, so full pieces are
sequences by themselves and there is one open piece a document at most. Open pieces
are dealt to groups of bounded size by a hash of their row; each group is packed by
itself, longest first, every piece going where the sum over residual gaps of the
squared number of open bins becomes smallest. Groups are large enough that what a
group leaves open is a small part of its sequences, and small enough for one task.

Defined results: null text counts as empty and is packed as its end id alone;
repeated rows are packed as often as they occur; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_bytes, released, text_arrays, texts_of, written
from .vocabulary import encoder_of

#: Open pieces that one task packs at a time.
GROUP = 65_536


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces are placed longest first, ties in the given order.

    count[g] is the number of open bins with residual gap g. Putting a piece of
    length s in a bin of gap g changes the sum of squares by
    2 * (count[g - s] - count[g]) + 2, without count[g - s] where the bin becomes
    full. The smallest change wins; among equal ones the smallest gap. A bin is
    opened only for a piece that fits in no open one: with all pieces known and the
    longest first, that takes fewer bins than letting new ones compete.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    of_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    never = np.iinfo(np.int64).max // 4
    for k in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        s = int(lengths[k])
        after, now = count[: capacity + 1 - s].copy(), count[s:]
        after[0] = 0  # a full bin no longer counts
        change = 2 * (after - now) + 2
        change[0] -= 1
        change[now == 0] = never  # count[capacity] is always 0
        least = int(np.argmin(change))
        gap = capacity if change[least] == never else s + least
        if gap == capacity:
            b, opened = opened, opened + 1
        else:
            b = of_gap[gap].pop()
            count[gap] -= 1
        bins[k], offsets[k] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            of_gap[gap - s].append(b)
    return bins, offsets


def cut_pieces(df: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids binary, row): every document's ids and the end id, cut to ``capacity``.

    All pieces but the first are full. ids are little-endian unsigned 32-bit;
    row tells equal rows apart.
    """
    content = df.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_file))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(content.value)
        row = TaskContext.get().partitionId() << 33
        for part, texts in text_arrays(batches):
            at, piece, start, length, rows, ids = [], [], [], [], [], []
            for k, got in enumerate(encoder.encode(texts)):
                got += end
                n = len(got) // 4
                row += 1
                edge, p = 0, 0
                while edge < n:
                    step = (n - 1) % capacity + 1 if p == 0 else capacity
                    at.append(k), piece.append(p), start.append(edge), length.append(step), rows.append(row)
                    ids.append(got[4 * edge : 4 * (edge + step)])
                    edge, p = edge + step, p + 1
            doc = part.column(0).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([doc, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(rows, pa.int64())], names=["doc_id", "piece", "start", "length", "ids", "row"])

    return texts_of(df, id_col, text_col).mapInArrow(released(run), "doc_id long, piece int, start long, length long, ids binary, row long")


def place(pieces: DataFrame, capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """pieces (with length and row) plus sequence_id and offset.

    ``pieces`` is read three times, so it should be a stored table.
    """
    full, open_ = pieces.filter(F.col("length") >= capacity), pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-open_.count() // group))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "piece"], kind="stable")
        bins, offsets = sum_of_squares(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(pdf["_group"].to_numpy().astype(np.int64) << 32) + bins, offset=offsets).drop(columns="_group")

    columns = pieces.columns
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = open_.withColumn("_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("_group").applyInPandas(pack, f"{types}, sequence_id long, offset long")
    alone = full.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(df: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    The cut pieces' places are stored once without their ids: tokens are made in
    one pass, and only lengths take part in the packing.
    """
    cut = cut_pieces(df, tokenizer_file, capacity, end_id, id_col, text_col)
    stored = written(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "row"), "pieces")
    return place(stored, capacity, group).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary, n_ids): the packed sequences themselves, from cut pieces and their places."""
    rows = placed.select("doc_id", "piece", "row", "sequence_id", "offset").join(pieces.select("doc_id", "piece", "row", "ids"), ["doc_id", "piece", "row"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.groupBy("sequence_id").agg(joined.alias("ids")).withColumn("n_ids", F.length("ids") / 4)

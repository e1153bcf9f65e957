"""Sum-of-squares packing of token sequences into windows of a fixed length."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.encode import encoder
from playbill.llm.tasks import map_text, ready, text_batches

WINDOW = 1024
# Pieces that one packer sees on average. Each packer leaves some windows part
# filled, so few packers mean little padding and many mean more tasks.
PIECES_PER_PACKER = 30_000


def token_pieces(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    window: int = WINDOW,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Cut the ids of each document (with ``end_id`` after them) into pieces of at most ``window``.

    All pieces but the last of a document are full. Columns: key, start, length,
    ids_crc32 (of the ids as little-endian 32-bit integers), doc_tokens, and the
    ids themselves with ``with_ids``. Null and empty texts give the end id alone.
    """

    def rows(batches):
        own = encoder(tokenizer)
        for batch, texts in text_batches(batches, "text"):
            flat, sizes = own.encode(texts)
            at = 0
            out: list[list] = [[], [], [], [], [], []]
            for i, n in enumerate(sizes):
                ids = np.append(flat[at : at + n], np.uint32(end_id)).astype("<u4")
                at += n
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    values = (i, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece)
                    for column, v in zip(out, values):
                        column.append(v)
            names = [key, "start", "length", "ids_crc32", "doc_tokens"]
            arrays = [batch.column(0).take(pa.array(out[0])), *(pa.array(x, pa.int64()) for x in out[1:5])]
            if with_ids:
                names.append("ids")
                arrays.append(pa.array(out[5], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[key].dataType.simpleString()
    ids = ", ids array<long>" if with_ids else ""
    source = docs.select(docs[key], docs[text].alias("text"))
    return map_text(source, rows, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long{ids}")


class Packer:
    """Online packing: each piece goes where the sum of squared level counts ends smallest.

    ``counts[h]`` is the number of open windows filled to ``h``. Moving a window
    from level h to h + s changes two squares; a new window changes one. Full
    windows leave the array. Ties go to the fullest window.
    """

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """(window number, offset there) of the next piece."""
        counts, room = self.counts, self.window - size
        best, change = 0, 2 * counts[size] + 1 if size < self.window else 0
        if room:
            now = counts[1 : room + 1]
            moved = 2 * (counts[1 + size : self.window + 1] - now) + 2
            moved[-1] -= 1
            moved[now == 0] = np.iinfo(np.int64).max
            at = room - 1 - int(moved[::-1].argmin())
            if moved[at] <= change:
                best = at + 1
        if best:
            number = self.open[best].pop()
            counts[best] -= 1
        else:
            number = self.made
            self.made += 1
        if best + size < self.window:
            self.open[best + size].append(number)
            counts[best + size] += 1
        return number, best


def pack_pieces(
    pieces: DataFrame, packers: int, window: int = WINDOW, key: str = "doc_id", order: tuple[str, ...] = ("start",)
) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``window``.

    Rows are dealt to ``packers`` by a hash of key and order columns, so a document
    of any length is spread; each packer keeps one level array, never its rows.
    Other columns ride along. The result depends on the rows alone, not on
    partitions: rows of a packer come in the order of hash, key and ``order``.
    """
    spark = ready(pieces.sparkSession)
    names = pieces.columns
    dealt = F.xxhash64(*(pieces[c] for c in (key, *order)))
    placed = (
        pieces.withColumn("__hash", dealt)
        .withColumn("__packer", F.pmod(F.col("__hash"), F.lit(max(1, packers))))
        .repartition(max(1, min(packers, 10_000)), "__packer")
        .sortWithinPartitions("__packer", "__hash", key, *order)
    )
    at_length = placed.columns.index("length")
    at_packer = placed.columns.index("__packer")

    def rows(batches):
        packer, now = None, None
        for batch in batches:
            ids, offsets = [], []
            for number, size in zip(batch.column(at_packer).to_pylist(), batch.column(at_length).to_pylist()):
                if number != now:
                    packer, now = Packer(window), number
                seq, offset = packer.place(size)
                ids.append(number << 40 | seq)
                offsets.append(offset)
            kept = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())], [*names, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    del spark
    return placed.mapInArrow(rows, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    window: int = WINDOW,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    pieces_per_packer: int = PIECES_PER_PACKER,
) -> DataFrame:
    """Pack all documents into windows of ``window`` tokens.

    One row per piece: key, start, length, ids_crc32, doc_tokens, (ids,)
    sequence_id and offset. Offsets in a sequence are gapless from 0. Every id of
    every row lies in one piece; repeated rows are packed each. A null text is
    the end id alone, an empty table gives no row, other columns are not read.
    """
    pieces = token_pieces(docs, tokenizer, window, end_id, key, text, with_ids)
    packers = -(-docs.count() * 2 // pieces_per_packer)
    return pack_pieces(pieces, packers, window, key)

"""Token ids as Arrow files of equal-length sequences with masks."""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playbill.llm.encode import encoder
from playbill.llm.tasks import map_text, ready, text_batches
from playbill.session import scratch_path

SEQUENCE = 1024
# Sequences of one record batch, and of one file.
_BATCH_ROWS = 64
_FILE_ROWS = 4_096
# Bytes of text that one writing task gets on average.
_TASK_BYTES = 24_000_000
# Values of the mask.
PADDING, INSIDE, LAST = 0, 1, 2


def _schema(length: int, kind: type, docs: bytes) -> pa.Schema:
    """Ids, and two bits for each: whether it is real (not padding), and whether it ends a document."""
    lists = {"ids": pa.from_numpy_dtype(kind), "real": pa.bool_(), "last": pa.bool_()}
    return pa.schema([pa.field(c, pa.list_(t, length)) for c, t in lists.items()], metadata={b"doc_ids": docs})


def id_type(size: int) -> type:
    """Two bytes an id where all ids below ``size`` fit, else four."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, by its URI; a bare path is local."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_file(
    folder: str, name: str, ids: np.ndarray, ends: np.ndarray, doc_ids: list[int | None], length: int, kind: type = np.uint32
) -> None:
    """One file: ``ids`` in rows of ``length`` as numbers of type ``kind``, the last row padded with 0.

    ``ends`` are the places of the documents' last ids. The keys of the documents
    that end here are in the schema's metadata, in order.
    """
    n_rows = -(-len(ids) // length)
    padded = np.zeros(n_rows * length, kind)
    padded[: len(ids)] = ids
    real, last = np.zeros(n_rows * length, bool), np.zeros(n_rows * length, bool)
    real[: len(ids)], last[ends] = True, True
    keys = b"".join(struct.pack("<?q", k is not None, k or 0) for k in doc_ids)
    schema = _schema(length, kind, keys)
    system, path = open_folder(folder)
    with system.open_output_stream(f"{path}/{name}") as sink, pa.ipc.new_file(sink, schema) as writer:
        for first in range(0, n_rows, _BATCH_ROWS):
            part = slice(first * length, (first + _BATCH_ROWS) * length)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(v[part]), length) for v in (padded, real, last)]
            writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of a batch as flat arrays: ids are a view, the mask is made from its bits."""
    ids, real, last = (batch.column(c).flatten() for c in range(3))
    bits = [v.to_numpy(zero_copy_only=False).view(np.uint8) for v in (real, last)]
    return ids.to_numpy(zero_copy_only=True), bits[0] + bits[1]


class TokenFile:
    """A file opened for random access: on a local disk rows are views of the mapped file."""

    def __init__(self, folder: str, name: str):
        system, path = open_folder(folder)
        local = isinstance(system, fs.LocalFileSystem)
        source = pa.memory_map(f"{path}/{name}") if local else system.open_input_file(f"{path}/{name}")
        self.reader = pa.ipc.open_file(source)
        keys = self.reader.schema.metadata[b"doc_ids"]
        self.doc_ids = [k if known else None for known, k in struct.iter_unpack("<?q", keys)]

    def batches(self):
        """(ids, mask) as flat arrays, a record batch at a time."""
        for i in range(self.reader.num_record_batches):
            yield _read(self.reader.get_batch(i))

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of one row; all batches but the last have the same number of rows."""
        return _read(self.reader.get_batch(row // _BATCH_ROWS).slice(row % _BATCH_ROWS, 1))


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 2,
    length: int = SEQUENCE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write the ids of all documents, ``end_id`` after each, in ascending order of the key.

    Each task writes files of at most ``_FILE_ROWS`` rows; a document may go on in
    the task's next file. Returns the table of files: task, part (order within
    the task), name, n_tokens, n_docs. File names are new for each attempt of a task and
    only those in this table count, so an attempt that was lost leaves nothing
    that is read. Null text is empty; null keys come first, equal keys are
    ordered by text; the key must be an integer. An empty table writes no file.
    """
    spark = ready(docs.sparkSession)
    source = docs.select(docs[key].cast("long").alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    size = source.select(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // _TASK_BYTES))
    ordered = source.repartitionByRange(tasks, "key", F.xxhash64("text")).sortWithinPartitions("key", "text")
    system, path = open_folder(folder)
    if isinstance(system, fs.LocalFileSystem):
        system.create_dir(path, recursive=True)
    most = length * _FILE_ROWS

    def rows(batches):
        from pyspark import TaskContext

        task, own = TaskContext.get().partitionId(), encoder(tokenizer)
        kind = id_type(1 + max(end_id, *own.tokenizer.get_vocab(with_added_tokens=True).values()))
        ids: list[np.ndarray] = []
        ends: list[int] = []
        keys: list[int | None] = []
        held = part = 0

        def flush(n: int):
            """Write the first ``n`` held ids."""
            nonlocal ids, ends, keys, held, part
            flat = np.concatenate(ids)
            inside = [e for e in ends if e < n]
            name = f"{task:06d}-{part:05d}-{uuid.uuid4().hex}.arrow"
            write_file(folder, name, flat[:n], np.array(inside, np.int64), keys[: len(inside)], length, kind)
            row = [[task], [part], [name], [n], [len(inside)]]
            ids, ends, keys = [flat[n:]], [e - n for e in ends[len(inside) :]], keys[len(inside) :]
            held, part = held - n, part + 1
            return pa.RecordBatch.from_arrays([pa.array(v) for v in row], ["task", "part", "name", "n_tokens", "n_docs"])

        for batch, texts in text_batches(batches, "text"):
            flat, sizes = own.encode(texts)
            ends_here = np.cumsum(sizes)
            flat = np.insert(flat, ends_here, np.uint32(end_id))
            ends.extend((ends_here + np.arange(len(sizes)) + held).tolist())
            keys.extend(batch.column(0).to_pylist())
            ids.append(flat)
            held += len(flat)
            while held >= most:
                yield flush(most)
        if held:
            yield flush(held)

    return map_text(ordered, rows, "task long, part long, name string, n_tokens long, n_docs long")


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens and ids_crc32.

    ``files`` is the table :func:`write_token_files` gave, once it is stored. One
    task reads the files of one writer in order, so a document may cross files;
    start counts the ids of all documents before it, over all tasks.
    """
    spark: SparkSession = ready(files.sparkSession)
    per_task = files.groupBy("task").agg(F.sum("n_tokens").alias("n"), F.sort_array(F.collect_list(F.struct("part", "name"))).alias("files"))
    # One row per writing task, a few numbers each.
    before = per_task.select("task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    jobs = per_task.join(before, "task").select("before", F.col("files.name").alias("names"))
    del spark

    def rows(batches):
        for batch in batches:
            for before, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start, size, crc = before, 0, 0
                for name in names:
                    file = TokenFile(folder, name)
                    out: list[list] = [[], [], [], []]
                    keys = iter(file.doc_ids)
                    for ids, mask in file.batches():
                        first = 0
                        for end in np.flatnonzero(mask == LAST) + 1:
                            piece = ids[first:end]
                            size, crc = size + len(piece), zlib.crc32(piece.astype("<u4").tobytes(), crc)
                            for column, v in zip(out, (next(keys), start, size, crc)):
                                column.append(v)
                            start, size, crc, first = start + size, 0, 0, int(end)
                        rest = ids[first:][mask[first:] == INSIDE]
                        size, crc = size + len(rest), zlib.crc32(rest.astype("<u4").tobytes(), crc)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, pa.int64()) for v in out], ["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    spread = jobs.repartition(jobs.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the files, store their table beside them, and read the documents back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    write_token_files(docs, f"{folder}/data", **options).write.parquet(f"{folder}/files")
    return read_documents(spark.read.parquet(f"{folder}/files"), f"{folder}/data")

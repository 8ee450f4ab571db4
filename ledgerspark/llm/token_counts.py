"""Token counts of documents in flat token files that have no index.

A file is a run of token ids with an end-of-document id after each document. It is read in blocks
at known offsets; each block is searched for separators in one vectorised step, and a prefix scan
over the blocks of a file tells each block how many documents ended before it and where the last
one did. Documents that span blocks are stitched that way, however many blocks a file has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerspark.llm import bpe
from ledgerspark.llm.sampling import SPLIT_ROWS
from ledgerspark.operators.ordered import RunningMax, RunningSum, with_running
from ledgerspark.session import new_path, stored

#: Tokens per block, and the type of a token in a file.
BLOCK_TOKENS, DTYPE = 1 << 16, "<u2"
#: The vocabulary's end-of-text id; texts cannot produce it here, as special strings count as plain text.
SEPARATOR = 49407


@dataclass(frozen=True)
class EarlierMax(RunningMax):
    """Maximum of the rows before this one."""

    def local(self, w: WindowSpec) -> Column:
        return F.max(self.col).over(w.rowsBetween(Window.unboundedPreceding, -1))


def write_tokens(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = bpe.VOCABULARY, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Encode whole texts into flat token files in the shared folder, one per task, and read them back
    as blocks: file, offset (in tokens), data, and ``keys``, those of the documents that end in the block.

    Null texts are empty documents: a separator and nothing before it.
    """
    tokenizer = bpe.tokenizer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary, False)
        file, offset = TaskContext.get().partitionId(), 0
        end = np.array([SEPARATOR], DTYPE)
        pending: list[np.ndarray] = []
        waiting: list[tuple[int, pa.Scalar]] = []  # (position of its separator, key)
        size = 0

        def block(data: np.ndarray) -> pa.RecordBatch:
            nonlocal offset
            stop = offset + len(data)
            n = sum(at < stop for at, _ in waiting)
            keys = pa.array([[k.as_py() for _, k in waiting[:n]]], pa.list_(batch.schema.field(0).type))
            del waiting[:n]
            made = pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([offset], pa.int64()), pa.array([data.tobytes()], pa.binary()), keys],
                ["file", "offset", "data", "keys"],
            )
            offset = stop
            return made

        for batch in batches:
            for keys, texts in bpe.in_blocks(iter([batch])):
                for k, ids in zip(keys, tok.encode(texts)):
                    pending += [np.frombuffer(ids, "<u4").astype(DTYPE), end]
                    size += len(ids) // 4 + 1
                    waiting.append((offset + size - 1, k))
                    if size >= block_tokens:
                        flat = np.concatenate(pending)
                        cut = len(flat) // block_tokens * block_tokens
                        for at in range(0, cut, block_tokens):
                            yield block(flat[at : at + block_tokens])
                        pending, size = [flat[cut:]], len(flat) - cut
        if size:
            yield block(np.concatenate(pending))

    kind = docs.schema[key].dataType.simpleString()
    blocks = docs.select(key, text).mapInArrow(run, f"file int, offset bigint, data binary, keys array<{kind}>")
    path = new_path(docs.sparkSession, "tokens")
    blocks.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(blocks.schema).parquet(path)


def read_tokens(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, dtype: str = DTYPE) -> DataFrame:
    """Blocks (file, offset, data) of raw token files; ``file`` is the path. A file is one row of the
    binary reader first, so each must be under 2 GB."""
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns):
                data = content.as_py()
                for at in range(0, len(data), block_tokens * width):
                    yield pa.RecordBatch.from_pydict(
                        {"file": [name.as_py()], "offset": pa.array([at // width], pa.int64()), "data": [data[at : at + block_tokens * width]]}
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, offset bigint, data binary")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = DTYPE, chunks: int | None = None) -> DataFrame:
    """One row per document: file, ordinal (from 0), start (offset of its first token), n_tokens, and
    offset and nth, the block in which it ends and its place there.

    ``blocks`` holds file, offset (of the first token, from 0, without gaps) and data. Two separators
    in a row enclose an empty document. Tokens after a file's last separator are a document that is
    not closed: it is counted as the last one, with null offset and nth. Null or empty data, and an
    empty table, hold no documents. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [np.frombuffer(d.as_py() or b"", dtype) for d in batch.column(2)]
            found = [np.flatnonzero(a == separator) for a in arrays]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(a) for a in arrays], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                ["file", "offset", "size", "at"],
            )

    kind = blocks.schema["file"].dataType.simpleString()
    searched = blocks.select("file", "offset", "data").mapInArrow(run, f"file {kind}, offset bigint, size bigint, at array<bigint>")
    searched = searched.filter("size > 0").select(
        "file", "offset", "size", F.transform("at", lambda x: x + F.col("offset")).alias("at")
    ).withColumns({"_n": F.size("at").cast("bigint"), "_last": F.try_element_at("at", F.lit(-1))})
    searched = stored(searched, "searched")  # one pass over the tokens, whatever is then asked of the separators
    scanned = with_running(searched, ["file"], ["offset"], chunks=chunks, chunk_rows=SPLIT_ROWS, _ended=RunningSum("_n"), _before=EarlierMax("_last"))
    first = F.coalesce("_before", F.lit(-1).cast("bigint")) + 1
    starts = F.transform("at", lambda x, i: F.when(i == 0, first).otherwise(F.get("at", i - 1) + 1))
    closed = scanned.select("file", "offset", "_ended", "_n", F.posexplode(F.arrays_zip("at", starts.alias("start"))).alias("nth", "_d"))
    closed = closed.select(
        "file",
        (F.col("_ended") - F.col("_n") + F.col("nth")).alias("ordinal"),
        F.col("_d.start").alias("start"),
        (F.col("_d.at") - F.col("_d.start")).alias("n_tokens"),
        "offset",
        "nth",
    )
    ends = scanned.groupBy("file").agg(
        F.max(F.col("offset") + F.col("size")).alias("_stop"),
        (F.coalesce(F.max("_last"), F.lit(-1).cast("bigint")) + 1).alias("start"),
        F.sum("_n").alias("ordinal"),
    )
    none = F.lit(None)
    left_open = ends.filter("_stop > start").select(
        "file", "ordinal", "start", (F.col("_stop") - F.col("start")).alias("n_tokens"), none.cast("bigint").alias("offset"), none.cast("int").alias("nth")
    )
    return closed.unionByName(left_open)


def document_token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, file, ordinal and start.

    The texts are written as flat token files and the counts come from scanning those; a
    document's key is known by its place among the separators. A null or empty text has 0 tokens; a
    null key stays; repeated rows give repeated rows. Only ``key`` and ``text`` are read.
    """
    blocks = write_tokens(docs, key, text)
    counted = count_tokens(blocks)
    named = blocks.select(F.col("file").alias("_f"), F.col("offset").alias("_o"), F.posexplode("keys").alias("_k", "_key"))
    same = (F.col("file") == F.col("_f")) & (F.col("offset") == F.col("_o")) & (F.col("nth") == F.col("_k"))
    return counted.join(named, same).select(F.col("_key").alias(key), "n_tokens", "file", "ordinal", "start")

"""Rows packed into compressed blocks, so that decisions travel and texts do not.

A table is written once to the shared folder as blocks of about a megabyte, each an Arrow stream in a
file of many; a small table says where each block lies.  A stage reads what it needs of each row under
the name (block, row), decides elsewhere, and sends the decisions to tasks that read the named blocks
from the shared folder.  No shuffle carries texts.  Names are unique even where rows repeat or ids are
null.  Files are written under fresh names and listed only by tasks that end well, so those of lost
tasks are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listweave.llm.common import arrow_limits, qualified, scratch, slices, storage, written

#: Bytes of a block before compression, and of a file of blocks after it.
BLOCK_BYTES, FILE_BYTES = 1_000_000, 64_000_000
#: Blocks that a task reads, about.
TASK_BLOCKS = 64
#: Bits of a row's number, and of a block's number within its task, in the name of a place.
ROW_BITS, OWN_BITS = 17, 22
_SPEC = "path string, start long, size long, rows long, n_bytes long"


def _sizes(batch: pa.RecordBatch) -> list[int]:
    """Bytes of each row, by its text columns; 16 more, so that a block has under 2**17 rows."""
    total = [16] * batch.num_rows
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
            for i, n in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
                total[i] += n
    return total


def packed(df: DataFrame, name: str) -> DataFrame:
    """(block, path, start, size, rows, n_bytes) of blocks with all rows of ``df`` in the shared folder.

    n_bytes: bytes of text and binary columns, about.  An empty table has no block.
    """
    spark = df.sparkSession
    arrow_limits(spark)
    where = scratch(spark, f"{name}-files")
    base = qualified(spark, where)
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        system, folder = storage(base)
        file, listed, at = None, [], 0

        def closed() -> pa.RecordBatch:
            file.close()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*listed, strict=True)], names=["path", "start", "size", "rows", "n_bytes"])

        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = _sizes(batch)
            for a, b in slices(sizes, BLOCK_BYTES):
                if file is None:
                    system.create_dir(folder, recursive=True)
                    own = f"{uuid.uuid4().hex}.blocks"
                    file, listed, at = system.open_output_stream(f"{folder}/{own}", compression=None), [], 0
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(a, b - a))
                data = sink.getvalue()
                file.write(data)
                listed.append((own, at, data.size, b - a, sum(sizes[a:b])))
                at += data.size
                if at >= FILE_BYTES:
                    yield closed()
                    file = None
        if file is not None:
            yield closed()

    listed = numbered.mapInArrow(pack, _SPEC).select(F.monotonically_increasing_id().alias("block"), "*")
    blocks = written(listed, name)
    blocks._files = where
    return blocks


def forgotten(blocks: DataFrame) -> None:
    """Delete blocks from which nothing that is still to be computed derives."""
    from listweave.llm.common import dropped

    files = blocks.limit(0)
    files._scratch = blocks._files
    dropped(files, blocks)


def place(block: Column | str = "block", row: Column | str = "row") -> Column:
    """One integer for (block, row): the block's task, its number there, and the row."""
    b, r = (F.col(c) if isinstance(c, str) else c for c in (block, row))
    task, own = F.shiftright(b, 33), b.bitwiseAND((1 << 33) - 1)
    return F.shiftleft(task, OWN_BITS + ROW_BITS).bitwiseOR(F.shiftleft(own, ROW_BITS)).bitwiseOR(r.cast("long"))


def place_block(at: Column | str) -> Column:
    p = F.col(at) if isinstance(at, str) else at
    own = F.shiftright(p, ROW_BITS).bitwiseAND((1 << OWN_BITS) - 1)
    return F.shiftleft(F.shiftright(p, OWN_BITS + ROW_BITS), 33).bitwiseOR(own)


def place_row(at: Column | str) -> Column:
    p = F.col(at) if isinstance(at, str) else at
    return p.bitwiseAND((1 << ROW_BITS) - 1).cast("int")


def tasks(blocks: DataFrame) -> int:
    """Number of tasks to read all blocks with."""
    least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-blocks.count() // TASK_BLOCKS))


def spread(blocks: DataFrame, n: int | None = None) -> DataFrame:
    """Block places (and what came with them) dealt over the tasks that will read the blocks.

    By a hash of its own: by the block alone, the planner would take a join's partitions for it, which
    adaptive execution merges by their small size.
    """
    return blocks.repartition(n or tasks(blocks), F.xxhash64("block"))


class Reader:
    """Reads blocks of one table in a task, with the file at hand kept open."""

    def __init__(self, base: str):
        self.system, self.folder = storage(base)
        self.path, self.file = None, None

    def read(self, path: str, start: int, size: int) -> pa.RecordBatch:
        if path != self.path:
            self.close()
            self.path, self.file = path, self.system.open_input_file(f"{self.folder}/{path}")
        table = pa.ipc.open_stream(self.file.read_at(size, start)).read_all().combine_chunks()
        return table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path, self.file = None, None


def read_blocks(blocks: DataFrame, schema: str | StructType, f: Callable[[dict, pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``f(what came with the block, its rows)`` of every block; columns are those packed, c0 and on.

    Texts are read where they are worked on, a block at a time.
    """
    return read_all(blocks, schema, lambda found: (out for asked, rows in found for out in f(asked, rows)))


def read_all(blocks: DataFrame, schema: str | StructType, f: Callable[[Iterator[tuple[dict, pa.RecordBatch]]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """As ``read_blocks``, with one call of ``f`` a task for all of its blocks."""
    base = qualified(blocks.sparkSession, blocks._files)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.RecordBatch]]:
        reader = Reader(base)
        for batch in batches:
            for i in range(batch.num_rows):
                asked = {n: c[i] for n, c in zip(batch.schema.names, batch.columns, strict=True)}
                yield asked, reader.read(*(asked[n].as_py() for n in ("path", "start", "size")))
        reader.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return f(found(batches))

    arrow_limits(blocks.sparkSession)
    return blocks.mapInArrow(run, schema)


def with_files(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` derived from the table of blocks, which go on naming its files."""
    rows._files = blocks._files
    return rows


def described(blocks: DataFrame, columns: list[str], schema: str, f: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """(block, row, ...) of every row: ``f`` gives a column for each field of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    whole = f"block long, row int, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(whole))

    def run(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = f(rows.rename_columns(columns)) | {"block": [asked["block"].as_py()] * rows.num_rows, "row": range(rows.num_rows)}
        yield pa.RecordBatch.from_arrays([pa.array(own[x.name], x.type) for x in arrow], schema=arrow)

    return read_blocks(with_files(blocks, spread(blocks)), whole, run)


def asked_rows(blocks: DataFrame, choice: DataFrame, *fields: str) -> DataFrame:
    """Blocks with ``asked``, the (row, fields) that ``choice(block, row, fields)`` names in them."""
    named = choice.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(F.col("row").cast("int").alias("row"), *fields))).alias("asked"))
    n = tasks(blocks)
    return with_files(blocks, spread(blocks.join(named, "block"), n))


def taken(blocks: DataFrame, choice: DataFrame, schema: StructType) -> DataFrame:
    """The rows that ``choice(block, row, times)`` names, each ``times`` times, with their columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)

    def run(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index = [r["row"] for r in asked["asked"].as_py() for _ in range(r["times"])]
        if index:
            got = rows.take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays([c.cast(x.type) for c, x in zip(got.columns, arrow_schema, strict=True)], schema=arrow_schema)

    return read_blocks(asked_rows(blocks, choice.withColumn("times", F.col("times").cast("int")), "times"), schema, run)

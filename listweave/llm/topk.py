"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Rows are packed in passing into blocks in the shared folder, in the narrowest integers that hold their
weights; a block's queries are written beside it.  The search is a grid of some query pieces by a part
of all candidate blocks.  A cell's task reads its blocks itself, so only names of blocks and lists of
results travel.  A block's postings, for each dimension (term) the places and weights of the rows that
are not zero there, are built once a cell; a query's terms scatter their weighted postings into a dense
array of scores, partition selection takes the block's best, and lists merge: in the cell block by
block, then across the ``PARTS`` parts.  No candidate is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.llm.blocks import Reader, packed
from listweave.llm.common import arrow_limits, qualified, written

#: Rows of a candidate block, and queries of a cell of the grid, about.
CANDIDATES, QUERIES = 16_384, 2_048
#: Parts of the candidates, which is the most lists of a query that are merged across tasks.
PARTS = 8
SCALE = 64
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def vector_rows(vectors: DataFrame, query: Column, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x, query) of the rows that take part; ``query`` says which of them are queries too.

    Rows with a null id, a null vector or null or non-finite components take no part; further columns,
    whatever their names, are left.  A null ``query`` is false.
    """
    x = F.col("x")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"), F.coalesce(query, F.lit(False)).alias("query"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where("vec_id is not null and x is not null").where(~bad)


def weights_of(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x); what leaves 64 bits becomes their nearest number."""
    with np.errstate(over="ignore"):
        w = np.floor(scale * x)
    out = np.clip(w, -(2.0**62), 2.0**62).astype(np.int64)
    wide = np.abs(w) >= 2.0**62
    if wide.any():
        out[wide] = [max(_LEAST, min(_MOST, int(v))) if np.isfinite(v) else (_MOST if v > 0 else _LEAST) for v in w[wide].tolist()]
    return out


def _narrow(w: np.ndarray) -> np.ndarray:
    for kind in (np.int8, np.int16, np.int32):
        limit = np.iinfo(kind)
        if not len(w) or (w.min() >= limit.min and w.max() <= limit.max):
            return w.astype(kind)
    return w


def _block_of(ids: np.ndarray, sizes: np.ndarray, weights: np.ndarray, places: np.ndarray) -> bytes:
    small = _narrow(weights)
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in (ids.astype("<i8"), sizes.astype("<i4"), places.astype("<i8"), small)] + [pa.array([small.dtype.str])], names=["ids", "sizes", "places", "weights", "kind"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, places, rows x dimensions) of a block; rows that are shorter than others end in zeros."""
    b = pa.ipc.open_stream(data).read_all().to_pylist()[0]
    ids, n, places, w = np.frombuffer(b["ids"], "<i8"), np.frombuffer(b["sizes"], "<i4"), np.frombuffer(b["places"], "<i8"), np.frombuffer(b["weights"], b["kind"])
    out = np.zeros((len(ids), int(n.max(initial=0))), w.dtype)
    row = np.repeat(np.arange(len(ids)), n)
    out[row, np.arange(len(w)) - np.repeat(n.cumsum() - n, n)] = w
    return ids, places, out


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of ``vector_rows`` as blocks of ``size`` rows at most, in passing, with their queries beside them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def flushed() -> pa.RecordBatch:
            ids, sizes, weights, query = (np.concatenate(x) for x in zip(*held, strict=True))
            places, of = np.arange(len(ids)), np.repeat(np.arange(len(ids)), sizes)
            own = np.flatnonzero(query)
            mine = query[of]
            whole, some = _block_of(ids, sizes, weights, places), _block_of(ids[own], sizes[own], weights[mine], places[own])
            return pa.RecordBatch.from_arrays([pa.array([whole], pa.large_binary()), pa.array([some if len(own) else None], pa.large_binary()), pa.array([len(own)], pa.int64())], names=["whole", "some", "queries"])

        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, min(1024, size - n if size > n else 1024))
                step = part.num_rows
                at = start
                while step:
                    x = part.column(1)
                    sizes = np.diff(x.offsets.to_numpy())
                    held.append((part.column(0).to_numpy(), sizes, weights_of(x.flatten().to_numpy(zero_copy_only=False)), part.column(2).to_numpy(zero_copy_only=False)))
                    n += step
                    if n >= size:
                        yield flushed()
                        held.clear()
                        n = 0
                    at += step
                    part = batch.slice(at, min(start + 1024 - at, size - n))
                    step = part.num_rows
        if held:
            yield flushed()

    arrow_limits(rows.sparkSession)
    return rows.mapInArrow(pack, "whole binary, some binary, queries long")


def block_top(queries: list[np.ndarray], c_ids: np.ndarray, c: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate id, score) of each query's best k in one block; ties to smaller ids.

    ``own``: the row of the block that each query is, or -1.  Scores beyond 64 bits count as the nearest
    64-bit number.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    where = np.empty(len(order) + 1, np.int64)
    where[order], where[-1] = np.arange(len(order)), -1
    largest = int(np.abs(c.astype(object)).max()) if c.dtype == np.int64 and c.size else int(np.abs(c.astype(np.int64)).max(initial=0))
    steep = max((max(map(abs, (int(q.min()), int(q.max())))) for q in queries if len(q)), default=0)
    bound = steep * largest * max(c.shape[1], 1)
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object
    postings: list = []
    for t in range(c.shape[1]):
        place = np.flatnonzero(c[:, t])
        postings.append((None if len(place) == len(c) else place, c[place, t].astype(kind)))
    scores = np.zeros(len(c), kind)
    found: list[list[np.ndarray]] = [[], [], []]
    for j, row in enumerate(queries):
        scores[:] = 0
        for t in np.flatnonzero(row[: c.shape[1]]).tolist():
            place, weight = postings[t]
            if place is None:
                scores += weight * scores.dtype.type(row[t]) if kind is not object else weight * int(row[t])
            else:
                scores[place] += weight * (kind(row[t]) if kind is not object else int(row[t]))
        s = scores if kind is not object else np.array([max(_LEAST, min(_MOST, v)) for v in scores], np.int64)
        ids = c_ids
        if own is not None and own[j] >= 0:
            s, ids = np.delete(s, where[own[j]]), np.delete(ids, where[own[j]])
        n = min(k, len(s))
        if not n:
            continue
        least = np.partition(s, len(s) - n)[len(s) - n]
        above = np.flatnonzero(s > least)
        level = np.flatnonzero(s == least)[: n - len(above)]  # ids ascend: the smaller ones win ties
        best = np.concatenate([above, level])
        found[0].append(np.full(len(best), j))
        found[1].append(ids[best])
        found[2].append(s[best].astype(np.int64))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def merged(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of each query in several (query, candidate id, score) lists."""
    q, v, s = (np.concatenate(x) for x in zip(*lists, strict=True))
    by = np.lexsort((v, ~s, q))
    q, v, s = q[by], v[by], s[by]
    begin = np.searchsorted(q, q, side="left")
    ok = np.arange(len(q)) - begin < k
    return q[ok], v[ok], s[ok]


def top_k(rows: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``rows`` for each of its queries, but the query's own row.

    ``rows`` is as from ``vector_rows``.  Every row counts, also where ids repeat: rows that share an id
    are candidates each, and queries each.  Terms that one side lacks count as zero.  Ties go to the
    smaller vec_id.  Fewer than k candidates give fewer rows; without queries or rows the result is
    empty.
    """
    spark = rows.sparkSession
    stored = packed(blocks(rows, CANDIDATES), "topk-rows")
    base = qualified(spark, stored._files)
    names = written(stored.select("block", "path", "start", "size", "n_bytes"), "topk-names")
    n_blocks = names.count()
    # query pieces that make up about QUERIES queries together, by parts of the candidate blocks
    pieces = max(1, QUERIES * 20 // max(1, CANDIDATES))
    named = F.sort_array(F.collect_list(F.struct("block", "path", "start", "size")))
    hashed = F.xxhash64("block")
    mine = names.groupBy(F.pmod(hashed, F.lit(max(1, -(-n_blocks // pieces)))).alias("q")).agg(named.alias("mine"))
    parts = names.groupBy(F.pmod(hashed, F.lit(PARTS)).alias("part")).agg(named.alias("theirs"))
    cells = mine.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long")))).join(parts, "part")
    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n_blocks, 1 << 20))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(base)

        def read(b: dict, name: str) -> Iterator[tuple[int, bytes]]:
            """The blocks of vectors in a stored block (several, where they are small), numbered."""
            column = reader.read(b["path"], b["start"], b["size"]).column(name)
            return ((n, x.as_py()) for n, x in enumerate(column) if x.is_valid)

        for batch in batches:
            for own, others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, block_of, place_of, vectors = [], [], [], []
                for b in own:
                    for n, some in read(b, "c1"):
                        i, at, w = _opened(some)
                        ids.append(i)
                        block_of.append(np.full(len(i), b["block"]))
                        place_of.append(at + (n << 32))
                        vectors += list(w)
                if not ids:
                    continue
                i, block, place = (np.concatenate(x) for x in (ids, block_of, place_of))
                lists: list = []
                for b in others:
                    for n, whole in read(b, "c0"):
                        c_ids, _, c = _opened(whole)
                        mine = (block == b["block"]) & (place >> 32 == n)
                        lists.append(block_top(vectors, c_ids, c, k, np.where(mine, place & 0xFFFFFFFF, -1)))
                        if len(lists) == 8:
                            lists = [merged(lists, k)]
                q, v, s = merged(lists, k)
                out = (block[q], place[q], i[q], v, s)
                for x in range(0, len(q), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(y[x : x + 20_000].astype(np.int64)) for y in out], names=["block", "place", "query_id", "vec_id", "score"])
        reader.close()

    found = cells.repartition(n_tasks, "q", "part").select("mine", "theirs").mapInArrow(search, "block long, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

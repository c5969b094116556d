"""Byte-level BPE: overlapping chunks are pre-tokenised apart, stitched, encoded piece by piece.

A long text is cut into chunks that overlap.  Each chunk is split by the pattern on its own; near
its right end a match may be cut short, and at its left end it may begin inside one.  Two
neighbours are stitched at the first boundary in their overlap that both have: the pattern only
looks ahead, so from a common boundary on both see the same pieces.  Where an overlap holds no
common boundary, the left chunk's last sure boundary is carried on over the text until the right
chunk's boundaries are met, so the result never depends on the chunks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.common import arrow_limits, map_rows

#: Characters of a chunk and of what it shares with the next.
CHUNK, OVERLAP = 32_768, 512
#: A boundary this close to a chunk's right end may come from a match that the end cut short.
MARGIN = 16
#: Bytes up to which a piece is merged by scanning its ranks.
SHORT = 64
#: Pieces that a worker remembers the ids of.
REMEMBERED = 400_000


def boundaries(pattern: regex.Pattern, text: str, start: int = 0) -> np.ndarray:
    """Ends of the pieces that ``pattern`` splits ``text[start:]`` into."""
    return np.fromiter((m.end() for m in pattern.finditer(text, start)), np.int64)


def chunk_starts(size: int, chunk: int = CHUNK) -> range:
    return range(0, max(size, 1), chunk)


def stitch(pattern: regex.Pattern, text: str, parts: list[np.ndarray], chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """Boundaries of the whole text from those of its chunks, each relative to its chunk's start."""
    out: list[np.ndarray] = []
    at = 0  # a sure boundary of the whole text: all before it is in ``out``
    for i, part in enumerate(parts):
        begin = i * chunk
        end = min(len(text), begin + chunk + overlap)
        own = part + begin
        if i == 0:
            own_start = 0
        else:
            # carry the sure boundary on until it meets this chunk's boundaries
            known = set(own.tolist())
            extra = []
            while at not in known and at < len(text) and not (at == begin):
                m = pattern.match(text, at)
                if m is None:
                    raise ValueError("the pattern leaves text out")
                at = m.end()
                extra.append(at)
                if at > end - MARGIN and end < len(text):
                    break
            out.append(np.array(extra, np.int64))
            own_start = at
            if at > end - MARGIN and end < len(text):
                continue
        sure = own[own > own_start]
        if end < len(text):
            sure = sure[sure <= end - MARGIN]
            if i + 1 < len(parts):  # the next chunk takes over at the first boundary both have
                nxt = parts[i + 1] + (i + 1) * chunk
                common = sure[np.isin(sure, nxt)]
                if len(common):
                    sure = sure[sure <= common[0]]
        if len(sure):
            out.append(sure)
            at = int(sure[-1])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class Codec:
    """Encoder and decoder for one vocabulary of byte strings by rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.beyond = max(ranks.values(), default=0) + 1
        self.pattern = regex.compile(pattern)
        self.text_of = {v: str(v) for v in ranks.values()}
        self.seen: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: the adjacent pair of the least rank merges first, the leftmost of equals."""
        got = self.ranks.get(piece)
        if got is not None:
            return (got,)
        n = len(piece)
        if n <= SHORT:
            return self._merge_short(piece)
        nxt, prev, width = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        heap = []
        for i in range(n - 1):
            r = self.ranks.get(piece[i : i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        while heap:
            r, i, w = heapq.heappop(heap)
            if not width[i]:
                continue
            j = nxt[i]
            if j >= n or width[i] + width[j] != w:
                continue
            width[i], width[j] = w, 0
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for a in (prev[i], i):
                b = nxt[a] if a >= 0 else n
                if b < n:
                    w = width[a] + width[b]
                    r = self.ranks.get(piece[a : a + w])
                    if r is not None:
                        heapq.heappush(heap, (r, a, w))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : i + width[i]]])
            i = nxt[i]
        return tuple(out)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        """The same for a short piece: scanning a few ranks beats a heap."""
        get, last = self.ranks.get, self.beyond
        parts = [piece[i : i + 1] for i in range(len(piece))]
        near = [get(a + b, last) for a, b in zip(parts, parts[1:], strict=False)]
        while near:
            least = min(near)
            if least == last:
                break
            i = near.index(least)
            parts[i] += parts.pop(i + 1)
            del near[i]
            if i < len(near):
                near[i] = get(parts[i] + parts[i + 1], last)
            if i:
                near[i - 1] = get(parts[i - 1] + parts[i], last)
        return tuple([self.ranks[x] for x in parts])

    def encode_pieces(self, pieces: list[str]) -> list[int]:
        seen, out = self.seen, []
        for p in pieces:
            ids = seen.get(p)
            if ids is None:
                ids = self.merge(p.encode())
                if len(p) <= 64:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[p] = ids
            out += ids
        return out

    def encode(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        if len(text) <= chunk + overlap:
            return self.encode_pieces(self.pattern.findall(text))
        parts = [boundaries(self.pattern, text[a : a + chunk + overlap]) for a in chunk_starts(len(text), chunk)]
        return self.encode_cut(text, stitch(self.pattern, text, parts, chunk, overlap))

    def encode_cut(self, text: str, ends: np.ndarray) -> list[int]:
        stops = ends.tolist()
        return self.encode_pieces([text[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """(tokens, SHA-256 of the ids in decimal, SHA-256 of the decoded bytes)."""
        line = " ".join(map(self.text_of.__getitem__, ids))
        return len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


_CODECS: dict[tuple[int, str], Codec] = {}


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """The codec of a rank file's bytes; a worker builds it once."""
    key = (hash(vocabulary), pattern)
    if key not in _CODECS:
        lines = (x.split() for x in vocabulary.splitlines() if x)
        _CODECS[key] = Codec({base64.b64decode(a): int(b) for a, b in lines}, pattern)
    return _CODECS[key]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
    with_ids: bool = False,
) -> DataFrame:
    """Columns ``keep`` of every row with n_tokens, ids_sha256, decoded_sha256 (and ids, if asked for).

    ``path`` is a rank file as tiktoken reads it, on the driver; it has a fixed size and is sent to
    the executors once.  A text of one chunk is encoded where it is read.  The distinct longer texts
    are dealt out a chunk a row, split in parallel, and stitched and encoded text by text.  A null
    text counts as empty; repeated rows and null ids each come back; an empty table gives an empty
    result.  The results take the place of columns in ``keep`` that have their names.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    keep = ["doc_id"] if keep is None else keep
    with open(path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    given = docs.select(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)], F.coalesce(F.col(text), F.lit("")).alias("t"))
    n = len(keep)
    own = ", ".join(f"c{i} {given.schema[i].dataType.simpleString()}" for i in range(n))
    results = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in results.split(", ")]
    is_long = F.length("t") > chunk + overlap

    def columns(c: Codec, encoded: list[list[int]]) -> dict:
        rows = [c.digests(x) for x in encoded]
        out = dict(zip(names, zip(*rows, strict=True), strict=False)) if rows else {k: [] for k in names}
        return {k: list(v) for k, v in out.items()} | ({"ids": encoded} if with_ids else {})

    def short(batch: pa.RecordBatch) -> dict:
        c = codec(vocabulary.value, pattern)
        return {f"c{i}": batch.column(i) for i in range(n)} | columns(c, [c.encode(t, chunk, overlap) for t in batch.column(n).to_pylist()])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = codec(vocabulary.value, pattern)
            ends = [boundaries(c.pattern, t).astype("<i4").tobytes() for t in batch.column(2).to_pylist()]
            if ends:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], names=["h", "k", "part", "ends"])

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        c = codec(vocabulary.value, pattern)
        frame = frame.sort_values("k")
        parts = [np.frombuffer(x, "<i4").astype(np.int64) for x in frame["ends"]]
        whole = "".join(p[:chunk] for p in frame["part"].iloc[:-1]) + frame["part"].iloc[-1]
        ids = c.encode_cut(whole, stitch(c.pattern, whole, parts, chunk, overlap))
        return pd.DataFrame({"h": frame["h"].iloc[:1].to_numpy()} | columns(c, [ids]))

    direct = map_rows(given.where(~is_long), f"{own}, {results}", short)
    hashed = given.where(is_long).withColumn("h", F.sha2("t", 256))
    pieces = (
        hashed.groupBy("h").agg(F.first("t").alias("t"))
        .select("h", "t", F.explode(F.expr(f"sequence(0, cast((length(t) - 1) div {chunk} as int))")).alias("k"))
        .select("h", "k", F.expr(f"substring(t, k * {chunk} + 1, {chunk + overlap})").alias("part"))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(parts, "h", "k").mapInArrow(split, "h string, k int, part string, ends binary")
    long = dealt.groupBy("h").applyInPandas(join, f"h string, {results}")
    joined = hashed.drop("t").join(long, "h").select(*[f"c{i}" for i in range(n)], *names)
    out = direct.unionByName(joined)
    return out.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(keep) if k not in names], *names)

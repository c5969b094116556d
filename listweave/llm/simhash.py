"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming distance.

Candidates come from the generalised pigeonhole principle: the 64 bits are dealt into parts, each
part i gets a threshold t_i >= -1 with sum(t_i + 1) = distance + 1, and two fingerprints within the
distance must differ in at most t_i bits of some part i.  Correlated bits share a part, so that the
other parts stay selective; the thresholds come from dynamic programming over estimated numbers of
signatures and candidates, whose estimates rest on a bounded sample of fingerprints.  Every
candidate is verified, so the sample only moves the cost, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.blocks import described, packed, taken
from listweave.llm.common import map_rows, text_bytes, written
from listweave.llm.components import connected_components, forest

BITS = 64
#: Bytes a-z for A-Z; other bytes stay.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Fingerprints that the plan's estimates rest on.
PLAN_SAMPLE = 4000
#: A bucket with more signatures is dealt into chunks, and pairs of chunks are compared apart.
BUCKET_ROWS = 4096
#: Estimated seconds for shuffling a signature and for comparing a candidate pair.
SIGNATURE_COST, CANDIDATE_COST = 2e-6, 1e-8


def shingle_hashes(text: bytes, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of UTF-8 bytes, repeats included.

    Words are runs of bytes other than \\x20 and \\x09-\\x0D, lower-cased in A-Z.  Fewer words than a
    shingle: the whole sequence is the only shingle; no word: no shingle.
    """
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: len(words) - shingle]]).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))


def fingerprint_of(h: np.ndarray) -> int:
    """A bit is set where over half of the hashes have it; zero without any."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 4096):
        part = h[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of UTF-8 bytes from the hashes of their shingles."""
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; a null text counts as empty, so its fingerprint is zero."""

    def run(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(x) for x in text_bytes(batch, "t")], np.uint64).view(np.int64)
        return {"doc_id": batch.column(0), "fp": fps}

    return map_rows(docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")), "doc_id long, fp long", run)


@dataclass(frozen=True)
class Part:
    """Bits of one part and its threshold; -1: the part is not probed."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def flips(self) -> list[int]:
        """What a probe changes: every choice of up to ``threshold`` bits."""
        return [sum(1 << b for b in c) for k in range(self.threshold + 1) for c in combinations(self.bits, k)]


def group_bits(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Deal the bits into parts of nearly equal size; each part takes the bits most correlated to it."""
    x = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    x -= x.mean(0)
    norm = np.sqrt((x * x).sum(0))
    norm[norm == 0] = 1
    near = np.abs(x.T @ x) / np.outer(norm, norm)
    free, out = set(range(BITS)), []
    for p in range(parts):
        size = BITS // parts + (p < BITS % parts)
        rest = sorted(free)
        own = [max(rest, key=lambda b: (near[b, rest].sum(), -b))]
        free.discard(own[0])
        while len(own) < size:
            best = max(sorted(free), key=lambda b: (near[b, own].sum(), -b))
            own.append(best)
            free.discard(best)
        out.append(tuple(sorted(own)))
    return out


def plan(sample: np.ndarray, rows: int, distance: int) -> list[Part]:
    """Parts and thresholds of the least estimated cost for ``rows`` fingerprints.

    Pairs that share a part within t bits are counted on the sample; where the sample is too small
    to hold any, independent bits with the sample's frequencies stand in.
    """
    rows = max(rows, 1000)  # for a few rows every plan is cheap; keep the signatures few
    if len(sample) < 2:
        sample = np.arange(2, dtype=np.uint64)
    ones = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).mean(0)
    differ = 2 * ones * (1 - ones)
    few = sample[:1000]
    best, best_cost = None, np.inf
    for m in range(2, distance + 2):
        groups = group_bits(sample, m)
        costs = []
        for bits in groups:
            mask = np.uint64(sum(1 << b for b in bits))
            d = np.bitwise_count((few[:, None] ^ few[None, :]) & mask)[np.triu_indices(len(few), 1)]
            seen = np.bincount(d, minlength=BITS + 1).cumsum() / max(1, len(d))
            model = np.array([1.0])
            for b in bits:
                model = np.convolve(model, [1 - differ[b], differ[b]])
            model = model.cumsum()
            row = {-1: 0.0}
            for t in range(min(distance, len(bits) - 1) + 1):
                share = max(seen[t] if seen[t] * len(d) >= 10 else 0, model[t])
                probes = sum(comb(len(bits), k) for k in range(t + 1))
                row[t] = rows * probes * SIGNATURE_COST + rows * (rows - 1) / 2 * share * CANDIDATE_COST
            costs.append(row)
        # dynamic programming: state is sum(t_i + 1) so far
        table = {0: (0.0, ())}
        for row in costs:
            new: dict = {}
            for used, (cost, chosen) in table.items():
                for t, c in row.items():
                    key = used + t + 1
                    if key <= distance + 1 and (key not in new or cost + c < new[key][0]):
                        new[key] = (cost + c, (*chosen, t))
            table = new
        if distance + 1 in table and table[distance + 1][0] < best_cost:
            best_cost, chosen = table[distance + 1]
            best = [Part(g, t) for g, t in zip(groups, chosen, strict=True)]
    return best


def _links(distance: int):
    """Task-local edges from rows sorted by bucket: compare within a bucket, keep a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held: list[np.ndarray] = []
        left: list[np.ndarray] | None = None

        def compare(cols: list[np.ndarray]) -> None:
            part, key, ca, cb, own, probe, fp, rep = cols
            fp = fp.view(np.uint64)
            n = len(fp)
            new = np.ones(n, bool)
            new[1:] = (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (ca[1:] != ca[:-1]) | (cb[1:] != cb[:-1])
            stop = np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
            at, step = np.arange(n), 1
            found_a, found_b, count = [], [], 0
            while len(at):
                at = at[at + step < stop[at]]
                o = at + step
                ok = (probe[at] == 0) | (probe[o] == 0)
                ok &= (ca[at] == cb[at]) | (own[at] != own[o])
                x, y = at[ok], o[ok]
                near = np.bitwise_count(fp[x] ^ fp[y]) <= distance
                if near.any():
                    found_a.append(rep[x[near]])
                    found_b.append(rep[y[near]])
                    count += int(near.sum())
                    if count > 500_000:
                        u, v = forest(np.concatenate(found_a), np.concatenate(found_b))
                        found_a, found_b, count = [u], [v], 0
                step += 1
            if found_a:
                held.append(np.stack(forest(np.concatenate(found_a), np.concatenate(found_b))))

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            if left is not None:
                cols = [np.concatenate(x) for x in zip(left, cols, strict=True)]
            # the last bucket may go on in the next batch
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1]) & (cols[3] == cols[3][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                compare([c[:cut] for c in cols])
            left = [c[cut:] for c in cols]
        if left is not None:
            compare(left)
        if held:
            a, b = np.concatenate(held, axis=1)
            a, b = forest(a, b)
            for i in range(0, len(a), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 10_000]), pa.array(b[i : i + 10_000])], schema=schema)

    return run


def link_forest(distinct: DataFrame, distance: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``distinct(rep, fp)`` within ``distance``.

    Every pair within the distance meets in a bucket and is compared there; a task emits a spanning
    forest of its links, so no bucket is expanded into all its pairs.
    """
    rows = distinct.count()
    sample = distinct.orderBy(F.xxhash64(F.lit(7), "fp"), "fp").limit(PLAN_SAMPLE).select("fp").collect()
    parts = plan(np.array([r.fp for r in sample], np.int64).view(np.uint64), rows, distance)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    ways = [(i, signed(p.mask), signed(x)) for i, p in enumerate(parts) if p.threshold >= 0 for x in p.flips()]
    spec = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("long").alias("mask"), F.lit(x).cast("long").alias("flip")) for i, m, x in ways])
    sigs = distinct.select("rep", "fp", F.explode(spec).alias("w")).select(
        F.col("w.part").alias("part"),
        F.col("fp").bitwiseAND(F.col("w.mask")).bitwiseXOR(F.col("w.flip")).alias("key"),
        (F.col("w.flip") != 0).cast("int").alias("probe"),
        "fp",
        "rep",
    )
    hot = written(sigs.groupBy("part", "key").count().where(F.col("count") > bucket_rows), "simhash-hot")
    if hot.isEmpty():
        dealt = sigs.select("part", "key", F.lit(0).alias("ca"), F.lit(0).alias("cb"), F.lit(0).alias("own"), "probe", "fp", "rep")
    else:
        chunks = F.coalesce(F.ceil(F.col("count") / bucket_rows), F.lit(1)).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        dealt = (
            sigs.join(hot, ["part", "key"], "left")
            .withColumn("chunks", chunks)
            .withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("part", "key", F.least("own", "other").alias("ca"), F.greatest("own", "other").alias("cb"), "own", "probe", "fp", "rep")
        )
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(n, "part", "key", "ca", "cb").sortWithinPartitions("part", "key", "ca", "cb")
    return ordered.mapInArrow(_links(distance), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    component_id is the smallest doc_id reachable over fingerprints within ``distance``.  Rows with
    a null doc_id link nothing and have a null component_id; repeated rows each come back; a null or
    empty text has fingerprint zero and links like any other; an empty table gives an empty result.
    """
    return components(written(fingerprints(docs, doc_id, text), "simhash-fp"), distance)


def components(fps: DataFrame, distance: int) -> DataFrame:
    """``fps(doc_id, fp, ...)`` with component_id."""
    reps = written(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-rep")
    comp = connected_components(link_forest(reps, distance)).withColumnRenamed("node", "rep")
    named = reps.join(comp, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp", "left").select(
        *fps.columns, F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4) -> DataFrame:
    """The rows of ``docs`` without all but one row of each group: that of the smallest doc_id stays.

    Of repeated rows with one doc_id, one stays.  Rows with a null doc_id stay as they are.
    """
    columns = docs.columns
    blocks = packed(docs, "simhash-rows")

    def run(batch: pa.RecordBatch) -> dict:
        fps = np.array([fingerprint(x) for x in text_bytes(batch, text)], np.uint64).view(np.int64)
        return {"doc_id": batch.column(columns.index(doc_id)).cast(pa.int64()), "fp": fps}

    rows = written(described(blocks, columns, "doc_id long, fp long", run), "simhash-fp")
    grouped = components(rows, distance)
    first = grouped.where("doc_id = component_id").groupBy("doc_id").agg(F.min(F.struct("block", "row")).alias("at"))
    nameless = rows.where("doc_id is null").select("block", "row")
    choice = first.select("at.block", "at.row").unionByName(nameless).withColumn("times", F.lit(1))
    return taken(blocks, choice, docs.schema)

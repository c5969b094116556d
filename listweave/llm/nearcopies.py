"""Near copies by SimHash and exact Jaccard similarity: every pair of 0.8 or more is linked.

SimHash fingerprints of five-word shingles, linked by the generalised pigeonhole of ``simhash``, propose
pairs; each is verified on whole sets of shingles.  That finds most near copies for a fingerprint a
document.  What differs in more bits is found by a prefix filter: two sets of similarity 0.8 share an
element among the first n - ceil(0.8 n) + 1 of each, whatever the order of the elements.  The order goes
by how many documents have an element, counted exactly, so elements of one document come first and never
leave it: a document that has a fifth of its shingles to itself meets no other.  Equal sets collapse
before, and only sets of candidates travel.

Sharing an element proposes many pairs within a large group of which few are similar enough, so each set also has
a sketch, the parities of its elements in some classes: two sketches differ in no more bits than their sets
differ in elements.  The join on an element compares sketches and lets through only what may have the similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listweave.llm.blocks import asked_rows, described, packed, place, place_block, place_row, read_blocks, spread, taken, tasks, with_files
from listweave.llm.common import dropped, text_bytes, written
from listweave.llm.components import connected_components
from listweave.llm.packing import groups, pack_sorted, squeezed, unpack_sorted, unsqueezed
from listweave.llm.simhash import fingerprint_of, link_forest, shingle_hashes

#: Words of a shingle, and the similarity from which documents are near copies: 4 / 5.
SHINGLE, PART, WHOLE = 5, 4, 5
#: Bits in which fingerprints of proposed pairs differ, at most.
DISTANCE = 4
#: Turns, at most, in which what shares an element is compared with one head of it, before the rest is.
TURNS = 2
#: Longs of a sketch: parities of a set's elements in 64 times as many classes.
SKETCH = 16
#: Elements that a bucket counts, about; bits of an element's hash there beyond those of their number.
BUCKET_TOKENS, SPARE_BITS = 1_000_000, 6


def shingles(text: bytes, words: int = SHINGLE) -> np.ndarray:
    """Distinct XXH64 of the shingles, ascending; words as for fingerprints, a short text is one shingle."""
    return np.unique(shingle_hashes(text, words))


def prefix_size(n: int) -> int:
    """How many first elements of a set of ``n`` hold one of every set of the similarity."""
    return n - -(-PART * n // WHOLE) + 1 if n else 0


def prefix(tokens: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(elements, positions) of the prefix in the order of (level, element) that are of a level above 0."""
    order = np.lexsort((tokens, level))[: prefix_size(len(tokens))]
    at = np.flatnonzero(level[order] > 0)
    return tokens[order[at]], at


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the elements in each class of hashes: what two sets do not share changes a bit each, at most."""
    odd = np.bincount((tokens % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH).astype(np.uint8) & 1
    return np.packbits(odd).view("<i8")


def _levels(frame: pd.DataFrame) -> pd.DataFrame:
    """For each block's elements in this bucket, the logarithm of the number of documents that have them."""
    values = [unpack_sorted(x) for x in frame["tokens"]]
    times = np.concatenate([np.frombuffer(unsqueezed(x), "<u4") for x in frame["times"]])
    merged, index = np.unique(np.concatenate(values), return_inverse=True)
    level = np.log2(np.bincount(index, times, len(merged))).astype(np.uint8)[index]
    parts = np.split(level, np.cumsum([len(v) for v in values])[:-1])
    return pd.DataFrame({"block": frame.block, "bucket": frame.bucket, "levels": [squeezed(p.tobytes()) for p in parts]})


def _asked_sets(asked: dict, rows: pa.RecordBatch, column: int) -> tuple[list[dict], list[np.ndarray]]:
    wanted = asked["asked"].as_py()
    some = rows.take(pa.array([w["row"] for w in wanted], pa.int64()))
    return wanted, [shingles(x) for x in text_bytes(some, some.schema.names[column])]


def _dealt(sets: list[np.ndarray], bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct short hashes of a block's sets by (bucket, hash), their buckets, documents; index of each element."""
    short = np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - bits)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, index = np.unique(short, return_inverse=True)
    once = np.unique(index * (len(sets) + 1) + of) // (len(sets) + 1)  # two elements of a set may share a short hash
    times = np.bincount(once, minlength=len(value))
    bucket = (value % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((value, bucket))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return value[order], bucket[order], times[order], back[index]


def node_prefixes(blocks: DataFrame, nodes: DataFrame, column: int) -> DataFrame:
    """(node, n, bits, tokens, at), written: for each of ``nodes(node, n)`` the elements of its prefix that others have.

    ``at`` holds the elements' positions in the order of the set, ``bits`` is the sketch of the whole
    set; nodes without such elements are left out.  ``column`` is the text's in the blocks.
    """
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    bits = min(64, math.ceil(math.log2(total + 2)) + SPARE_BITS)
    least = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total // BUCKET_TOKENS))
    choice = nodes.select(place_block("node").alias("block"), place_row("node").alias("row"), "node")
    chosen = written(choice.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("row", "node"))).alias("asked")), "near-chosen")
    n_tasks = tasks(blocks)

    def send(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, sets = _asked_sets(asked, rows, column)
        value, bucket, times, _ = _dealt(sets, bits, buckets)
        block = asked["block"].as_py()
        sent = [(block, k, pack_sorted(value[x:y]), squeezed(times[x:y].astype("<u4").tobytes())) for k, x, y in groups(bucket)]
        if sent:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*sent, strict=True)], names=["block", "bucket", "tokens", "times"])

    asking = with_files(blocks, spread(blocks.join(chosen, "block"), n_tasks))
    sent = read_blocks(asking, "block long, bucket long, tokens binary, times binary", send)
    levels = written(sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_levels, "block long, bucket long, levels binary"), "near-levels")
    known = levels.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "levels"))).alias("known"))

    def first(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted, sets = _asked_sets(asked, rows, column)
        _, _, _, index = _dealt(sets, bits, buckets)
        level = np.frombuffer(b"".join(unsqueezed(k["levels"]) for k in asked["known"].as_py()), np.uint8)[index]
        out: list[list] = [[], [], [], [], []]
        for w, s, own in zip(wanted, sets, np.split(level, np.cumsum([len(s) for s in sets])[:-1]), strict=True):
            tokens, at = prefix(s, own)
            if len(tokens):
                for held, value in zip(out, (w["node"], len(s), sketch(s), tokens.view(np.int64), at.astype(np.int32)), strict=True):
                    held.append(value)
        if out[0]:
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["node", "n", "bits", "tokens", "at"])

    asking = with_files(blocks, spread(blocks.join(chosen, "block").join(known, "block"), n_tasks))
    out = written(read_blocks(asking, "node long, n int, bits array<long>, tokens array<long>, at array<int>", first), "near-prefixes")
    dropped(chosen, levels)
    return out


def _by_token(prefixes: DataFrame, *columns: str) -> DataFrame:
    """One row an element: the ``columns`` of its node, ``token`` and ``at``."""
    return prefixes.select(*columns, F.explode(F.arrays_zip("tokens", "at")).alias("x")).select(*columns, F.col("x.tokens").alias("token"), "x.at")


def shared_prefixes(blocks: DataFrame, nodes: DataFrame, column: int) -> DataFrame:
    """(node, n, token, at): elements of prefixes that more than one of ``nodes(node, n)`` has."""
    return _by_token(node_prefixes(blocks, nodes, column), "node", "n")


def _verified(pairs: DataFrame, blocks: DataFrame, column: int, name: str) -> DataFrame:
    """Those of the written ``pairs(a, b)`` whose whole sets have the similarity, written."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    choice = needed.select(place_block("node").alias("block"), place_row("node").alias("row"), "node")

    def run(asked: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted, sets = _asked_sets(asked, rows, column)
        arrays = [pa.array([w["node"] for w in wanted], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["node", "s"])

    sets = written(read_blocks(asked_rows(blocks, choice, "node"), "node long, s array<long>", run), "near-sets")
    joined = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    same, both = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
    links = written(joined.where(same * (PART + WHOLE) >= both * PART).select("a", "b"), name)
    dropped(sets)
    return links


def _may_match(x: str, y: str) -> F.Column:
    """False where sizes, what is left of the sets at their first common element, or sketches rule the similarity out."""
    apart = " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(SKETCH))
    return F.expr(
        f"{y}.n * {WHOLE} >= {x}.n * {PART} and {x}.n * {WHOLE} >= {y}.n * {PART} and least({x}.n - {x}.at, {y}.n - {y}.at) * {PART + WHOLE} >= ({x}.n + {y}.n) * {PART}"
        f" and ({apart}) * {PART + WHOLE} <= ({x}.n + {y}.n) * {WHOLE - PART}"
    )


def _apart(prefixes: DataFrame, links: DataFrame) -> DataFrame:
    """(token, x) of ``prefixes`` where the documents of a token are not all linked yet; written."""
    found = connected_components(links)
    named = prefixes.select("node", "n", "tokens", "at").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = _by_token(named, "node", "n", "component")
    tokens = each.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    left = each.join(tokens, "token").join(prefixes.select("node", "bits"), "node")
    return written(left.select("token", F.struct("node", "n", "at", "component", "bits").alias("x")), "near-apart")


def near_copy_links(blocks: DataFrame, nodes: DataFrame, column: int) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``nodes(node, n, fp)`` with the similarity.

    Nodes are places in ``blocks`` of different sets.  First what fingerprints propose; then, for what
    shares elements of prefixes and is not linked yet, each document with one head an element, in
    ``TURNS`` turns or until one finds nothing; then what is still apart.  A large group of near copies is so linked by stars, as
    many as it has elements, and not expanded into pairs.
    """
    prints = written(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "near-prints")
    equal = nodes.join(prints, "fp").where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    proposed = written(link_forest(prints, DISTANCE).unionByName(equal).distinct(), "near-proposed")
    links = _verified(proposed, blocks, column, "near-links-0")
    prefixes = node_prefixes(blocks, nodes.select("node", "n"), column)
    tested = None
    for turn in range(TURNS):
        left = _apart(prefixes, links)
        # first one head for most of a group's elements, then heads that differ from element to element
        key = F.xxhash64("x.node") if not turn else F.xxhash64(F.lit(turn), "token", "x.node")
        heads = left.groupBy("token").agg(F.min_by("x", key).alias("h"))
        stars = left.join(heads, "token").where("x.component <> h.component").where(_may_match("x", "h"))
        stars = stars.select(F.least("x.node", "h.node").alias("a"), F.greatest("x.node", "h.node").alias("b")).distinct()
        stars = written(stars if tested is None else stars.join(tested, ["a", "b"], "left_anti"), "near-stars")
        dropped(left)
        found = _verified(stars, blocks, column, "near-links-some")
        links = written(links.unionByName(found), "near-links-all")
        tested = stars if tested is None else tested.unionByName(stars)
        if found.isEmpty():
            break
    left = _apart(prefixes, links)
    pairs = left.join(left.withColumnRenamed("x", "y"), "token").where("x.node < y.node and x.component <> y.component").where(_may_match("x", "y"))
    pairs = written(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(tested, ["a", "b"], "left_anti"), "near-pairs")
    dropped(left, prefixes)
    return written(links.unionByName(_verified(pairs, blocks, column, "near-links-last")), "near-links")


def keep_one_copy(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one row of each group: that of the smallest doc_id stays.

    A group is what pairs with a Jaccard similarity of 0.8 or more over 5-word shingles connect; null
    texts and texts without words are equal.  Of repeated rows with one doc_id, one stays, also where
    their texts differ.  Rows with a null doc_id stay.  Whole texts count, however long; an empty table
    gives an empty result; all columns come back, whatever their names.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    at_id, at_text = docs.columns.index(doc_id), docs.columns.index(text)
    blocks = packed(docs, "near-rows")

    def run(batch: pa.RecordBatch) -> dict:
        hashes = [shingle_hashes(x, SHINGLE) for x in text_bytes(batch, columns[at_text])]
        sets = [np.unique(h) for h in hashes]
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
        return {
            "doc_id": batch.column(at_id).cast(pa.int64()), "d1": digests[:, 0], "d2": digests[:, 1],
            "n": [len(s) for s in sets], "fp": np.array([fingerprint_of(h) for h in hashes], np.uint64).view(np.int64),
        }

    rows = written(described(blocks, columns, "doc_id long, d1 long, d2 long, n int, fp long", run), "near-described")
    known = rows.where("doc_id is not null")
    first = known.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", place().alias("node"), "n", "fp")).alias("m"))
    nodes = written(first.select("d1", "d2", "m.*"), "near-nodes")
    links = near_copy_links(blocks, nodes.select("node", "n", "fp"), at_text)
    # different texts of one doc_id belong together
    lo, hi = F.min(F.struct("d1", "d2")), F.max(F.struct("d1", "d2"))
    many = written(known.groupBy("doc_id").agg(lo.alias("lo"), hi.alias("hi")).where("lo <> hi").select("doc_id", F.col("lo.d1").alias("l1"), F.col("lo.d2").alias("l2")), "near-many")
    if not many.isEmpty():
        own = known.join(many, "doc_id").join(nodes.select("d1", "d2", F.col("node").alias("a")), ["d1", "d2"])
        both = own.join(nodes.select(F.col("d1").alias("l1"), F.col("d2").alias("l2"), F.col("node").alias("b")), ["l1", "l2"])
        links = written(links.unionByName(both.where("a <> b").select("a", "b").distinct()), "near-links-ids")
    found = connected_components(links)
    grouped = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    stay = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("m")).select(F.col("m.node").alias("node"))
    choice = stay.select(place_block("node").alias("block"), place_row("node").alias("row"))
    nameless = rows.where("doc_id is null").select("block", "row")
    return taken(blocks, choice.unionByName(nameless).withColumn("times", F.lit(1)), docs.schema)

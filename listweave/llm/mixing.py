"""Mixing sources to target weights over a domain-language-source tree.

The budget flows down the tree.  At each node the children share what it got by weight, none beyond
its capacity (its tokens times the epochs allowed); what a child cannot take goes to its siblings by
their weights, and only what the whole node cannot take goes on to the node's own siblings.  A leaf
fills its budget with whole epochs and then a prefix of one more, in an order drawn from the seed and
the epoch's number.

All of it is DataFrame code.  The shares are exact integers: a child is full where
capacity * (weights left) <= (budget left) * weight, in ascending order of capacity to weight.  A
leaf's prefix is found over slices of the hash order, so that a leaf with a third of all rows is never
ordered by one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.llm.blocks import described, packed, taken
from listweave.llm.common import written

NUMBER = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """What to mix.  Weights are positive integers by level and value; others get ``default``."""

    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default: int = 1
    #: Budget as a fraction numerator/denominator of all tokens.
    share: tuple[int, int] = (1, 1)
    epochs: int = 1
    seed: int = 17
    #: Hex digits of the order's hash that name a slice, from coarse to fine slices.
    slice_digits: tuple[int, ...] = (2, 4)

    def weight(self, level: str) -> Column:
        known = self.weights.get(level, {})
        if not known:
            return F.lit(self.default).cast(NUMBER)
        pairs = [x for k, v in sorted(known.items()) for x in (F.lit(k), F.lit(v))]
        return F.coalesce(F.create_map(*pairs)[F.col(level)], F.lit(self.default)).cast(NUMBER)


def share_out(children: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """``children(parent..., weight, capacity, got)`` with ``budget``: what each child gets of ``got``.

    ``order`` makes ties definite.  Fractions are cut off, so a node may give out a few tokens less
    than it has.
    """
    line = Window.partitionBy(*parent).orderBy((F.col("capacity").cast("double") / F.col("weight").cast("double")), *order)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    zero = F.lit(0).cast(NUMBER)
    x = children.withColumn("_cap", F.coalesce(F.sum("capacity").over(before), zero).cast(NUMBER))
    x = x.withColumn("_rest", (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)).cast(NUMBER))
    full = (F.col("capacity") * F.col("_rest")).cast(NUMBER) <= ((F.col("got") - F.col("_cap")) * F.col("weight")).cast(NUMBER)
    x = x.withColumn("_full", full)
    taken = F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(whole), zero).cast(NUMBER)
    open_weight = F.coalesce(F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole), zero).cast(NUMBER)
    x = x.withColumn("_taken", taken).withColumn("_open", open_weight)
    part = F.expr("cast(floor(((got - _taken) * weight) div nullif(_open, 0)) as decimal(38,0))")
    return x.withColumn("budget", F.when(F.col("_full"), F.col("capacity")).otherwise(F.least("capacity", part))).drop("_cap", "_rest", "_full", "_taken", "_open")


def leaf_budgets(totals: DataFrame, mix: Mix) -> DataFrame:
    """``totals(levels..., tokens)`` of the leaves with ``budget``, by sharing out level by level."""
    levels = list(mix.levels)
    leaves = totals.withColumn("tokens", F.col("tokens").cast(NUMBER)).withColumn("capacity", (F.col("tokens") * mix.epochs).cast(NUMBER))
    top = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast(NUMBER).alias("n"))
    got = top.select(F.expr(f"cast(n * {mix.share[0]} div {mix.share[1]} as decimal(38,0))").alias("got"), F.lit(1).alias("_root"))
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        children = leaves.groupBy(*path).agg(F.sum("capacity").cast(NUMBER).alias("capacity"))
        children = children.withColumn("weight", mix.weight(path[-1])).withColumn("_root", F.lit(1))
        joined = children.join(F.broadcast(got) if depth == 1 else got, ["_root", *path[:-1]])
        shared = share_out(joined, ["_root", *path[:-1]], path[-1:])
        got = shared.select("_root", *path, F.col("budget").alias("got"))
    return leaves.join(got.drop("_root").withColumnRenamed("got", "budget"), levels).select(*levels, "tokens", "budget")


def mixture(docs: DataFrame, mix: Mix, key: str, tokens: str) -> DataFrame:
    """The rows of ``docs`` with ``_epochs``, how often each is taken (0: not at all).

    ``docs`` has the level columns without nulls, a ``key`` and an integer column ``tokens``.  Rows
    of one leaf are taken in the order of md5(seed:epoch:key), then key; equal keys of a leaf share
    one place, as if they were one row of their tokens.  Null keys are the text ``null``; null tokens
    count as 0.  An empty table gives an empty result.
    """
    levels = list(mix.levels)
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = docs.select(*levels, name.alias("_key"), F.coalesce(F.col(tokens), F.lit(0)).cast(NUMBER).alias("_n"))
    units = written(rows.groupBy(*levels, "_key").agg(F.sum("_n").cast(NUMBER).alias("_n")), "mix-units")
    totals = units.groupBy(*levels).agg(F.sum("_n").cast(NUMBER).alias("tokens"))
    budgets = written(leaf_budgets(totals, mix), "mix-budgets")
    planned = budgets.select(
        *levels,
        F.expr("cast(coalesce(budget div nullif(tokens, 0), 0) as long)").alias("_whole"),
        F.expr("cast(coalesce(budget % nullif(tokens, 0), 0) as decimal(38,0))").alias("_rest"),
    )
    order = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("_whole"), F.col("_key")).cast("binary"))
    drawn = units.join(planned, levels).withColumn("_order", order).withColumn("_slice", F.substring("_order", 1, mix.slice_digits[-1]))
    # tokens ahead of each slice: within its coarser slice, plus those ahead of that one
    sums, outer = None, 0
    fine = drawn.groupBy(*levels, "_slice").agg(F.sum("_n").cast(NUMBER).alias("_sum"))
    for digits in mix.slice_digits:
        here, up = F.substring("_slice", 1, digits), F.substring("_here", 1, outer)
        x = fine.groupBy(*levels, here.alias("_here")).agg(F.sum("_sum").cast(NUMBER).alias("_sum")).withColumn("_up", up)
        line = Window.partitionBy(*levels, "_up").orderBy("_here").rowsBetween(Window.unboundedPreceding, -1)
        x = x.withColumn("_own", F.coalesce(F.sum("_sum").over(line), F.lit(0)).cast(NUMBER))
        if sums is not None:
            x = x.join(sums.withColumnsRenamed({"_here": "_up", "_ahead": "_before"}), [*levels, "_up"])
        ahead = F.col("_own") if sums is None else F.col("_own") + F.col("_before")
        sums, outer = x.select(*levels, "_here", ahead.cast(NUMBER).alias("_ahead")), digits
    sums = sums.withColumnRenamed("_here", "_slice")
    upto = Window.partitionBy(*levels, "_slice").orderBy("_order", "_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = drawn.join(sums, [*levels, "_slice"]).withColumn("_upto", F.col("_ahead") + F.sum("_n").over(upto))
    taken = placed.select(*levels, "_key", (F.col("_whole") + F.when(F.col("_upto") <= F.col("_rest"), 1).otherwise(0)).alias("_epochs"))
    return docs.withColumn("_key", name).join(taken, [*levels, "_key"]).drop("_key")


#: Tokens are estimated from bytes.
BYTES_A_TOKEN = 4
#: Sources by domain for the corpus at hand; the rest, and null, are ``other``.
DOMAINS = {"web": range(0, 8), "books": range(8, 12), "news": range(12, 16)}
CORPUS_MIX = Mix(
    weights={
        "domain": {"web": 5, "books": 3, "news": 2, "other": 1},
        "lang": {"en": 6, "de": 2, "fr": 2, "es": 2},
    },
    share=(1, 1),
    epochs=4,
)


def corpus_leaves(docs: DataFrame, n_bytes: Column | None = None) -> DataFrame:
    """``docs`` with _domain, _lang, _source and _tokens; null lang or source are ``unknown``."""
    domain = F.lit("other")
    for name, sources in DOMAINS.items():
        domain = F.when(F.col("source").isin([f"src{i}" for i in sources]), name).otherwise(domain)
    unknown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    size = F.coalesce(F.octet_length("text") if n_bytes is None else n_bytes, F.lit(0))
    return docs.withColumns({
        "_domain": domain, "_lang": unknown("lang"), "_source": unknown("source"),
        "_tokens": F.floor((size + BYTES_A_TOKEN - 1) / BYTES_A_TOKEN).cast("long"),
    })


def mix_corpus(docs: DataFrame, mix: Mix = CORPUS_MIX) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epochs) of every row of documents."""
    leaves = corpus_leaves(docs.select("doc_id", "lang", "source", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"), F.col("_tokens").alias("tokens")
    )
    return mixture(leaves, mix, "doc_id", "tokens").select("doc_id", "domain", "lang", "source", "tokens", F.col("_epochs").cast("long").alias("epochs"))


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents that the mix takes, with their columns, each as often as it is taken.

    A null text is one of no tokens, a null lang or source counts as ``unknown``.  Rows of a leaf with
    one doc_id, or with none, share a place in its order and are taken together.  An empty table gives
    an empty result; further columns come back, whatever their names.
    """
    columns = docs.columns
    blocks = packed(docs, "mix-rows")

    def run(batch: pa.RecordBatch) -> dict:
        own = {c: batch.column(columns.index(c)) for c in ("doc_id", "lang", "source")}
        return own | {"n_bytes": pc.binary_length(batch.column(columns.index("text")))}

    small = described(blocks, columns, "doc_id long, lang string, source string, n_bytes long", run)
    rows = written(corpus_leaves(small, F.col("n_bytes")), "mix-described").withColumnsRenamed({"_domain": "domain", "_lang": "lang_", "_source": "source_"})
    rows = rows.select("block", "row", "doc_id", "domain", F.col("lang_").alias("lang"), F.col("source_").alias("source"), "_tokens")
    choice = mixture(rows, mix, "doc_id", "_tokens").where("_epochs > 0").select("block", "row", F.col("_epochs").alias("times"))
    return taken(blocks, choice, docs.schema)

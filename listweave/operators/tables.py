"""Table mutation as next snapshots: inserts, upserts, updates, deletes and versions over DataFrames.

Each function returns the next state of a table (and what changed, where asked for); writing it is
the store's business.  Keys compare null-safely where a key may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_new(target: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(next table, rows that were new): rows whose key exists are ignored, repeats count once."""
    new = rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True), new.select(*rows.columns)


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], merge: dict[str, str] | None = None) -> DataFrame:
    """Next table after rows replace or join those of their key.

    ``merge`` names, by column, how both values combine: ``new`` (default), ``keep`` (old unless
    null), ``coalesce`` (new unless null), ``least`` or ``greatest`` (nulls ignored).
    """
    merge = merge or {}
    old, new = target.alias("o"), rows.alias("n")
    joined = old.withColumn("_in_old", F.lit(True)).alias("o").join(new.withColumn("_in_new", F.lit(True)).alias("n"), keys, "full")
    columns: list[Column] = [F.col(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        o = F.col(f"o.{c}")
        if c not in rows.columns:
            columns.append(o.alias(c))
            continue
        n = F.col(f"n.{c}")
        how = merge.get(c, "new")
        both = {
            "new": F.when(F.col("n._in_new"), n).otherwise(o), "keep": F.coalesce(o, n), "coalesce": F.coalesce(n, o),
            "least": F.least(o, n), "greatest": F.greatest(o, n),
        }[how]
        columns.append(both.alias(c))
    return joined.select(*columns).select(*target.columns)


def upsert_changed(target: DataFrame, rows: DataFrame, keys: list[str], stamp: str, as_of: Column) -> DataFrame:
    """Upsert in which an equal row keeps its ``stamp`` and a changed or new one gets ``as_of``."""
    values = [c for c in rows.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"), F.col(stamp).alias("_stamp"))
    fresh = rows.join(old, keys, "left")
    same = F.struct(*values).eqNullSafe(F.col("_old"))
    fresh = fresh.select(*rows.columns, F.when(same, F.col("_stamp")).otherwise(as_of).alias(stamp))
    rest = target.join(rows.select(*keys), keys, "left_anti")
    return rest.unionByName(fresh, allowMissingColumns=True)


def upsert_where(target: DataFrame, rows: DataFrame, keys: list[str], where: Column) -> DataFrame:
    """Upsert in which a row that is there changes only under ``where``, over its columns and the new
    ones (prefix ``new_``); a condition that is null holds no change.  One full join."""
    values = [c for c in rows.columns if c not in keys]
    renamed = rows.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"new_{c}") for c in values])
    joined = target.withColumn("_there", F.lit(True)).join(renamed, keys, "full")
    hit = F.coalesce(F.col("_hit") & (F.col("_there").isNull() | where), F.lit(False))
    return joined.select(*[F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns])


def update_from(target: DataFrame, rows: DataFrame, keys: list[str], columns: list[str], where: Column | None = None) -> DataFrame:
    """Columns of matching rows replaced by those of ``rows`` (prefix ``new_`` in ``where``)."""
    renamed = rows.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"new_{c}") for c in columns])
    joined = target.join(renamed, keys, "left")
    hit = F.coalesce(F.col("_hit") & (where if where is not None else F.lit(True)), F.lit(False))
    return joined.select(*[F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def delete_missing(target: DataFrame, keep: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a key in ``keep``, rows without)."""
    named = keep.select(*keys).distinct()
    return target.join(named, keys, "left_semi"), target.join(named, keys, "left_anti")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; the planner limits groups before the shuffle.

    Where ``order`` ties, the smallest of the other columns decides, so that the row does not hang on
    the partitioning; rows that tie in all of them are equal.  Maps, which have no order, take no part.
    """
    rest = [F.col(f.name) for f in rows.schema if f.name not in keys and "map<" not in f.dataType.simpleString()]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "sample_rank") -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(rank, place).where(F.col(rank) <= n)


def with_current_flag(versions: DataFrame, entity: str, order: list[Column], flag: str = "is_current") -> DataFrame:
    """Versions with the flag on the newest one of each entity only."""
    place = F.row_number().over(Window.partitionBy(entity).orderBy(*order))
    return versions.withColumn(flag, place == 1)


def equal_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of the tables has, with the side; repeats count."""
    common = a.columns
    return a.select(*common).exceptAll(b.select(*common)).withColumn("side", F.lit("left")).unionByName(
        b.select(*common).exceptAll(a.select(*common)).withColumn("side", F.lit("right"))
    )


def or_join(a: DataFrame, b: DataFrame, pairs: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join on any of several equalities as a union of equi-joins; a pair comes back once.

    A disjunction as a join condition would be planned as a nested loop.
    """
    if how != "inner":
        raise ValueError("only inner joins")
    left = a.select(F.struct("*").alias("a"))
    right = b.select(F.struct("*").alias("b"))
    parts = [left.join(right, F.col(f"a.{x}") == F.col(f"b.{y}")) for x, y in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()

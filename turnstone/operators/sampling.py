"""Top-k lists, seeded samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.operators.scan import values_at_ranks


def fill_to(df: DataFrame, must: Column, order: Sequence[str], k: int) -> DataFrame:
    """All rows that must be in, then the lowest others up to ``k`` rows in total.

    The lowest ``k`` others are a distributed top-k; how many of them are still
    needed is a scalar, so nothing but those ``k`` rows is ever ranked.
    """
    included = df.where(must)
    need = F.lit(k) - included.agg(F.count("*")).scalar()
    others = df.where(~F.coalesce(must, F.lit(False))).orderBy(*order).limit(k)
    packed = others.agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order]))).alias("r"))
    kept = packed.select(F.explode(F.slice("r", F.lit(1), F.greatest(need, F.lit(0)).cast("int"))).alias("x"))
    return included.unionByName(kept.select(*[F.col(f"x.{c}").alias(c) for c in df.columns]))


def relabel_closest(df: DataFrame, where: Column, order: Sequence[str], k: int, keys: Sequence[str]) -> DataFrame:
    """Mark the first ``k`` rows of a filter in a total order as ``chosen``."""
    chosen = df.where(where).orderBy(*order).limit(k).select(*keys, F.lit(True).alias("chosen"))
    return df.join(chosen, list(keys), "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def keyed_random(keys: Sequence[str], seed: int) -> Column:
    """A uniform number in [0, 1) that depends on the key and seed only.

    Unlike a per-partition generator it gives the same value after a retry or
    under another partitioning.  The first eight hex digits of an MD5 make it the same in any engine.
    """
    text = F.concat_ws(",", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("double") / F.lit(float(1 << 32))


def shuffled_head(df: DataFrame, keys: Sequence[str], seed: int, n: int) -> DataFrame:
    """``n`` rows in seeded random order: a distributed top-k."""
    return df.withColumn("_u", keyed_random(keys, seed)).orderBy("_u", *keys).limit(n).drop("_u")


def keyed_split(df: DataFrame, keys: Sequence[str], share: float, seed: int) -> DataFrame:
    """Every row marked ``train`` or ``test``; rows of one key stay together."""
    return df.withColumn("part", F.when(keyed_random(keys, seed) < share, "train").otherwise("test"))


def ordered_split(df: DataFrame, order: str, share: float, bucket) -> DataFrame:
    """Unshuffled split: the first ``share`` of rows in order are the training rows.

    The cut is the exact value at that rank, so no row is numbered globally.
    """
    last = values_at_ranks(df, [], order, {"cut": lambda n: F.floor(F.lit(share) * n + 1e-9) - 1}, bucket)
    return df.withColumn("is_train", F.coalesce(F.col(order) <= last.select("cut").scalar(), F.lit(False)))

"""Sampling and splitting (A1, A2)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 10000


def bootstrap_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """A1: resample with replacement (Poisson counts per row, expected size ``fraction * n``).

    Runs inside each partition with no shuffle. Give a seed for a repeatable draw; the draw
    is repeatable only while the input partitions are the same.
    """
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def poisson_count(key: str | Column, fraction: float, prefix: str) -> Column:
    """How often a bootstrap draw of ``fraction`` of the rows takes a row: a Poisson(``fraction``) number
    that follows from 48 bits of ``md5(prefix + key)``.

    The Poisson distribution function is used to eight digits.
    """
    k = F.col(key) if isinstance(key, str) else key
    head = F.conv(F.substring(F.md5(F.concat(F.lit(prefix), F.coalesce(k.cast("string"), F.lit("")))), 1, 12), 16, 10)
    u = head.cast("bigint") / F.lit(float(1 << 48))
    steps, term, total = [], math.exp(-fraction), 0.0
    while total < 1 - 1e-6:
        total += term
        steps.append(round(total, 8))
        term *= fraction / len(steps)
    # a lambda variable, so that the hash is taken once and not once a step
    return F.get(F.transform(F.array(u), lambda x: sum((F.when(x >= s, 1).otherwise(0) for s in steps[1:]), F.when(x >= steps[0], 1).otherwise(0))), F.lit(0))


def replicate_weights(df: DataFrame, key: str | Column, replicate: int, fraction: float, seed: int = 0, name: str = "weight") -> DataFrame:
    """A1 as weights: the rows that replicate number ``replicate`` draws, each once, with the number of its
    draws in ``name``. No row is copied; the same rows and numbers come again from any retry, partitioning
    or later read, so what was fitted and what is reported are the same draw."""
    count = poisson_count(key, fraction, f"{seed}:{replicate}:").cast("double")
    return df.withColumn(name, count).where(F.col(name) > 0)


def keyed_bootstrap(df: DataFrame, key: str | Column, fraction: float, seed: int = 0, name: str = "draw") -> DataFrame:
    """A1, keyed: Poisson(``fraction``) copies of each row, numbered in ``name``; the count follows from
    48 bits of ``md5(seed:key)``, so a retried task, a re-read and any partitioning draw the same rows.

    The Poisson distribution function is used to eight digits; rows of equal key are drawn alike.
    """
    times = poisson_count(key, fraction, f"{seed}:")
    none = F.array().cast("array<bigint>")
    copies = F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times.cast("bigint") - 1)).otherwise(none)
    return df.select("*", F.explode(copies).alias(name))


def split_bucket(key: str | Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """A bucket in ``[0, buckets)`` from the first 32 bits of ``md5(key as string)``.

    Depends only on the key value, so every re-read and every partitioning agrees.
    """
    k = F.col(key) if isinstance(key, str) else key
    head = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def in_train(key: str | Column, train_fraction: float = 0.7, buckets: int = DEFAULT_BUCKETS) -> Column:
    return split_bucket(key, buckets) < F.lit(int(round(train_fraction * buckets)))


def with_split(
    df: DataFrame, key: str, train_fraction: float = 0.7, name: str = "split", buckets: int = DEFAULT_BUCKETS
) -> DataFrame:
    """Label every row ``train`` / ``test`` in one narrow pass."""
    return df.withColumn(
        name, F.when(in_train(key, train_fraction, buckets), F.lit("train")).otherwise(F.lit("test"))
    )


def keyed_split(
    df: DataFrame, key: str, train_fraction: float = 0.7, buckets: int = DEFAULT_BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """A2, keyed: disjoint (train, test) by a hash bucket of ``key``; repeated keys stay together."""
    cond = in_train(key, train_fraction, buckets)
    return df.filter(cond), df.filter(~cond)


def random_split(df: DataFrame, train_fraction: float = 0.7, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A2, random: one seeded ``randomSplit`` (both parts come from the same split)."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test

"""Profiles, time splits and samples."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadcast.session import cut_lineage


def profile(df: DataFrame, key: str = "link_id", ts: str = "snapshot_ts") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
        F.countDistinct(key).alias("n_keys"),
    )


def _kept(df: DataFrame, ts: str) -> tuple[DataFrame, int | None, int | None]:
    """``df`` as a written table, and the least and greatest ``ts``, noted while writing: rows are computed once for bounds and sides."""
    seen = Observation()
    kept = cut_lineage(df.observe(seen, F.min(ts).alias("low"), F.max(ts).alias("high")))
    bounds = seen.get
    return kept, bounds["low"], bounds["high"]


def file_bounds(spark: SparkSession, path: str, ts: str = "snapshot_ts") -> DataFrame:
    """One row (n, min_ts, max_ts) of stored files, from the statistics in their footers: no row group is read."""
    with _set(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        found = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
        found._jdf.queryExecution().executedPlan()  # planned while the settings hold
        return found


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def split_at(df: DataFrame, split_ts: int | None, ts: str = "snapshot_ts") -> tuple[DataFrame, DataFrame]:
    at = F.lit(split_ts).cast("bigint")
    return df.filter(F.col(ts) < at), df.filter(F.col(ts) >= at)


def _last(low: int | None, high: int | None, seconds: int) -> int | None:
    return None if high is None else high - seconds


def _fraction(low: int | None, high: int | None, frac: float) -> int | None:
    return None if low is None else low + int(frac * (high - low))


def _bounds(df: DataFrame, ts: str) -> tuple[int | None, int | None]:
    return tuple(df.agg(F.min(ts), F.max(ts)).first())


def last_split_ts(df: DataFrame, seconds: int = 2 * 86400, ts: str = "snapshot_ts") -> int | None:
    return _last(*_bounds(df, ts), seconds)


def fraction_split_ts(df: DataFrame, frac: float = 0.8, ts: str = "snapshot_ts") -> int | None:
    return _fraction(*_bounds(df, ts), frac)


def split_last(df: DataFrame, seconds: int = 2 * 86400, ts: str = "snapshot_ts") -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ``seconds`` are the test side."""
    kept, low, high = _kept(df, ts)
    return split_at(kept, _last(low, high, seconds), ts)


def split_fraction(df: DataFrame, frac: float = 0.8, ts: str = "snapshot_ts") -> tuple[DataFrame, DataFrame]:
    """(train, test) at ``frac`` of the time span."""
    kept, low, high = _kept(df, ts)
    return split_at(kept, _fraction(low, high, frac), ts)


def _with_side(df: DataFrame, at: int | None, ts: str) -> DataFrame:
    """``side``, for both sides in one read.  A row without a time is on neither side."""
    before = F.col(ts) < F.lit(at).cast("bigint")
    return df.filter(F.col(ts).isNotNull()).withColumn("side", F.when(before, "train").otherwise("test"))


def with_side_last(df: DataFrame, seconds: int = 2 * 86400, ts: str = "snapshot_ts") -> DataFrame:
    kept, low, high = _kept(df, ts)
    return _with_side(kept, _last(low, high, seconds), ts)


def with_side_fraction(df: DataFrame, frac: float = 0.8, ts: str = "snapshot_ts") -> DataFrame:
    kept, low, high = _kept(df, ts)
    return _with_side(kept, _fraction(low, high, frac), ts)


def sample_slot(link: str = "link_id", ts: str = "snapshot_ts") -> Column:
    """Repeatable slot 0..99 of a row: (link * 2654435761 + ts) mod 100, taken in parts that cannot overflow."""
    return F.pmod(F.pmod(F.col(link), F.lit(100)) * 61 + F.pmod(F.col(ts), F.lit(100)), F.lit(100))


def hash_sample(df: DataFrame, pct: int = 10, link: str = "link_id", ts: str = "snapshot_ts") -> DataFrame:
    return df.filter(sample_slot(link, ts) < pct)


def keep_or_sample(df: DataFrame, flag: str, pct: int = 10, link: str = "link_id", ts: str = "snapshot_ts") -> DataFrame:
    """All rows with ``flag`` = 1 and a sample of the others."""
    return df.filter((F.col(flag) == 1) | (sample_slot(link, ts) < pct))


def head_by(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def hash_pick(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """A repeatable look at ``n`` rows, spread over the keys."""
    return df.orderBy(F.pmod(F.col(key) * 7919, F.lit(1009)), key).limit(n)

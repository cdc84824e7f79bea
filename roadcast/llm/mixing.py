"""Mixing sources to target weights: repetition rates per source, whole copies plus one seeded coin per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps, positions

WORD_RUN = r"[^\x20\x09-\x0D]+"
MAX_BROADCAST_SOURCES = 100_000


def text_size(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: float, steps: Steps) -> DataFrame:
    """Target per source from (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn and share the total.  A target above ``max_repeat`` times
    its source's size stops there and the excess goes to the others by weight, again until none is above.  Each pass is
    one small aggregate; the driver sees three sums.
    """
    ordered = positions(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], steps)
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.pmod(F.col("_pos"), F.lit(len(weights))).cast("int")]
    cap = F.lit(float(max_repeat)) * F.col("source_size")
    rows = steps.write(ordered.select("source", "source_size", weight.alias("_w"), cap.alias("_cap")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, n_capped = 0.0, -1
    while True:
        full = F.col("_w") * level >= F.col("_cap")
        spent, share, n = rows.agg(
            F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_w"))), F.count_if(full)
        ).first()
        if n == n_capped or not share:
            break
        n_capped, level = n, (total - (spent or 0.0)) / share
    target = F.least(F.col("_w") * level, F.col("_cap")) if n_capped >= 0 else F.col("_cap")
    return steps.write(rows.select("source", "source_size", target.alias("target")))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: float = 3, seed: str = "mix-1",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Sequence[str] = (),
) -> DataFrame:
    """How often each document enters the mix: doc_id, size, source_size, target, copies, taken and ``carry`` columns.

    A source's rate is its target by its size.  Each document is taken floor(rate) times, and once more if a coin with the
    rate's fraction says so; the coin is a digest of seed and id, so reruns agree.  Repeated ids toss the same coin.
    Null texts have size 0; a null source is a source of its own and comes last; a source without words has target 0; a
    null id tosses the coin of the empty text.  An empty table gives no rows.  Source rows are broadcast up to
    MAX_BROADCAST_SOURCES; beyond that the join is a shuffle whose hot sources AQE splits.
    """
    steps = Steps(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("doc_id"), text_size(F.col(text_col)).alias("size"), F.col(source_col).alias("_source"), *[F.col(c).alias(f"_c{n}") for n, c in enumerate(carry)])
    if not carry:  # the sizes are needed twice and cost a pass over all texts
        slim = steps.write(slim)
    sizes = slim.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat, steps)
    side = F.broadcast(targets) if targets.count() <= MAX_BROADCAST_SOURCES else targets
    joined = slim.join(side, F.col("_source").eqNullSafe(F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    coin = F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    copies = F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)
    return joined.select(
        "doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
        *[F.col(f"_c{n}") for n in range(len(carry))],
    )


def emit_mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents themselves: every column of ``docs``, each row as often as :func:`mix` takes it."""
    carry = docs.columns
    mixed = mix(docs, carry=carry, **settings)
    copies = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(*[F.col(f"_c{n}").alias(c) for n, c in enumerate(carry)])

"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import text_of
from sluice.session import stage

#: production parameters: shares follow the source sizes to this power; seed of counts and order
POWER, SEED = 0.5, 20
#: a mean above this is drawn as a sum of smaller ones, as exp() of a large one vanishes
STEP = 16
UNIT = float(1 << 52)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a digest."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(UNIT)


def poisson_table(mean: Column) -> Column:
    """Cumulative probabilities of a Poisson number of a mean up to STEP, beyond any 52-bit uniform."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(96)),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(
                acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * mean / k)
            ).alias("c"),
        ),
        lambda acc: acc["c"],
    )


def rates(docs: DataFrame, weights: DataFrame | None = None, source: str = "source") -> DataFrame:
    """(src, rate): how often a document of each source is repeated on average.

    The size of a source is the characters of its texts, summed over all rows.
    ``weights`` (src, weight) are the target shares of the result, in any unit;
    without them they are the sizes to the power POWER.  The result is as
    large as the input on average.  Sources without a weight get rate 0;
    sources without characters are repeated once.
    """
    sizes = docs.select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.length(text_of()).cast("long").alias("size"),
    ).groupBy("src").agg(F.sum("size").alias("size"))
    sizes = stage(sizes, "sizes")
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(POWER)))
    else:
        weighted = sizes.join(weights.select("src", "weight"), "src", "left").na.fill(0.0, ["weight"])
    total = weighted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    scale = (total["size"] or 0) / total["weight"] if total["weight"] else 0.0
    rate = F.when(F.col("size") > 0, F.col("weight") * F.lit(scale) / F.col("size")).otherwise(1.0)
    return weighted.select("src", rate.alias("rate"))


def replicated(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", seed: int = SEED) -> DataFrame:
    """Every row as often as its hash-seeded Poisson count says, with ``_m_copy`` and ``_m_order``.

    The count depends on the seed, doc_id and source only: rows of one id get
    the same one, whatever the partitions.  A null id or source counts as
    empty.  The numbers in ``_m_order`` deal the copies out evenly.
    """
    by_source = rates(docs, weights, source)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP).cast("int"))
    drawn = by_source.withColumn("draws", draws)
    drawn = drawn.select(
        F.col("src").alias("_m_src"),
        F.col("draws").alias("_m_draws"),
        poisson_table(F.col("rate") / F.col("draws")).alias("_m_table"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    src = F.coalesce(F.col(source).cast("string"), F.lit(""))
    drawn_at = F.transform(
        F.sequence(F.lit(1), F.col("_m_draws")),
        lambda d: uniform(F.lit(str(seed)), F.col("_m_key"), d.cast("string")),
    )
    count = F.aggregate(
        drawn_at,
        F.lit(0),
        lambda acc, u: acc + F.size(F.filter(F.col("_m_table"), lambda c: c <= u)),
    )
    joined = docs.withColumn("_m_key", F.concat_ws("|", src, key)).withColumn("_m_from", src)
    joined = joined.join(stage(drawn, "drawn"), F.col("_m_from") == F.col("_m_src"))
    copies = joined.withColumn("_m_count", count).where("_m_count > 0")
    copies = copies.withColumn("_m_copy", F.explode(F.sequence(F.lit(1), F.col("_m_count"))))
    order = F.xxhash64(F.lit(seed), F.col("_m_key"), F.col("_m_copy"))
    return copies.withColumn("_m_order", order).select(*docs.columns, "_m_copy", "_m_order")


def mix(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", seed: int = SEED) -> DataFrame:
    """The replicated rows, dealt out and sorted by the hash of their copies: a global shuffle."""
    copies = replicated(docs, weights, source, seed)
    # the random number parts copies of rows that share an id
    dealt = copies.repartitionByRange("_m_order", F.rand(seed))
    return dealt.sortWithinPartitions("_m_order", "_m_copy")

"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, unit

#: The largest mean drawn at once; beyond it independent draws of equal mean are added.
MOST_MEAN = 64.0


def source_rates(docs: DataFrame, source: str, text: str, weights: dict[str | None, float] | None) -> DataFrame:
    """Mean copies per source: its target share of all characters over its characters.

    A source without a weight has weight 1. A source without characters cannot be
    weighed by them and has mean 1. Totals cover all rows.
    """
    chars = docs.groupBy(F.col(source).alias("_mix_source")).agg(
        F.sum(F.coalesce(F.length(F.col(text)), F.lit(0))).cast("double").alias("_mix_chars"))
    share = F.lit(1.0)
    for name, value in (weights or {}).items():
        share = F.when(F.col("_mix_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(share)
    totals = chars.agg(F.sum("_mix_chars").alias("all"), F.sum(share).alias("shares"))
    every, shares = totals.first()
    rate = F.when(F.col("_mix_chars") > 0, share / F.lit(shares or 1.0) * F.lit(every or 0.0)
                  / F.col("_mix_chars")).otherwise(F.lit(1.0))
    rates = chars.select("_mix_source", rate.alias("_mix_rate"))
    rates = rates.withColumn("_mix_draws", F.greatest(F.lit(1), F.ceil(F.col("_mix_rate") / MOST_MEAN)).cast("int"))
    return rates.select("_mix_source", "_mix_rate", "_mix_draws", _cdf(F.col("_mix_rate") / F.col("_mix_draws")).alias("_mix_cdf"))


def _cdf(mean: Column) -> Column:
    """The distribution function at 0, 1, 2 ... until nothing below 2**-53 is left."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")

    def step(held: Column, k: Column) -> Column:
        p = held["p"] * mean / k
        total = held["total"] + p
        return F.struct(p.alias("p"), total.alias("total"), F.array_append(held["cdf"], total).alias("cdf"))

    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("total"), F.array(F.exp(-mean)).alias("cdf"))
    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda x: x["cdf"])).otherwise(
        F.array(F.lit(1.0)))


def mix_sources(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
                weights: dict[str | None, float] | None = None, seed: str = "mix-1",
                marks: bool = True) -> DataFrame:
    """The rows, each repeated by its draw, in a global order that the seed decides.

    The number of copies is the Poisson distribution of the source's rate, inverted at a
    number in (0, 1) that seed and key decide. Rows with the same key have the same draw;
    a null key counts as the word "null", a null source is a source. ``marks``
    adds mix_copy (from 1), mix_copies and mix_order in place of
    columns of that name; all others stay as they are.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))

    def draw(i: Column) -> Column:
        return let(unit(F.lit(seed), F.lit("copies"), i.cast("string"), name),
                   lambda u: F.size(F.filter(F.col("_mix_cdf"), lambda c: c <= u)))

    rates = source_rates(docs, source, text, weights)
    drawn = docs.join(rates, F.col(source).eqNullSafe(F.col("_mix_source"))).withColumn(
        "_mix_copies", F.aggregate(F.sequence(F.lit(1), F.col("_mix_draws")), F.lit(0), lambda a, i: a + draw(i)))
    copies = drawn.where(F.col("_mix_copies") > 0).withColumn(
        "_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    order = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), name,
                                                 F.col("_mix_copy").cast("string"))), 1, 15), 16, 10).cast("long")
    copies = copies.withColumn("_mix_order", order).orderBy("_mix_order", F.col(key), "_mix_copy")
    added = [F.col("_mix_copy").alias("mix_copy"), F.col("_mix_copies").alias("mix_copies"),
             F.col("_mix_order").alias("mix_order")] if marks else []
    names = ("mix_copy", "mix_copies", "mix_order") if marks else ()
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], *added)

"""Mixing sources to target weights by repeating documents.

Words are added up per source. Targets share out all words by weight, but no source gets more than
``MOST`` times its words; the excess is shared again by weight. The rate of a source is its target
over its words. Each document is taken floor(rate) times, plus once more by a Bernoulli draw whose
probability is the fraction of the rate.

Draws that do not know of each other leave a source's words off its target by as much as a third
where a few long documents hold most of them (figures in the README). So the draws of a source are
made to balance: its documents are sorted by size, and then by a hash, and the uniform number of a
draw is a start seeded by a hash of the source plus the place of the document times the
probability, modulo 1. Each draw has the same probability as before, the draws along any stretch of
sizes hold as many copies as they should but for one, and a source's words are off by the words of
its largest document at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.common import numbered, small
from yearpanel.sources.scratch import materialise

#: No source gives more than this many times its words.
MOST = 3
#: Weights of sources in order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def _uniform(text: Column) -> Column:
    """A number from 0 to 1 that depends on a text alone: 52 bits of its digest."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def sized(docs: DataFrame, carried: Sequence[Column] = ()) -> DataFrame:
    """doc_id, source, size (words), digest of every row. A null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.col("doc_id").cast("long")
    own = F.concat_ws(":", F.lit(SEED), F.coalesce(number.cast("string"), F.lit("")), text)
    return docs.select(
        number.alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(own).alias("digest"),
        *carried,
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target of every source of ``sized`` rows, null included.

    Sources are in order of code points, null last. Each turn fixes the sources that their share
    would lift above ``most`` times their words, and shares the rest out among the others; three
    numbers a turn reach the driver. A source without words has the target 0.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = numbered(sums, [F.col("source").asc_nulls_last()], "mix-sources")
    weight = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights)).cast("int") + 1)
    sources = materialise(
        placed.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights"
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * most
    left, weight_left, fixed, share = total, None, F.lit(False), F.lit(0.0)
    while True:
        found = sources.agg(
            F.coalesce(F.sum(F.when(fixed, cap)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~fixed, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if (left, weight_left) == (total - found.taken, found.weight) or not found.weight:
            break
        left, weight_left = total - found.taken, found.weight
        # Fixed sources stay above: shares only grow from turn to turn.
        share = (F.lit(left) * F.col("weight")).cast("double") / F.lit(float(weight_left))
        fixed = share > cap
    return sources.select(
        "source", "source_size", F.when(fixed, cap.cast("double")).otherwise(share).alias("target")
    )


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    carried: Sequence[Column] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per row of ``docs``.

    ``copies`` says how often the mix holds a document and ``taken`` how many words that is. Rows
    that repeat whole are separate documents. A null doc_id stays null, a null source is a source
    of its own. Documents without words are copied like others and give nothing. Other columns are
    dropped but for those ``carried``. An empty table gives no row.
    """
    rows = materialise(sized(docs, carried), "mix-sizes")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("digest"), F.col("doc_id")]
    placed = numbered(rows, order, "mix-places")
    goals = targets(rows, weights, most).withColumnRenamed("source", "own")
    rate = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
        F.col("target") / F.col("source_size")
    )
    start = _uniform(F.concat_ws(":", F.lit(SEED), F.coalesce("own", F.lit(""))))
    goals = goals.withColumns({"rate": rate, "start": start})
    goals = goals.withColumn("chance", F.col("rate") - F.floor("rate"))
    joined = placed.join(
        small(materialise(goals, "mix-targets")), F.col("source").eqNullSafe(F.col("own"))
    )
    at = F.col("start") + F.col("place") * F.col("chance")
    extra = F.when(at - F.floor(at) < F.col("chance"), 1).otherwise(0)
    copies = (F.floor("rate") + extra).cast("long")
    chosen = joined.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return chosen.drop("digest", "place", "own", "rate", "start", "chance")


def emitted(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix holds it."""
    row = F.struct(*[F.col(name) for name in docs.columns]).alias("row")
    mix = mixed(docs, weights, most, [row]).filter("copies > 0")
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mix.select("row", F.explode(copies)).select("row.*")

"""Audit of how filters interact, over every order in which they can be applied.

Documents are counted by part and by the set of filters they fail, a mask of five bits, so that
a part has 32 cells at most however many documents it holds. Each cell is folded across an array
of all orders: ``aggregate`` walks the filters of an order and ``transform`` the orders, which
gives one struct for every order and step, weighted with the counts of the cell. The structs of a
part's cells are added element by element.

All of it is built-in functions. The orders are one literal of 120 entries, which tasks get with
their plan.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.common import small
from yearpanel.sources.scratch import materialise

FILTERS = "ABCDE"
BITS = {letter: 1 << k for k, letter in enumerate(FILTERS)}
ORDERS = ["".join(order) for order in permutations(FILTERS)]

#: Characters that separate words.
WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: Percentages of distinct words (at least) and of capitals (at most).
DISTINCT, CAPITALS = 65, 5
SIGNS = r"[#$%&*|]"

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_mask(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text fails; ``words`` are its words."""
    n = F.when(F.btrim(text, F.lit(WHITE)) == "", 0).otherwise(F.size(words))
    different = F.when(n == 0, 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    length = F.char_length(text)
    upper = length - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": n < MIN_WORDS,
        "B": F.lit(100).cast("long") * different < F.lit(DISTINCT).cast("long") * n,
        "C": F.lit(100).cast("long") * upper > F.lit(CAPITALS).cast("long") * length,
        "D": text.rlike(SIGNS),
    }
    bits = [F.when(condition, BITS[letter]).otherwise(0) for letter, condition in fails.items()]
    return sum(bits[1:], bits[0])


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask: the filters that each row fails, one row per row.

    A null text is an empty one and fails A. E fails where a smaller doc_id has the same text;
    rows without a doc_id are neither smaller nor larger than others.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.split(F.btrim(text, F.lit(WHITE)), r"[\x20\x09-\x0D]+").alias("words"),
    )
    own = materialise(
        rows.select(
            "doc_id",
            "part",
            F.sha2("text", 256).alias("digest"),
            text_mask(F.col("text"), F.col("words")).alias("mask"),
        ),
        "filter-masks",
    )
    repeated = (
        own.filter("doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select("digest", "first")
    )
    found = own.join(small(materialise(repeated, "repeated-texts")), "digest", "left")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return found.select(
        "doc_id", "part", (F.col("mask") + F.when(later, BITS["E"]).otherwise(0)).alias("mask")
    )


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part and cells (mask, n, good, toxic), 32 at most, of ``judged`` rows.

    A document is good or toxic if any of its labels says so; one without a label is neither.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
    ).filter("doc_id is not null and (good or toxic)")
    known = known.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    counted = (
        rows.join(known, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("good")).alias("good"),
            F.count_if(F.col("toxic")).alias("toxic"),
        )
    )
    cell = F.struct("mask", "n", "good", "toxic")
    return counted.groupBy("part").agg(F.collect_list(cell).alias("cells"))


def _counts(**values: Column) -> Column:
    return F.struct(*[values[name].cast("long").alias(name) for name in COUNTS])


def _folded(cell: Column, orders: Column) -> Column:
    """A struct for every order and step: what the documents of a cell add to its counts."""
    none = F.lit(0).cast("long")
    zeros = _counts(**{name: none for name in COUNTS})

    def step(state: Column, bit: Column) -> Column:
        fails = cell["mask"].bitwiseAND(bit) != 0
        first, again = fails & ~state["gone"], fails & state["gone"]
        counts = _counts(
            kept=F.when(state["gone"] | fails, none).otherwise(cell["n"]),
            removed=F.when(first, cell["n"]).otherwise(none),
            redundant=F.when(again, cell["n"]).otherwise(none),
            unique_fails=F.when(cell["mask"] == bit, cell["n"]).otherwise(none),
            good_lost=F.when(first, cell["good"]).otherwise(none),
            toxic_lost=F.when(first, cell["toxic"]).otherwise(none),
        )
        return F.struct(
            (state["gone"] | fails).alias("gone"),
            F.concat(state["steps"], F.array(counts)).alias("steps"),
        )

    start = F.struct(F.lit(False).alias("gone"), F.slice(F.array(zeros), 1, 0).alias("steps"))
    return F.flatten(
        F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"]))
    )


def audited(parts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of ``cells``: 600 rows for every part."""
    orders = F.lit([[BITS[letter] for letter in order] for order in ORDERS])
    zeros = F.array_repeat(_counts(**{n: F.lit(0) for n in COUNTS}), len(ORDERS) * len(FILTERS))

    def added(total: Column, cell: Column) -> Column:
        return F.zip_with(
            total,
            _folded(cell, orders),
            lambda a, b: _counts(**{name: a[name] + b[name] for name in COUNTS}),
        )

    letters = F.flatten(orders)

    def removals(counts: Column, bit: Column) -> Column:
        """What a filter removes over all orders."""
        none = F.lit(0).cast("long")
        own = F.zip_with(
            counts, letters, lambda c, at: F.when(at == bit, c["removed"]).otherwise(none)
        )
        return F.aggregate(own, none, lambda a, b: a + b)

    def with_shapley(counts: Column) -> Column:
        bits = F.lit(list(BITS.values()))
        shapley = F.transform(bits, lambda bit: removals(counts, bit))
        return F.struct(counts.alias("counts"), shapley.alias("shapley"))

    # As the variable of a lambda the sums are made once, however often they are used.
    merged = F.transform(F.array(F.aggregate("cells", zeros, added)), with_shapley)
    rows = parts.select("part", F.inline(merged)).select(
        "part", "shapley", F.posexplode("counts").alias("at", "c")
    )
    order = F.element_at(F.lit(ORDERS), F.floor(F.col("at") / len(FILTERS)).cast("int") + 1)
    step = F.col("at") % len(FILTERS) + 1
    named = rows.select(
        "part", "shapley", "c.*", order.alias("filter_order"), step.cast("int").alias("step")
    )
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    number = F.instr(F.lit(FILTERS), letter)
    return named.select(
        "part",
        "filter_order",
        "step",
        *COUNTS,
        F.element_at("shapley", number).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, counts and shapley, 600 rows for every source value.

    Documents are counted row by row, rows that repeat or lack a doc_id included. A null source is
    the empty string. Other columns are dropped. An empty table gives no row.
    """
    return audited(cells(judged(docs), labels))

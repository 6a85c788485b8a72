"""What each filter of a chain removes, in every order the chain could have.

Five failure conditions are found once per document. A to D are read off its own text. E, the
text of a document with a smaller id, is an existential self-join: a left-semi join on hash,
exact text and smaller id. The ids that fail E are united with the other failing ids, and the
bit combinations are counted per part; all 120 orders are worked out from those few counts.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keystar.session import stash

FILTERS = "ABCDE"
MIN_WORDS = 200
#: A document fails B with fewer distinct words than this percentage of its words.
DISTINCT_PERCENT = 50
#: A document fails C with a larger percentage of capitals among its code points.
CAPITALS_PERCENT = 3
MARKS = "[#$%&*|]"
SPACE = "[ \\t-\\r]+"
#: Rows of one text that are compared in one place; a text with more is spread by salts.
SALT_ROWS = 1000
#: Slots a shared digest may fall into when texts are fetched; bounds what is broadcast.
SLOTS = 1 << 20


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(text: Column) -> Column:
    """The failed conditions among A to D, as bits."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = {
        "A": n < MIN_WORDS,
        "B": 100 * distinct < DISTINCT_PERCENT * n,
        "C": 100 * capitals > CAPITALS_PERCENT * F.length(text),
        "D": text.rlike(MARKS),
    }
    bits = [F.when(test, F.lit(_bit(x))).otherwise(0) for x, test in failed.items()]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def repeated(rows: DataFrame, scan: DataFrame) -> DataFrame:
    """(doc_id, part, digest) of every row whose text stands under a smaller doc_id.

    ``rows`` has (doc_id, part, digest, text), ``scan`` the same rows without texts. Texts move
    for shared digests only. The right side of the semi-join is the least id of each text,
    combined before it is shuffled; a text with very many rows is spread by salts over tasks.
    """
    groups = scan.groupBy("digest").agg(F.count("*").alias("n"))
    shared = stash(
        groups.where("n > 1").select("digest", F.ceil(F.col("n") / SALT_ROWS).alias("salts")),
        "shared",
    )
    # The slots of shared digests keep most other texts from moving.
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(shared.select(slot).distinct())
    near = rows.withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot")
    copies = stash(near.join(shared.hint("merge"), "digest"), "copies")
    earlier = (
        copies.groupBy("digest", "text")
        .agg(F.min("doc_id").alias("first"), F.first("salts").alias("salts"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        .drop("salts")
    )
    salted = copies.withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts"))
    return (
        salted.alias("l")
        .join(
            earlier.hint("merge").alias("r"),
            (F.col("l.digest") == F.col("r.digest"))
            & (F.col("l.salt") == F.col("r.salt"))
            & (F.col("l.text") == F.col("r.text"))
            & (F.col("r.first") < F.col("l.doc_id")),
            "left_semi",
        )
        .select("doc_id", "part", "digest")
    )


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per combination of failed conditions.

    The row with mask zero counts all documents of the part.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )
    scan = stash(rows.select("doc_id", "part", "digest", own_failures(text).alias("mask")), "masks")

    # A document fails in two branches at most; equal rows are counted by either of them.
    own = scan.where("mask > 0").withColumns({"own": F.lit(1), "again": F.lit(0)})
    again = repeated(rows, scan).withColumns(
        {"mask": F.lit(_bit("E")), "own": F.lit(0), "again": F.lit(1)}
    )
    failing = (
        own.unionByName(again)
        .groupBy("doc_id", "part", "digest")
        .agg(
            F.bit_or("mask").alias("mask"),
            F.greatest(F.sum("own"), F.sum("again")).alias("n"),
        )
    )
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    combinations = (
        failing.join(marks, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    none = F.lit(0)
    totals = scan.groupBy("part").agg(
        none.alias("mask"),
        F.count("*").alias("n"),
        none.cast("long").alias("good"),
        none.cast("long").alias("toxic"),
    )
    return totals.unionByName(combinations)


def all_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts per combination."""
    cells = counts.groupBy("part").agg(
        # At most one cell per combination of the five bits, and the total.
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))

    def bits(letters: Column) -> Column:
        each = [F.when(F.contains(letters, F.lit(x)), _bit(x)).otherwise(0) for x in FILTERS]
        return each[0] + each[1] + each[2] + each[3] + each[4]

    def at(step: Column) -> Column:
        letter = F.substring("filter_order", step, F.lit(1))
        before = F.substring("filter_order", F.lit(1), step - 1)
        return F.struct(
            step.alias("step"),
            letter.alias("letter"),
            bits(letter).alias("bit"),
            bits(before).alias("before"),
        )

    steps = (
        cells.withColumn("filter_order", F.explode(orders))
        .withColumn("at", F.explode(F.transform(F.sequence(F.lit(1), F.lit(len(FILTERS))), at)))
        .select("part", "cells", "filter_order", "at.*")
    )

    def fails(cell: Column) -> Column:
        return cell["mask"].bitwiseAND(F.col("bit")) != 0

    def gone(cell: Column) -> Column:
        return cell["mask"].bitwiseAND(F.col("before")) != 0

    def total(test: Callable[[Column], Column], value: str = "n") -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(F.filter("cells", test), zero, lambda sofar, cell: sofar + cell[value])

    found = steps.select(
        "part",
        "filter_order",
        "step",
        "letter",
        (total(lambda c: c["mask"] == 0) - total(lambda c: fails(c) | gone(c))).alias("kept"),
        total(lambda c: fails(c) & ~gone(c)).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"),
        total(lambda c: c["mask"] == F.col("bit")).alias("unique_fails"),
        total(lambda c: fails(c) & ~gone(c), "good").alias("good_lost"),
        total(lambda c: fails(c) & ~gone(c), "toxic").alias("toxic_lost"),
    )
    everywhere = Window.partitionBy("part", "letter")
    return found.withColumn("shapley", F.sum("removed").over(everywhere)).drop("letter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley): 600 rows per language.

    Null and empty texts are equal and fail A. Null and empty languages are one part. A row
    without an id is never smaller than another and has no smaller one, so it does not fail E;
    rows that share an id do not fail E by each other; repeated rows each count. A document is
    good (toxic) if any label row of its id says 1; labels without an id name nothing. Without
    documents there are no rows. Other columns are not read.
    """
    return all_orders(failure_counts(docs, labels))

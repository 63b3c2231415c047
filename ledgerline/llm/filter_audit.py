"""Filter interaction audit: what a chain of quality filters takes out, for every order of it.

Four filters look at a document alone, the fifth at the whole table: a document
fails it if the same text stands under a smaller doc_id. Such documents are
found by a left-semi join on hash, exact text and smaller doc_id against the
texts that stand more than once, each with its smallest id. The ids that fail
are united with the ids that fail the other filters and their bits are put
together: what is left of the table is one row per part and combination of
failures (at most 32 a part). Every order's counts follow from those.

Texts are shuffled once to find the repeated ones (copies are combined
map-side, so a text that fills a third of the table sends one row a task) and
once for the join, whose two sides are plain shuffles that AQE can split.

Defined cases: a null text is empty, and an empty text is a text like any other
(equal to other empty ones). A null ``lang`` is the part ''. A row without a
doc_id has no smaller one, isn't smaller than any, and has no labels. Rows equal
in id and text are none the other's copy and count one each. A document has a
label if any of its rows in the label table has it; null labels say nothing.
Columns other than those named are neither read nor returned. No documents: no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.staging import stage

LETTERS = "ABCDE"
DUPLICATE = "E"
#: What stands between words.
BLANKS = r"[\x20\x09-\x0D]+"


def own_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that need nothing but the text."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 100,
        "B": 100 * n_distinct.cast("long") < 80 * n_words.cast("long"),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def _read(docs: DataFrame) -> DataFrame:
    """doc_id, text and part; two hashes that stand for the text where it isn't carried."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), text.alias("text"),
                       F.xxhash64(text).alias("hash"), F.xxhash64(text, F.lit(1)).alias("check"))


def failure_masks(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, hash, check, mask, n)``: per id, part and text its failure bits
    (bit k for letter k of ``LETTERS``) and the number of rows it stands for."""
    rows = _read(docs)
    repeated = (rows.where(F.col("doc_id").isNotNull()).groupBy("hash", "text")
                .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(F.col("hash").alias("r_hash"), F.col("text").alias("r_text"), "first_id"))
    repeated = stage(repeated, "repeated-texts")
    key = ["doc_id", "part", "hash", "check"]
    copies = rows.join(repeated, (F.col("hash") == F.col("r_hash")) & (F.col("text") == F.col("r_text"))
                       & (F.col("first_id") < F.col("doc_id")), "left_semi")
    bits = sum((F.when(failed, _bit(letter)).otherwise(0)
                for letter, failed in own_failures(F.col("text")).items()), F.lit(0))
    failing = rows.select(*key, bits.alias("bits"), F.lit(1).alias("n")).unionByName(
        copies.select(*key, F.lit(_bit(DUPLICATE)).alias("bits"), F.lit(0).alias("n")))
    return failing.groupBy(*key).agg(F.bit_or("bits").alias("mask"), F.sum("n").alias("n"))


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and combination of failures."""
    marks = stage(labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")), "label-marks")
    masks = failure_masks(docs).join(marks, "doc_id", "left")
    total = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return masks.groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good").alias("good"),
                                             total("toxic").alias("toxic"))


def interactions(combos: DataFrame) -> DataFrame:
    """Every order of the filters, step by step, from the counted combinations.

    Per part, filter_order (a text of letters, applied left to right) and step (from 1;
    its filter is that letter): documents kept after it, removed by it, redundant (failing
    it, but gone before), unique_fails (failing it alone), good_lost and toxic_lost (removed
    with that label), shapley (removed by its filter, summed over all orders).
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    steps = (combos.withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    place = lambda x: F.instr("filter_order", x)
    before = sum((F.when(place(x) < F.col("step"), _bit(x)).otherwise(0) for x in LETTERS), F.lit(0))
    bit = sum((F.when(letter == x, _bit(x)).otherwise(0) for x in LETTERS), F.lit(0))
    steps = (steps.withColumn("letter", letter).withColumn("bit", bit).withColumn("before", before))
    mask = F.col("mask")
    reached = mask.bitwiseAND(F.col("before")) == 0
    fails = mask.bitwiseAND(F.col("bit")) != 0
    count = lambda which, what="n": F.sum(F.when(which, F.col(what)).otherwise(0)).cast("long")
    counted = steps.groupBy("part", "filter_order", "step", "letter").agg(
        count(reached & ~fails).alias("kept"), count(reached & fails).alias("removed"),
        count(~reached & fails).alias("redundant"), count(mask == F.col("bit")).alias("unique_fails"),
        count(reached & fails, "good").alias("good_lost"),
        count(reached & fails, "toxic").alias("toxic_lost"))
    per_filter = counted.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return counted.join(per_filter, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(stage(combinations(docs, labels), "failure-combinations"))

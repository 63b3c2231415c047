"""Mixing sources to target weights.

Budgets go down a tree (domain, language, source): a node's budget is shared
among its children by their weights, a child gets no more than its subtree can
give (its tokens times the epochs allowed), and what it can't take goes to its
siblings by weight; only what a whole family can't take is left to the level
above. Budgets are whole tokens and add up exactly.

A leaf's budget buys whole epochs, then a token-prefix of one more epoch in an
order seeded by epoch: documents by the MD5 of seed, epoch and doc_id, as long
as the running total fits. The cut is found in two steps, per leading digits of
the MD5 and then inside the one group where the budget ends, so a source that
holds a third of all rows is never sorted as one group, and the texts are not
shuffled: they are joined with one row per leaf. Only DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.staging import stage

SEED = 20_240
EPOCHS = 4                    # times that a document may be used, at most
SHARE = (1, 2)                # tokens to select, as a share of all there are
GROUP_DIGITS = 3              # leading MD5 digits of the first step

#: Target weights by level; a value that isn't named has weight 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 8, "de": 3, "fr": 3, "es": 6}
SOURCE_WEIGHTS = {"src0": 3, "src1": 2}

LEVELS = ["domain", "lang", "source"]


def n_tokens(text: str = "text") -> Column:
    """Words between ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain(source: str = "source") -> Column:
    """Sources are grouped into four domains by checksum; null is in none."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(F.col(source)), F.lit(4)).cast("string"))


def _weight(level: str, weights: dict[str, int]) -> Column:
    named = reduce(lambda c, kv: c.when(F.col(level) == kv[0], kv[1]), weights.items(),
                   F.when(F.lit(False), 0))
    return named.otherwise(1).cast("long")


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``keys``, null equal to null; the left's keys stay."""
    other = right.withColumnsRenamed({c: f"__{c}" for c in keys})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys])
    return left.join(other, same, how).drop(*[f"__{c}" for c in keys])


def share_out(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """``children(*parents, child, weight, capacity, budget)`` with ``budget`` that
    of the parent -> with the child's own.

    Children in the order of capacity / weight: one is full if, with those
    before it full, its share of the rest is not below its capacity; the others
    share the rest by weight, cut so that the parts add up. Weight 0 gets none.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    order = [F.asc_nulls_last("__ratio"), F.asc_nulls_first(child)]
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    before = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = family.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    big = "decimal(38,0)"
    left = F.greatest(F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), F.lit(0))
    ranked = (children.withColumn("__ratio", ratio)
              .withColumn("__left", left).withColumn("__rest", F.sum("weight").over(onward))
              .withColumn("__full", (F.col("weight") > 0)
                          & (F.col("capacity").cast(big) * F.col("__rest")
                             <= F.col("__left").cast(big) * F.col("weight"))))
    open_ = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.when(~F.col("__full"), F.col("weight")).otherwise(0)
    # all children that aren't full share what the full ones leave
    ranked = (ranked.withColumn("__pot", F.greatest(F.col("budget") - F.coalesce(
                  F.sum(F.when(F.col("__full"), F.col("capacity"))).over(family), F.lit(0)), F.lit(0)))
              .withColumn("__all", F.sum(weight).over(family))
              .withColumn("__upto", F.sum(weight).over(open_)))
    cut = lambda upto: F.expr(
        f"CAST(CAST(__pot AS decimal(38,0)) * ({upto}) DIV greatest(__all, 1) AS bigint)")
    own = F.when(F.col("__full"), F.col("capacity")).when(F.col("weight") == 0, 0).otherwise(
        cut("__upto") - cut("__upto - weight"))
    return ranked.withColumn("budget", own).drop("__ratio", "__left", "__rest", "__full", "__pot",
                                                 "__all", "__upto")


def leaf_budgets(leaves: DataFrame, weights: list[dict[str, int]], budget: int | None = None,
                 share: tuple[int, int] = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``leaves(*LEVELS, tokens)`` -> with ``budget``; the total is ``budget`` or
    the given share of all tokens."""
    if budget is None:
        all_tokens = leaves.agg(F.sum("tokens").cast("decimal(38,0)")).first()[0] or 0
        budget = int(all_tokens) * share[0] // share[1]
    tree, out = leaves.withColumn("capacity", F.col("tokens") * epochs), None
    for depth, (level, named) in enumerate(zip(LEVELS, weights)):
        parents = LEVELS[:depth]
        nodes = tree.groupBy(*parents, level).agg(F.sum("capacity").alias("capacity"))
        if parents:
            nodes = _join(nodes, out, parents)
        else:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        out = share_out(nodes.withColumn("weight", _weight(level, named)), parents, level)
        out = out.select(*parents, level, "budget")
    return _join(leaves, out, LEVELS)


def order_key(epoch: Column, doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """The place of a document in an epoch; a null id counts as an empty one."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def select_leaves(rows: DataFrame, budgets: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows(*LEVELS, doc_id, tokens)`` and leaf budgets -> one row per leaf:
    ``whole`` epochs, and ``cut``: documents whose key in the next epoch is not
    above it are in the prefix (null: none)."""
    plan = budgets.select(
        *LEVELS, F.expr("CASE WHEN tokens > 0 THEN budget DIV tokens ELSE 0 END").alias("whole"),
        F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END").alias("rest"))
    plan = stage(plan, "leaf-plan")
    keyed = _join(rows, plan.where("rest > 0"), LEVELS).select(
        *LEVELS, "tokens", "rest", order_key(F.col("whole"), seed=seed).alias("key"))
    keyed = keyed.withColumn("part", F.substring("key", 1, GROUP_DIGITS))
    # at most 16**GROUP_DIGITS parts a leaf, pre-aggregated in the tasks
    parts = keyed.groupBy(*LEVELS, "part").agg(F.sum("tokens").alias("sum"), F.max("rest").alias("rest"))
    upto = Window.partitionBy(*LEVELS).orderBy("part")
    parts = parts.withColumn("upto", F.sum("sum").over(upto))
    ends = stage(parts.where("upto - sum <= rest AND rest < upto")
                 .groupBy(*LEVELS).agg(F.min(F.struct("part", (F.col("upto") - F.col("sum")).alias("start")))
                                       .alias("end")).select(*LEVELS, "end.part", "end.start"),
                 "leaf-ends")
    inside = _join(keyed, ends, [*LEVELS, "part"])
    so_far = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("key"))
    last = (inside.withColumn("total", F.col("start") + so_far).where("total <= rest")
            .groupBy(*LEVELS).agg(F.max("key").alias("key")))
    cuts = _join(ends, last, LEVELS, "left").select(*LEVELS, F.coalesce("key", "part").alias("cut"))
    return _join(plan, cuts, LEVELS, "left").select(*LEVELS, "whole", "cut")


def mix(docs: DataFrame, weights: list[dict[str, int]] | None = None, budget: int | None = None,
        share: tuple[int, int] = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The selected rows of ``docs`` (all columns) with ``domain``, ``n_tokens``
    and ``copies``, the number of epochs that take the document.

    Clashing columns of ``docs`` with these three names are replaced. Null
    languages, sources and domains are values of their own. Texts without
    tokens cost nothing: they are in whole epochs, and in a prefix that reaches
    them. Rows with the same doc_id stand at the same place and are taken
    together or not at all. An empty table, a budget of 0 or a leaf without
    tokens selects nothing there.
    """
    weights = weights or [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS]
    full = docs.withColumn("domain", domain()).withColumn("n_tokens", n_tokens())
    rows = stage(full.select(*LEVELS, "doc_id", F.col("n_tokens").alias("tokens")), "tokens")
    leaves = stage(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    plan = stage(select_leaves(rows, leaf_budgets(leaves, weights, budget, share, epochs), seed),
                 "mix-plan")
    own = [F.col(f"d.{c}") for c in full.columns if c != "copies"]
    extra = F.coalesce((order_key(F.col("p.whole"), "d.doc_id", seed) <= F.col("p.cut")).cast("long"),
                       F.lit(0))
    same = reduce(lambda x, y: x & y, [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in LEVELS])
    return (full.alias("d").join(plan.alias("p"), same)
            .select(*own, (F.col("p.whole") + extra).alias("copies")).where("copies > 0"))

"""Quality scores by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that the risk sees. With the
class prior pi, g the logit and l the logistic loss, the non-negative unbiased
risk (Kiryo et al., 2017) is

    pi * mean_P l(g) + max(0, mean_U l(-g) - pi * mean_P l(-g)),

minimised over hashed n-gram features; while the second part is negative its
gradient is followed the other way, as the paper has it. pi is estimated by the
share of good rows among the labelled rows that may be learned from.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import ngrams as NG
from ledgerline.llm.samples import collect_features, first_by_hash

POSITIVE_ROWS = 2_000      # trusted positives that the risk is taken over, at most
UNLABELLED_ROWS = 4_000    # unlabelled texts, at most
FOLDS = 5                  # rows with crc32(doc_id as text) % FOLDS = 0 are held out
THRESHOLD = 0.3


def held_out(doc_id: str = "doc_id"):
    """True for the rows whose labels are never learned from; a null id is held
    out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def fit_nnpu(x: np.ndarray, positive: np.ndarray, prior: float, rounds: int = 400,
             rate: float = 1.0, decay: float = 1e-5) -> NG.LinearModel:
    """Minimise the non-negative risk; ``positive`` marks rows of P, the rest are U.
    Without rows of both kinds: the constant of the prior."""
    start = float(np.log(prior / (1 - prior)))
    p, u = positive.astype(bool), ~positive.astype(bool)
    if not p.any() or not u.any():
        return NG.LinearModel(np.zeros(NG.WIDTH), start)
    n_p, n_u = p.sum(), u.sum()

    def gradient(z: np.ndarray) -> np.ndarray:
        s, low = NG.sigmoid(z), np.logaddexp(0, z)          # l(-g) = log(1 + e^g)
        negative = low[u].mean() - prior * low[p].mean()
        rest = np.where(p, -prior * s / n_p, s / n_u)
        if negative < 0:
            return -rest
        return rest + np.where(p, prior * (s - 1) / n_p, 0)

    return NG.minimise(gradient, x, start, rounds, rate, decay)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> NG.LinearModel:
    """Labels count only where the row isn't held out. U: texts that carry no
    label there, whatever else they are. Null ids, labels or texts are left out
    of the fit; a doc_id with both labels isn't trusted and counts as neither."""
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out())
    known = usable.groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high"))
    known = known.where("low = high").select("doc_id", F.col("low").cast("int").alias("label"))
    ones, rows = known.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    prior = (ones + 1) / (rows + 2)
    trusted = first_by_hash(known.where("label = 1"), "doc_id", POSITIVE_ROWS)
    free = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id")
    loose = first_by_hash(free.join(usable.select("doc_id"), "doc_id", "left_anti"),
                          "doc_id", UNLABELLED_ROWS)
    # at most POSITIVE_ROWS + UNLABELLED_ROWS rows: can be broadcast
    chosen = trusted.unionByName(loose.withColumn("label", F.lit(0))).distinct()
    x, y = collect_features(docs.where("text IS NOT NULL").select("doc_id", "text")
                            .join(F.broadcast(chosen), "doc_id"), "label")
    return fit_nnpu(x, y, prior)


def score(docs: DataFrame, model: NG.LinearModel, text_col: str = "text"):
    """Column expression: the score (0 to 1) of a whole text. Null scores as the
    empty text does: the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def quality(texts: pd.Series) -> pd.Series:
        return pd.Series(NG.sigmoid(sent.value.logits(texts.tolist())))

    return quality(F.col(text_col))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.
    An empty table gives no rows; other columns are not looked at."""
    scored = docs.select("doc_id", held_out().alias("held_out"),
                         score(docs, fit(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

"""Quality rules: fixed text statistics, then a calibrated n-gram classifier.

The statistics of the base rules are counted over the whole text. Texts that
pass them are judged by logistic regression on hashed word and character
n-grams: fitted on labelled rows, its probabilities calibrated on labelled rows
it was not fitted on (Platt), and compared with a fixed threshold. Texts are
scored in Arrow batches, each on its own: no shuffle.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import ngrams as NG
from ledgerline.llm.samples import collect_packed, first_by_hash, unpacked
from ledgerline.llm.staging import free_name
from ledgerline.llm.words import slices

MIN_WORDS = 50             # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50    # base rule: more words in repeated 3-word windows fail
KEEP = 0.5                 # calibrated probability of good quality a kept text needs
LABELLED_ROWS = 4_000      # labelled rows that the classifier is fitted on, at most
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

JUDGED = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
          "n_repeat_words:bigint,base_failed:boolean,probability:double,kept:boolean>")


@dataclass
class QualityModel:
    model: NG.LinearModel
    slope: float
    offset: float

    def probability(self, texts: list[str | None]) -> np.ndarray:
        return NG.sigmoid(self.slope * self.model.logits(texts) + self.offset)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS
        ) -> QualityModel:
    """Fit on at most ``rows`` labelled texts, a fifth of them for calibration.

    Rows without a doc_id, a label of 0 or 1 or a text don't count; a doc_id
    that is labelled more than once counts once per distinct label. Without
    rows of both labels every text gets the smoothed share of ones.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
             .select("doc_id", F.col(label).cast("int").alias("label")).distinct())
    chosen = first_by_hash(known, "doc_id", rows)        # at most ``rows`` rows: can be broadcast
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    packed, y = collect_packed(texts.join(F.broadcast(chosen), "doc_id"), "label")
    order = np.random.default_rng(11).permutation(len(y))
    apart, own = order[:len(y) // 5], order[len(y) // 5:]
    model = NG.fit_logistic(unpacked(packed, own), y[own])
    logits = unpacked(packed, apart) @ model.weights.astype(np.float32) + model.bias
    return QualityModel(model, *NG.fit_platt(logits, y[apart]))


def statistics(text: str | None) -> dict:
    """The base rules' counts of one text; null has no words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()          # bytes are cut at the six ASCII blanks only
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return {"n_words": len(words),
            "word_chars": len(text) - sum(map(text.count, BLANKS)),
            "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": repeat_words(words)}


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that stand in the text twice or more."""
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) >= len(words) - 2:
        return 0
    number = {w: n for w, n in windows.items() if n > 1}
    covered = np.zeros(len(words), dtype=bool)
    at = np.flatnonzero([w in number for w in zip(words, words[1:], words[2:])])
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def judge(docs: DataFrame, model: QualityModel, text_col: str = "text", judged_col: str = "judged",
          keep: float = KEEP) -> DataFrame:
    """``docs`` with a struct column ``judged_col``: the counts, base_failed,
    the calibrated probability and kept. Null and empty texts have no words and
    so fail the base rules; each repeated row is judged on its own; an empty
    table stays empty."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(judged_col, T._parse_datatype_string(JUDGED))])
    made = pa.struct([(f.name, {"bigint": pa.int64(), "double": pa.float64(),
                                "boolean": pa.bool_()}[f.dataType.simpleString()])
                      for f in schema[judged_col].dataType.fields])

    def score(batches):
        for batch in batches:
            for part in slices(batch, text_col, NG.PIECE):
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                out = []
                for text, p in zip(texts, sent.value.probability(texts)):
                    row = statistics(text)
                    failed = (row["n_words"] < MIN_WORDS or 100 * row["n_repeat_words"]
                              > MAX_REPEAT_PERCENT * row["n_words"])
                    out.append(row | {"base_failed": failed, "probability": float(p),
                                      "kept": bool(not failed and p >= keep)})
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, type=made)],
                                                 names=[*part.schema.names, judged_col])

    return docs.mapInArrow(score, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (same columns) without the rows that the quality rules reject."""
    name = free_name(docs, "judged")
    return (judge(docs, fit(docs, labels), judged_col=name)
            .where(F.col(name)["kept"]).select(docs.columns))

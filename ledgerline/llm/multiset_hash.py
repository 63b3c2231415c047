"""Homomorphic multiset hash of documents: a sum of wide vectors hashed from paragraphs.

A paragraph (a line with a word) has a vector of ``LANES`` numbers for itself and one for
each of its shingles (five words; all of them where there are fewer). A number holds two random
bytes, 24 bits apart. A document's fingerprint is their componentwise sum modulo 2^48, and the
number of vectors modulo 2^32. So the order of paragraphs doesn't matter, equal multisets of paragraphs have equal
fingerprints, and a paragraph is put in or taken out by adding or subtracting its own
fingerprint (``add``, ``subtract``) without reading the rest. Bytes come from a 128-bit hash of the
paragraph or shingle: proof against chance, not against an adversary.

The vectors of different shingles are independent, so the squared length of the
difference of two fingerprints estimates in how many shingles the two differ.
``likeness`` is what they share over all that either has (0 to 1): 1 for equal
fingerprints, and off by about 1 / sqrt(2 * LANES) at 0.

Texts are cut into shingles next to where they are read; rows that carry hashes but no text are
added up map-side, and one row a document is shuffled. For the edited texts a text meets its
place in the order of doc_ids (shuffled once) and hands the head that the edit takes to the document
before it. The order itself is made from ids alone: range-partitioned, written, the next row
looked up within each part, and the ends of the parts tied together (one row a part).

Defined cases: a null text is empty and has no paragraph: its fingerprint is all zero. Rows equal in
doc_id and text are one document for the order, and each returns its row. Rows of one doc_id but
different texts are ordered by their hash. Rows without a doc_id come last. A single document is its own next one.
Two empty texts have likeness 1. Whitespace within a paragraph counts for the paragraph's own vector, not for its shingles.
Other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.staging import stage

LANES = 64
LANE_BITS, HALF_BITS, COUNT_BITS = 48, 24, 32
SHINGLE = 5
BLANKS = r"[\x20\x09-\x0D]+"
_PER_HASH = 4               # numbers that one 64-bit hash gives
_MEAN = 127.5               # of a byte


# -- vectors ------------------------------------------------------------------
def items(text: Column) -> Column:
    """What is added up for a text: two 64-bit hashes for each paragraph and shingle."""
    both = lambda *x: F.struct(F.xxhash64(*x).alias("a"), F.xxhash64(*x, F.lit(1)).alias("b"))
    shingles = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))),
        lambda i: F.slice(w, i, SHINGLE))
    lines = F.filter(F.split(text, "\n"), lambda p: p.rlike(r"[^\x20\x09-\x0D]"))
    # each step is an array of its own, so that nothing is cut or sliced more than once
    cut = F.transform(lines, lambda p: F.struct(p.alias("p"), F.array_remove(F.split(p, BLANKS), "").alias("w")))
    parts = F.transform(cut, lambda x: F.concat(F.array(both(F.lit("paragraph"), x["p"])), F.transform(
        shingles(x["w"]), lambda s: both(s))))
    return F.flatten(parts)


def fingerprints(texts: DataFrame, key: list[str], text_col: str) -> DataFrame:
    """``(key..., lanes)``: lanes[0] is the number of vectors, then come the ``LANES`` sums.
    Rows of equal key must have equal texts; they give one row."""
    nothing = F.struct(F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    # the leading item without a hash stands for the row itself, also where the text is empty
    rows = texts.select(*key, F.explode(F.concat(F.array(nothing), items(F.col(text_col)))).alias("item"))
    a, b = F.col("item.a"), F.col("item.b")
    wide = rows.select(*key, a.isNull().alias("is_row"), *[
        F.when(a.isNotNull(), F.xxhash64(a, b, F.lit(j))).alias(f"w{j}") for j in range(LANES // _PER_HASH)])

    def lane(i: int) -> Column:
        """Two bytes 24 bits apart: 2^31 of them add up to a LONG."""
        x = F.shiftrightunsigned(f"w{i // _PER_HASH}", 16 * (i % _PER_HASH))
        low, high = (x.bitwiseAND(F.lit(mask).cast("long")) for mask in (0xFF, 0xFF00))
        return F.sum(low + F.shiftleft(high, HALF_BITS - 8))

    summed = wide.groupBy(*key).agg(F.count_if("is_row").alias("n_rows"), F.count("w0").alias("s"),
                                    *[lane(i).alias(f"s{i}") for i in range(LANES)])
    per_row = lambda c, bits: F.pmod(F.expr(f"coalesce({c}, 0) div n_rows"), F.lit(1 << bits))
    return summed.select(*key, F.array(per_row("s", COUNT_BITS), *[
        per_row(f"s{i}", LANE_BITS) for i in range(LANES)]).alias("lanes"))


def _combine(x: Column, y: Column, sign: int) -> Column:
    modulus = lambda i: F.when(i == 0, F.lit(1 << COUNT_BITS)).otherwise(F.lit(1 << LANE_BITS))
    return F.transform(F.sequence(F.lit(0), F.lit(LANES)),
                       lambda i: F.pmod(F.get(x, i) + sign * F.get(y, i), modulus(i)))


def add(x: Column, y: Column) -> Column:
    """Fingerprint of the union of two multisets of paragraphs."""
    return _combine(x, y, 1)


def subtract(x: Column, y: Column) -> Column:
    """Fingerprint of x without the paragraphs of y, which must be in it."""
    return _combine(x, y, -1)


def as_text(lanes: Column) -> Column:
    """Lowercase hex: 8 digits of the count, then 12 a lane."""
    digits = lambda n, width: F.lower(F.lpad(F.hex(n), width, "0"))
    return F.concat(digits(F.get(lanes, F.lit(0)), COUNT_BITS // 4), F.concat_ws("", F.transform(
        F.slice(lanes, 2, LANES), lambda x: digits(x, LANE_BITS // 4))))


def likeness(x: Column, y: Column) -> Column:
    """What two fingerprints share over all that either has, estimated, 0 to 1."""
    return F.when(x == y, F.lit(1.0)).otherwise(_overlap(_centred(x), _centred(y)))


def _centred(lanes: Column) -> Column:
    """Sums of bytes less what is expected of their count, around zero: independent for other items."""
    n, turn = F.get(lanes, F.lit(0)), float(1 << HALF_BITS)
    off = lambda s: s - n * F.lit(_MEAN)
    halves = F.flatten(F.transform(F.slice(lanes, 2, LANES), lambda s: F.array(
        s.bitwiseAND(F.lit((1 << HALF_BITS) - 1)), F.shiftright(s, HALF_BITS))))
    return F.transform(halves, lambda s: off(s) - F.rint(off(s) / turn) * turn)


def _overlap(x: Column, y: Column) -> Column:
    nothing = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy"))
    return F.aggregate(
        F.arrays_zip(x.alias("x"), y.alias("y")), nothing,
        lambda s, p: F.struct((s["xy"] + p["x"] * p["y"]).alias("xy"), (s["xx"] + p["x"] * p["x"]).alias("xx"),
                              (s["yy"] + p["y"] * p["y"]).alias("yy")),
        lambda s: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(
            F.try_divide(s["xy"], s["xx"] + s["yy"] - s["xy"]), F.lit(0.0)))))


# -- the documents after one another --------------------------------------------
KEY = ["k1", "k2"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a 128-bit key of id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text, F.col(id_col)).alias("k1"),
                       F.xxhash64(text, F.col(id_col), F.lit(1)).alias("k2"), F.col(id_col).alias("id"),
                       text.alias("text"))


def in_order(keyed: DataFrame) -> DataFrame:
    """``(k1, k2, id, n_chars, next1, next2)``: each document and the key of the one after it,
    by descending id; after the last comes the first."""
    order = [F.col("id").desc_nulls_last(), F.col("k1"), F.col("k2")]
    ids = keyed.select(*KEY, "id", F.length("text").alias("n_chars")).distinct()
    parts = stage(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "id-ranges")
    here = F.struct(*KEY)
    w = Window.partitionBy("part").orderBy(*order)
    rows = parts.withColumn("after", F.lead(here).over(w)).withColumn("row", F.row_number().over(w))
    # one row a part, in one task: bounded by the number of shuffle partitions
    whole = Window.orderBy("part")
    firsts = rows.where("row = 1").select("part", here.alias("head"))
    tied = firsts.select("part", F.coalesce(
        F.lead("head").over(whole), F.first("head").over(whole.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("following"))
    after = F.coalesce("after", "following")
    return stage(rows.join(tied, "part").select(*KEY, "id", "n_chars", after["k1"].alias("next1"),
                                                after["k2"].alias("next2")), "id-order")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text (the last half replaced by as much
    of the next document's start) and how alike they are to it and to the next document's.

    ``(id, n_chars, edited_sha256, lanes, edited_lanes, near_edited, near_next)``.
    """
    keyed = _keyed(docs, id_col, text_col)
    order = in_order(keyed)
    texts = keyed.select(*KEY, "text")
    before = order.select(F.col("next1").alias("k1"), F.col("next2").alias("k2"), F.col("k1").alias("p1"),
                          F.col("k2").alias("p2"), F.expr("n_chars div 2").cast("int").alias("wanted"))
    # every document hands the start of its text to the one before it
    heads = (texts.join(before, KEY).select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.substring("text", F.lit(1), F.col("wanted")).alias("head"))
        .groupBy(*KEY).agg(F.min("head").alias("head")))
    n = F.length("text")
    edited = texts.join(heads, KEY).select(*KEY, F.concat(
        F.substring("text", F.lit(1), n - F.expr("length(text) div 2").cast("int")), "head").alias("edited"))
    edited = edited.select(*KEY, F.unhex(F.sha2("edited", 256)).alias("digest"), "edited")
    edited = fingerprints(edited, [*KEY, "digest"], "edited").withColumnRenamed("lanes", "edited_lanes")
    own = fingerprints(texts, KEY, "text")
    to_previous = own.join(before, KEY).select(F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                                               F.col("lanes").alias("next_lanes"))
    per_text = own.join(to_previous, KEY).join(edited, KEY).select(
        *KEY, F.lower(F.hex("digest")).alias("edited_sha256"), "lanes", "edited_lanes",
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))
    rows = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return (order.select(*KEY, "id", F.col("n_chars").cast("long").alias("n_chars")).join(rows, KEY)
            .join(per_text, KEY).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("id", "n_chars", "edited_sha256", "lanes", "edited_lanes", "near_edited", "near_next"))

"""Fuzzy line dedup by MinHash, DataFrame functions only.

1. Lines are trimmed; equal ones are one line (two 64-bit hashes).
2. Every code-point shingle of a line is hashed once; the signature is, for each
   of VALUES constants, the least of hash XOR constant (pre-aggregated in the tasks:
   a line's shingles are never shuffled).
3. Three of the values make a band's bucket: unlike lines rarely meet. In a bucket of up to SMALL lines all pairs
   whose signatures agree well enough go on.
4. Lines of larger buckets get an odd sketch of their shingle set (Mitzenmacher, Pagh and
   Pham, 2014): a bit says whether the number of shingles hashed to it is odd. Two
   sketches differ in no more bits than the sets differ in shingles, whatever they share,
   so the bound, applied in the bucket's join itself, loses no link. All lines of such a
   bucket are compared with some of them, picked by hash, and with the one whose buckets are
   the largest. That ties most groups of near copies, originals to their edited copies too.
   Of a bucket that verified links leave in more than one component, the lines outside of the
   largest one are compared with all others, up to OUTSIDE of them. Lines of buckets with more
   are joined on their rarest shingles only, as many as any similar pair must share one of
   (prefix filter, no link is lost). So lines that have much in common, yet aren't similar,
   don't meet, and no bucket of any size ends as all its pairs. Nothing is capped.
5. Pairs that are left are verified by the exact Jaccard similarity of their shingle sets.
6. Distributed union-find over the verified links; of each component the line
   that comes first (by doc_id, then place) stays, all others go.

Buckets and components of any size are grouped by minima and counts that Spark
combines before the shuffle, and sent back by plain joins that AQE splits.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import connected_components
from ledgerline.llm.staging import free_name, stage

SHINGLE = 9          # code points
PER_ROW = 8          # shingles that are hashed in one row
VALUES = 21          # signature values of a line
WORDS = 16           # LONGs of the odd sketch of a line of a large bucket
#: Three values make a band. The values come from one hash and aren't independent; the recall
#: is measured by tests/llm/test_line_recall.py, AGREE and sketches included.
BANDS = [tuple(range(i, i + 3)) for i in range(0, VALUES, 3)]
THRESHOLD = 0.8
AGREE = 11           # values in which candidates must agree; at 0.8 a pair has 0.999 of doing so
SMALL = 8            # lines in a bucket that are all compared by their signatures
MIDDLE = 128         # lines in a bucket beyond which more lines are picked
OUTSIDE = 1024       # lines outside of a bucket's largest component that are compared by their sketches
PICKED = 4           # lines that a larger bucket's lines are compared with first
PICKED_MORE = 16     # the same for more than MIDDLE lines
FIRSTS = 24          # rare shingles of a line that are looked at, so that a pair comes out once
PREFILTER = 1 << 20  # hash classes of the broadcast prefilter: its size bound

_VALUES = [f"m{i}" for i in range(VALUES)]
_SKETCH = [f"s{i}" for i in range(WORDS)]
_PACKED = [f"p{i}" for i in range(-(-VALUES // 16))]
_OWN = ["k", *_VALUES, *_SKETCH, "n"]
_SHORT = ["k", *_PACKED, *_SKETCH, "n"]

_random = random.Random(42)
_CONSTANTS = [_random.getrandbits(64) - 2**63 for _ in range(max(VALUES, PICKED_MORE))]


_BLANKS = " \t\r\u000b\f"


def normal(line: Column) -> Column:
    # most lines have no blank at their ends, and to trim is dear
    ends = [end(line, F.lit(x)) for end in (F.startswith, F.endswith) for x in _BLANKS]
    return F.when(reduce(Column.__or__, ends), F.trim(line, F.lit(_BLANKS))).otherwise(line)


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, text_hash, pos, line) of the lines that aren't blank, normalised."""
    split = docs.where(F.col(text).isNotNull()).select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return split.withColumn("line", normal(F.col("line"))).where("line <> ''")


def _keys() -> list[Column]:
    """The line's identity: XXH64 under two seeds."""
    return [F.xxhash64("line").alias("k"), F.xxhash64(F.lit(1), F.col("line")).alias("k2")]


def _last(line: str) -> Column:
    """The place of the last shingle: a shorter line is one shingle."""
    return F.greatest(F.length(line) - (SHINGLE - 1), F.lit(1))


def _shingle_hash(points: Column, start: Column) -> Column:
    """``points`` holds 4 bytes a code point, so that any place is found at once."""
    return F.xxhash64(F.substring(points, start * 4 - 3, F.lit(4 * SHINGLE)))


def _shingles(line: str) -> Column:
    """The set of a line's shingle hashes; the outer transform makes the points once."""
    return F.element_at(F.transform(F.array(F.encode(line, "UTF-32")), lambda points: F.array_distinct(
        F.transform(F.sequence(F.lit(1), _last(line)), lambda i: _shingle_hash(points, i)))), 1)


def signatures(lines: DataFrame) -> DataFrame:
    """(k, k2, m0, ...): one row per distinct line."""
    # keys and points are made below the explode, once a line; a row then has the
    # hashes of PER_ROW shingles, the last one repeated where the line is over. Nothing explodes
    # to nothing here; explode alone would make Spark filter by size and make the arrays twice
    rows = (lines.select(*_keys(), F.encode("line", "UTF-32").alias("points"), _last("line").alias("last"))
            .withColumn("starts", F.sequence(F.lit(1), F.col("last"), F.lit(PER_ROW)))
            .select("k", "k2", "points", "last", F.explode_outer("starts").alias("i")))
    hashes = [f"h{j}" for j in range(PER_ROW)]
    points = rows.select("k", "k2", "last", *[
        _shingle_hash(F.col("points"), F.least(F.col("i") + j, F.col("last"))).alias(h)
        for j, h in enumerate(hashes)])
    least = [F.min(F.shiftright(F.least(*[F.col(h).bitwiseXOR(F.lit(c)) for h in hashes]), 32)
                   .cast("int")).alias(m) for m, c in zip(_VALUES, _CONSTANTS)]
    return points.groupBy("k", "k2").agg(*least)


def odd_sketches(texts: DataFrame) -> DataFrame:
    """(k, s0, ..., n) of ``texts(k, line)``: the odd sketch and the size of the shingle set."""
    # the last bits of a hash say which bit it turns over, those before in which word
    rows = texts.select("k", F.explode_outer(_shingles("line")).alias("h")).select(
        "k", F.expr(f"cast(shiftright(h, 6) & {WORDS - 1} AS int)").alias("w"),
        F.expr("shiftleft(1L, cast(h & 63 AS int))").alias("bit"))
    words = rows.groupBy("k", "w").agg(F.bit_xor("bit").alias("x"), F.count(F.lit(1)).alias("n"))
    sketch = words.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("w", "x"))).alias("x"),
                                    F.sum("n").alias("n"))
    return sketch.select("k", *[F.coalesce(F.try_element_at("x", F.lit(w)), F.lit(0)).cast("long").alias(s)
                                for w, s in enumerate(_SKETCH)], "n")


def _side(members: DataFrame, x: str, *columns, own: list[str] = _OWN[1:]) -> DataFrame:
    """``members`` with the key and the columns ``own`` named for one side of a pair."""
    return members.select(*columns, F.col("k").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in own])


def _packed() -> list[Column]:
    """The last 4 bits of every signature value, 16 of them in a LONG: a join compares these
    much faster than VALUES columns. Values that differ may agree in them, not the reverse."""
    return [F.expr(" | ".join(f"shiftleft(cast({m} & 15 AS bigint), {4 * i})"
                              for i, m in enumerate(_VALUES[16 * j:16 * j + 16]))).alias(p)
            for j, p in enumerate(_PACKED)]


def _agree(packed: bool = False) -> Column:
    """Whether the signatures of a and b agree well enough."""
    if packed:
        # of every 4 bits the last one is set if any of them differs; 0x1111111111111111
        differ = [" | ".join(f"shiftrightunsigned({p}_a ^ {p}_b, {i})" for i in range(4)) for p in _PACKED]
        return F.expr(" + ".join(f"bit_count(({x}) & 1229782938247303441L)" for x in differ) + f" <= {VALUES - AGREE}")
    return F.expr(" + ".join(f"cast({m}_a = {m}_b AS int)" for m in _VALUES) + f" >= {AGREE}")


def _near(threshold: float, packed: bool = False) -> Column:
    """Whether the signatures and sketches of a and b leave them a chance of the threshold."""
    differ = " + ".join(f"bit_count({s}_a ^ {s}_b)" for s in _SKETCH)
    # |x - y| + |y - x| <= (1 - t) / (1 + t) * (|x| + |y|) for sets of similarity t
    most = (1 - threshold) / (1 + threshold)
    return _agree(packed) & F.expr(f"{differ} <= {most + 1e-9!r}D * (n_a + n_b)")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs(a, b)`` whose exact Jaccard similarity of shingle sets reaches
    the threshold."""
    side = lambda x: texts.select(F.col("k").alias(x), F.col("line").alias(f"line_{x}"))
    sets = (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", _shingles("line_a").alias("x"), _shingles("line_b").alias("y"))
            .select("a", "b", F.size(F.array_intersect("x", "y")).alias("both"),
                    (F.size("x") + F.size("y")).alias("sizes")))
    return sets.where(F.col("both") >= threshold * (F.col("sizes") - F.col("both"))).select(
        "a", "b").distinct()


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _rare_shingle_pairs(rest: DataFrame, sketches: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Candidates ``(a, b)`` among the lines ``rest(k, c)`` that are of different components
    ``c``. Of two similar lines the larger set x shares a shingle of its first |x| - t |x| + 1
    with the first |y| - 2 t / (1 + t) |y| + 1 of the smaller set y, in any order that both
    keep; here rare shingles come first, and those of one line only meet nobody. Two lines
    with common shingles among their FIRSTS come out at the least of these only."""
    sets = stage(rest.join(texts, "k").select("k", "c", _shingles("line").alias("hs"))
                 .select("k", "c", F.size("hs").alias("n"), F.explode_outer("hs").alias("h")), "line-shingles")
    shared = sets.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    own = Window.partitionBy("k")
    alone = F.col("n") - F.count(F.lit(1)).over(own)
    ranked = (sets.join(shared, "h").withColumn("rank", F.row_number().over(own.orderBy("f", "h")))
              .withColumn("place", F.col("rank") + alone))
    first = lambda share: F.col("n") - F.ceil(share * F.col("n") - 1e-9) + 1
    ranked = (ranked.where(F.col("place") <= first(threshold))
              .withColumn("short", F.col("place") <= first(2 * threshold / (1 + threshold)))
              .withColumn("firsts", F.collect_list(F.when(F.col("short") & (F.col("rank") <= FIRSTS), F.col("h")))
                          .over(own)))
    if _VALUES[0] in sketches.columns:
        sketches = sketches.select("k", *_packed(), *_SKETCH, "n")
    ranked = stage(ranked.select("k", "c", "h", "short", "firsts").join(sketches, "k"), "rare-shingles")
    side = lambda rows, x: _side(rows, x, "h", *[F.col(c).alias(f"{c}_{x}") for c in ("c", "firsts")],
                                 own=_SHORT[1:])
    # all elements of firsts have a row on both sides
    once = F.expr("coalesce(array_min(array_intersect(firsts_a, firsts_b)) = h, true)")
    return (side(ranked, "a").join(side(ranked.where("short"), "b"), "h")
            .where(F.expr(f"c_a <> c_b AND struct(n_b, b) < struct(n_a, a) AND n_b >= {threshold - 1e-9!r}D * n_a")
                   & _near(threshold, packed=True) & once).select("a", "b").distinct())


def similar_lines(lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Edges ``(src, dst)`` that connect the keys of different lines which verified links
    connect, of those that the bands brought together."""
    bands = [F.xxhash64(F.lit(b), *[f"m{i}" for i in values]).alias(f"b{b}") for b, values in enumerate(BANDS)]
    signed = stage(signatures(lines).select("k", *bands, *_packed()), "line-signatures")
    rows = signed.select("k", F.explode(F.array(*[f"b{b}" for b in range(len(BANDS))])).alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    left = stage(rows.join(shared, "band"), "bucket-members")
    few, large = left.where(F.col("n") <= SMALL), left.where(F.col("n") > SMALL)
    # a line of many large buckets is like many others, as the original of edited copies is
    members = left.groupBy("k").agg(F.sum("n").alias("total"))
    signed = stage(signed.select("k", *_PACKED).join(members, "k"), "member-signatures")

    few = few.select("band", "k").join(signed, "k")
    pairs = (_side(few, "a", "band", own=_PACKED).join(_side(few, "b", "band", own=_PACKED), "band")
             .where(F.expr("a < b") & _agree(packed=True)).select("a", "b").distinct())
    pairs = stage(pairs, "bucket-pairs")

    wanted = (pairs.select(F.explode(F.array("a", "b")).alias("k")).withColumn("large", F.lit(False))
              .unionByName(large.select("k", F.lit(True).alias("large")))
              .groupBy("k").agg(F.max("large").alias("large")))
    wanted = stage(wanted, "candidates")
    classes = wanted.select(F.pmod("k", F.lit(PREFILTER)).alias("class")).distinct()
    texts = (lines.select(F.xxhash64("line").alias("k"), "line")
             .withColumn("class", F.pmod("k", F.lit(PREFILTER)))
             .join(F.broadcast(classes), "class", "left_semi")     # at most PREFILTER rows
             .join(wanted, "k").select("k", "line", "large").distinct())
    texts = stage(texts, "candidate-lines")
    sketches = stage(signed.join(odd_sketches(texts.where("large")), "k").select(_SHORT), "line-sketches")
    side = lambda rows, x, *columns: _side(rows, x, *columns, own=_SHORT[1:])


    picked = [F.min(F.col("k").bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)) for x in _CONSTANTS[:PICKED_MORE]]
    central = F.max_by("k", F.struct("total", "k"))
    picks = (large.join(signed.select("k", "total"), "k").groupBy("band")
             .agg(F.max("n").alias("lines"), F.array(*picked).alias("picked"), central.alias("central")).select(
        "band", F.array_union(F.when(F.col("lines") > MIDDLE, F.col("picked"))
                              .otherwise(F.slice("picked", 1, PICKED)), F.array("central")).alias("picked")))
    large = large.join(picks, "band")
    met = large.select("k", F.explode("picked").alias("b")).where("k <> b").distinct()
    met = (side(met.join(sketches, "k"), "a", "b").join(side(sketches, "b"), "b")
           .where(_near(threshold, packed=True)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    links = stage(_verified(pairs.unionByName(met).distinct(), texts, threshold), "links")

    # lines of large buckets that aren't one component; those picked have all their links
    labels = connected_components(_edges(links)).withColumnRenamed("node", "k")
    open_ = stage(large.where(~F.array_contains("picked", F.col("k"))).select("band", "k", "n")
                  .join(labels, "k", "left").select("band", "k", "n", F.coalesce("component", "k").alias("c")),
                  "open-buckets")
    # in an open bucket all pairs that are left have a line outside of its largest component
    parts = open_.groupBy("band", "c").agg(F.count(F.lit(1)).alias("lines"))
    apart = (parts.groupBy("band").agg(F.max_by("c", F.struct("lines", "c")).alias("main"),
                                       (F.sum("lines") - F.max("lines")).alias("outside")).where("outside > 0"))
    rest = stage(open_.join(apart, "band"), "open-lines")
    edges = labels.select(F.col("k").alias("src"), F.col("component").alias("dst"))
    if not rest.isEmpty():
        few = rest.where(F.col("outside") <= OUTSIDE).select("band", "k", "c", "main").join(sketches, "k")
        more = (side(few.where("c <> main"), "a", "band", F.col("c").alias("c_a"))
                .join(side(few, "b", "band", F.col("c").alias("c_b"), "main"), "band")
                .where(F.expr("c_a <> c_b AND (c_b = main OR a < b)") & _near(threshold, packed=True))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        beyond = rest.where(F.col("outside") > OUTSIDE).select("k", "c").distinct()
        if not beyond.isEmpty():
            rare = _rare_shingle_pairs(beyond, sketches, texts, threshold)
            more = more.unionByName(rare.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        edges = edges.unionByName(_edges(stage(_verified(more.distinct(), texts, threshold), "links")))
    return edges


def line_groups(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Occurrences ``(doc_id, text_hash, pos, k, k2, component, kept)`` of all lines
    that aren't blank. ``component`` is the least key of similar lines, null for
    a line that is similar to no other; ``kept`` marks each group's first line."""
    lines = _lines(docs, text)
    places = stage(lines.select("doc_id", "text_hash", "pos", *_keys()), "line-places")
    found = stage(connected_components(similar_lines(lines, threshold)), "line-components")
    places = places.join(found.withColumnRenamed("node", "k"), "k", "left")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "pos")
    group = [F.coalesce("component", "k").alias("g"),
             F.when(F.col("component").isNull(), F.col("k2")).alias("g2")]
    first = (places.select(*group, place.alias("place")).groupBy("g", "g2")
             .agg(F.min("place").alias("first"), F.max("place").alias("last"))
             .where("first <> last").select("g", "g2", "first"))
    first = stage(first, "line-winners")
    tagged = places.select("*", *group, place.alias("place")).alias("p")
    return (tagged.join(first.alias("f"), F.expr("p.g = f.g AND p.g2 <=> f.g2"), "left")
            .select("p.doc_id", "p.text_hash", "p.pos", "p.k", "p.k2", "p.component",
                    F.coalesce(F.expr("p.place = f.first"), F.lit(True)).alias("kept")))


def dedup_lines(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD,
                dropped_col: str = "n_dropped") -> DataFrame:
    """``docs`` with the repeated lines cut from ``text`` and a column
    ``dropped_col``: how many lines went.

    Lines are what ``\\n`` parts. Blank lines stay. Of equal and of similar
    lines, in one document or many, the first stays: smallest doc_id, then
    text hash, then place; null ids come last. Rows that agree in doc_id and
    text are the same document: they keep the same lines. Null and empty texts
    are left as they are; a text may become empty. An empty table stays empty;
    other columns pass through.
    """
    gone = (line_groups(docs, text, threshold).where("NOT kept")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone")))
    own = free_name(docs, "lines")
    cut = (docs.alias("d").join(gone.alias("g"), F.expr(
        f"xxhash64(d.{text}) = g.text_hash AND d.doc_id <=> g.doc_id"), "left")
        .select("d.*", F.col("g.gone").alias(own)))
    # a line's places are whole numbers from 0; array_except keeps their order.
    # The outer transform cuts the text once, not for every line
    places = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(own))
    whole = F.when(F.col(own).isNull(), F.col(text)).otherwise(F.element_at(F.transform(
        F.array(F.split(text, "\n")), lambda lines: F.array_join(
            F.transform(places(lines), lambda i: F.get(lines, i)), "\n")), 1))
    out = cut.select(*[whole.alias(c) if c == text else F.col(c) for c in docs.columns
                       if c != dropped_col],
                     F.coalesce(F.size(own), F.lit(0)).cast("long").alias(dropped_col))
    return out


def keep_first_lines(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: same columns, ``n_chars`` brought up to date. A
    document goes if lines were cut from it and nothing but blanks is left."""
    name = free_name(docs, "n_dropped")
    cut = dedup_lines(docs, dropped_col=name).where(
        (F.col(name) == 0) | (F.trim("text", F.lit(" \t\r\u000b\f\n")) != ""))
    cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
                         ) if "n_chars" in docs.columns else cut
    return cut.select(docs.columns)

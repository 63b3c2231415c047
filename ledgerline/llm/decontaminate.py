"""Benchmark decontamination with training suffix arrays.

Every Arrow batch of training texts is cut into shards of whole documents. A
shard's words become numbers, its suffixes are sorted by prefix doubling, and
all suffixes of the benchmark items are looked up in that suffix array by
binary search, one word deeper at a time. Occurrences of windows that follow
one another in both texts are joined, which gives the longest verbatim matches
and where they stand. A word that no item has ends a suffix: nothing of the
benchmark can match beyond it.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text;
each block is one more pass over the shards inside the same job, so neither
the driver nor a task ever holds more than a block. Documents are never
shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.staging import free_name
from ledgerline.llm.words import lower_words, slices

WINDOW = 10
SHARD_BYTES = 8 << 20     # text of a shard; a longer document is a shard of its own
BLOCK_BYTES = 8 << 20     # benchmark text that is held at once

FOUND = ("struct<n_words:bigint,n_hit:bigint,items:array<string>,"
         "spans:array<struct<item_id:string,item_start:bigint,doc_start:bigint,n_words:bigint>>>")
_SPAN = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()),
                   ("doc_start", pa.int64()), ("n_words", pa.int64())])


@dataclass
class TestBlock:
    """Items of a benchmark block, equal word sequences once, as numbers from 1."""
    vocabulary: pa.Array
    texts: list[np.ndarray]
    ids: list[list[str]]          # of each text, sorted as strings; nulls left out


def test_block(rows: list[tuple]) -> TestBlock:
    words, row_of = lower_words(pa.array([t for _, t in rows], type=pa.string()))
    coded = words.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.searchsorted(row_of, np.arange(len(rows) + 1))
    same: dict[bytes, set] = {}
    for (item, _), a, b in zip(rows, ends, ends[1:]):
        if b > a:
            same.setdefault(number[a:b].tobytes(), set()).update([] if item is None else [str(item)])
    return TestBlock(coded.dictionary, [np.frombuffer(k, dtype=np.int64) for k in same],
                     [sorted(v) for v in same.values()])


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts in suffix order, words from each position up to the next 0).

    Suffixes start at words other than 0, end before the next 0, and are
    ordered by their first ``depth`` words, shorter ones first.
    """
    n = len(tokens)
    stops = np.append(np.flatnonzero(tokens == 0), n)
    run = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
    order = np.flatnonzero(tokens)
    order = order[np.argsort(tokens[order], kind="stable")]
    rank = np.zeros(n + 1, dtype=np.int64)
    slots = np.arange(len(order))
    key = tokens[order]
    span = 1
    while True:
        first = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, dtype=bool)
        group = np.cumsum(first) - 1
        rank[order[slots]] = slots[np.flatnonzero(first)][group] + 1
        size = np.bincount(group) if len(group) else group
        longest = np.zeros(len(size), dtype=np.int64)
        np.maximum.at(longest, group, run[order[slots]])
        open_ = (size > 1) & (longest > span)
        slots = slots[open_[group]] if len(group) else slots
        if span >= depth or not len(slots):
            return order, run
        starts = order[slots]
        after = np.where(run[starts] > span, rank[np.minimum(starts + span, n)], 0)
        key = rank[starts] * (n + 2) + after
        by = np.argsort(key, kind="stable")
        order[slots], key = starts[by], key[by]
        span *= 2


def _bound(order, run, tokens, lo, hi, depth, word, after: bool) -> np.ndarray:
    """Per query, the first slot of [lo, hi) whose word at ``depth`` is not below
    (``after``: is above) the query's."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        start = order[mid]
        seen = np.where(run[start] > depth, tokens[np.minimum(start + depth, len(tokens) - 1)], 0)
        below = seen <= word[open_] if after else seen < word[open_]
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    return lo


def find_windows(tokens: np.ndarray, texts: list[np.ndarray], window: int):
    """(text, start in it, start in tokens, words) of each occurrence of each
    text's windows: ``window`` words, or all words of a shorter text."""
    order, run = suffix_array(tokens, window)
    size = np.array([min(window, len(t)) for t in texts])
    text = np.repeat(np.arange(len(texts)), [len(t) - s + 1 for t, s in zip(texts, size)])
    start = np.concatenate([np.arange(len(t) - s + 1) for t, s in zip(texts, size)])
    flat = np.concatenate(texts)
    base = (np.cumsum([len(t) for t in texts]) - [len(t) for t in texts])[text] + start
    need = size[text]
    lo, hi = np.zeros(len(text), dtype=np.int64), np.full(len(text), len(order), dtype=np.int64)
    for depth in range(window):
        at = np.flatnonzero((lo < hi) & (need > depth))
        word = flat[base[at] + depth]
        left = _bound(order, run, tokens, lo[at], hi[at], depth, word, after=False)
        right = _bound(order, run, tokens, left, hi[at], depth, word, after=True)
        lo[at], hi[at] = left, right
    met = np.flatnonzero(lo < hi)
    count = hi[met] - lo[met]
    which = np.repeat(met, count)
    slot = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]
    return text[which], start[which], order[slot], need[which]


def scan_shard(texts: pa.Array, block: TestBlock, window: int, before: list | None) -> list[dict]:
    """For each text what FOUND names; ``before`` has what earlier blocks found."""
    words, row_of = lower_words(texts)
    n_words = np.bincount(row_of, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    found = [{"n_words": int(n), "n_hit": 0, "items": [], "spans": []} for n in n_words]
    for row, old in zip(found, before or []):
        row["items"], row["spans"] = old["items"], old["spans"]
    touched = {i for i, row in enumerate(found) if row["spans"]}
    if block.texts and len(words):
        number = pa.compute.index_in(words, value_set=block.vocabulary)
        tokens = np.zeros(len(words) + len(texts), dtype=np.int64)
        tokens[np.arange(len(words)) + row_of] = pa.compute.fill_null(number, -1).to_numpy(
            zero_copy_only=False) + 1
        text, start, at, size = find_windows(tokens, block.texts, window)
        doc = np.searchsorted(first + np.arange(len(texts)), at, side="right") - 1
        place = at - (first + np.arange(len(texts)))[doc]
        by = np.lexsort((place, place - start, text, doc))
        text, start, place, size, doc = text[by], start[by], place[by], size[by], doc[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = ((doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1)
                   | (start[1:] != start[:-1] + 1))
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(by)) - 1
        for h, t in zip(heads.tolist(), tails.tolist()):
            row, ids = found[doc[h]], block.ids[text[h]]
            touched.add(int(doc[h]))
            row["items"] = row["items"] + ids
            row["spans"] = row["spans"] + [{
                "item_id": ids[0] if ids else None, "item_start": int(start[h]),
                "doc_start": int(place[h]), "n_words": int(place[t] + size[t] - place[h])}]
    for i in touched:
        hit = np.zeros(found[i]["n_words"], dtype=bool)
        for s in found[i]["spans"]:
            hit[s["doc_start"]:s["doc_start"] + s["n_words"]] = True
        found[i]["n_hit"] = int(hit.sum())
        found[i]["items"] = sorted(set(found[i]["items"]))
    return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    rows, size = [], 0
    for r in benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).toLocalIterator():
        if rows and size + len(r[1] or "") > BLOCK_BYTES:
            yield rows
            rows, size = [], 0
        rows.append((r[0], r[1]))
        size += len(r[1] or "")
    yield rows


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, found_col: str = "found") -> DataFrame:
    """``docs`` with a struct column ``found_col``: n_words, n_hit (words inside
    an occurrence of a window), items (ids of the items that have one, sorted as
    strings) and spans (longest verbatim matches, places counted in words).

    Windows are ``window`` consecutive item words; an item of fewer words is one
    window, one without words has none. Null texts have no words. Items with
    equal words are all reported, a span names the first of their ids; an item
    without an id marks words but is not listed. An empty benchmark finds
    nothing; an empty table stays empty; repeated rows are scanned each.
    """
    spark, out = docs.sparkSession, docs
    kind = T._parse_datatype_string(FOUND)
    for k, rows in enumerate(_blocks(benchmark, item_col, item_text_col)):
        block = spark.sparkContext.broadcast(test_block(rows))
        schema = T.StructType([*docs.schema.fields, T.StructField(found_col, kind)])

        def shards(batches, block=block, again=k > 0):
            for batch in batches:
                for part in slices(batch, text_col, SHARD_BYTES):
                    columns = part.columns[:-1] if again else part.columns
                    names = part.schema.names[:-1] if again else part.schema.names
                    texts = part.column(part.schema.get_field_index(text_col))
                    before = part.columns[-1].to_pylist() if again else None
                    found = scan_shard(texts, block.value, window, before)
                    made = pa.array(found, type=pa.struct([
                        ("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))]))
                    yield pa.RecordBatch.from_arrays([*columns, made], names=[*names, found_col])

        out = out.mapInArrow(shards, schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (same columns) without those that hold a window of the benchmark."""
    name = free_name(docs, "found")
    return (scan(docs, benchmark, window=window, found_col=name)
            .where(F.col(name)["n_hit"] == 0).select(docs.columns))

import re

import pyarrow as pa

from ledgerline.llm.words import lower_words, slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_words_and_slices():
    texts = ["Ab, c3-É!", None, "", "  ", "\x00x\x7fy\u2028z"]
    got, rows = lower_words(pa.array(texts))
    assert got.to_pylist() == [w for t in texts for w in words(t)]
    assert rows.tolist() == [i for i, t in enumerate(texts) for _ in words(t)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(5))], names=["t", "n"])
    parts = list(slices(batch, "t", 3))
    assert sum((p.column(1).to_pylist() for p in parts), []) == list(range(5))
    assert parts[0].num_rows == 1

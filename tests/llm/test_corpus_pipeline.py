import random

import corpus_pipeline as CP
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, domain string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(3)
    items = [words(rng, 25) for _ in range(3)]
    texts = {i: "\n".join(words(rng, 40) for _ in range(4)) for i in range(120)}
    shared = words(rng, 60)
    for i in (3, 4, 5):
        texts[i] += "\n" + shared                         # a line in several documents
    texts[10], texts[11] = texts[9], texts[9]              # exact copies
    near = texts[20].split()
    texts[21] = " ".join(near[:80] + ["changed"] + near[80:])          # one line, nearly the same words
    texts[30] += " " + items[1]                            # a benchmark passage
    for i in range(80, 110):
        texts[i] = " ".join(w + "$$$" for w in texts[i].split())       # junk
    texts[110], texts[111], texts[112] = None, "", "too short"
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}", len(t or ""), "x") for i, t in texts.items()]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string"
                          ).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < 80)) for i in range(0, 110, 2)], "doc_id long, quality int"
                          ).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_each_stage_takes_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, function in CP.STAGES:
        docs = function(spark, docs, sf_dir)
        if name != "mixing":
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert list(seen) == ["quality_rules", "line_dedup", "simhash_near_dedup",
                          "benchmark_decontamination", "mixing"]
    good = set(range(80)) | set(range(113, 120))
    assert seen["quality_rules"].keys() == good
    lines = seen["line_dedup"]
    assert lines.keys() == good - {10, 11}
    assert lines[3].text.count("\n") == 4 and lines[4].text.count("\n") == 3
    assert all(r.n_chars == len(r.text) for r in lines.values())
    assert seen["simhash_near_dedup"].keys() == lines.keys() - {21}
    assert seen["benchmark_decontamination"].keys() == seen["simhash_near_dedup"].keys() - {30}
    assert seen["mixing"].keys() <= seen["benchmark_decontamination"].keys()
    assert all(r.copies > 0 and r.domain.startswith("d") for r in seen["mixing"].values())


def test_line_dedup_stage_ties_edited_copies_by_their_original(spark, sf_dir):
    rng = random.Random(11)
    rows = []
    for first in (0, 1000):
        base = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(60)]
        texts = [" ".join(base)]
        for _ in range(200):
            w = list(base)
            for at in rng.sample(range(60), 3):
                w[at] = "".join(rng.choices("qrstuvwxyz", k=6))
            texts.append(" ".join(w))
        rows += [(first + i, t, "en", "src", len(t), "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = {r.doc_id for r in dict(CP.STAGES)["line_dedup"](spark, docs, sf_dir).collect()}
    # the bands miss a few of the 400 links
    assert {0, 1000} <= kept and len(kept) <= 20, sorted(kept)


def test_run_gives_the_last_stage(spark, sf_dir):
    out = CP.run(spark, sf_dir)
    assert {"doc_id", "domain", "n_tokens", "copies"} <= set(out.columns) and out.count() > 0


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, function in CP.STAGES:
        docs = function(spark, docs, sf_dir)
        assert docs.count() == 0

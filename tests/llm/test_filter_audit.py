"""The audit against a walk through every order, and its defined cases. SQL: test_llm_oracle."""
import re
from collections import defaultdict
from itertools import permutations

from ledgerline.llm import filter_audit as FA

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(120))


def walked(rows, labels):
    """Removes documents one filter after the other."""
    texts = [(i, t or "", lang or "") for i, t, lang in rows]
    fails = []
    for i, t, _ in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, shapley = {}, defaultdict(int)
    for part in {p for _, _, p in texts}:
        mine = [(i, f) for (i, _, p), f in zip(texts, fails) if p == part]
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, x in enumerate(order, 1):
                removed = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(f[x] for _, f in gone),
                    sum(f[x] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
                gone += removed
                shapley[part, x] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels, docs=DOCS):
    got = FA.audit(spark.createDataFrame(rows, docs), spark.createDataFrame(labels, LABELS)).collect()
    return {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"])
        for r in got}


ROWS = [(1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (4, "", "en"), (5, None, "en"),
        (6, None, None), (7, LONG + " #", "en"), (8, "AB " * 150, "en"), (9, "SHOUT $ " * 3, "fr"), (None, LONG, "en"),
        (None, None, "fr"), (10, "a b " * 200, "fr"), (11, LONG + " ", "en"), (12, "x" * 100_000, "en"),
        (12, "#" * 9, "de"), (1, LONG, "en")]
MARKS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (5, None, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1), (12, 1, 0)]


def test_against_a_walk_through_every_order(spark):
    got = audited(spark, ROWS, MARKS)
    assert got == walked(ROWS, MARKS) and len(got) == 600 * 4


def test_a_text_that_fills_a_third_of_the_table(spark):
    rows = [(i, LONG if i % 3 == 0 else f"{LONG} {i}", "en") for i in range(300)]
    got = audited(spark, rows, [(0, 1, 0), (3, 1, 1)])
    assert got["en", "EABCD", 1] == (201, 99, 0, 99, 1, 1, 99 * 120)


def test_no_labels_no_documents_and_clashing_columns(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, ROWS, []) == walked(ROWS, [])
    names = DOCS + ", part string, mask int, n int, hash string, good int, first_id int, step int"
    wide = [(*r, "p", 1, 2, "h", 3, 4, 5) for r in ROWS]
    assert audited(spark, wide, MARKS, names) == walked(ROWS, MARKS)

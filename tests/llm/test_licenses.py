import random

from ledgerline.llm import licenses as LI
from test_llm_words import words


def brute_base(text):
    w = words(text)
    places, labels = [], set()
    for phrase, label in LI.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def test_base_matches_brute_force(spark):
    rng = random.Random(4)
    vocab = "under the MIT license apache version 2 cc by nc nd Gnu general public é other".split()
    texts = [rng.choice([" ", "-", ",\n"]).join(rng.choices(vocab, k=rng.randint(0, 200)))
             for _ in range(80)]
    texts += [None, "", "cc by nc cc by nc", "CC-BY-NC", "apache license version 2.0",
              "under the mit licenses", "x " * 5000 + "under the MIT License"]
    got = LI.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    rows = {r.doc_id: r.scanned for r in got.collect()}
    for i, t in enumerate(texts):
        s = rows[i]
        assert (s.n_words, s.n_base, s.first_word, s.last_word, s.base_labels) == brute_base(t)
        assert set(s.base_labels) <= set(s.labels) and 0 <= s.score <= 1
        assert s["labels"] == sorted(set(s["labels"]))


def labels_of(text):
    rules = LI.standard_rules()
    watched = frozenset().union(*(r.needs for r in rules), *(p.split() for p in LI.BASE_PHRASES))
    return LI.scan_text(text, rules, watched)["labels"]


def test_hundreds_of_rules_and_their_order():
    rules = LI.standard_rules()
    assert len(rules) > 300
    assert labels_of("Licensed under the GNU Lesser General Public License, version 2.1") == ["lgpl-2.1"]
    assert labels_of("licensed under the GNU General Public License, version 3.") == ["gpl-3"]
    assert labels_of("SPDX-License-Identifier: AGPL-3.0-or-later") == ["agpl-3"]
    assert labels_of("Licensed under CC BY-SA 4.0.") == ["cc-by-sa"]
    assert labels_of("Licensed under CC BY-NC-ND 4.0") == ["cc-by-nc", "cc-by-nc-nd"]   # base label stays
    assert labels_of("Wir gehen mit dem Hund. The license plate.") == []


def test_bsd_grant_with_any_holder(spark):
    grant = ("Redistributions of source code ... redistribution. Neither the name of {} nor the names of its "
             "contributors may be used to endorse or promote products derived from it")
    holders = ["Acme", "Universität Zürich", "the regents of " + "a very long name " * 12,
               "nobody. Neither the name of Éire"]
    df = spark.createDataFrame([(i, grant.format(h)) for i, h in enumerate(holders)] + [
        (9, grant.format("x").replace("nor the names", "or names"))], "doc_id long, text string")
    got = {r.doc_id: r.scanned.labels for r in LI.scan(df).collect()}
    assert all("bsd-3" in got[i] for i in range(len(holders))) and "bsd-3" not in got[9], got


def test_suppression_by_containment():
    d = lambda label, priority, a, b: LI.Detection(label, priority, 0.5, a, b)
    kept = LI.suppress([d("in", 2, 3, 5), d("out", 1, 2, 8), d("over", 2, 5, 9), d("long", 3, 20, 30),
                        d("short", 3, 22, 25), d("same", 3, 20, 30)])
    assert [k.label for k in kept] == ["out", "over", "long"]


def test_empty_table_and_clashes(spark):
    df = spark.createDataFrame([(1, "MIT license", "x"), (1, "MIT license", "x")],
                               "doc_id long, text string, labels string")
    rows = LI.scan(df).collect()
    assert rows[0] == rows[1] and rows[0].scanned["labels"] == ["mit"] and rows[0]["labels"] == "x"
    assert LI.scan(df.limit(0)).count() == 0

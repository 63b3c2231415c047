"""Cleaners on micro-frames: T1, T4, T5, T11, imputation, conservation, determinism."""
import datetime as dt


from ledgerline.operators import clean as C
from ledgerline.operators.median import exact_median

TXN_SCHEMA = ("transaction_id string, account_id string, transaction_date string, "
              "transaction_amount string, transaction_type string, payment_status string, "
              "channel string")


def txns(spark, rows):
    return spark.createDataFrame(rows, TXN_SCHEMA)


def test_null_predicate_row_is_rejected_not_lost(spark):          # T1
    raw = txns(spark, [
        ("T1", "A1", "2024-01-05", "10.00", "Deposit", "Success", "ATM"),
        ("T2", "A1", "2024-01-05", "10.00", None, "Success", "ATM"),       # NULL type
        ("T3", "A1", "2024-01-05", "-5.00", "Deposit", "Success", "ATM"),
        ("T4", None, "2024-01-05", "5.00", "Deposit", "Success", "ATM"),
    ])
    split = C.clean_transactions(raw)
    assert [r.transaction_id for r in split.valid.collect()] == ["T1"]
    reasons = {r.transaction_id: r.reject_reason for r in split.rejected.collect()}
    assert reasons == {"T2": "invalid_transaction_type", "T3": "non_positive_amount",
                       "T4": "missing_account_id"}


def test_highest_amount_wins_and_conflicts_are_rejected(spark):  # T4
    raw = txns(spark, [
        ("T1", "A1", "2024-01-05", "10.00", "Deposit", "Success", "ATM"),
        ("T1", "A1", "2024-01-05", "1009.00", "Deposit", "Success", "ATM"),
        ("T1", "A1", "2024-01-05", "10.00", "Deposit", "Success", "ATM"),  # exact re-send
    ])
    split = C.clean_transactions(raw)
    assert [r.transaction_amount for r in split.valid.collect()] == [1009.0]
    rej = split.rejected.collect()
    assert [(r.transaction_amount, r.reject_reason) for r in rej] == [(10.0, "duplicate_id_conflict")]


def test_ties_are_broken_deterministically(spark):                # T5
    rows = [("T1", "A1", "2024-01-05", "10.00", "Deposit", "Success", ch)
            for ch in ("POS", "ATM", "Branch", "Mobile App")]
    winners = set()
    for n in (1, 3, 7):
        raw = txns(spark, rows).repartition(n)
        v = C.clean_transactions(raw).valid.collect()
        assert len(v) == 1
        winners.add(v[0].channel)
    assert winners == {"ATM"}                                       # smallest remaining column


def test_conservation_in_equals_dups_plus_valid_plus_rejected(spark):
    rows = [("T%d" % (i % 7), "A%d" % (i % 3) if i % 11 else None,
             ["2024-01-05", "05-01-2024", "bad", ""][i % 4], str((i % 9) - 2 + 0.5),
             ["Deposit", "Wire", None][i % 3], "Success", "ATM") for i in range(60)]
    raw = txns(spark, rows + rows[:10])                              # 10 exact re-sends
    split = C.clean_transactions(raw)
    n_in = raw.count()
    n_distinct = C.standardise_transactions(raw).dropDuplicates().count()
    assert n_in == (n_in - n_distinct) + split.valid.count() + split.rejected.count()
    valid_ids = {r.transaction_id for r in split.valid.collect()}
    assert len(valid_ids) == split.valid.count()                    # one row per id


def test_orphans_split_after_ranking(spark):                       # T11
    raw = txns(spark, [
        ("T1", "A9", "2024-01-05", "99.00", "Deposit", "Success", "ATM"),   # best, orphan
        ("T1", "A1", "2024-01-05", "10.00", "Deposit", "Success", "ATM"),   # valid account
    ])
    accounts = spark.createDataFrame([("A1",)], "account_id string")
    best = C.clean_transactions(raw).valid
    split = C.split_orphans(best, accounts)
    assert split.valid.count() == 0                                 # the id is lost, as in the reference
    assert [r.reject_reason for r in split.rejected.collect()] == ["orphan_account"]


CUST_SCHEMA = ("customer_id string, first_name string, last_name string, dob string, "
               "gender string, email string, phone string, city string, country string, "
               "customer_income string, credit_score string, customer_since string")


def cust(cid, income, score, since="2020-01-01", city=" mumbai "):
    return (cid, "F", "L", "1990-02-03", "Male", " A@B.COM ", "1", city, "India", income,
            score, since)


def test_customer_imputation_and_standardisation(spark):
    raw = spark.createDataFrame([
        cust("C1", "100.0", "600.0"), cust("C2", "300.0", "700"), cust("C3", None, None),
        cust("C4", "200.0", "650"), cust("C4", "200.0", "650"),       # exact duplicate
        cust(None, "900.0", "800"),                                  # no id -> rejected
    ], CUST_SCHEMA)
    split = C.clean_customers(raw)
    rows = {r.customer_id: r for r in split.valid.collect()}
    assert set(rows) == {"C1", "C2", "C3", "C4"}
    # medians over the de-duplicated rows incl. the NULL-id row: income 100,200,300,900
    assert rows["C3"].customer_income == 250.0
    assert rows["C3"].credit_score == 675                           # (650+700)/2 truncated
    assert rows["C1"].credit_score == 600                           # '600.0' -> 600
    assert rows["C1"].email == "a@b.com" and rows["C1"].city == "Mumbai"
    assert rows["C1"].customer_since == dt.date(2020, 1, 1)
    assert [r.reject_reason for r in split.rejected.collect()] == ["missing_customer_id"]


def test_all_null_medians(spark):
    raw = spark.createDataFrame([cust("C1", None, None)], CUST_SCHEMA)
    row = C.clean_customers(raw).valid.first()
    assert row.customer_income is None and row.credit_score == 650


def test_key_dedup_rejects_losers(spark):
    raw = spark.createDataFrame([cust("C1", "1.0", "600", city="b"),
                                 cust("C1", "1.0", "600", city="a")], CUST_SCHEMA)
    split = C.clean_customers(raw, medians=(1.0, 600))
    assert [r.city for r in split.valid.collect()] == ["A"]
    assert [r.reject_reason for r in split.rejected.collect()] == ["duplicate_customer_id"]


def test_accounts_reject_null_type(spark):
    raw = spark.createDataFrame([("A1", "C1", "Savings", "B1", "01/31/2024", "Active"),
                                 ("A2", "C1", None, "B1", "2024-01-31", "Active"),
                                 ("A3", None, "Savings", "B1", "2024-01-31", "Active")],
                                "account_id string, customer_id string, account_type string, "
                                "branch_id string, account_opened_date string, "
                                "account_status string")
    split = C.clean_accounts(raw)
    v = split.valid.collect()
    assert [(r.account_id, r.account_opened_date) for r in v] == [("A1", dt.date(2024, 1, 31))]
    assert {r.account_id: r.reject_reason for r in split.rejected.collect()} == {
        "A2": "invalid_account_type", "A3": "missing_customer_id"}


def test_loans_reject_null_and_non_positive_amounts(spark):
    raw = spark.createDataFrame([("L1", "C1", "Home Loan", "100.5", "7.5", "12.0", "2024-01-01",
                                  "Active", "Success"),
                                 ("L2", "C1", "Home Loan", None, "7.5", "12", "2024-01-01",
                                  "Active", "Success"),
                                 ("L3", "C1", "Home Loan", "0", "7.5", "12", "2024-01-01",
                                  "Active", "Success")],
                                "loan_id string, customer_id string, loan_type string, "
                                "loan_amount string, interest_rate string, tenure_months string, "
                                "loan_start_date string, loan_status string, "
                                "emi_payment_status string")
    split = C.clean_loans(raw)
    v = split.valid.first()
    assert (v.loan_id, v.loan_amount, v.tenure_months) == ("L1", 100.5, 12)
    assert {r.loan_id: r.reject_reason for r in split.rejected.collect()} == {
        "L2": "missing_amount", "L3": "non_positive_amount"}


def test_branches_keep_one_null_id(spark):
    raw = spark.createDataFrame([(None, "X", "c", "n"), (None, "Y", "c", "n"),
                                 ("B1", "Z", "c", "n")],
                                "branch_id string, branch_name string, city string, country string")
    assert C.clean_branches(raw).count() == 2


def test_exact_median_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    for n in (1, 2, 999, 1000):
        vals = rng.integers(0, 50_000, size=n).astype(float)
        df = spark.createDataFrame([(float(v),) for v in vals], "x double")
        assert exact_median(df, "x") == float(np.median(vals))
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_median(df, "x") is None


def test_exact_medians_two_columns_with_one_crowded(spark):
    """A column with many distinct values must not crowd out another's candidates."""
    import numpy as np
    from ledgerline.operators.median import exact_medians
    rng = np.random.default_rng(3)
    a = rng.integers(0, 10_000, size=501).astype(float)
    b = rng.integers(0, 5, size=501).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = exact_medians(df, ["a", "b"])
    assert got == {"a": float(np.median(a)), "b": float(np.median(b))}


def test_rows_that_become_equal_are_all_accounted_for(spark):
    """Conservation: rows in = exact copies + valid + rejected, for every entity."""
    accounts = spark.createDataFrame(
        [("A1", "C1", "Savings", "1", d, "Active") for d in ("2024-01-05", "05-01-2024", "01/05/2024",
                                                            "2024-01-05")]
        + [("A2", "C1", "Nope", "1", "2024-01-05", "Active")],
        "account_id string, customer_id string, account_type string, branch_id string, "
        "account_opened_date string, account_status string")
    customers = spark.createDataFrame(
        [("1", "a", "b", None, "F", mail, "0", city, "X", "10", "700", None)
         for mail, city in ((" X@y.com", "rome"), ("x@y.com", "Rome"), ("x@y.com", "Oslo"), ("x@y.com", "Rome"))],
        "customer_id string, first_name string, last_name string, dob string, gender string, "
        "email string, phone string, city string, country string, customer_income string, "
        "credit_score string, customer_since string")
    loans = spark.createDataFrame(
        [("L1", "C1", "t", amount, "7.5", "12", d, "Active", "Success")
         for amount, d in (("10", "2024-01-05"), ("10.0", "05-01-2024"), ("11", "2024-01-05"), ("-1", "x"))],
        "loan_id string, customer_id string, loan_type string, loan_amount string, interest_rate string, "
        "tenure_months string, loan_start_date string, loan_status string, emi_payment_status string")
    for raw, clean in ((accounts, C.clean_accounts), (customers, C.clean_customers), (loans, C.clean_loans)):
        split, n = clean(raw), raw.dropDuplicates().count()
        assert split.valid.count() == 1
        assert split.valid.count() + split.rejected.count() == n
        given = split.rejects_given(split.valid)
        assert sorted(map(str, given.collect())) == sorted(map(str, split.rejected.select(given.columns).collect()))
    assert {r.reject_reason for r in C.clean_accounts(accounts).rejected.collect()} == {
        "duplicate_account_id", "invalid_account_type"}


def test_re_sends_are_rejected_once_and_never_win_twice(spark):
    """Exact re-sends, hot ones too, among winners, losers and invalid rows."""
    t = lambda i, amount, kind="Deposit": (i, "A1", "2024-01-05", amount, kind, "Success", "ATM")
    raw = txns(spark, [t("T1", "5")] * 40 + [t("T2", "9")] * 3 + [t("T2", "7")] * 3 + [t("T2", "7.0")] + [t("T2", "6")]
               + [t("T3", "1", "Nope")] * 5 + [t(None, "1")] * 2)
    split = C.clean_transactions(raw)
    assert sorted((r.transaction_id, r.transaction_amount) for r in split.valid.collect()) == [("T1", 5.0), ("T2", 9.0)]
    expected = sorted([("T2", 7.0, "duplicate_id_conflict"), ("T2", 6.0, "duplicate_id_conflict"),
                       ("T3", 1.0, "invalid_transaction_type"), ("None", 1.0, "missing_transaction_id")])
    for rejected in (split.rejected, split.rejects_given(split.valid)):
        assert sorted((str(r.transaction_id), r.transaction_amount, r.reject_reason)
                      for r in rejected.collect()) == expected


def test_orphans_of_written_transactions(spark):
    rows = txns(spark, [(f"T{i}", a, "2024-01-05", "1", "Deposit", "Success", "ATM")
                        for i, a in enumerate(["A1", "A2", "A9", "A9", None])])
    accounts = spark.createDataFrame([("A1",), ("A2",), (None,)], "account_id string")
    found = C.orphans(rows, accounts)
    old = C.split_orphans(rows, accounts).rejected
    assert sorted(map(str, found.select(old.columns).collect())) == sorted(map(str, old.collect()))
    assert found.count() == 3


def _conflicts(spark, scratch):
    """Tagged transactions with re-sends, conflicts, ties and invalid rows sent twice, written."""
    rows = [(f"T{i % 300}", f"A{i % 7}" if i % 11 else None, "2024-03-05" if i % 13 else None,
             "nan" if i % 17 == 0 else f"{i % 40 + 1}.25", "Deposit", "Success" if i % 3 else None, "ATM")
            for i in range(420)]
    rows += rows[::5] + rows[::50] + [("T1", "A1", "05-03-2024", "2.25", " Deposit", "Success", "ATM")]
    raw = spark.createDataFrame(rows, "transaction_id string, account_id string, transaction_date string, "
                                "transaction_amount string, transaction_type string, payment_status string, "
                                "channel string")
    C.tag_transactions(raw).write.parquet(f"{scratch}/tagged")
    return spark.read.parquet(f"{scratch}/tagged")


def _sorted(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_winners_and_losers_of_written_rivals(spark, scratch):                       # F2, F3, F4
    split = C.split_tagged(_conflicts(spark, scratch), "transaction_id", [("transaction_amount", "desc")], "conflict")
    split.repeated().write.parquet(f"{scratch}/repeated")
    repeated = spark.read.parquet(f"{scratch}/repeated")
    split.rivals(repeated).write.parquet(f"{scratch}/rivals")
    rivals = spark.read.parquet(f"{scratch}/rivals")
    assert 0 < rivals.count() < split.candidates.count() // 2          # the others are not shuffled
    assert _sorted(split.valid_of(repeated, rivals)) == _sorted(split.valid)
    assert _sorted(split.rejects_of(rivals)) == _sorted(split.rejected)
    assert _sorted(split.valid_given(repeated)) == _sorted(split.valid)
    assert _sorted(split.rejects_given(split.valid, repeated)) == _sorted(split.rejected)


def test_invalid_rows_that_come_once_are_not_shuffled(spark, scratch):               # F2, F3, F4
    tagged = _conflicts(spark, scratch)
    assert _sorted(C.distinct_rows(tagged)) == _sorted(tagged.dropDuplicates())
    nulls = spark.createDataFrame([(1, None), (None, 1), (1, None), (None, None), (None, None)], "a int, b int")
    assert _sorted(C.distinct_rows(nulls)) == _sorted(nulls.dropDuplicates())
    plan = C.distinct_rows(tagged)._jdf.queryExecution().executedPlan().toString()
    assert any("LeftAnti" in x for x in plan.splitlines())             # unique rows leave before any exchange


def test_rows_of_unknown_keys_are_marked(spark):
    rows = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "X"), (5, "X")], "n int, k string")
    known = spark.createDataFrame([("A",), ("B",), ("C",)], "k string")
    got = {r.n: r.u for r in C.marked_unknown(rows, known, "k", "u").collect()}
    assert got == {1: False, 2: False, 3: True, 4: True, 5: True}

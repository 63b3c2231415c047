"""CSV ingestion and the landing zone."""
import os

from ledgerline.sources import ingest as I

HEADER = "transaction_id,account_id,transaction_date,transaction_amount,transaction_type,payment_status,channel"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def only_txn():
    return {"transactions": I.S.REQUIRED_COLUMNS["transactions"]}


def test_columns_bind_by_name_and_short_rows_pad(spark, scratch):
    reordered = ("account_id,transaction_id,transaction_date,transaction_amount,"
                 "transaction_type,payment_status,channel,extra_col")
    write(f"{scratch}/raw/transactions.csv",
          f"{reordered}\nA1,T1,2024-01-05,10.5,Deposit,Success,ATM,x\nA2,T2,2024-01-06\n")
    rep = I.ingest_all(spark, f"{scratch}/raw", f"{scratch}/landing", "2026-01-02", only_txn())
    assert rep.ok, rep.results
    r = rep.results[0]
    assert (r.row_count, r.column_count) == (2, 8)
    assert I.latest_ingest_date(spark, f"{scratch}/landing") == "2026-01-02"
    df = I.read_landing(spark, f"{scratch}/landing", "transactions", "2026-01-02")
    rows = {x.transaction_id: x for x in df.collect()}
    assert rows["T1"].account_id == "A1" and rows["T1"].extra_col == "x"   # extra passes through
    assert rows["T2"].payment_status is None                               # padded
    assert dict(df.dtypes)["transaction_amount"] == "string"               # landed untouched


def test_failures_are_recorded_and_others_continue(spark, scratch):
    raw = f"{scratch}/raw"
    write(f"{raw}/transactions.csv", f"{HEADER}\nT1,A1,2024-01-05,1,Deposit,Success,ATM,EXTRA\n")
    write(f"{raw}/branches.csv", "branch_id,branch_name,city,country\n")          # header only
    write(f"{raw}/accounts.csv", "account_id,customer_id\nA1,C1\n")               # missing cols
    write(f"{raw}/loans.csv", "loan_id,customer_id,loan_type,loan_amount,interest_rate,"
          "tenure_months,loan_start_date,loan_status,emi_payment_status\nL1,C1,x,1,1,1,d,s,e\n")
    rep = I.ingest_all(spark, raw, f"{scratch}/landing", "2026-01-02")
    status = {r.source_name: r for r in rep.results}
    assert not rep.ok
    assert status["transactions"].status == "FAILED" and status["transactions"].malformed_rows == 1
    assert status["branches"].error == "File parsed but contains zero rows."
    assert status["accounts"].missing_columns == ["account_type", "branch_id",
                                                  "account_opened_date", "account_status"]
    assert "not found" in status["customers"].error
    assert status["loans"].status == "SUCCESS"
    manifest = rep.manifest(spark)
    assert manifest.count() == 5
    I.write_manifest(spark, rep, f"{scratch}/manifest")
    assert spark.read.json(f"{scratch}/manifest").count() == 5


BRANCH = "branch_id,branch_name,city,country"


def land(spark, scratch, name="branches"):
    rep = I.ingest_all(spark, f"{scratch}/raw", f"{scratch}/landing", "2026-01-02",
                       {name: I.S.REQUIRED_COLUMNS[name]})
    return rep.results[0], (I.read_landing(spark, f"{scratch}/landing", name, "2026-01-02").collect()
                            if rep.ok else None)


def test_quotes_line_breaks_and_missing_texts(spark, scratch):
    write(f"{scratch}/raw/branches.csv",
          f'{BRANCH}\n1,"two\nlines","He said ""hi"", ok",NA\n2, kept blank ,"",null\n3,N/A,NaN,x\n')
    result, rows = land(spark, scratch)
    assert (result.status, result.row_count, result.malformed_rows) == ("SUCCESS", 3, 0)
    assert [tuple(r) for r in sorted(rows)] == [
        ("1", "two\nlines", 'He said "hi", ok', None), ("2", " kept blank ", None, None),
        ("3", None, None, "x")]


def test_part_files_with_their_own_column_order(spark, scratch):
    write(f"{scratch}/raw/branches.csv/part-0.csv", f"{BRANCH}\n1,a,b,c\n")
    write(f"{scratch}/raw/branches.csv/part-1.csv", "country,city,branch_name,branch_id\nc2,b2,a2,2\n")
    result, rows = land(spark, scratch)
    assert result.row_count == 2
    assert {(r.branch_id, r.branch_name, r.city, r.country) for r in rows} == {
        ("1", "a", "b", "c"), ("2", "a2", "b2", "c2")}


def test_unreadable_source_fails_alone_and_a_rerun_replaces(spark, scratch):
    os.makedirs(f"{scratch}/raw", exist_ok=True)
    write(f"{scratch}/raw/branches.csv", f"{BRANCH}\n1,a,b,c\n")
    os.makedirs(f"{scratch}/raw/accounts.csv")
    with open(f"{scratch}/raw/accounts.csv/part-0.csv.gz", "wb") as f:
        f.write(b"\x1f\x8b not a gzip file")
    sources = {n: I.S.REQUIRED_COLUMNS[n] for n in ("branches", "accounts")}
    for _ in range(2):
        rep = I.ingest_all(spark, f"{scratch}/raw", f"{scratch}/landing", "2026-01-02", sources)
        assert {r.source_name: r.status for r in rep.results} == {"branches": "SUCCESS", "accounts": "FAILED"}
        assert I.read_landing(spark, f"{scratch}/landing", "branches", "2026-01-02").count() == 1


def test_header_is_checked_before_the_rows(spark, scratch):
    write(f"{scratch}/raw/branches.csv", "branch_id,city\n1,x,surplus\n")
    result, _ = land(spark, scratch)
    assert result.missing_columns == ["branch_name", "country"] and result.row_count == 0
    assert not os.path.exists(f"{scratch}/landing/branches")


def jobs_of(spark, fn):
    """How many Spark jobs a call starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"ingest-{fn.__name__}-{id(fn)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_the_number_of_jobs_does_not_follow_the_number_of_files(spark, scratch):
    for n in (3, 60):
        for i in range(n):
            columns = BRANCH.split(",")[::-1 if i % 2 else 1]
            values = dict(zip(BRANCH.split(","), (str(i), f"n{i}", "c", "d")))
            write(f"{scratch}/{n}/part-{i}.csv", ",".join(columns) + "\n" + ",".join(values[c] for c in columns) + "\n")

    def look(n):
        def run():
            rows = I.read_csv_text(spark, f"{scratch}/{n}").collect()
            assert {(r.branch_id, r.branch_name) for r in rows} == {(str(i), f"n{i}") for i in range(n)}
        return run
    few, many = jobs_of(spark, look(3)), jobs_of(spark, look(60))
    assert many <= few + 2, (few, many)


def test_few_and_many_files_take_the_same_number_of_jobs(spark, scratch):
    """Both callables live through both counts, so their job groups differ."""
    for n in (3, 60):
        for i in range(n):
            write(f"{scratch}/{n}/part-{i}.csv", f"{BRANCH}\n{i},n{i},c,d\n")
    looks = [lambda n=n: I.read_csv_text(spark, f"{scratch}/{n}").collect() for n in (3, 60)]
    few, many = [jobs_of(spark, look) for look in looks]
    assert 0 < few and many <= few + 2, (few, many)


def partitions_with_rows(df):
    from pyspark.sql import functions as F
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_a_file_without_quoted_breaks_is_read_by_many_tasks(spark, scratch):
    rows = "".join(f'{i},"name, ""{i}""",city,{i * 7}\n' for i in range(60_000))
    write(f"{scratch}/plain.csv", f"{BRANCH}\n{rows}")
    write(f"{scratch}/broken.csv", f'{BRANCH}\n{rows}x,"two\nlines",c,d\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        plain, broken = (I.read_csv_text(spark, f"{scratch}/{n}.csv") for n in ("plain", "broken"))
        assert partitions_with_rows(plain) > 4 and plain.count() == 60_000
        assert partitions_with_rows(broken) == 1 and broken.count() == 60_001
        assert plain.exceptAll(broken).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_headers_with_breaks_blanks_and_repeated_names(spark, scratch):
    write(f"{scratch}/a.csv", '\n"branch\nid",x,X,\n1,2,3,4\n')
    df = I.read_csv_text(spark, f"{scratch}/a.csv")
    assert df.columns == ["branch\nid", "x1", "X2", "_c3", "_extra"] and tuple(df.first()) == ("1", "2", "3", "4", None)
    write(f"{scratch}/b.csv", 'id,id,\n1,2,3\n')
    assert I.read_csv_text(spark, f"{scratch}/b.csv").columns == I._whole_header(spark, f"{scratch}/b.csv") + ["_extra"]


def test_torn_rows_fail_and_stray_quotes_do_not(spark, scratch):
    write(f"{scratch}/raw/branches.csv", f'{BRANCH}\n1,a,b,c\n2,"a,b\n3,x,y,z\n')
    result, _ = land(spark, scratch)
    assert result.status == "FAILED" and "inside a quoted field" in result.error
    write(f"{scratch}/raw/branches.csv", f'{BRANCH}\n1,a 5" pipe,b,c\n2,"",b,"c"\n')
    result, rows = land(spark, scratch)
    assert result.status == "SUCCESS" and {r.branch_name for r in rows} == {'a 5" pipe', None}


def test_a_reader_sees_the_old_partition_until_the_new_one_is_committed(spark, scratch, monkeypatch):
    write(f"{scratch}/raw/branches.csv", f"{BRANCH}\n1,a,b,c\n")
    land(spark, scratch)
    seen, commit = [], I.commit

    def watched(record, path, key):
        # all of the new rows are written, the record isn't
        seen.append(I.read_landing(spark, f"{scratch}/landing", "branches", "2026-01-02").count())
        commit(record, path, key)
    monkeypatch.setattr(I, "commit", watched)
    write(f"{scratch}/raw/branches.csv", f"{BRANCH}\n1,a,b,c\n2,a,b,c\n")
    result, rows = land(spark, scratch)
    assert seen == [1] and len(rows) == 2

    def lost(*_):
        raise RuntimeError("driver lost before the commit")
    monkeypatch.setattr(I, "commit", lost)
    write(f"{scratch}/raw/branches.csv", f"{BRANCH}\n3,a,b,c\n")
    result, _ = land(spark, scratch)
    assert result.status == "FAILED"
    assert I.read_landing(spark, f"{scratch}/landing", "branches", "2026-01-02").count() == 2


def test_commit_records(spark, scratch):
    from ledgerline.sources.commits import commit, in_force
    path = f"{scratch}/log"
    assert in_force(spark, path, ["k"]) is None
    row = lambda k, v: spark.createDataFrame([(k, v)], "k string, v long")
    for k, v in (("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5)):
        commit(row(k, v), path, ["k"])
    assert {(r.k, r.v) for r in in_force(spark, path, ["k"]).collect()} == {("a", 3), ("b", 2), (None, 5)}

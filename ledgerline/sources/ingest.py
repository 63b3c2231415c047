"""Raw CSV ingestion into a landing zone by ingest date.

Per source: the file must exist (S2), parse without over-long or torn rows (S3),
hold at least one row (S4) and carry every required column (S5); then it is
landed untouched, all columns as text, under ``ingest_date=YYYY-MM-DD`` (S6).
One ``IngestionResult`` per source feeds the manifest (S7); every source is
attempted and ``IngestReport.ok`` is false when any failed (S8).

A drop is looked through as lines first, by many tasks and in a fixed number of
jobs whatever its number of files: the first line of each file, and the parity
of its quotes. Files are grouped by header on the executors. Only files with a
line that ends inside a quoted field need the multi-line reader, which takes a
file as one task; all others are split. Then rows go to a run folder while an
``Observation`` counts them and the over-long ones, and when all is well a commit
record puts the run into force (``sources/commits.py``): a reader sees what landed
before or what landed now. Whatever goes wrong with one source is that source's
FAILED row; the others still land.
"""

from __future__ import annotations

import csv
import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas as S
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.commits import commit, in_force
from ledgerline.sources.sinks import CSV_DIALECT

EXTRA = "_extra"


class IngestionError(RuntimeError):
    """Raised by callers that require every source to land."""


@dataclass(frozen=True)
class RawTables:
    """The five raw sources, as they landed."""

    customers: DataFrame
    branches: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    loans: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "branches": self.branches,
                "accounts": self.accounts, "transactions": self.transactions,
                "loans": self.loans}


@dataclass
class IngestionResult:
    source_name: str
    status: str                       # SUCCESS | FAILED
    file_path: str | None = None
    row_count: int = 0
    column_count: int = 0
    malformed_rows: int = 0
    missing_columns: list[str] = field(default_factory=list)
    error: str | None = None
    output_path: str | None = None
    ingested_at: str = field(default_factory=lambda: dt.datetime.now().isoformat())


@dataclass
class IngestReport:
    results: list[IngestionResult]

    @property
    def ok(self) -> bool:
        return all(r.status == "SUCCESS" for r in self.results)

    def manifest(self, spark: SparkSession) -> DataFrame:
        """One row per source (bounded by the number of sources)."""
        schema = T.StructType([
            T.StructField("source_name", T.StringType()), T.StructField("status", T.StringType()),
            T.StructField("file_path", T.StringType()), T.StructField("row_count", T.LongType()),
            T.StructField("column_count", T.IntegerType()),
            T.StructField("malformed_rows", T.LongType()),
            T.StructField("missing_columns", T.ArrayType(T.StringType())),
            T.StructField("error", T.StringType()), T.StructField("output_path", T.StringType()),
            T.StructField("ingested_at", T.StringType())])
        rows = [tuple(asdict(r)[f.name] for f in schema.fields) for r in self.results]
        return spark.createDataFrame(rows, schema)


def _read(spark: SparkSession, where: str | list[str], header: list[str], multi_line: bool) -> DataFrame:
    """Files that share a header: all columns as text, ``_extra`` for surplus fields.

    Quoted fields may hold commas, doubled quotes and, with ``multi_line``, line breaks."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header]
                          + [T.StructField(EXTRA, T.StringType())])
    df = (spark.read.options(**CSV_DIALECT).option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .option("recursiveFileLookup", True).schema(schema).csv(where))
    return df.select(*[F.when(~F.col(f"`{c}`").isin(*S.MISSING_TEXTS), F.col(f"`{c}`")).alias(c)
                       for c in header], EXTRA)


def _open_quotes(line: Column) -> Column:
    """Quotes of a line that open or close a field: doubled ones are text, and so is one
    in the middle of an unquoted field. An odd number leaves a field open."""
    return F.when(F.instr(line, '"') > 0, F.regexp_count(
        F.replace(line, F.lit('""'), F.lit("")), F.lit('(?:^|,)"|"(?=,|$)'))).otherwise(F.lit(0))


def scan_drop(spark: SparkSession, path: str) -> DataFrame:
    """One row per distinct first line and need of its files: ``header``, ``multi_line``,
    ``torn`` (the file ends inside a quoted field), ``files`` (their paths) and ``n_files``.

    Two passes over the lines, each split like any text; empty files have no row.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    quotes = lines.select(meta["file_path"].alias("file"), _open_quotes(F.col("value")).alias("n"))
    parity = quotes.groupBy("file").agg(F.max(F.col("n") % 2).alias("odd"), F.sum("n").alias("n"))
    # a file's first line is that of its first range with the smallest place
    firsts = (lines.where((meta["file_block_start"] == 0) & (F.trim("value") != ""))
              .select(meta["file_path"].alias("file"), "value", F.monotonically_increasing_id().alias("at"))
              .groupBy("file").agg(F.min_by("value", "at").alias("header")))
    # an odd header opens a field that ends on a later line: such a file is read on its own
    alone = F.when(_open_quotes(F.col("header")) % 2 == 1, F.col("file"))
    return (firsts.join(parity, "file")
            .groupBy("header", (F.col("odd") == 1).alias("multi_line"), (F.col("n") % 2 == 1).alias("torn"),
                     alone.alias("alone"))
            .agg(F.collect_list("file").alias("files"), F.count(F.lit(1)).alias("n_files")))


def column_names(header: str) -> list[str]:
    """Names in a header line; empty and repeated ones are numbered like Spark's reader does."""
    names = next(csv.reader([header]), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if n == "" else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header row, every column as text, bound **by name**, plus ``_extra``.

    Part files of a folder may have their columns in different orders: files are
    read by their header, group by group, and the groups are united by name. Texts that
    mean a missing value are NULL, short rows are padded with NULLs, and the
    first surplus field of an over-long row is in ``_extra``. The driver gets the
    distinct headers and, where there are several, the names of their files (it
    lists these for any read).
    """
    groups = sorted(scan_drop(spark, path).collect(), key=lambda g: (g["header"], g["multi_line"], g["alone"] or ""))
    if not groups:
        raise ValueError("no columns to parse from file")
    torn = sum(g["n_files"] for g in groups if g["torn"])
    if torn:
        raise ValueError(f"{torn} files end inside a quoted field")
    parts = []
    for g in groups:
        names = (_whole_header(spark, g["alone"]) if g["alone"] else column_names(g["header"]))
        parts.append(_read(spark, path if len(groups) == 1 else g["files"], names, g["multi_line"]))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _whole_header(spark: SparkSession, file: str) -> list[str]:
    """Of a file whose header record has line breaks."""
    return spark.read.options(**CSV_DIALECT).option("multiLine", True).csv(file).columns


def missing_columns(columns: list[str], required: tuple[str, ...]) -> list[str]:
    """Metadata only."""
    return [c for c in required if c not in columns]


def ingest_source(spark: SparkSession, name: str, path: str, landing_root: str,
                  ingest_date: str, required: tuple[str, ...]) -> IngestionResult:
    result = IngestionResult(name, "FAILED", path)
    try:
        _ingest(spark, result, landing_root.rstrip("/"), ingest_date, required)
    except Exception as exc:  # noqa: BLE001  (any unreadable source is a FAILED row, not the run's end)
        missing = isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"
        result.error = (f"File not found: {path}" if missing
                        else f"Failed to parse CSV: {str(exc).splitlines()[0] if str(exc) else exc!r}")
    return result


def _ingest(spark: SparkSession, result: IngestionResult, landing_root: str, ingest_date: str,
            required: tuple[str, ...]) -> None:
    df = read_csv_text(spark, result.file_path)
    columns = [c for c in df.columns if c != EXTRA]
    result.column_count = len(columns)
    result.missing_columns = missing_columns(columns, required)
    if result.missing_columns:
        result.error = f"Missing required columns: {result.missing_columns}"
        return
    seen = Observation(f"ingest_{result.source_name}")
    run = f"{landing_root}/{result.source_name}/ingest_date={ingest_date}/run={uuid.uuid4().hex}"
    (df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(EXTRA).isNotNull()).alias("bad"))
     .drop(EXTRA).write.parquet(run))
    result.row_count, result.malformed_rows = seen.get["n"], seen.get["bad"]
    if result.malformed_rows:
        result.error = (f"Failed to parse CSV: {result.malformed_rows} rows have more fields than "
                        f"the header")
    elif not result.row_count:
        result.error = "File parsed but contains zero rows."
    if result.error:
        return                      # no record names the run: nobody reads it
    record = spark.createDataFrame([(result.source_name, ingest_date, run, result.row_count)],
                                   "source_name string, ingest_date string, path string, row_count long")
    commit(record, _commits(landing_root, result.source_name), ["ingest_date"])
    result.output_path = run
    result.status = "SUCCESS"


def _commits(landing_root: str, source: str) -> str:
    return f"{landing_root.rstrip('/')}/_commits/{source}"


def ingest_all(spark: SparkSession, raw_dir: str, landing_root: str,
               ingest_date: str | None = None,
               sources: dict[str, tuple[str, ...]] | None = None) -> IngestReport:
    """Attempt every source; failures are recorded, not raised."""
    ingest_date = ingest_date or dt.date.today().isoformat()
    sources = sources or S.REQUIRED_COLUMNS
    # sources are independent: their small jobs are submitted side by side
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        futures = [pool.submit(ingest_source, spark, name,
                               f"{raw_dir.rstrip('/')}/{S.SOURCE_FILES[name]}",
                               landing_root, ingest_date, required)
                   for name, required in sources.items()]
        return IngestReport([f.result() for f in futures])


def write_manifest(spark: SparkSession, report: IngestReport, path: str) -> None:
    report.manifest(spark).coalesce(1).write.mode("overwrite").json(path)


def _landed(spark: SparkSession, landing_root: str, source: str) -> dict[str, str]:
    """Ingest date -> folder of the run in force (one small record a day)."""
    records = in_force(spark, _commits(landing_root, source), ["ingest_date"])
    return {} if records is None else {r["ingest_date"]: r["path"] for r in records.collect()}


def latest_ingest_date(spark: SparkSession, landing_root: str, source: str = "transactions"
                       ) -> str:
    """Newest committed ``ingest_date``."""
    days = _landed(spark, landing_root, source)
    if not days:
        raise FileNotFoundError(f"no ingested partitions for source '{source}'")
    return max(days)


def read_landing(spark: SparkSession, landing_root: str, source: str, ingest_date: str
                 ) -> DataFrame:
    """One day of a landed source, as the newest commit record has it."""
    days = _landed(spark, landing_root, source)
    if ingest_date not in days:
        raise FileNotFoundError(f"no ingested partition {ingest_date} for source '{source}'")
    return spark.read.parquet(days[ingest_date])


def write_raw_csv(df: DataFrame, raw_dir: str, name: str) -> str:
    """Drop a source as CSV (what an upstream system would deliver)."""
    path = f"{raw_dir.rstrip('/')}/{S.SOURCE_FILES[name]}"
    df.write.mode("overwrite").options(**CSV_DIALECT).csv(path)
    return path


def _drop_lines(df: DataFrame, raw_dir: str, name: str, header: tuple[str, ...], each: str = "",
                end: str = "") -> None:
    """A small table as one CSV file, with a text after each row and one after them all."""
    rows = F.array_join(F.array_sort(F.collect_list(F.concat(F.concat_ws(",", *header), F.lit(each)))), "\n")
    (df.agg(F.concat(F.lit(",".join(header) + "\n"), rows, F.lit(end))).coalesce(1).write.mode("overwrite")
     .text(f"{raw_dir}/{S.SOURCE_FILES[name]}"))


def _drop_all(raw: RawTables, raw_dir: str) -> None:
    """The five sources as upstream systems might deliver them: loans in two folders of part
    files with their own column orders, customers with a note of several lines."""
    note = F.when(F.col("customer_id") % 5 == 0, F.concat(F.lit('said "yes",\nthen left '), "first_name"))
    write_raw_csv(raw.customers.withColumn("note", note), raw_dir, "customers")
    for name in ("branches", "accounts", "transactions"):
        write_raw_csv(getattr(raw, name), raw_dir, name)
    even = F.col("loan_id") % 2 == 0
    for folder, rows in (("a", raw.loans.where(even)), ("b", raw.loans.where(~even).select(*raw.loans.columns[::-1]))):
        rows.write.options(**CSV_DIALECT).csv(f"{raw_dir}/{S.SOURCE_FILES['loans']}/{folder}")


def ingest_roundtrip(spark: SparkSession, raw: RawTables) -> DataFrame:
    """All five raw sources -> CSV drops -> ingestion -> landing read-back (S1-S10),
    with drops that must fail beside them, under ``spark.checkpoint.dir``.

    Branches are dropped and ingested a second time on the same day without those of
    odd ids, which puts the first run out of force; a third drop on that day fails and changes nothing.
    Returns per source how it went and what landed: status, rows, columns, the
    number of non-NULL cells and the length of all texts in the first column.
    """
    run = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-roundtrip-{uuid.uuid4().hex}"
    day = "2026-01-01"
    _drop_all(raw, f"{run}/raw")
    # a drop without a required column, one without rows, one that isn't there, one whose rows
    # have a field too many, one that ends inside a quoted field
    branch = S.REQUIRED_COLUMNS["branches"]
    write_raw_csv(raw.loans.drop("loan_amount"), f"{run}/bad", "loans")
    write_raw_csv(raw.branches.limit(0).coalesce(1), f"{run}/bad", "branches")
    _drop_lines(raw.branches, f"{run}/bad", "customers", branch, each=",surplus")
    _drop_lines(raw.branches, f"{run}/bad", "transactions", branch, end='\n99,"not closed')
    bad = {n: S.REQUIRED_COLUMNS[n] for n in ("loans", "branches", "accounts")}
    bad |= {n: branch for n in ("customers", "transactions")}
    good = ingest_all(spark, f"{run}/raw", f"{run}/landing", day)
    write_raw_csv(raw.branches.where(F.col("branch_id") % 2 == 0), f"{run}/again", "branches")
    again = ingest_all(spark, f"{run}/again", f"{run}/landing", day, {"branches": branch})
    failed = ingest_all(spark, f"{run}/bad", f"{run}/landing", day, bad)
    rows = []
    for kind, report in (("good", good), ("again", again), ("bad", failed)):
        for r in report.results:
            base = spark.createDataFrame(
                [(kind, r.source_name, r.status, r.row_count, r.malformed_rows, ",".join(r.missing_columns))],
                "drop_kind string, source_name string, status string, row_count long, malformed_rows long, "
                "missing_columns string")
            if kind == "good":
                landed = read_landing(spark, f"{run}/landing", r.source_name,
                                      latest_ingest_date(spark, f"{run}/landing", r.source_name))
                cells = landed.agg(
                    F.count(F.lit(1)).alias("landed_rows"),
                    sum((F.count(F.col(c)) for c in landed.columns), F.lit(0)).alias("cells"),
                    F.sum(F.length(S.REQUIRED_COLUMNS[r.source_name][0])).alias("id_characters"))
            else:
                cells = spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in (
                    "landed_rows", "cells", "id_characters")])
            rows.append(base.join(F.broadcast(cells)))          # one row each
    return reduce(DataFrame.unionByName, rows)


def read_latest_landing(spark: SparkSession, landing_root: str, ingest_date: str | None = None
                        ) -> RawTables:
    """The five landed sources of one ingest date, as ``RawTables``.

    Without a date, the newest *transactions* partition is used for all five
    sources, as the reference does.
    """
    day = ingest_date or latest_ingest_date(spark, landing_root, "transactions")
    return RawTables(**{n: read_landing(spark, landing_root, n, day)
                        for n in ("customers", "branches", "accounts", "transactions", "loans")})

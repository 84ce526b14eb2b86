"""Publishing several report tables as one run.

``publish`` writes every table's rows into a folder of its own run, reads them
back for their number and checksum, and last of all appends the run to a
ledger.  Readers join the ledger: a run that stopped half-way is in no table,
a repeated one changes nothing, and of several runs of a week the newest is
seen, in all tables at once.  Nothing is deleted; ``superseded`` names what a
clean-up may remove.

    <out>/<table>/report_monday=.../run_id=.../   rows
    <out>/run_ledger/                             one row per run and table
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.dates import reporting_week
from ..sources.sinks import append_table
from .views import do_sell_by_month, do_sell_by_week
from .weekly import REPORT_MONDAY, WeeklyInputs, land_inputs, weekly_reports

RUN_ID = "run_id"
LEDGER = "run_ledger"
_LEDGER_SCHEMA = ("report_monday date, run_id string, table_name string, tables int, row_count long, checksum long, "
                  "columns string, published_at timestamp")


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The published runs, one row per run and table; none before the first."""
    path = f"{out.rstrip('/')}/{LEDGER}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _LEDGER_SCHEMA)
    return spark.read.schema(_LEDGER_SCHEMA).parquet(path)


def complete_runs(spark: SparkSession, out: str) -> DataFrame:
    """report_monday, run_id and published_at of every run whose tables are
    all in the ledger."""
    return (ledger(spark, out).groupBy(REPORT_MONDAY, RUN_ID)
            .agg(F.count_distinct("table_name").alias("_n"), F.max("tables").alias("_of"),
                 F.max("published_at").alias("published_at"))
            .filter("_n = _of").drop("_n", "_of"))


def current_runs(spark: SparkSession, out: str) -> DataFrame:
    """report_monday and run_id of the run that readers see: each week's
    newest (one row a week)."""
    newest = F.max_by(F.col(RUN_ID), F.struct("published_at", RUN_ID)).alias(RUN_ID)
    return complete_runs(spark, out).groupBy(REPORT_MONDAY).agg(newest)


def superseded(spark: SparkSession, out: str) -> DataFrame:
    """report_monday and run_id of complete runs that a newer one replaced."""
    return (complete_runs(spark, out).select(REPORT_MONDAY, RUN_ID)
            .join(current_runs(spark, out), [REPORT_MONDAY, RUN_ID], "left_anti"))


def checksum(df: DataFrame) -> F.Column:
    """A number that all rows decide and their order does not; doubles count
    by their bits, repeated rows by their number."""
    total = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
    return (total % F.lit((1 << 61) - 1)).cast("long")


def _measured(rows: DataFrame) -> tuple[int, int]:
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(checksum(rows), F.lit(0)).alias("s")).first()
    return found["n"], found["s"]


def _table_path(out: str, table: str) -> str:
    return f"{out.rstrip('/')}/{table}"


def _run_rows(spark: SparkSession, out: str, table: str, schema, monday: _dt.date, run_id: str) -> DataFrame:
    """The rows that a run stored, of a table whose rows have ``schema``."""
    path = f"{_table_path(out, table)}/{REPORT_MONDAY}={monday}/{RUN_ID}={run_id}"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:                         # an empty report leaves no folder
        return spark.createDataFrame([], schema)


def publish(reports: Mapping[str, DataFrame], out: str, report_monday: _dt.date, run_id: str) -> bool:
    """Store ``reports`` (table name -> rows) for ``report_monday`` as the run
    ``run_id`` and enter it into the ledger.  Returns False, and does nothing,
    where the ledger has that run.  A run that stopped before its entry is
    written anew: its own folders are replaced, no other run's.

    What the ledger holds is read back from the files, not counted on the way."""
    if not run_id or any(c in run_id for c in "/\\:=%?#* "):
        raise ValueError(f"a run id is part of a folder name: {run_id!r}")
    spark = next(iter(reports.values())).sparkSession
    done = complete_runs(spark, out).filter((F.col(RUN_ID) == run_id) & (F.col(REPORT_MONDAY) == F.lit(report_monday)))
    if not done.isEmpty():
        return False
    entries = []
    for name, report in reports.items():
        stored = report.withColumns({REPORT_MONDAY: F.lit(report_monday), RUN_ID: F.lit(run_id)})
        append_table(stored, _table_path(out, name), [REPORT_MONDAY, RUN_ID], replace_partitions=True)
        n, s = _measured(_run_rows(spark, out, name, report.schema, report_monday, run_id))
        entries.append((report_monday, run_id, name, len(reports), n, s, report.schema.json()))
    rows = spark.createDataFrame(entries, ", ".join(_LEDGER_SCHEMA.split(", ")[:-1]))
    # one small file, committed as a whole: the run is there with all its tables or not at all
    rows.coalesce(1).withColumn("published_at", F.current_timestamp()).write.mode("append").parquet(
        f"{out.rstrip('/')}/{LEDGER}")
    return True


def read_published(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table as published: of every week the rows of its newest complete run,
    with ``report_monday``.  The ledger is a row a week and table; it is joined
    on the partition columns, so only the seen runs' folders are read."""
    known = ledger(spark, out).filter(F.col("table_name") == table)
    newest = known.agg(F.max_by("columns", "published_at")).first()[0]
    if newest is None:
        raise ValueError(f"no published run has the table {table}")
    schema = StructType.fromJson(json.loads(newest))
    seen = current_runs(spark, out)
    runs = seen.join(known.select(REPORT_MONDAY, RUN_ID).distinct(), [REPORT_MONDAY, RUN_ID])
    whole = StructType([*schema.fields, StructField(REPORT_MONDAY, DateType()), StructField(RUN_ID, StringType())])
    try:
        rows = spark.read.schema(whole).parquet(_table_path(out, table))
    except AnalysisException:
        return spark.createDataFrame([], whole).drop(RUN_ID)
    seen_rows = rows.join(F.broadcast(runs), [REPORT_MONDAY, RUN_ID], "left_semi")
    return seen_rows.select(*[F.col(f"`{c}`") for c in schema.names], REPORT_MONDAY)


def check_run(spark: SparkSession, out: str, report_monday: _dt.date, run_id: str) -> list[str]:
    """The tables of a run whose stored rows no longer have the ledger's number
    and checksum."""
    entries = ledger(spark, out).filter((F.col(RUN_ID) == run_id) & (F.col(REPORT_MONDAY) == F.lit(report_monday))).collect()
    changed = []
    for e in entries:
        schema = StructType.fromJson(json.loads(e["columns"]))
        if _measured(_run_rows(spark, out, e["table_name"], schema, report_monday, run_id)) != (e["row_count"], e["checksum"]):
            changed.append(e["table_name"])
    return changed


def publish_weekly(inputs: WeeklyInputs, run_date: _dt.date, out: str, run_id: str | None = None, *,
                   land: bool = True, **options) -> bool:
    """The six tables of a run date as one run (by default named by the date);
    options as of ``weekly_reports``."""
    snap = options.get("snap", False)
    run_id = run_id or f"run-{run_date}"
    monday = reporting_week(run_date, snap)[0]
    if land:
        done = complete_runs(inputs.feed.sparkSession, out)
        if not done.filter((F.col(RUN_ID) == run_id) & (F.col(REPORT_MONDAY) == F.lit(monday))).isEmpty():
            return False
        inputs = land_inputs(inputs, run_date, f"{out.rstrip('/')}/_landed/{run_date}", snap)
    return publish(weekly_reports(inputs, run_date, **options), out, monday, run_id)


def register_published_views(spark: SparkSession, out: str) -> list[str]:
    """Temp views over the published do_sell table, as ``register_views`` has
    them over the appended one."""
    table = read_published(spark, out, "do_sell")
    table.createOrReplaceTempView("do_sell")
    do_sell_by_month(table).createOrReplaceTempView("do_sell_by_month")
    do_sell_by_week(table).createOrReplaceTempView("do_sell_by_week")
    return ["do_sell", "do_sell_by_month", "do_sell_by_week"]

"""The batch and streaming jobs, each callable from Python or as ``python -m peoplelake.plans.jobs <job> --lake ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.operators.latest import latest_across, mark_current, upsert
from peoplelake.operators.quality import QualityGateError, RawCounts, Thresholds, enforce, quality_report
from peoplelake.operators.retrieval import Encoder, embed
from peoplelake.operators.sequences import version_intervals
from peoplelake.plans import gold, insights, silver
from peoplelake.plans.catalog import load_marts
from peoplelake.schemas import STREAMS
from peoplelake.session import build_session, discard, scratch_path
from peoplelake.sources import versions as published
from peoplelake.sources.lake import CHUNK_PARTITIONS, SILVER_PARTITIONS, Lake, read_table, write_table
from peoplelake.sources.log import read_since
from peoplelake.streaming.ingest import ingest_topic, watch

LOG = logging.getLogger(__name__)
AsOf = dt.date | str | None


def existing_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """A written table in the shape of ``like``, or None when it is not there yet."""
    try:
        return read_table(spark, path, like=like)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def merged(existing: DataFrame | None, new: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
    """Latest-wins over both tables: the newest row per key stays, the new batch on a tie, and every other row as well.

    The whole table is written again: a row may leave its partition (an employee changes department), so replacing the
    touched partitions alone would leave the old row behind.
    """
    if existing is None:
        return new
    both = existing.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return latest_across(both, keys, [newest_by, "_batch"]).drop("_batch")


def clean_employees(
    raw: DataFrame,
    lake: Lake,
    as_of: AsOf = None,
    *,
    mode: str = "overwrite",
    thresholds: Thresholds = Thresholds(),
    fail_on_quality: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Write, audit, publish: returns the published employee table and its quality report.

    The cleaned rows are written once, to a version that nobody reads yet; the audit reads the five columns it needs of it,
    and one small commit then makes it the table. A closed gate or a crash leaves the table as it was. ``mode="merge"``
    keeps the published rows of other employees and the newer row of each employee, so an incremental load gives what a
    full rebuild gives; the audit is then of the merged table. The report also has the shares of missing and repeated ids
    among the raw rows, counted as they passed.
    """
    _check_mode(mode)
    spark = raw.sparkSession
    target = lake.silver("dim_employee")
    counts = RawCounts()
    cleaned = counts.cleaned(silver.silver_employees(counts.raw(raw), as_of))
    before = published.current(spark, target)
    if mode == "merge":
        cleaned = merged(existing_table(spark, target, cleaned), cleaned, ["employee_id"], "ingest_ts")
    folder = published.write_version(cleaned, target, SILVER_PARTITIONS["dim_employee"])
    report_path = scratch_path(spark, "quality")
    of_cleaned = quality_report(spark.read.schema(cleaned.schema).parquet(f"{target}/{folder}"), thresholds)
    of_cleaned.unionByName(counts.report(spark, thresholds)).coalesce(1).write.parquet(report_path)
    report = spark.read.parquet(report_path)
    try:
        if fail_on_quality:
            enforce(report)
    except QualityGateError:
        discard(spark, f"{target}/{folder}")
        raise
    published.commit(spark, target, published.Commit(before.number + 1 if before else 0, (folder,), cleaned.schema.json()))
    published.expire(spark, target)
    return read_table(spark, target, like=cleaned), report


MODES = ("overwrite", "merge")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}; appending would repeat keys")


# The stream of HRIS employee versions, and the table of their validity.
HRIS, HISTORY = "employees", "dim_employee_history"
_FACTS = {
    "attendance": ("fct_attendance", silver.silver_attendance, ["attendance_id"]),
    "performance": ("fct_performance", silver.silver_performance, ["review_id"]),
    "recruitment": ("fct_recruitment", silver.silver_recruitment, ["application_id", "stage"]),
}


def clean_fact(raw: DataFrame, lake: Lake, stream: str, mode: str = "overwrite") -> DataFrame:
    """Clean one fact stream and write its partitioned table; ``merge`` keeps the newest event of every key."""
    _check_mode(mode)
    spark = raw.sparkSession
    table, plan, keys = _FACTS[stream]
    cleaned, target = plan(raw), lake.silver(table)
    if mode == "merge":
        cleaned = merged(existing_table(spark, target, cleaned), cleaned, keys, "event_ts")
    published.publish(cleaned, target, SILVER_PARTITIONS[table])
    return read_table(spark, target, like=cleaned)


def clean_versions(raw: DataFrame, lake: Lake, mode: str = "overwrite") -> DataFrame:
    """Write the HRIS history: every version of every employee, with the time it was valid and whether it is the current one.

    Only the stream's own fields are kept, so a message that landed twice is one version. ``merge`` adds the new versions to the
    published ones and draws all intervals again, as a late version also ends the one before it; loading a feed in parts, in any
    order and with overlaps, gives what loading it at once gives. Rows without an employee id are no versions and are dropped.
    """
    _check_mode(mode)
    spark, target = raw.sparkSession, lake.silver(HISTORY)
    fields = [c for c in STREAMS[HRIS].struct.names if c in raw.columns]
    versions = raw.select(*fields).filter(F.col("employee_id").isNotNull())
    if mode == "merge":
        existing = existing_table(spark, target, versions)
        versions = versions if existing is None else existing.unionByName(versions)
    history = version_intervals(versions.distinct(), "employee_id")
    published.publish(history, target, SILVER_PARTITIONS[HISTORY])
    return read_table(spark, target, like=history)


def current_staff(versions: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Current HRIS rows with their tenure, the dimension of the detail marts; a history says itself which rows are current."""
    marked = versions if "is_current" in versions.columns else mark_current(versions, "employee_id")
    return silver.tenure_days(marked.filter("is_current"), as_of)


def build_detail_marts(spark: SparkSession, lake: Lake, versions: DataFrame, as_of: AsOf = None) -> list[str]:
    """The four detail marts from the HRIS versions and the written fact tables; the dimension is computed once."""
    staff_path = scratch_path(spark, "current-staff")
    write_table(current_staff(versions, as_of), staff_path)
    staff = read_table(spark, staff_path)
    marts = {
        "gold_headcount": lambda: gold.headcount(staff, as_of),
        "gold_attendance_compliance": lambda: gold.attendance_compliance(
            read_table(spark, lake.silver("fct_attendance")), staff, as_of),
        "gold_performance": lambda: gold.review_outcomes(
            read_table(spark, lake.silver("fct_performance")), staff, as_of),
        "gold_recruitment_funnel": lambda: gold.recruitment_funnel(
            read_table(spark, lake.silver("fct_recruitment")), as_of),
    }
    for name, build in marts.items():
        published.publish(build().coalesce(1), lake.gold(name))
    return list(marts)


def refresh_chunks(
    spark: SparkSession, lake: Lake, *, encoder: Encoder | None = None, reset: bool = False
) -> DataFrame:
    """Narrate the written marts, embed the texts and upsert them into the chunk collection by chunk id.

    The new state is a version of its own, published when it is whole, partitioned by the fields that searches filter on.
    """
    fresh = embed(insights.insight_chunks(load_marts(spark, lake)), "text", encoder)
    target = lake.insights()
    if not reset:
        try:
            fresh = upsert(read_table(spark, target), fresh, "chunk_id")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    published.publish(fresh, target, CHUNK_PARTITIONS)
    return read_table(spark, target)


# -- command line -----------------------------------------------------------------------------------------------------------
# Exit codes by which a scheduler tells the failing stage.
EXIT_OK, EXIT_SESSION, EXIT_READ, EXIT_BUILD, EXIT_QUALITY_RUN, EXIT_QUALITY, EXIT_WRITE = 0, 2, 3, 4, 5, 6, 7
EXIT_UNKNOWN_MART, EXIT_MART_FAILED, EXIT_VALIDATION = 4, 8, 9


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="peoplelake")
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--as-of", default=None, help="reporting day, default today")
    jobs = parser.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="broker topic to raw table")
    ingest.add_argument("--stream", required=True, choices=sorted(STREAMS))
    ingest.add_argument("--servers", required=True)
    ingest.add_argument("--topic", required=True)
    ingest.add_argument("--once", action="store_true")
    ingest.add_argument("--max-rows", type=int, default=None)
    ingest.add_argument("--starting-offsets", default=None)
    clean = jobs.add_parser("silver", help="raw tables to cleaned tables")
    clean.add_argument("--stream", default="employee_csv", choices=["employee_csv", HRIS, *_FACTS])
    clean.add_argument("--since", default=None)
    clean.add_argument("--mode", choices=MODES, default=None, help="default: merge with --since, else overwrite")
    clean.add_argument("--fail-on-dq", action="store_true")
    marts = jobs.add_parser("gold", help="cleaned employees to marts")
    marts.add_argument("--marts", nargs="*", default=None)
    marts.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    marts.add_argument("--coalesce", type=int, default=1)
    marts.add_argument("--fail-on-validation", action="store_true")
    marts.add_argument("--detail", action="store_true", help="the four detail marts, from the HRIS history (else its raw rows) and the fact tables")
    chunks = jobs.add_parser("insights", help="marts to the embedded chunk collection")
    chunks.add_argument("--reset", action="store_true")
    return parser


def _run_ingest(spark: SparkSession, lake: Lake, args) -> int:
    source = {}
    if args.max_rows:
        source["max_per_trigger"] = args.max_rows
    if args.starting_offsets:
        source["starting_offsets"] = args.starting_offsets
    query = ingest_topic(spark, args.servers, args.topic, args.stream, lake, once=args.once, **source)
    batches = watch(query)
    LOG.info("%s batches read %s rows", len(batches), sum(p.numInputRows for p in batches.values()))
    return EXIT_OK


def _run_silver(spark: SparkSession, lake: Lake, args) -> int:
    if args.since and args.mode == "overwrite":
        LOG.error("--since with --mode overwrite would drop all older rows")
        return EXIT_BUILD
    try:
        raw = read_since(spark, lake.bronze(args.stream), args.since)
    except Exception:
        LOG.exception("raw table %s cannot be read", args.stream)
        return EXIT_READ
    if raw.isEmpty():
        LOG.warning("raw table %s is empty", args.stream)
        return EXIT_OK
    mode = args.mode or ("merge" if args.since else "overwrite")
    try:
        if args.stream == HRIS:
            clean_versions(raw, lake, mode)
        elif args.stream in _FACTS:
            clean_fact(raw, lake, args.stream, mode)
        else:
            clean_employees(raw, lake, args.as_of, mode=mode, fail_on_quality=args.fail_on_dq)
    except QualityGateError:
        LOG.exception("quality gate closed")
        return EXIT_QUALITY
    except Exception:
        LOG.exception("cleaning failed")
        return EXIT_WRITE
    return EXIT_OK


def _run_gold(spark: SparkSession, lake: Lake, args) -> int:
    if args.detail:
        return _run_detail(spark, lake, args)
    try:
        gold.select_marts(args.marts)
    except ValueError as error:
        LOG.error("%s", error)
        return EXIT_UNKNOWN_MART
    try:
        employees = read_table(spark, lake.silver("dim_employee"))
    except Exception:
        LOG.exception("cleaned employees cannot be read")
        return EXIT_READ
    if employees.isEmpty():
        LOG.warning("no employees, no marts")
        return EXIT_OK
    status = gold.build_all(
        employees, lake, args.as_of, names=args.marts, mode=args.mode, files=args.coalesce
    ).agg(
        F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(~F.col("passed")).alias("doubtful")
    ).first()
    if status["failed"]:
        return EXIT_MART_FAILED
    return EXIT_VALIDATION if args.fail_on_validation and status["doubtful"] else EXIT_OK


def _run_detail(spark: SparkSession, lake: Lake, args) -> int:
    try:
        staff = published.read_current(spark, lake.silver(HISTORY))
        staff = read_since(spark, lake.bronze(HRIS), None) if staff is None else staff
    except Exception:
        LOG.exception("raw table %s cannot be read", HRIS)
        return EXIT_READ
    try:
        build_detail_marts(spark, lake, staff, args.as_of)
    except Exception:
        LOG.exception("detail marts failed")
        return EXIT_MART_FAILED
    return EXIT_OK


def _run_insights(spark: SparkSession, lake: Lake, args) -> int:
    LOG.info("chunk collection holds %s rows", refresh_chunks(spark, lake, reset=args.reset).count())
    return EXIT_OK


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        spark = spark or build_session(f"peoplelake-{args.job}")
    except Exception:
        LOG.exception("no Spark session")
        return EXIT_SESSION
    run = {"ingest": _run_ingest, "silver": _run_silver, "gold": _run_gold, "insights": _run_insights}[args.job]
    return run(spark, Lake(args.lake.rstrip("/")), args)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())

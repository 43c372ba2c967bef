"""Mart catalog, governed read-only access, query-log audit and lake health."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peoplelake.functions.text import squash_whitespace_ends
from peoplelake.plans.gold import MARTS, Mart, load_mart
from peoplelake.plans.governance import inspected, is_query, objections, restrict_functions, sources
from peoplelake.sources import versions
from peoplelake.sources.lake import Lake, read_table

# Access limits and the words a read-only query may not contain.
DEFAULT_LIMIT = 500
HARD_CAP = 10_000
MAX_SQL_CHARS = 4000
BLOCKED_WORDS = (
    "ATTACH", "COPY", "INSTALL", "LOAD", "PRAGMA", "SET", "EXPORT", "IMPORT", "READ_TEXT", "READ_BLOB",
    "DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "CREATE", "ALTER", "GRANT", "REVOKE",
)


def load_marts(spark: SparkSession, lake: Lake, registry: Sequence[Mart] = MARTS) -> dict[str, DataFrame]:
    """Every written mart of the registry by name; marts that are not there are left out."""
    loaded = {m.name: load_mart(spark, lake, m.name) for m in registry}
    return {name: df for name, df in loaded.items() if df is not None}


def view_name(mart: str) -> str:
    return mart.replace("/", "_")


def register_views(marts: Mapping[str, DataFrame]) -> list[str]:
    """Publish marts as ``<domain>_<metric>`` temp views for Spark SQL."""
    for name, df in marts.items():
        df.createOrReplaceTempView(view_name(name))
    return sorted(view_name(name) for name in marts)


def signature(mart: str, df: DataFrame) -> str:
    return f"{view_name(mart)}({', '.join(f'{name} {kind}' for name, kind in df.dtypes)})"


def mart_catalog(marts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per view: domain, metric, column count, signature and row count."""
    rows = []
    for name, df in sorted(marts.items()):
        domain, metric = name.split("/", 1)
        rows.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(view_name(name)).alias("view_name"),
            F.lit(domain).alias("domain"),
            F.lit(metric).alias("metric"),
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(signature(name, df)).alias("signature"),
            "row_count",
        ))
    return reduce(DataFrame.unionByName, rows)


def discovered_marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Every mart that lies in the lake as ``<domain>/<metric>``, registered or not, by name."""
    root = lake.gold()
    names = [f"{domain}/{metric}" for domain in versions.subfolders(spark, root) if domain != "versions"
             for metric in versions.subfolders(spark, f"{root}/{domain}") if metric != "versions"]
    return {name: read_table(spark, lake.gold(name)) for name in names if versions.data_files(spark, lake.gold(name))}


def discovered_catalog(spark: SparkSession, lake: Lake) -> DataFrame:
    """:func:`mart_catalog` of :func:`discovered_marts`; rows are counted in the files' footers, so no data is scanned."""
    rows = []
    for name, df in discovered_marts(spark, lake).items():
        domain, metric = name.split("/", 1)
        count = versions.row_count(spark, versions.data_files(spark, lake.gold(name)))
        rows.append((view_name(name), domain, metric, len(df.columns), signature(name, df), count))
    return spark.createDataFrame(
        rows, "view_name string, domain string, metric string, column_count int, signature string, row_count bigint")


def catalog_document(marts: Mapping[str, DataFrame]) -> str:
    """Signatures grouped by domain, as a text block for prompts and docs."""
    lines = ["Available read-only views over the Gold marts:", ""]
    domains = sorted({name.split("/", 1)[0] for name in marts})
    for domain in domains:
        lines.append(f"### Domain: {domain}")
        lines += [f"- {signature(n, marts[n])}" for n in sorted(marts) if n.startswith(domain + "/")]
        lines.append("")
    return "\n".join(lines) if marts else "(no tables available)"


class GovernedViews:
    """Read access limited to registered marts, with a default row limit and a hard cap that a result always reports.

    ``sql`` runs in a session of its own that has the mart views and the allowed functions and no others, and where files can't
    be named as tables. Either way the analysed plan is judged before anything runs, see :mod:`peoplelake.plans.governance`.
    """

    def __init__(self, marts: Mapping[str, DataFrame], default_limit: int = DEFAULT_LIMIT, hard_cap: int = HARD_CAP):
        self._views = {view_name(name): df for name, df in marts.items()}
        self._default, self._cap = default_limit, hard_cap
        self._session: SparkSession | None = None
        self._readable: set[str] = set()
        self._sources: dict[str, set[str]] = {}

    @property
    def names(self) -> list[str]:
        return sorted(self._views)

    def _limited(self, df: DataFrame, limit: int | None) -> DataFrame:
        """At most ``limit`` rows, the first in the order of all columns, with ``truncated``: whether there were more.

        The rank is planned as a top-N before the shuffle, so one task sees ``limit`` + 1 rows of each other.
        """
        if limit is not None and limit <= 0:
            raise ValueError("the limit must be positive")
        most = min(limit or self._default, self._cap)
        order = [F.col(f"`{c}`") for c in df.columns]
        first = df.orderBy(*order).limit(most + 1)
        everyone = Window.partitionBy()
        ranked = first.withColumns({
            "_place": F.row_number().over(Window.orderBy(*order)), "truncated": F.count(F.lit(1)).over(everyone) > most})
        return ranked.filter(F.col("_place") <= most).drop("_place")

    def query(
        self, view: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, limit: int | None = None
    ) -> DataFrame:
        """Apply a DataFrame transform to one registered view; the result must read that view alone, by allowed operators and
        functions, so a transform can't bring in code of its own."""
        if view not in self._views:
            raise PermissionError(f"unknown view {view!r}; allowed: {self.names}")
        if view not in self._sources:
            self._sources[view] = sources(self._views[view])
        result = transform(self._views[view])
        strange, read = inspected(result)
        if strange or not read or not read <= self._sources[view]:
            raise PermissionError("; ".join(sorted(strange)) or f"the result does not come from {view!r} alone")
        return self._limited(result, limit)

    def sql(self, text: str, limit: int | None = None) -> DataFrame:
        """Run one SELECT over the mart views. What :func:`audit_query_log` flags and what the plan's check objects to is
        refused; a function or table that is not there fails the analysis."""
        if reasons := refusals(text):
            raise PermissionError("; ".join(reasons))
        if self._session is None:
            self._session = self._restricted()
        statement = text.strip().rstrip(";")
        if not is_query(self._session, statement):
            raise PermissionError("not a query")
        result = self._session.sql(statement)
        if found := objections(result, self._readable):
            raise PermissionError("; ".join(found))
        return self._limited(result, limit)

    def _restricted(self) -> SparkSession:
        frames = list(self._views.items())
        session = frames[0][1].sparkSession.newSession() if frames else SparkSession.active().newSession()
        for name, df in frames:
            own = session.read.schema(df.schema).parquet(*df.inputFiles())
            own.createOrReplaceTempView(name)
            self._readable |= sources(own)
        session.conf.set("spark.sql.runSQLOnFiles", "false")
        restrict_functions(session)
        return session


def refusals(text: str | None, blocked: Sequence[str] = BLOCKED_WORDS, max_chars: int = MAX_SQL_CHARS) -> list[str]:
    """Why a read-only policy refuses one statement, by the rules of :func:`audit_query_log`; empty if it may run."""
    given = text or ""
    trimmed = re.sub(r";\s*$", "", given.strip())
    upper = trimmed.upper()
    found = sorted(set(re.findall(r"(?<![A-Z_])(" + "|".join(blocked) + r")(?![A-Z_])", upper)))
    checks = {
        "empty": not trimmed, f"longer than {max_chars} characters": len(given) > max_chars,
        "not a SELECT": bool(trimmed) and not re.match(r"\s*(SELECT|WITH)\b", upper), "several statements": ";" in trimmed,
        f"blocked words {', '.join(found)}": bool(found)}
    return [reason for reason, hit in checks.items() if hit]


def audit_query_log(
    log: DataFrame, sql: str = "sql", blocked: Sequence[str] = BLOCKED_WORDS, max_chars: int = MAX_SQL_CHARS
) -> DataFrame:
    """Flag logged statements that a read-only policy would refuse; one projection, no shuffle.

    A blocked word counts when it stands between characters other than letters and underscores, in any case; found
    words are listed alphabetically. Shared intermediate texts are columns of their own, so each is computed once.
    """
    word = r"(?<![A-Z_])(" + "|".join(blocked) + r")(?![A-Z_])"
    text, upper = F.col("_text"), F.col("_upper")
    trimmed = F.regexp_replace(squash_whitespace_ends(F.coalesce(F.col(sql), F.lit(""))), r";\s*$", "")
    return (
        log.withColumn("_text", trimmed)
        .withColumn("_upper", F.upper(text))
        .withColumns({
            "is_empty": text == "",
            "too_long": F.length(F.coalesce(F.col(sql), F.lit(""))) > max_chars,
            "is_select": upper.rlike(r"^\s*(SELECT|WITH)\b"),
            "has_many_statements": text.contains(";"),
            "blocked_words": F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(upper, F.lit(word), 1))), ","),
        })
        .withColumn(
            "allowed",
            ~F.col("is_empty") & ~F.col("too_long") & F.col("is_select") & ~F.col("has_many_statements")
            & (F.col("blocked_words") == ""),
        )
        .drop("_text", "_upper")
    )


def lake_health(spark: SparkSession, lake: Lake, chunks: DataFrame | None = None, registry: Sequence[Mart] = MARTS):
    """One row per expected artefact: is it there, how many rows, newest snapshot."""
    rows = []
    for mart in registry:
        df = load_mart(spark, lake, mart.name)
        if df is None:
            rows.append(spark.sql(f"SELECT '{mart.name}' artefact, false present, 0L row_count, CAST(NULL AS DATE) newest"))
        else:
            rows.append(df.agg(F.count(F.lit(1)).alias("row_count"), F.max("snapshot_date").alias("newest")).select(
                F.lit(mart.name).alias("artefact"), F.lit(True).alias("present"), "row_count", "newest"))
    if chunks is not None:
        rows.append(chunks.agg(F.count(F.lit(1)).alias("row_count"), F.max("snapshot_date").cast("date").alias("newest"))
                    .select(F.lit("insight_chunks").alias("artefact"), (F.col("row_count") > 0).alias("present"),
                            "row_count", "newest"))
    return reduce(DataFrame.unionByName, rows).withColumn("ready", F.col("present") & (F.col("row_count") > 0))

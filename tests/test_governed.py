"""Governed access: what may run, what is refused, and that a cut result says so."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from peoplelake.plans import catalog, governance
from peoplelake.sources.lake import read_table, write_table


@pytest.fixture
def views(spark, lake):
    write_table(spark.range(30).selectExpr("CAST(29 - id AS INT) AS n", "'x' AS word"), lake.gold("a/b"))
    write_table(spark.range(3).selectExpr("id AS secret"), lake.gold("other/mart"))
    return catalog.GovernedViews({"a/b": read_table(spark, lake.gold("a/b"))}, default_limit=10, hard_cap=20)


def test_limits_are_reported_and_ordered(views):
    got = views.query("a_b").collect()
    assert [r["n"] for r in got] == list(range(10)) and all(r["truncated"] for r in got)
    assert views.query("a_b", limit=500).count() == 20
    whole = views.query("a_b", lambda df: df.filter("n < 5")).collect()
    assert len(whole) == 5 and not any(r["truncated"] for r in whole)
    for bad in (0, -1):
        with pytest.raises(ValueError):
            views.query("a_b", limit=bad)
        with pytest.raises(ValueError):
            views.sql("SELECT 1 AS one", limit=bad)


def test_only_the_view_may_be_read(spark, lake, views):
    with pytest.raises(PermissionError):
        views.query("other_mart")
    for other in (spark.range(7), spark.createDataFrame([(1,)], "n int")):
        with pytest.raises(PermissionError):
            views.query("a_b", lambda df: other)
    with pytest.raises(PermissionError):
        views.query("a_b", lambda df: df.join(read_table(spark, lake.gold("other/mart"))))


def test_sql_runs_in_a_session_of_its_own(spark, lake, views):
    spark.range(3).createOrReplaceTempView("outside")
    assert [r["n"] for r in views.sql("select max(n) as n from a_b;").collect()] == [29]
    for text in ("select * from outside", f"select * from parquet.`{lake.gold('other/mart')}`", "select * from other_mart"):
        with pytest.raises(AnalysisException):
            views.sql(text).collect()
    assert spark.sql("select count(*) from outside").first()[0] == 3


FORBIDDEN = [
    "select java_method('java.lang.System', 'getProperty', 'user.home') as x",
    "select reflect('java.lang.System', 'getenv', 'PATH') as x from a_b",
    "select try_reflect('java.lang.System', 'getenv', 'PATH') as x from a_b",
    "select n from a_b where n > (select length(java_method('java.lang.System', 'getProperty', 'user.home')))",
    "with x as (select reflect('java.lang.System', 'lineSeparator') as y) select * from x",
    "select sum(case when input_file_name() like '%x%' then 1 end) as x from a_b",
    "select current_user() as x", "select version() as x", "select uuid() as x from a_b", "select raise_error('x') as x",
    "select * from range(5)", "select * from explode(array(1, 2))", "select x from a_b lateral view explode(array(1)) t as x",
    "select explode(array(1, 2)) as x", "select from_csv('1', 'a int') as x", "select * from sql_keywords()",
    "select * from text.`/etc/passwd`", "select transform(n) using 'cat' as x from a_b", "select * from default.kept",
]


@pytest.mark.parametrize("text", FORBIDDEN)
def test_functions_and_sources_beyond_the_lists_are_refused(spark, views, tmp_path, text):
    spark.range(1).write.mode("overwrite").saveAsTable("kept", path=str(tmp_path / "kept"))
    with pytest.raises((PermissionError, AnalysisException)):
        views.sql(text)


def test_the_plan_alone_tells(spark, lake, views):
    """The same without the restricted session: what DataFrame code brings along is found in the analysed plan."""
    view = read_table(spark, lake.gold("a/b"))
    readable = governance.sources(view)
    own = F.udf(lambda n: n, "int")
    pandas = F.pandas_udf(lambda n: n, "int", F.PandasUDFType.SCALAR)
    for frame in (
        view.select(F.expr("java_method('java.lang.System', 'getProperty', 'user.home')")), view.select(F.input_file_name()),
        view.select(own("n")), view.filter(own("n") > 1), view.select(pandas("n")), view.select(F.explode(F.array("n"))),
        view.mapInPandas(lambda frames: frames, view.schema), view.groupBy("word").applyInPandas(lambda f: f, view.schema),
        view.crossJoin(spark.range(3)), view.unionByName(read_table(spark, lake.gold("other/mart")), allowMissingColumns=True),
        view.filter(F.expr("exists(select 1 from range(3))")), view.select(F.reflect(F.lit("java.lang.Math"), F.lit("random"))),
    ):
        assert governance.objections(frame, readable), frame
        with pytest.raises(PermissionError):
            views.query("a_b", lambda df: frame)


@pytest.mark.parametrize("text", [
    "select word, count(distinct n) as c, avg(n) as a, percentile(n, 0.5) as p from a_b group by word having max(n) > 1",
    "with x as (select n, n % 3 as m from a_b) select m, sum(n) over (partition by m order by n) as s from x where n in (1, 2, 5)",
    "select upper(word) || '-' || cast(n as string) as t, case when n > 3 then 'a' else 'b' end as k, nvl(nullif(n, 2), 0) as z from a_b",
    "select a.n from a_b a join a_b b on a.n = b.n + 1 where exists (select 1 from a_b c where c.n = a.n) union select -1",
    "select n, rank() over (order by n desc) as r, date_add(date '2020-01-01', n) as d from a_b order by n limit 3 offset 1",
    "select word, n, count(*) as c, grouping(n) as g from a_b group by cube(word, n)", "select 1 as one",
    "select max(n) filter (where n < 9) as m, max_by(word, n) as w, collect_set(word) as s, round(stddev(n), 2) as d from a_b",
    "select transform(array(n, 2), x -> x + 1) as t, struct(n, word).word as w, word like 'x%' as l, word rlike 'x' as r from a_b",
    "select * from a_b pivot (sum(n) for word in ('x', 'y'))", "select try_divide(n, 0) as q, n between 1 and 2 as b from a_b except select 1, true",
])
def test_plain_queries_pass(views, text):
    assert views.sql(text).count() >= 1


@pytest.mark.parametrize("text", [None, "", " ; ", "drop table a_b", "select 1; select 2", "with x as (select 1) insert into t select 1",
                                  "select " + "1," * 3000 + "1", "explain select 1", "SELECT * FROM read_text('x')"])
def test_refusals_agree_with_the_audit(spark, views, text):
    with pytest.raises(PermissionError):
        views.sql(text)
    assert not catalog.audit_query_log(spark.createDataFrame([(text,)], "sql string")).first()["allowed"]


@pytest.mark.parametrize("text", ["select 1", " WITH x AS (SELECT 1) SELECT * FROM x ; ", "select dataset, loaded from t"])
def test_allowed_statements_agree_with_the_audit(spark, text):
    assert catalog.refusals(text) == []
    assert catalog.audit_query_log(spark.createDataFrame([(text,)], "sql string")).first()["allowed"]

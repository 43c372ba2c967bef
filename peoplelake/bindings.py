"""Workforce tables derived from the TPC-H-style driver tables, so every query grows with them.

No workforce table ships with the drivers: one order is one employee, one event one attendance record or application,
one line item one review. Dirty spellings are spread over the rows by key arithmetic; no row is filtered out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2002-01-01"

# Dirty spellings, fixed values.
DEPARTMENT_SPELLINGS = (
    "Engineering", "engineering", "ENGINEERING", "Engg", "Engg.", "Eng", "Eng.",
    "Sales", "sales", "SALES", "Sales Dept", "Sales-Team",
    "Marketing", "marketing", "MKTG", "Mktg.", "Marketing Dept",
    "Finance", "finance", "FIN", "Fin.", "Finance & Accounts",
    "Human Resources", "HR", "hr", "H.R.", "Human-Resources", "human resources",
    "Operations", "Ops", "OPS", "ops", "Op.",
    "Support", "support", "Cust Support", "Customer Support", "CS",
    "IT", "I.T.", "Information Technology", "Info Tech", "it",
    "Legal", " Legal ", "   ",
)
SALARY_WORDS = ("N/A", "unknown", "TBD", "-", "??", "null", "", "-5", "100000001", "pending", "1-2", "1.2.3")
BAD_DATES = (
    "2025-13-45", "31/02/2024", "not-a-date", "0000-00-00", "2099-01-01", "32-13-2024", "1900-00-15", "",
    "1949-12-31", "1950-01-01", "2002-01-01", "2002-01-02",
)
YES_SPELLINGS = ("yes", "y", "TRUE", "1", " Yes ")
NO_SPELLINGS = ("no", "n", "False", "0", "NO")
SKILLS = (
    "bookkeeping", "welding", "Forklift", "first aid", "Payroll law", "typing", "Negotiation", "Swahili", "CAD", "forecasting",
    "tax", "Mentoring", "auditing", "Dutch", "scheduling", "copy editing", "lab safety", "statistics", "Route planning",
)
STATUS_OF_EVENT = {"view": "Present", "click": "present", "signup": "absent", "purchase": "leave", "error": "WFH"}
STAGE_OF_EVENT = {
    "view": "applied", "click": "screen", "signup": "interview", "purchase": "offer", "error": "hired",
}
# One or more for each kind of intent rule, in spellings that hit it, miss it or hit several.
QUESTIONS = (
    "bottom 3 offices by tenure",
    "count of open contracts for {dept}",
    "Break-down of overtime, {dept} against Legal",
    "sort {dept} by median pay",
    "tell me about {dept}",
    "some background on the {dept} people, in general",
    "What's causing departures at {dept}?",
    "Root cause of the drop in {dept}, and the takeaways",
    "  hello!  ",
    "What is the weather in {dept}?",
    "Explain the rating of {dept} by country",
    "{dept} payroll",
    "Give me the story behind the churn in {dept}",
    "List {dept} hires",
)
ANSWERS = (
    "Example:\n```sql\nSELECT 1\n```\nYours:\n```SQL\nSELECT department FROM salary_by_department\nWHERE department = '{dept}'\n```",
    "```\nSELECT * FROM attrition_by_country LIMIT 5 ```",
    "Here is the query\n\nSELECT avg_salary\nFROM salary_by_department -- {dept}",
    "SELECT headcount FROM workforce_by_department",
    "```sql\n-- CANNOT_ANSWER: no {dept} data\n```",
    "I cannot answer this about {dept}",
    "",
)
STATEMENTS = (
    "SELECT department FROM salary_by_department WHERE department = '{dept}' LIMIT 5;",
    "with x as (select 1) select * from x",
    "DROP TABLE {dept}",
    "select 1; delete from t",
    "SELECT dataset, loaded FROM attrition_by_country",
    "copy t to '/tmp/{dept}.csv'",
    "  ",
    "SELECT * FROM read_text('{dept}')",
    "INSERT INTO t SELECT * FROM u; UPDATE t SET a = 1",
)
TABLE_REFS = ("attrition", "salary", "workforce", "performance", "bogus", "attrition_by_country", "performance_top")


@dataclass(frozen=True)
class Tables:
    """Lazy readers of one scale-factor folder."""

    spark: SparkSession
    folder: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def one_of(options: tuple[str, ...], position: Column) -> Column:
    """Option at a 0-based position modulo the number of options."""
    return F.get(F.array(*[F.lit(o) for o in options]), F.pmod(position, F.lit(len(options))).cast("int"))


def null_when(condition: Column, c: Column) -> Column:
    return F.when(~condition, c)


def mapped(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


def people(t: Tables) -> DataFrame:
    """Orders with their customer and nation. Join strategies follow the table sizes."""
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def employees(t: Tables) -> DataFrame:
    """Cleaned-employee shape, with some values missing in every dimension."""
    cust, status = F.col("o_custkey"), F.col("o_orderstatus")
    return people(t).select(
        F.col("o_orderkey").cast("string").alias("employee_id"),
        F.col("c_name").alias("name"),
        null_when(cust % 41 == 0, F.col("c_mktsegment")).alias("department"),
        null_when(cust % 59 == 0, F.col("n_name")).alias("country"),
        null_when(cust % 47 == 0, F.col("o_totalprice")).alias("salary"),
        F.when(status == "F", "Yes").when(status == "O", "No").alias("attrition"),
        null_when(cust % 43 == 0, F.col("o_orderdate").cast("date")).alias("joining_date"),
        null_when(cust % 37 == 0, F.substring("o_orderpriority", 1, 1).cast("int")).alias("performance_rating"),
        null_when(cust % 39 == 0, (cust % 36).cast("int")).alias("experience_years"),
    )


def feed(t: Tables) -> DataFrame:
    """Dirty employee feed as it sits in the raw layer; urgent leavers are delivered twice, the later one corrected."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    twice = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    rows = people(t).withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(twice, 2).otherwise(1))))
    price = (F.col("o_totalprice") + (F.col("copy") - 1) * 1000).cast("decimal(14,2)")
    whole = F.floor(price)
    style = key % 30
    salary = (
        F.when(style < len(SALARY_WORDS), one_of(SALARY_WORDS, style))
        .when(style == 12, F.concat(F.lit("$"), F.format_number(whole, 0)))
        .when(style == 13, F.concat(F.floor(price / 1000).cast("string"), F.lit("k")))
        .when(style == 14, F.format_number(price, 2))
        .when(style == 15, F.concat(F.lit("€"), F.format_number(whole, 0)))
        .when(style == 16, F.concat(F.lit("  "), price.cast("string"), F.lit(" INR  ")))
        .when(style != 17, price.cast("string"))
    )
    day = key % 40
    joined = F.when(day < len(BAD_DATES), one_of(BAD_DATES, day)).when(
        day != 12, F.date_format("o_orderdate", "yyyy-MM-dd"))
    r = key % 17
    rating = (
        F.when(r == 0, 0.0).when(r == 1, 4.7).when(r == 2, 5.4)
        .when(r != 3, F.substring("o_orderpriority", 1, 1).cast("double"))
    )
    x = key % 19
    experience = (
        F.when(x == 0, -1.0).when(x == 1, 60.0).when(x == 2, 61.0).when(x != 3, (cust % 36).cast("double"))
    )
    flag = (
        F.when(F.col("o_orderstatus") == "F", one_of(YES_SPELLINGS, key))
        .when(F.col("o_orderstatus") == "O", one_of(NO_SPELLINGS, key))
        .when(key % 2 == 0, "maybe")
    )
    nation = F.col("n_name")
    late = F.when((F.col("copy") == 2) & (cust % 2 == 1), 1).otherwise(0)
    ingest_ts = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=late)
    return rows.select(
        key.cast("string").alias("employee_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        null_when(key % 53 == 0, one_of(DEPARTMENT_SPELLINGS, key)).alias("department"),
        salary.alias("salary"),
        joined.alias("joining_date"),
        rating.alias("performance_rating"),
        F.when(cust % 23 == 0, "   ").when(cust % 29 != 0, F.concat(F.lit("Manager "), (cust % 50).cast("string")))
        .alias("manager"),
        flag.alias("attrition"),
        F.when(key % 3 == 0, F.lower(nation)).when(key % 3 == 1, F.concat(F.lit("  "), nation, F.lit(" ")))
        .otherwise(nation).alias("country"),
        null_when(key % 13 == 0, F.array(
            one_of(SKILLS, key), one_of(SKILLS, key * 7 + 3), one_of(SKILLS, cust), one_of(SKILLS, key))
        ).alias("skills"),
        experience.alias("experience"),
        (key * 2 + F.col("copy")).alias("offset"),
        ingest_ts.alias("ingest_ts"),
        F.to_date(ingest_ts).alias("ingest_date"),
    )


def hris_versions(t: Tables) -> DataFrame:
    """HRIS employee versions: high-priority people have a second, later version with a raise and a flipped state."""
    twice = F.col("o_orderpriority") == "2-HIGH"
    located = people(t).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = located.withColumn("version", F.explode(F.sequence(F.lit(1), F.when(twice, 2).otherwise(1))))
    v = F.col("version")
    hired = F.col("o_orderdate").cast("date")
    active = F.when(v == 1, F.col("o_orderstatus") != "F").otherwise(F.col("o_orderstatus") == "F")
    return rows.select(
        F.col("o_orderkey").cast("string").alias("employee_id"),
        F.col("c_mktsegment").alias("department"),
        F.col("r_name").alias("location"),
        F.concat(F.lit("L"), v.cast("string")).alias("grade"),
        (F.col("o_totalprice") + (v - 1) * 500).alias("base_salary"),
        active.alias("is_active"),
        hired.alias("hire_date"),
        F.when(~active, F.date_add(hired, 100)).alias("termination_date"),
        F.date_add(hired, v).cast("timestamp").alias("event_ts"),
    )


def _attendance_id() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))


def attendance(events: DataFrame) -> DataFrame:
    """Attendance records; several events of a person on a day share an id."""
    return events.select(
        _attendance_id().alias("attendance_id"),
        F.col("user_id").cast("string").alias("employee_id"),
        F.to_date("ts").alias("work_date"),
        (F.col("value") / 10).alias("hours_worked"),
        mapped(F.col("event_type"), STATUS_OF_EVENT).alias("status"),
        (F.col("value") > 100).alias("is_late"),
        F.col("event_id").alias("sequence"),
        F.col("ts").alias("event_ts"),
    )


def staff_of_events(t: Tables) -> DataFrame:
    """Dimension for the event-based facts: every customer as an employee. Events of other users are unknown to it."""
    known = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return known.select(
        F.col("c_custkey").cast("string").alias("employee_id"),
        F.col("c_mktsegment").alias("department"),
        F.col("r_name").alias("location"),
    )


def reviews(t: Tables) -> DataFrame:
    shipped = F.col("l_shipdate")
    half = F.when(F.month(shipped) <= 6, "-H1").otherwise("-H2")
    return t("lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_orderkey").cast("string").alias("employee_id"),
        F.concat(F.year(shipped).cast("string"), half).alias("cycle"),
        F.col("l_linenumber").alias("rating"),
        ((F.col("l_discount") - 0.05) * 1000).alias("goals_met_pct"),
        (F.col("l_returnflag") == "R").alias("promotion_flag"),
        F.col("l_extendedprice").alias("bonus_amount"),
        shipped.cast("timestamp").alias("event_ts"),
    )


def staff_of_reviews(t: Tables) -> DataFrame:
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("employee_id"), F.col("c_mktsegment").alias("department"))


def applications(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    events = t("events").join(t("customer"), F.col("user_id") == F.col("c_custkey"), "left")
    return events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), (F.col("event_id") % 7).cast("string"))
        .alias("application_id"),
        F.concat(F.lit("src"), (k % 5).cast("string")).alias("source"),
        F.when(k >= 90, "ghosted").otherwise(mapped(F.col("event_type"), STAGE_OF_EVENT)).alias("stage"),
        F.col("c_mktsegment").alias("department"),
        F.col("value").alias("offer_amount"),
        F.col("event_id").alias("sequence"),
        F.col("ts").alias("event_ts"),
    )


# -- message frames -------------------------------------------------------------------------------------------------------
def _messages(rows: DataFrame, topic: str, key: Column, value: Column, offset: Column, ts: Column) -> DataFrame:
    return rows.select(
        key.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(offset, F.lit(4)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
    )


def json_text(*pairs: tuple[str, Column, bool]) -> Column:
    """JSON object text from (name, value, quoted) triples; a missing value is a JSON null."""
    pieces = [F.lit("{")]
    for i, (name, value, quoted) in enumerate(pairs):
        mark = '"' if quoted else ""
        given = F.concat(F.lit(mark), value.cast("string"), F.lit(mark))
        pieces += [F.lit(f'{"," if i else ""}"{name}":'), F.coalesce(given, F.lit("null"))]
    return F.concat(*pieces, F.lit("}"))


def attendance_messages(events: DataFrame) -> DataFrame:
    """Attendance events as JSON: ids arrive as numbers, ``signup`` rows carry a bad field, ``error`` rows are broken."""
    kind = F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    hours = F.when(kind == "signup", '"abc"').otherwise((F.col("value") / 10).cast("string"))
    text = json_text(
        ("attendance_id", F.col("event_id"), False),
        ("employee_id", F.col("user_id"), False),
        ("work_date", F.date_format("ts", "yyyy-MM-dd"), True),
        ("punch_in", stamp, True),
        ("hours_worked", hours, False),
        ("status", mapped(kind, STATUS_OF_EVENT), True),
        ("is_late", F.col("value") > 100, False),
        ("event_ts", stamp, True),
    )
    broken = F.when(kind == "error", F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(text)
    return _messages(events, "attendance", F.col("user_id"), broken, F.col("event_id"), F.col("ts"))


def review_messages(t: Tables) -> DataFrame:
    rows = reviews(t)
    text = json_text(
        ("review_id", F.col("review_id"), True),
        ("employee_id", F.col("employee_id"), True),
        ("cycle", F.col("cycle"), True),
        ("rating", F.col("rating"), False),
        ("promotion_flag", F.col("promotion_flag"), False),
        ("bonus_amount", F.col("bonus_amount"), False),
        ("event_ts", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), True),
    )
    return _messages(rows, "performance", F.col("employee_id"), text,
                     F.col("employee_id").cast("bigint") * 8 + F.col("rating"), F.col("event_ts"))


def application_messages(t: Tables) -> DataFrame:
    rows = applications(t)
    text = json_text(
        ("application_id", F.col("application_id"), True),
        ("source", F.col("source"), True),
        ("stage", F.col("stage"), True),
        ("department", F.col("department"), True),
        ("offer_amount", F.col("offer_amount"), False),
        ("event_ts", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), True),
    )
    return _messages(rows, "recruitment", F.col("application_id"), text, F.col("sequence"), F.col("event_ts"))


# -- question and answer logs ---------------------------------------------------------------------------------------------
def filled(options: tuple[str, ...], position: Column, dept: Column) -> Column:
    return F.replace(one_of(options, position), F.lit("{dept}"), dept)


def order_texts(t: Tables, options: tuple[str, ...], name: str) -> DataFrame:
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_orderkey").alias("log_id"), filled(options, F.col("o_orderkey"), F.col("c_mktsegment")).alias(name))


def question_log(t: Tables) -> DataFrame:
    """Templated questions per order and the user turns of the conversation table."""
    asked = order_texts(t, QUESTIONS, "question").withColumn("log_id", F.concat(F.lit("o"), F.col("log_id")))
    spoken = t("conversations").filter(F.col("role") == "user").select(
        F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("log_id"), F.col("text").alias("question"))
    return asked.unionByName(spoken)


def table_questions(t: Tables) -> DataFrame:
    questions = order_texts(t, QUESTIONS, "question")
    return questions.withColumn("table_ref", one_of(TABLE_REFS, F.col("log_id")))


def turns(t: Tables) -> DataFrame:
    """User turns with the assistant turn that follows, if any. Joined on (conversation, turn), so long ones spread."""
    talk = t("conversations")
    asked = talk.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    answered = talk.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer_summary"))
    return asked.join(answered, ["conv_id", "turn"], "left")


# -- vectors --------------------------------------------------------------------------------------------------------------
def centroids(t: Tables) -> DataFrame:
    """One query vector per label: the mean of the label's vectors, aggregated per (label, dimension)."""
    cells = t("embeddings").select("label", F.posexplode("embedding").alias("at", "v"))
    means = cells.groupBy("label", "at").agg(F.avg("v").alias("v"))
    packed = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("cells"))
    return packed.select(
        F.col("label").alias("query_id"), F.transform("cells", lambda c: c["v"]).alias("query_vector"))

import pytest

from peoplelake.operators import routing

QUESTIONS = [
    ("Which department has the highest attrition rate?", "ANALYTICAL", 1.0, "accepted"),
    ("Show me the top 5 paying departments.", "ANALYTICAL", 1.0, "accepted"),
    ("How many employees joined in 2024?", "ANALYTICAL", 1.0, "accepted"),
    ("Tell me about our overall workforce health.", "SEMANTIC", 1.0, "accepted"),
    ("Why is Marketing attrition so high?", "HYBRID", 1.0, "accepted"),
    ("What's driving turnover in our top-paying departments?", "HYBRID", 1.0, "accepted"),
    ("Compare performance ratings across departments.", "ANALYTICAL", 1.0, "accepted"),
    ("Which countries have the largest headcount?", "SEMANTIC", 0.0, "needs_review"),
    ("  Hello!! ", "OFFTOPIC", 1.0, "accepted"),
    ("Sing me something", "OFFTOPIC", 0.6, "accepted"),
    ("My company", "SEMANTIC", 0.0, "needs_review"),
    ("Describe the average", "ANALYTICAL", 0.5, "needs_review"),
    ("weather report by top 3", "ANALYTICAL", 0.5, "needs_review"),
    ("WHAT SHOULD I KNOW", "SEMANTIC", 1.0, "accepted"),
]


def test_intents(spark):
    df = spark.createDataFrame([(i, q[0]) for i, q in enumerate(QUESTIONS)], "i int, question string")
    rows = routing.classify_intents(df).orderBy("i").collect()
    got = [(r["question"], r["intent"], r["confidence"], r["decision"]) for r in rows]
    assert got == QUESTIONS
    for r in rows:
        assert r["needs_sql"] == (r["intent"] in ("ANALYTICAL", "HYBRID"))
        assert r["needs_rag"] == (r["intent"] in ("SEMANTIC", "HYBRID"))


def test_classification_needs_no_shuffle(spark):
    df = spark.createDataFrame([("x",)], "question string")
    assert "Exchange" not in routing.classify_intents(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("answer, sql, refused", [
    ("```sql\nSELECT 1\n```\ntext\n```SQL\nSELECT 2\n```", "SELECT 2", False),
    ("``` select a\nfrom b ```", "select a\nfrom b", False),
    ("Here is the SQL:\n\n  SELECT 1\nFROM t\n", "SELECT 1\nFROM t", False),
    ("This query works\nSELECT 1", "SELECT 1", False),
    ("SELECT 1", "SELECT 1", False),
    ("Here only", "", False),
    ("```sql\n-- CANNOT_ANSWER: no data\n```", "-- CANNOT_ANSWER: no data", True),
    ("I cannot answer", "I cannot answer", False),
    ("", "", False),
    (None, "", False),
])
def test_sql_extraction(spark, answer, sql, refused):
    row = routing.extract_sql(spark.createDataFrame([(answer,)], "answer string")).first()
    assert (row["sql"], row["cannot_answer"]) == (sql, refused)


def test_table_resolution(spark):
    views = ["attrition_by_country", "attrition_by_department", "attrition_by_tenure_bucket", "salary_by_department",
             "salary_top_paying_depts"]
    cases = [
        ("attrition by country?", "attrition", "attrition_by_country", 2),
        ("attrition per Department", "attrition", "attrition_by_department", 1),
        ("attrition", "attrition", None, 0),
        ("by tenure bucket", "attrition_by", "attrition_by_tenure_bucket", 2),
        ("top paying", "salary", "salary_top_paying_depts", 2),
        ("country", "attri", None, 0),
        ("anything", "salary_by_department", "salary_by_department", 0),
        (None, "salary", None, 0),
        ("by the numbers", "attrition", "attrition_by_country", 1),
    ]
    df = spark.createDataFrame([(i, q, t) for i, (q, t, _, _) in enumerate(cases)], "i int, question string, table_ref string")
    out = routing.resolve_tables(df, views)
    assert [(r["question"], r["table_ref"], r["resolved_view"], r["score"]) for r in out.orderBy("i").collect()] == cases
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_conversation_window_and_context(spark):
    rows = [("hot", i, f" q{i}\nx ", "a" * 400 if i == 9 else f"a{i}") for i in range(10)] + [("b", 0, "only", None)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, question string, answer_summary string")
    kept = routing.last_turns(df, "conv_id", "turn").collect()
    assert sorted(r["turn"] for r in kept if r["conv_id"] == "hot") == [4, 5, 6, 7, 8, 9]
    got = {r["conv_id"]: r for r in routing.render_context(df, "conv_id", "turn").collect()}
    assert got["hot"]["context"] == (
        "Recent conversation:\n  User: q7 x\n  Assistant: a7\n  User: q8 x\n  Assistant: a8\n  User: q9 x\n  Assistant: "
        + "a" * 300)
    assert got["b"]["context"] == "Recent conversation:\n  User: only\n  Assistant: " and got["b"]["turns"] == 1

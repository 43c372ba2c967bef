"""Batch scoring of question logs: intent rules, table-name resolution, SQL extraction, conversation context.

Everything per-question is one projection; no question is ever paired with a rule table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.functions.text import squash_whitespace_ends

# Intents in precedence order, and the weighted patterns that vote for them.
INTENTS = ("ANALYTICAL", "SEMANTIC", "HYBRID", "OFFTOPIC")
INTENT_RULES = (
    (r"\btop\s+\d+\b", "ANALYTICAL", 2),
    (r"\bbottom\s+\d+\b", "ANALYTICAL", 2),
    (r"\bhow many\b", "ANALYTICAL", 2),
    (r"\bcount of\b", "ANALYTICAL", 2),
    (r"\b(highest|lowest|max(imum)?|min(imum)?)\b", "ANALYTICAL", 2),
    (r"\b(average|avg|median|mean|sum|total)\b", "ANALYTICAL", 2),
    (r"\b(rank|sort|order by|list)\b", "ANALYTICAL", 1),
    (r"\b(rate|ratio|percentage|pct|%)\b", "ANALYTICAL", 1),
    (r"\bcompare\b", "ANALYTICAL", 1),
    (r"\bbreak[\- ]?down\b", "ANALYTICAL", 1),
    (r"\b(tell me about|describe|summari[sz]e)\b", "SEMANTIC", 2),
    (r"\b(give me an overview|what.?s the situation)\b", "SEMANTIC", 2),
    (r"\bwhat should I know\b", "SEMANTIC", 2),
    (r"\b(narrative|story|context|background)\b", "SEMANTIC", 1),
    (r"\bin general\b", "SEMANTIC", 1),
    (r"\bwhy\s+(is|are|do|does|did)\b", "HYBRID", 2),
    (r"\bwhat\s+(is|are|'s|s)?\s*driving\b", "HYBRID", 2),
    (r"\bwhat\s+(is|are|'s|s)?\s*causing\b", "HYBRID", 2),
    (
        r"\b(driving|causing|leading\s+to|behind)\s+(the\s+)?"
        r"(attrition|turnover|churn|departures?|exits?|drop|spike|surge)\b",
        "HYBRID",
        2,
    ),
    (r"\b(explain|reason for|root cause)\b", "HYBRID", 2),
    (r"\b(insight|takeaway|implication)s?\b", "HYBRID", 1),
    (r"^\s*(hi|hello|hey|yo|good (morning|afternoon|evening))[\s!.?]*$", "OFFTOPIC", 3),
    (r"\b(weather|joke|recipe|movie|football|cricket|stock price)\b", "OFFTOPIC", 2),
)
# Words (matched anywhere, also inside longer words) that make a question on-topic.
TOPIC_WORDS = (
    "employee", "employees", "headcount", "attrition", "turnover", "salary", "salaries", "payroll", "pay",
    "compensation", "comp", "department", "departments", "dept", "country", "countries", "performance", "rating",
    "ratings", "hire", "hires", "hiring", "tenure", "experience", "workforce", "team", "talent",
)
OFFTOPIC_CONFIDENCE = 0.6
ACCEPT_CONFIDENCE = 0.75


def classify_intents(questions: DataFrame, text: str = "question") -> DataFrame:
    """Add rule scores per intent, the winning intent, its confidence, acceptance and the dispatch flags.

    A question no rule matches is off-topic unless it contains a topic word, in which case it stays undecided
    (semantic, confidence 0). Equal scores go to the earlier intent.
    """
    # The normalised text is a column of its own, so it is computed once and not once per rule.
    q = F.col("_q")
    normal = questions.withColumn("_q", F.lower(squash_whitespace_ends(F.col(text))))
    votes = {
        intent: sum(
            (F.when(q.rlike("(?iU)" + rule), weight).otherwise(0) for rule, target, weight in INTENT_RULES
             if target == intent),
            F.lit(0),
        )
        for intent in INTENTS
    }
    scored = normal.withColumns({f"score_{i.lower()}": v for i, v in votes.items()}).withColumn(
        "_on_topic", q.rlike("|".join(TOPIC_WORDS))
    )
    columns = [F.col(f"score_{i.lower()}") for i in INTENTS]
    total, best = sum(columns[1:], columns[0]), F.greatest(*columns)
    silent = total == 0
    winner = F.coalesce(*[F.when(c == best, F.lit(i)) for i, c in zip(INTENTS, columns)])
    decided = scored.select(
        *questions.columns,
        *columns,
        F.when(silent, F.when(F.col("_on_topic"), "SEMANTIC").otherwise("OFFTOPIC")).otherwise(winner).alias("intent"),
        F.when(silent, F.when(F.col("_on_topic"), 0.0).otherwise(OFFTOPIC_CONFIDENCE))
        .otherwise(F.try_divide(best, total))
        .alias("confidence"),
    )
    intent, confidence = F.col("intent"), F.col("confidence")
    accepted = (confidence >= ACCEPT_CONFIDENCE) | ((intent == "OFFTOPIC") & (confidence >= OFFTOPIC_CONFIDENCE))
    return decided.withColumns({
        "decision": F.when(accepted, "accepted").otherwise("needs_review"),
        "needs_sql": intent.isin("ANALYTICAL", "HYBRID"),
        "needs_rag": intent.isin("SEMANTIC", "HYBRID"),
    })


# The fenced block pattern, prose openers that may precede bare SQL, and the refusal marker.
FENCED_SQL = r"(?is)```(?:sql)?\s*(.+?)\s*```"
PROSE_OPENERS = ("here", "the sql", "this query")
CANNOT_ANSWER = "CANNOT_ANSWER"


def extract_sql(answers: DataFrame, text: str = "answer") -> DataFrame:
    """Add the last fenced SQL block of a model answer (or the answer without a prose first line) and a refusal flag."""
    blocks, lines = F.col("_blocks"), F.col("_lines")
    fenced = F.regexp_extract_all(text, F.lit(FENCED_SQL), 1)
    written = F.filter(F.split(text, r"\r?\n"), lambda x: squash_whitespace_ends(x) != "")
    opener = F.lower(F.coalesce(F.get(lines, F.lit(0)), F.lit("")))
    chatty = opener.startswith(PROSE_OPENERS[0])
    for start in PROSE_OPENERS[1:]:
        chatty = chatty | opener.startswith(start)
    body = F.when(chatty, F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1)))).otherwise(lines)
    sql = F.when(F.size(blocks) > 0, F.try_element_at(blocks, F.lit(-1))).otherwise(F.array_join(body, "\n"))
    split = answers.withColumns({"_blocks": fenced, "_lines": written})
    return (
        split.withColumn("sql", squash_whitespace_ends(F.coalesce(sql, F.lit(""))))
        .withColumn("cannot_answer", F.col("sql").contains(CANNOT_ANSWER))
        .drop("_blocks", "_lines")
    )


def resolve_tables(
    references: DataFrame, views: Sequence[str], question: str = "question", table_ref: str = "table_ref"
) -> DataFrame:
    """Map an unknown table name to the registered view it most likely means.

    A view is a candidate when the name is one of its underscore-delimited prefixes; its score is the number of
    remaining name parts that occur in the question. The best score wins, then the shorter name; a score of 0 resolves
    to nothing. The prefixes are spelled out once into a constant lookup the size of the view registry, so a question
    is resolved where it lies: no join, no shuffle on a handful of hot names.
    """
    prefixes: dict[str, list[dict]] = {}
    for view in views:
        parts = view.split("_")
        for cut in range(1, len(parts)):
            prefixes.setdefault("_".join(parts[:cut]), []).append({"view": view, "parts": parts[cut:]})
    lookup = F.from_json(F.lit(json.dumps(prefixes)), "map<string, array<struct<view: string, parts: array<string>>>>")
    name, known = F.col(table_ref), F.col(table_ref).isin(*views)
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(question), F.lit(""))), F.lit("[a-z0-9]+"), 0)

    def best_candidate(spoken: Column) -> Column:
        def scored(c: Column) -> Column:
            hits = F.size(F.filter(c["parts"], lambda part: F.array_contains(spoken, part)))
            return F.struct((-hits).alias("loss"), F.length(c["view"]).alias("size"), c["view"].alias("view"))

        return F.array_min(F.transform(F.try_element_at(lookup, name), scored))

    # Binding the words as a lambda argument makes them be extracted once per question, not once per candidate part.
    best = F.get(F.transform(F.array(words), best_candidate), F.lit(0))
    resolved = references.withColumn("_best", F.when(~known, best))
    return resolved.select(
        *references.columns,
        F.when(known, name).when(F.col("_best.loss") < 0, F.col("_best.view")).alias("resolved_view"),
        F.coalesce(-F.col("_best.loss"), F.lit(0)).alias("score"),
    )


# Turns remembered, turns rendered, and characters per rendered side of a turn.
MAX_TURNS = 6
RENDER_TURNS = 3
RENDER_CHARS = 300


def last_turns(turns: DataFrame, conversation: str, position: str, n: int = MAX_TURNS) -> DataFrame:
    """Newest ``n`` turns per conversation. The group limit runs before the shuffle, so long conversations stay cheap."""
    newest = Window.partitionBy(conversation).orderBy(F.desc(position))
    return turns.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= n)


def render_context(
    turns: DataFrame,
    conversation: str,
    position: str,
    question: str = "question",
    answer: str = "answer_summary",
    n: int = RENDER_TURNS,
    max_chars: int = RENDER_CHARS,
) -> DataFrame:
    """Prompt block of the last ``n`` turns, oldest first; each conversation gathers at most ``n`` rows."""

    def side(column: str) -> Column:
        text = F.replace(squash_whitespace_ends(F.col(column)), F.lit("\n"), F.lit(" "))
        return F.coalesce(F.substring(text, 1, max_chars), F.lit(""))

    block = F.concat(F.lit("  User: "), side(question), F.lit("\n  Assistant: "), side(answer))
    recent = last_turns(turns, conversation, position, n).select(
        conversation, F.struct(F.col(position).alias("at"), block.alias("block")).alias("_turn")
    )
    gathered = recent.groupBy(conversation).agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    lines = F.transform("_turns", lambda t: t["block"])
    return gathered.select(
        conversation,
        F.size("_turns").alias("turns"),
        F.concat(F.lit("Recent conversation:\n"), F.array_join(lines, "\n")).alias("context"),
    )

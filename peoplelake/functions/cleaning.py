"""Column expressions that repair single fields. All are codegen-friendly built-ins; none can fail a row under ANSI.

Multi-step repairs are split where an intermediate value is used more than once, so that a plan can keep that value in
a column of its own and compute it once per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical department and the spellings it absorbs, tried in this order.
DEPARTMENT_PATTERNS = (
    ("Engineering", r"^(eng|engg|engineering)\.?$"),
    ("Sales", r"^sales(\s*(dept|team|-team))?$"),
    ("Marketing", r"^(marketing|mktg)\.?(\s*dept)?$"),
    ("Finance", r"^(finance|fin)\.?$|^finance\s*&\s*accounts$"),
    ("Human Resources", r"^(hr|h\.r\.|human[\s\-]*resources)$"),
    ("Operations", r"^(ops|op|operations)\.?$"),
    ("Support", r"^(support|cs|cust(omer)?\s*support)$"),
    ("IT", r"^(it|i\.t\.|info(rmation)?\s*tech(nology)?)$"),
)
DEPARTMENTS = tuple(name for name, _ in DEPARTMENT_PATTERNS)
# Salary words that mean "no value", the thousands form, and the plausible ranges.
SALARY_PLACEHOLDERS = ("n/a", "unknown", "tbd", "-", "??", "null", "")
THOUSANDS_FORM = r"^[\d,. ]+\s*[kK]\s*$"
SALARY_RANGE = (0, 100_000_000)
RATING_RANGE = (1, 5)
EXPERIENCE_RANGE = (0, 60)
HOURS_RANGE = (0, 24)
EARLIEST_YEAR = 1950
# Spellings of a yes/no answer.
YES_WORDS = ("yes", "y", "true", "1")
NO_WORDS = ("no", "n", "false", "0")


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The reporting day: a literal when given (repeatable runs), the wall clock otherwise."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def folded(c: Column) -> Column:
    """Case- and margin-insensitive form used for matching."""
    return F.lower(F.trim(c))


def department_of(key: Column, otherwise: Column) -> Column:
    """Canonical name of a folded spelling: the first pattern that matches, else ``otherwise``."""
    matches = [F.when(key.rlike(pattern), F.lit(name)) for name, pattern in DEPARTMENT_PATTERNS]
    return F.coalesce(*matches, otherwise)


def canonical_department(c: Column) -> Column:
    """First matching canonical name, else the text as it came; null stays null."""
    return department_of(folded(c), c)


def salary_amount(text: Column) -> Column:
    """Number in a folded money text: currency signs, separators, a ``k`` suffix and trailing units are understood."""
    in_thousands = text.rlike(THOUSANDS_FORM)
    kept = F.regexp_replace(text, F.when(in_thousands, r"[^0-9.]").otherwise(r"[^0-9.\-]"), F.lit(""))
    amount = kept.try_cast("double") * F.when(in_thousands, 1000).otherwise(1)
    return F.when(~text.isin(*SALARY_PLACEHOLDERS), amount)


def parse_salary(c: Column) -> Column:
    """Money text to double, null when it is not a number or not plausible."""
    return null_outside(salary_amount(folded(c)), SALARY_RANGE)


def iso_day(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd")


def plausible_day(day: Column, as_of: dt.date | str | None = None) -> Column:
    """No earlier than 1950 and no later than the reporting day, else null."""
    return F.when((F.year(day) >= EARLIEST_YEAR) & (day <= as_of_date(as_of)), day)


def parse_iso_date(c: Column, as_of: dt.date | str | None = None) -> Column:
    return plausible_day(iso_day(c), as_of)


def yes_no_of(word: Column) -> Column:
    return F.when(word.isin(*YES_WORDS), "Yes").when(word.isin(*NO_WORDS), "No")


def yes_no(c: Column) -> Column:
    return yes_no_of(folded(c))


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def distinct_sorted(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def length_or_zero(c: Column) -> Column:
    return F.coalesce(F.array_size(c), F.lit(0))


def whole_number_within(c: Column, bounds: tuple[int, int]) -> Column:
    """Truncate to int inside the bounds, null outside."""
    return F.when(c.between(*bounds), c.cast("int"))


def null_outside(c: Column, bounds: tuple[int, int]) -> Column:
    return F.when(c.between(*bounds), c)

"""Explicit schemas of the incoming JSON streams, written as DDL.

``from_json`` makes every field nullable, so the required keys are listed next to each schema instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class StreamSchema:
    name: str
    ddl: str
    required: tuple[str, ...]
    key: str = "employee_id"

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.ddl)


# Field names and types of the five feeds.
STREAMS: dict[str, StreamSchema] = {
    s.name: s
    for s in (
        StreamSchema(
            "employees",
            "employee_id string, first_name string, last_name string, email string, gender string, "
            "date_of_birth date, hire_date date, termination_date date, department string, job_title string, "
            "grade string, manager_id string, location string, country string, employment_type string, "
            "base_salary double, currency string, is_active boolean, event_ts timestamp",
            ("employee_id", "event_ts"),
        ),
        StreamSchema(
            "employee_csv",
            "employee_id string, name string, department string, salary string, joining_date string, "
            "performance_rating double, manager string, attrition string, country string, "
            "skills array<string>, experience double",
            (),
        ),
        StreamSchema(
            "attendance",
            "attendance_id string, employee_id string, work_date date, punch_in timestamp, punch_out timestamp, "
            "hours_worked double, status string, leave_type string, is_late boolean, event_ts timestamp",
            ("attendance_id", "employee_id", "work_date", "event_ts"),
        ),
        StreamSchema(
            "performance",
            "review_id string, employee_id string, cycle string, rating int, rating_label string, "
            "goals_met_pct double, reviewer_id string, comments string, promotion_flag boolean, "
            "bonus_amount double, event_ts timestamp",
            ("review_id", "employee_id", "cycle", "event_ts"),
        ),
        StreamSchema(
            "recruitment",
            "application_id string, requisition_id string, candidate_id string, source string, stage string, "
            "department string, job_title string, location string, recruiter_id string, offer_amount double, "
            "currency string, event_ts timestamp",
            ("application_id", "requisition_id", "candidate_id", "event_ts"),
            key="application_id",
        ),
    )
}

# Columns the raw layer adds around the parsed payload.
LOG_COLUMNS = ("topic", "partition", "offset", "kafka_ts", "kafka_key", "_raw")


def stream_schema(name: str) -> StreamSchema:
    try:
        return STREAMS[name]
    except KeyError:
        raise ValueError(f"unknown stream {name!r}; known: {sorted(STREAMS)}") from None

from tidemark.plans.landing import (
    REPORT_SCHEMA, EmptySourceError, LandingError, RuleViolation, RunReport, configs_from_frame, land_table, land_tables, load_source,
)

__all__ = [
    "REPORT_SCHEMA", "EmptySourceError", "LandingError", "RuleViolation", "RunReport", "land_table",
    "land_tables", "load_source", "configs_from_frame",
]

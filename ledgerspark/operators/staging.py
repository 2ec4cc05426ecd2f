"""Staging: typed views of the bronze tables (pure column casts, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Staged column types.
GL_TYPES = [("entry_id", "string"), ("entry_date", "date"), ("project_code", "string"),
            ("project_name", "string"), ("segment", "string"), ("cost_centre", "string"),
            ("account_code", "string"), ("account_name", "string"), ("account_type", "string"),
            ("currency", "string"), ("amount", "decimal(18,2)"), ("description", "string")]
FX_TYPES = [("rate_date", "date"), ("from_currency", "string"), ("to_currency", "string"),
            ("rate", "decimal(12,6)")]
PAYROLL_TYPES = [("allocation_id", "string"), ("allocation_date", "date"), ("employee_id", "string"),
                 ("project_code", "string"), ("cost_centre", "string"), ("hours_logged", "decimal(8,2)"),
                 ("rate_per_hour", "decimal(10,2)"), ("cost_inr", "decimal(18,2)")]


def _cast_all(df: DataFrame, types: list[tuple[str, str]], lenient: bool) -> DataFrame:
    # ANSI casts fail the job on a bad value and on an absent column; `lenient` turns
    # both into nulls the quality gates then report (used on dirty bronze input).
    def cast(c: str, t: str):
        if not lenient:
            return F.col(c).cast(t)
        return F.expr(f"try_cast(`{c}` as {t})") if c in df.columns else F.lit(None).cast(t)

    return df.select(*[cast(c, t).alias(c) for c, t in types])


def stage_gl(df: DataFrame, lenient: bool = False) -> DataFrame:
    return _cast_all(df, GL_TYPES, lenient)


def stage_fx(df: DataFrame, lenient: bool = False) -> DataFrame:
    return _cast_all(df, FX_TYPES, lenient)


def stage_payroll(df: DataFrame, lenient: bool = False) -> DataFrame:
    return _cast_all(df, PAYROLL_TYPES, lenient)

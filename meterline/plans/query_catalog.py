"""Registered queries: an id and typed parameters in, a bounded result out."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from datetime import date
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame

from meterline.plans import operations_reports as ops
from meterline.plans import personal_reports as pers
from meterline.plans.area import Area


class QueryRejected(ValueError):
    """The request names no enabled query, has wrong parameters or returns too many rows."""


def _text(value) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError("a non-empty text is required")
    return value


def _date(value) -> str:
    return value.isoformat() if isinstance(value, date) else date.fromisoformat(value).isoformat()


def _month_start(value) -> str:
    text = _date(value)
    if not text.endswith("-01"):
        raise ValueError("the first day of a month is required")
    return text


def _year_month(value) -> str:
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", value):
        raise ValueError("YYYY-MM is required")
    return value


def _number(value) -> Decimal:
    try:
        return Decimal(str(value))
    except InvalidOperation:
        raise ValueError("a number is required") from None


_READERS = {
    "text": _text, "date": _date, "month_start": _month_start, "year_month": _year_month,
    "numeric": _number,
}


@dataclass(frozen=True)
class RegisteredQuery:
    query_id: str
    area: str
    run: Callable[..., DataFrame]
    parameters: tuple[tuple[str, str], ...] = ()
    max_rows: int | None = None
    enabled: bool = True


def _parameters(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(part.split(":")) for part in text.split()) if text else ()


_PERIOD = "start_date:month_start end_date_exclusive:month_start"


def _catalog() -> dict[str, RegisteredQuery]:
    rows = [
        ("OPS_ANALYSIS_001", ops.plan_mix_by_age_band, "as_of_date:date", None),
        ("OPS_ANALYSIS_002", ops.monthly_usage_statistics, _PERIOD, None),
        ("OPS_ANALYSIS_003", ops.usage_against_allowance, _PERIOD + " as_of_date:date", None),
        ("OPS_ANALYSIS_004", ops.category_mix, _PERIOD, None),
        ("OPS_ANALYSIS_005", ops.usage_distribution, _PERIOD, None),
        ("OPS_ANALYSIS_006", ops.bundle_internet_matrix, "", None),
        ("PERS_001", pers.monthly_usage, "user_id:text from_month:date to_month:date", 36),
        ("PERS_002", pers.daily_usage_of_month, "user_id:text year_month:year_month", 31),
        ("PERS_003", pers.detail_usage_of_day, "user_id:text usage_date:date", 100),
        ("PERS_004", pers.monthly_category_usage, "user_id:text year_month:year_month", 100),
        ("PERS_005", pers.monthly_detail_usage, "user_id:text year_month:year_month", 100),
        ("PERS_006", pers.selected_service_usage, "user_id:text year_month:year_month", 100),
        ("PERS_007", pers.recent_usage, "user_id:text", 1),
        ("PERS_008", pers.current_plan, "user_id:text", 1),
        ("PERS_009", pers.current_services, "user_id:text", 20),
        ("PERS_010", pers.current_discounts, "user_id:text", 20),
        ("PERS_011", pers.family_status, "user_id:text", 1),
        ("PERS_012", pers.recommendation_context, "user_id:text", 1),
        ("PERS_013", pers.plan_candidates, "min_fee:numeric max_fee:numeric", 200),
        ("PERS_014", pers.plan_benefits, "plan_id:text", 100),
        ("PERS_015", pers.available_dates, "user_id:text", 1),
    ]
    return {
        query_id: RegisteredQuery(
            query_id,
            "operations" if query_id.startswith("OPS") else "personalization",
            run,
            _parameters(parameters),
            max_rows,
        )
        for query_id, run, parameters, max_rows in rows
    }


CATALOG = _catalog()


def disable(catalog: Mapping[str, RegisteredQuery], *query_ids: str) -> dict[str, RegisteredQuery]:
    return {
        name: replace(query, enabled=False) if name in query_ids else query
        for name, query in catalog.items()
    }


def prepare(
    area: Area, query_id: str, parameters: Mapping, catalog: Mapping[str, RegisteredQuery] = CATALOG
) -> DataFrame:
    """Check the request and return the lazy result."""
    query = catalog.get(query_id)
    if query is None or not query.enabled or query.area != area.name:
        raise QueryRejected(f"{query_id} is not an enabled query of the {area.name} area")
    expected = [name for name, _ in query.parameters]
    if sorted(parameters) != sorted(expected):
        raise QueryRejected(f"{query_id} takes exactly {expected}")
    values = []
    for name, kind in query.parameters:
        try:
            values.append(_READERS[kind](parameters[name]))
        except (TypeError, ValueError) as problem:
            raise QueryRejected(f"{query_id} parameter {name}: {problem}") from None
    if query.parameters[:2] == _parameters(_PERIOD) and values[0] >= values[1]:
        raise QueryRejected(f"{query_id}: the period is empty")
    return query.run(area, *values)


def run(
    area: Area, query_id: str, parameters: Mapping, catalog: Mapping[str, RegisteredQuery] = CATALOG
) -> DataFrame:
    """Result of a registered query; more rows than it allows is an error, never a cut."""
    result = prepare(area, query_id, parameters, catalog)
    max_rows = catalog[query_id].max_rows
    if max_rows is None:
        return result
    rows = result.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise QueryRejected(f"{query_id} returns more than {max_rows} rows")
    return result.sparkSession.createDataFrame(rows, result.schema)

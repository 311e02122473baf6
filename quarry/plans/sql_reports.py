"""The reports as SQL text with named parameters over views that are registered on demand (S9, S10; R1-R7, R9).

A statement names its tables as ``{table}``; only these become temporary views. Values go in as parameters
(``:label``), never as text. ``try_cast`` stands for the implicit cast of the dirty label, which ANSI mode rejects.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from quarry.plans import analog
from quarry.sources.tables import Warehouse

_PER_CLIENT = "(SELECT client_id, count(id) AS n FROM {hires} WHERE try_cast(hired AS DOUBLE) = :label GROUP BY client_id)"
_CONTACTS = f"""
SELECT CAST(sum(c.n * h.n) AS BIGINT) AS count, c.contact_method
FROM (SELECT client_id, contact_method, count(id) AS n FROM {{communication}} GROUP BY client_id, contact_method) c
JOIN {_PER_CLIENT} h ON c.client_id = h.client_id
GROUP BY c.contact_method ORDER BY count, contact_method"""
_BY_CLIENT_COLUMN = f"""
SELECT CAST(sum(h.n) AS BIGINT) AS %s, bio.%s
FROM {_PER_CLIENT} h JOIN {{bio}} bio ON bio.client_id = h.client_id
GROUP BY bio.%s ORDER BY %s"""

#: Name -> statement and the label it asks for. Facts are counted per client before they meet the dimension or the contacts.
STATEMENTS: dict[str, tuple[str, float | None]] = {
    "sql_created_by_month": ("SELECT count(id) AS n_created, CAST(month(create_date) AS BIGINT) AS month FROM {activities} GROUP BY month ORDER BY month", None),
    "sql_registered_by_year": (
        "SELECT count(id) AS n_registered, CAST(year(create_date) AS BIGINT) AS year_registered FROM {activities} GROUP BY year_registered ORDER BY year_registered",
        None,
    ),
    "sql_hired_by_branch": (_BY_CLIENT_COLUMN % ("hired", "service_branch", "service_branch", "hired, service_branch"), 1.0),
    "sql_not_hired_by_branch": (_BY_CLIENT_COLUMN % ("not_hired", "service_branch", "service_branch", "not_hired, service_branch"), 0.0),
    "sql_hired_by_rank": (_BY_CLIENT_COLUMN % ("hired", "service_rank", "service_rank", "hired DESC, service_rank"), 1.0),
    "sql_contact_method_hired": (_CONTACTS, 1.0),
    "sql_contact_method_not_hired": (_CONTACTS, 0.0),
    "sql_star_join_wide": (
        """SELECT hired, Service_R AS service_rank, Service_B AS service_branch, S_years AS years_in_service,
       R_years AS reg_after_years, responsive, active AS resume_done FROM {star} WHERE try_cast(hired AS DOUBLE) = :label""",
        1.0,
    ),
}


def run_statement(wh: Warehouse, text: str, tables: dict[str, Callable[[], DataFrame]], args: dict[str, Any], prefix: str = "dw_") -> DataFrame:
    """Run ``text`` after registering the tables it names in braces, and no others, as ``<prefix><table>``."""
    named = {name for _, name, _, _ in string.Formatter().parse(text) if name}
    for name in named:
        tables[name]().createOrReplaceTempView(prefix + name)
    return wh.spark.sql(text.format(**{name: prefix + name for name in named}), args)


def _report(name: str) -> Callable[[Warehouse], DataFrame]:
    text, label = STATEMENTS[name]

    def run(wh: Warehouse) -> DataFrame:
        return run_statement(wh, text, analog.warehouse_views(wh, label), {} if label is None else {"label": label})

    run.__name__ = name
    run.__doc__ = f"S9 / S10: the report {name.removeprefix('sql_')} as SQL text."
    return run


REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {name: _report(name) for name in STATEMENTS}

"""Composed SQL-style reports over the warehouse analog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import month_of, year_of
from quarry.operators.joins import count_many_to_many, count_through_dimension
from quarry.operators.relational import group_count
from quarry.plans import analog
from quarry.sources.tables import Warehouse


def created_by_month(wh: Warehouse) -> DataFrame:
    """``count(id)`` per month of the create date, by month."""
    act = analog.activities(wh)
    return (
        act.groupBy(month_of("create_date").alias("month"))
        .agg(F.count("id").alias("n_created"))
        .select("n_created", "month")
        .orderBy("month")
    )


def registered_by_year(wh: Warehouse) -> DataFrame:
    """R2: ``count(id)`` per year of the create date, by year."""
    act = analog.activities(wh)
    return (
        act.groupBy(year_of("create_date").alias("year_registered"))
        .agg(F.count("id").alias("n_registered"))
        .select("n_registered", "year_registered")
        .orderBy("year_registered")
    )


def _hires_with_label(wh: Warehouse, label: float) -> DataFrame:
    return analog.hires_with_label(wh, label)


def hired_by_branch(wh: Warehouse, label: float = 1.0, out: str = "hired") -> DataFrame:
    """R3 (R4 with ``label=0``): hires per service branch, ascending by count.

    Orders are counted per client before the join to the client table, so the
    join sees one row per client however many orders one client holds.
    """
    counts = count_through_dimension(
        _hires_with_label(wh, label), "client_id", "id",
        analog.bio(wh), "client_id", ["service_branch"], out,
    )
    return counts.select(out, "service_branch").orderBy(F.col(out).asc(), F.col("service_branch"))


def not_hired_by_branch(wh: Warehouse) -> DataFrame:
    """R4."""
    return hired_by_branch(wh, label=0.0, out="not_hired")


def hired_by_rank(wh: Warehouse) -> DataFrame:
    """Hires per service rank, descending by count."""
    counts = count_through_dimension(
        _hires_with_label(wh, 1.0), "client_id", "id",
        analog.bio(wh), "client_id", ["service_rank"], "hired",
    )
    return counts.select("hired", "service_rank").orderBy(F.col("hired").desc(), F.col("service_rank"))


def contact_method(wh: Warehouse, label: float = 1.0) -> DataFrame:
    """``count(com.id)`` per contact method of the (not) hired.

    Contacts and hires meet on the client, m:n; both sides are aggregated per
    client first and the products summed, which equals the join's row count.
    """
    counts = count_many_to_many(
        analog.communication(wh), "client_id", "id", ["contact_method"],
        _hires_with_label(wh, label), "client_id", "count",
    )
    return counts.select("count", "contact_method").orderBy(F.col("count"), F.col("contact_method"))


def contact_method_hired(wh: Warehouse) -> DataFrame:
    return contact_method(wh, 1.0)


def contact_method_not_hired(wh: Warehouse) -> DataFrame:
    return contact_method(wh, 0.0)


def clients_per_branch(wh: Warehouse) -> DataFrame:
    """Clients per service branch (``groupBy().count()``)."""
    return group_count(wh.customer.select(F.col("c_mktsegment").alias("service_branch")), "service_branch")


def hires_per_job_function(wh: Warehouse) -> DataFrame:
    """Hiring rows per job function."""
    return group_count(analog.hires(wh), "job_function")


def ratings_per_movie(wh: Warehouse) -> DataFrame:
    """Ratings (line items) per movie (part)."""
    return group_count(wh.lineitem.select(F.col("l_partkey").alias("movie_id")), "movie_id")


def star_join_wide(wh: Warehouse) -> DataFrame:
    """Wide star-join extract of the hired, label compared as text."""
    star = analog.client_star(wh, statuses=analog.statuses_with_label(lambda label: label == "1"))
    return star.where(F.col("hired") == F.lit("1")).select(
        "hired",
        F.col("Service_R").alias("service_rank"),
        F.col("Service_B").alias("service_branch"),
        F.col("S_years").alias("years_in_service"),
        F.col("R_years").alias("reg_after_years"),
        F.col("responsive").alias("responsive"),
        F.col("active").alias("resume_done"),
    )


def filter_join_project(wh: Warehouse, director: str = "Brand#13") -> DataFrame:
    """One director's movies joined to their ratings (USING the key)."""
    movies = wh.part.select(F.col("p_partkey").alias("movie_id"), F.col("p_brand").alias("director"))
    ratings = wh.lineitem.select(
        F.col("l_partkey").alias("movie_id"),
        F.col("l_orderkey").alias("user_id"),
        F.col("l_quantity").alias("rating"),
    )
    quoted = director.replace("\\", "\\\\").replace("'", "\\'")
    return (
        movies.where(f"director = '{quoted}'")
        .join(ratings, "movie_id")
        .select("movie_id", "director", "user_id", "rating")
    )

"""The seven questions over film-rental tables, as lazy DataFrames.

``tables`` maps the names of ``lakeshelf.schemas.RENTAL`` to frames. Wherever the question leaves
room, ties are kept and durations are exact; the variants that cut ties, count whole days or
treat every value but 1 as inactive are parameters.

Counts and sums climb the join chain key by key (``lakeshelf.operators.aggregates``) and the
final grouping repeats the dimension's key next to its name, so equal names stay apart.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.functions import (
    contains_text,
    exact_seconds,
    starts_with_ignoring_case,
    whole_days,
)
from lakeshelf.operators.aggregates import add_up, carry_up, count_rows, flag_count
from lakeshelf.operators.joins import without_match
from lakeshelf.operators.ranking import leaders_per_group, top_k, top_k_cut
from lakeshelf.operators.reduction import possible_matches
from lakeshelf.operators.rows import tag_rows

Tables = Mapping[str, DataFrame]


def films_per_category(tables: Tables, check_films: bool = True) -> DataFrame:
    """1: number of films per category, largest first.

    ``check_films`` leaves out links to films that do not exist.
    """
    links = tables["film_category"].select("film_id", "category_id")
    if check_films:
        links = links.join(tables["film"].select("film_id"), "film_id")
    counts = carry_up(
        count_rows(links, ["category_id"]),
        tables["category"],
        "category_id",
        ["category_id", "name"],
        ["cnt"],
    )
    return counts.orderBy(F.desc("cnt"), "category_id").select("name", "cnt")


def _copies(tables: Tables) -> DataFrame:
    """Inventory of films that exist."""
    inventory = tables["inventory"].select("inventory_id", "film_id")
    return inventory.join(tables["film"].select("film_id"), "film_id")


def _rentals_per_actor(tables: Tables) -> DataFrame:
    n = ["rental_cnt"]
    per_copy = count_rows(tables["rental"], ["inventory_id"], "rental_cnt")
    per_film = carry_up(per_copy, _copies(tables), "inventory_id", ["film_id"], n, splittable=True)
    per_actor = carry_up(per_film, tables["film_actor"], "film_id", ["actor_id"], n)
    return carry_up(
        per_actor, tables["actor"], "actor_id", ["actor_id", "first_name", "last_name"], n
    )


def most_rented_actors(tables: Tables, k: int = 10, keep_ties: bool = True) -> DataFrame:
    """2: the ``k`` actors whose films were rented most."""
    counts = _rentals_per_actor(tables)
    if not keep_ties:
        cut = top_k_cut(counts, "rental_cnt", k, ["actor_id"])
        return cut.select("first_name", "last_name", "rental_cnt")
    return (
        top_k(counts, "rental_cnt", k, "rank", "actor_rental_rank")
        .orderBy("actor_rental_rank", "actor_id")
        .select("first_name", "last_name", "rental_cnt", "actor_rental_rank")
    )


def top_category_by_amount(tables: Tables, keep_ties: bool = True) -> DataFrame:
    """3: the category on which most money was spent; null amounts count for nothing."""
    amt = ["amt"]
    # A rental has one or a few payments: summing them first would only add a shuffle.
    paid = tables["payment"].select("rental_id", F.col("amount").alias("amt"))
    sums = carry_up(paid, tables["rental"], "rental_id", ["inventory_id"], amt)
    sums = carry_up(sums, _copies(tables), "inventory_id", ["film_id"], amt, splittable=True)
    sums = carry_up(sums, tables["film_category"], "film_id", ["category_id"], amt)
    sums = carry_up(sums, tables["category"], "category_id", ["category_id", "name"], amt)
    sums = sums.withColumn("amt", F.col("amt").cast("decimal(28,2)"))
    if not keep_ties:
        return top_k_cut(sums, "amt", 1, ["category_id"]).select("name")
    return top_k(sums, "amt", 1, "rank", "category_amt_rank").select(
        "name", "amt", "category_amt_rank"
    )


def films_without_inventory(tables: Tables) -> DataFrame:
    """4: titles of films that are not in the inventory, sorted."""
    missing = without_match(tables["film"], tables["inventory"], "film_id", "film_id")
    # The id spreads equal titles over the sort's partitions.
    return missing.orderBy("title", "film_id").select("title")


def top_actors_of_category(
    tables: Tables, category: str = "Children", k: int = 3, reduce: bool = False
) -> DataFrame:
    """5: actors with the ``k`` highest numbers of films in a category, ties kept.

    ``reduce`` drops actors of other categories' films before the shuffle, at the price of
    another pass over the category's films: for links too many to shuffle whole.
    """
    n = ["actor_film_cnt"]
    wanted = tables["category"].where(F.col("name") == category).select("category_id")
    films = tables["film_category"].select("film_id", "category_id").join(wanted, "category_id")
    films = films.join(tables["film"].select("film_id"), "film_id")
    per_film = count_rows(films, ["film_id"], "actor_film_cnt", splittable=True)
    film_actor = tables["film_actor"]
    if reduce:
        film_actor = possible_matches(film_actor, films, "film_id")
    per_actor = carry_up(per_film, film_actor, "film_id", ["actor_id"], n)
    per_actor = carry_up(
        per_actor, tables["actor"], "actor_id", ["actor_id", "first_name", "last_name"], n
    )
    return (
        top_k(per_actor, "actor_film_cnt", k, "dense_rank", "actor_rank")
        .orderBy("actor_rank", "actor_id")
        .select("first_name", "last_name", "actor_film_cnt", "actor_rank")
    )


def customers_per_city(tables: Tables, inactive: str = "zero") -> DataFrame:
    """6: active and inactive customers per city, most inactive first.

    The active count is the sum of the flag. Inactive is ``active = 0``, or with
    ``inactive="not_one"`` any other known value than 1.
    """
    active = F.col("active")
    rule = {"zero": active == 0, "not_one": active != 1}[inactive]
    counts = ["active_cnt", "inactive_cnt"]
    sums = tables["customer"].groupBy("address_id").agg(
        F.sum(active).alias("active_cnt"), flag_count(rule).alias("inactive_cnt")
    )
    sums = carry_up(sums, tables["address"], "address_id", ["city_id"], counts)
    sums = carry_up(sums, tables["city"], "city_id", ["city_id", "city"], counts)
    return sums.orderBy(F.desc("inactive_cnt"), "city_id").select("city", *counts)


def city_patterns(city: Column) -> dict[str, Column]:
    """The two groups of cities that question 7 asks for, by output title."""
    # The titles.
    return {
        "most popular category for A% cities:": starts_with_ignoring_case(city, "a"),
        "most popular category for %-% cities:": contains_text(city, "-"),
    }


def longest_rented_categories(
    tables: Tables,
    patterns: Mapping[str, Column] | None = None,
    measure: str = "seconds",
    reduce: bool = False,
) -> DataFrame:
    """7: per group of cities, the category with the longest total rental time.

    One pass for all groups: cities are tagged first, the tags travel to the customers, and
    rentals of other customers are dropped before anything is summed; with ``reduce`` most of
    them before they are shuffled, at the price of another pass over the customers: for few
    cities and many rentals. ``measure`` is ``"seconds"`` (exact) or ``"days"`` (whole calendar
    days).
    """
    start, end = F.col("rental_date"), F.col("return_date")
    time = {"seconds": exact_seconds, "days": whole_days}[measure](start, end)
    cities = tables["city"].select("city_id", "city")
    tagged = tag_rows(cities, patterns or city_patterns(F.col("city")), "title").drop("city")
    tagged = tables["address"].select("address_id", "city_id").join(tagged, "city_id")
    tagged = tables["customer"].select("customer_id", "address_id").join(tagged, "address_id")
    returned = (
        tables["rental"].where(end.isNotNull()).select("customer_id", "inventory_id", time.alias("rtime"))
    )
    if reduce:
        returned = possible_matches(returned, tagged, "customer_id")
    t, kept = ["rtime"], ["title"]
    sums = add_up(
        returned.join(tagged.select("customer_id", "title"), "customer_id"), ["inventory_id", *kept], t
    )
    sums = carry_up(sums, tables["inventory"], "inventory_id", ["film_id"], t, kept)
    sums = carry_up(sums, tables["film_category"], "film_id", ["category_id"], t, kept)
    sums = carry_up(sums, tables["category"], "category_id", ["name"], t, kept)
    return leaders_per_group(sums, "rtime", "title", few_groups=True).select("title", "name")

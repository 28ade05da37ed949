"""Declared schemas, table lists and gold-table rules.

Nothing is inferred from files: money stays decimal, an empty payload keeps its columns,
and no extra pass over the data is paid.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


INT, LONG, SHORT = T.IntegerType(), T.LongType(), T.ShortType()
TEXT, DATE, MOMENT, FLAG = T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Names of the tables a run extracts.
RENTAL_TABLES = (
    "actor", "actor_info", "address", "category", "city", "country", "customer",
    "customer_list", "film", "film_actor", "film_category", "film_list", "inventory",
    "language", "nicer_but_slower_film_list", "payment", "rental",
    "sales_by_film_category", "sales_by_store", "staff", "staff_list", "store",
)
SILVER_TABLES = ("aisles", "clients", "departments", "orders", "products")
SHOP_DIMENSIONS = (
    "departments", "aisles", "products", "location_areas", "clients", "store_types", "stores",
)

# Only the columns that the rental questions use; return_date is null while a copy is out.
RENTAL = {
    "category": _schema(category_id=INT, name=TEXT),
    "film": _schema(film_id=INT, title=TEXT),
    "film_category": _schema(film_id=INT, category_id=INT),
    "film_actor": _schema(film_id=INT, actor_id=INT),
    "actor": _schema(actor_id=INT, first_name=TEXT, last_name=TEXT),
    "inventory": _schema(inventory_id=INT, film_id=INT),
    "rental": _schema(rental_id=INT, inventory_id=INT, customer_id=INT, rental_date=MOMENT, return_date=MOMENT),
    "payment": _schema(rental_id=INT, amount=T.DecimalType(5, 2)),
    "customer": _schema(customer_id=INT, address_id=INT, active=INT),
    "address": _schema(address_id=INT, city_id=INT),
    "city": _schema(city_id=INT, city=TEXT),
}

# Shop snapshots as landed; the day of an order is in the path, not in the file.
SHOP = {
    "departments": _schema(department_id=LONG, department=TEXT),
    "aisles": _schema(aisle_id=LONG, aisle=TEXT),
    "products": _schema(product_id=LONG, product_name=TEXT, aisle_id=LONG, department_id=LONG),
    "location_areas": _schema(area_id=LONG, area=TEXT),
    "clients": _schema(id=LONG, fullname=TEXT, location_area_id=LONG),
    "store_types": _schema(store_type_id=LONG, type=TEXT),
    "stores": _schema(store_id=LONG, location_area_id=LONG, store_type_id=LONG),
    "orders": _schema(order_id=LONG, product_id=LONG, client_id=LONG, store_id=LONG, quantity=LONG),
}
OUT_OF_STOCK = _schema(product_id=LONG)

FACT_ORDERS_KEYS = ("product_id", "client_id", "store_id")

GOLD = {
    **{f"dim_{name}": SHOP[name] for name in SHOP_DIMENSIONS},
    "dim_dates": _schema(report_date=DATE, day_of_week=SHORT, is_holiday=FLAG),
    "fact_orders": _schema(report_date=DATE, product_id=LONG, client_id=LONG, store_id=LONG, quantity=LONG),
    "fact_oos": _schema(report_date=DATE, product_id=LONG),
}


@dataclass(frozen=True)
class Rules:
    """What a gold table promises: a unique key, filled columns, bounded text."""

    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)


# Keys, required columns and text lengths of the gold tables.
GOLD_RULES = {
    "dim_departments": Rules(("department_id",), ("department_id",), {"department": 127}),
    "dim_aisles": Rules(("aisle_id",), ("aisle_id",), {"aisle": 127}),
    "dim_products": Rules(("product_id",), ("product_id",), {"product_name": 255}),
    "dim_dates": Rules(("report_date",), ("report_date", "day_of_week", "is_holiday")),
    "dim_location_areas": Rules(("area_id",), ("area_id",), {"area": 64}),
    "dim_clients": Rules(("id",), ("id",), {"fullname": 63}),
    "dim_store_types": Rules(("store_type_id",), ("store_type_id",), {"type": 64}),
    "dim_stores": Rules(("store_id",), ("store_id",)),
    "fact_orders": Rules(
        (), ("report_date", "product_id", "client_id", "store_id", "quantity")
    ),
    "fact_oos": Rules((), ("report_date", "product_id")),
}


@dataclass(frozen=True)
class Reference:
    """Each value of ``columns`` in ``table`` is one of ``target_columns`` in ``target``; a null refers to nothing."""

    table: str
    columns: tuple[str, ...]
    target: str
    target_columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return ",".join(self.columns)


# Which gold column holds keys of which dimension.
GOLD_REFERENCES = (
    Reference("dim_products", ("aisle_id",), "dim_aisles", ("aisle_id",)),
    Reference("dim_products", ("department_id",), "dim_departments", ("department_id",)),
    Reference("dim_clients", ("location_area_id",), "dim_location_areas", ("area_id",)),
    Reference("dim_stores", ("location_area_id",), "dim_location_areas", ("area_id",)),
    Reference("dim_stores", ("store_type_id",), "dim_store_types", ("store_type_id",)),
    Reference("fact_orders", ("report_date",), "dim_dates", ("report_date",)),
    Reference("fact_orders", ("product_id",), "dim_products", ("product_id",)),
    Reference("fact_orders", ("client_id",), "dim_clients", ("id",)),
    Reference("fact_orders", ("store_id",), "dim_stores", ("store_id",)),
    Reference("fact_oos", ("report_date",), "dim_dates", ("report_date",)),
    Reference("fact_oos", ("product_id",), "dim_products", ("product_id",)),
)

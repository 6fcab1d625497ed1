"""A handful of hand-made source rows; every test changes what it needs."""

from datetime import date
from decimal import Decimal

from depotlake.schemas import SOURCES
from depotlake.sources import Sources

DAY = date(2024, 1, 5)

ROWS = {
    "customers": [(1, "Ann", "ann@example.com"), (2, "Bob", "bob@example.com")],
    "orders": [(10, 1, DAY), (11, 1, DAY), (12, 2, date(2024, 2, 1))],
    "order_items": [
        (10, 100, 2, Decimal("10.00"), 1),
        (11, 100, 1, Decimal("10.00"), 1),
        (12, 101, 3, Decimal("5.50"), 1),
    ],
    "products": [(100, "nut", 1, 7), (101, "bolt", 1, 8)],
    "categories": [(1, "Parts")],
    "suppliers": [(7, "S7", "ACTIVE", Decimal("4.00")), (8, "S8", "ACTIVE", Decimal("4.50"))],
    "inventory": [
        (1, 5, 100, 40, 10, "HEALTHY", 9, Decimal("0.85"), "FAST"),
        (2, 5, 101, 20, 10, "LOW", 4, Decimal("0.87"), "SLOW"),
    ],
    "shipments": [
        (1, 10, 7, 5, DAY, DAY, DAY, Decimal("3.00"), 5, True, Decimal("4.5"), Decimal("0.90")),
        (2, 12, 8, 5, DAY, DAY, DAY, Decimal("4.00"), 2, False, Decimal("3.5"), Decimal("1.06")),
    ],
    "warehouses": [(5, "W5", "HUB", "West", "Reno")],
}


def sources(spark, **changed) -> Sources:
    rows = {**ROWS, **changed}
    return Sources({n: spark.createDataFrame(rows[n], ddl) for n, ddl in SOURCES.items()})

"""Hand-made tables."""

from datetime import datetime
from decimal import Decimal

from tillroll.schema import NARRATIVES, TRANSACTIONS

NOON = datetime(2010, 6, 1, 12)


def sale(id, **changes):
    row = {
        "id": id,
        "invoice_no": "500001",
        "stock_code": "10001",
        "description": "MUG",
        "quantity": 2,
        "invoice_date": NOON,
        "unit_price": Decimal("1.50"),
        "customer_id": 7,
        "country": "France",
    }
    row.update(changes)
    return row


def facts_of(spark, *rows):
    return spark.createDataFrame(
        [tuple(row[name] for name in TRANSACTIONS.names) for row in rows], TRANSACTIONS
    )


def narratives_of(spark, *rows):
    return spark.createDataFrame(list(rows), NARRATIVES)

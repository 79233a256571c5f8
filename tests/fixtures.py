"""A landing source of our own for the ingest, slice and layer tests.

A stationery shop in three towns. Purchases fall on 3 and 4 March 2021; nothing
is ordered on the 5th. ``DAY`` is the date that the slice tests cut out.

* two orders on DAY and one on the next day; a blank order id among the items
  and payments, and an order with a blank customer beside a blank customer row;
* the pen (``sku-pen``) is bought three times, once on each order;
* zip 40100 belongs to a buyer and to the seller of the pens; zip 40900 to nobody;
* the orders file lists its columns in another order, the sellers file lacks the
  state, the products file has a column of its own.
"""

from __future__ import annotations

import csv
import os

from retail_lakehouse.schemas import BY_TABLE

DAY, NEXT_DAY, EMPTY_DAY = "2021-03-03", "2021-03-04", "2021-03-05"

# (order, customer, status, time, delivered, estimate)
_ORDERS = [
    ("A-17", "ana", "delivered", f"{DAY} 08:15:00", "2021-03-08 00:00:05", "2021-03-07 23:59:50"),
    ("A-18", "", "shipped", f"{DAY} 23:59:59", "", "2021-03-20 00:00:00"),
    ("B-01", "rui", "delivered", f"{NEXT_DAY} 00:00:00", "2021-03-06 12:00:00", "2021-03-19 00:00:00"),
]
# (order, line, product, seller, price, freight)
_ITEMS = [
    ("A-17", 1, "sku-pen", "north", "2.40", "0.60"),
    ("A-17", 2, "sku-pad", "south", "7.25", "1.75"),
    ("A-18", 1, "sku-pen", "north", "2.40", ""),
    ("B-01", 1, "sku-pen", "north", "2.50", "0.60"),
    ("B-01", 2, "sku-ink", "south", "11.00", "2.00"),
    ("", 1, "sku-ink", "south", "11.00", "2.00"),
]
_PAYMENTS = [("A-17", 1, "voucher", "5.00"), ("A-17", 2, "credit_card", "7.00"), ("", 1, "boleto", "13.00")]
_REVIEWS = [("rev-a", "A-17", 4, 'Blue,\nnot "black"'), ("rev-b", "B-01", 2, "")]
_PEOPLE = [("ana", "person-1", "40100"), ("rui", "person-2", "40200"), ("", "person-3", "40300")]
_PRODUCTS = [("sku-pen", "escrita"), ("sku-pad", "papel"), ("sku-ink", "")]
_SELLERS = [("north", "40100", "Norte"), ("south", "40500", "Sul")]
_PLACES = [("40100", "Norte"), ("40100", "Norte"), ("40300", "Meio"), ("40500", "Sul"), ("40900", "Longe")]
_NAMES = [("escrita", "writing"), ("papel", "paper"), ("outros", "other")]


def source_rows() -> dict[str, list[dict]]:
    """The rows by table; a key that is left out is blank."""
    order = ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
    return {
        "olist_orders": [dict(zip(order, r)) for r in _ORDERS],
        "olist_order_items": [dict(zip(("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"), r)) for r in _ITEMS],
        "olist_order_payments": [dict(zip(("order_id", "payment_sequential", "payment_type", "payment_value"), r)) for r in _PAYMENTS],
        "olist_order_reviews": [dict(zip(("review_id", "order_id", "review_score", "review_comment_message"), r)) for r in _REVIEWS],
        "olist_customers": [dict(zip(("customer_id", "customer_unique_id", "customer_zip_code_prefix"), r)) for r in _PEOPLE],
        "olist_products": [dict(zip(("product_id", "product_category_name"), r)) for r in _PRODUCTS],
        "olist_sellers": [dict(zip(("seller_id", "seller_zip_code_prefix", "seller_city"), r)) for r in _SELLERS],
        "olist_geolocation": [dict(zip(("geolocation_zip_code_prefix", "geolocation_city"), r)) for r in _PLACES],
        "product_category_name_translation": [dict(zip(("product_category_name", "product_category_name_english"), r)) for r in _NAMES],
    }


def put_csv(path: str, header: list[str], rows: list[dict], bom: bool = False) -> str:
    """A CSV file with exactly these columns, in this order."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as out:
        lines = csv.writer(out)
        lines.writerow(header)
        lines.writerows([row.get(name, "") for name in header] for row in rows)
    return path


def put_source(folder: str, tables: dict[str, list[dict]] | None = None) -> str:
    """Write a source folder, with the headers the module's text describes."""
    for table, rows in (tables or source_rows()).items():
        header = list(BY_TABLE[table].columns)
        if table == "olist_orders":
            header.reverse()
        elif table == "olist_sellers":
            header.remove("seller_state")
        elif table == "olist_products":
            header.insert(1, "shelf")
        put_csv(os.path.join(folder, BY_TABLE[table].filename), header, rows, bom=table == "olist_customers")
    return folder

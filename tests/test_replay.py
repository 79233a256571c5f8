"""The source summary and the daily slice, on the stationery source."""

import datetime as dt
import os

import pytest

from fixtures import DAY, EMPTY_DAY, NEXT_DAY, put_csv, put_source, source_rows
from retail_lakehouse.operators.slice import SourceDataError, daily_slice, slice_digest
from retail_lakehouse.schemas import BY_TABLE, DATASETS
from retail_lakehouse.sources.landing import read_landing_csv, source_summary, write_daily_slice


def tables(spark, folder):
    return {d.table_name: read_landing_csv(spark, os.path.join(folder, d.filename), d) for d in DATASETS}


def values(df, *columns):
    return sorted(tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect())


def test_summary(spark, scratch):
    put_source(scratch)
    os.remove(os.path.join(scratch, BY_TABLE["olist_sellers"].filename))
    found = source_summary(spark, scratch)
    assert found["orders"] == len(source_rows()["olist_orders"])
    assert (found["first_order_date"], found["last_order_date"]) == (dt.date.fromisoformat(DAY), dt.date.fromisoformat(NEXT_DAY))
    assert found["missing_files"] == [BY_TABLE["olist_sellers"].filename]


@pytest.mark.parametrize("when", ["", "soon", "2021-03-03 99:99:99", "2021-02-30 10:00:00"])
def test_summary_and_slice_refuse_bad_purchase_times(spark, scratch, when):
    rows = source_rows()
    rows["olist_orders"][1]["order_purchase_timestamp"] = when
    put_source(scratch, rows)
    with pytest.raises(SourceDataError):
        source_summary(spark, scratch)
    with pytest.raises(Exception, match="invalid purchase timestamp"):
        daily_slice(tables(spark, scratch), DAY)["olist_orders"].collect()


def test_summary_needs_orders(spark, scratch):
    with pytest.raises(SourceDataError, match="Missing"):
        source_summary(spark, scratch)
    put_source(scratch, {"olist_orders": []})
    with pytest.raises(SourceDataError, match="empty"):
        source_summary(spark, scratch)


def test_the_slice_is_closed_under_its_references(spark, scratch):
    """Every table of the slice, derived here from the rows by set membership."""
    rows = source_rows()
    landing = os.path.join(scratch, "landing")
    counts = write_daily_slice(daily_slice(tables(spark, put_source(os.path.join(scratch, "src"))), DAY), landing, DAY)
    orders = [r for r in rows["olist_orders"] if r["order_purchase_timestamp"].startswith(DAY)]
    ids = {r["order_id"] for r in orders}
    keep = {t: [r for r in rows[t] if r["order_id"] in ids] for t in ("olist_order_items", "olist_order_payments", "olist_order_reviews")}
    keep["olist_orders"] = orders
    keep["olist_customers"] = [r for r in rows["olist_customers"] if r["customer_id"] in {o["customer_id"] for o in orders}]
    for table, key in (("olist_products", "product_id"), ("olist_sellers", "seller_id")):
        keep[table] = [r for r in rows[table] if r[key] in {i[key] for i in keep["olist_order_items"]}]
    zips = {r["customer_zip_code_prefix"] for r in keep["olist_customers"]} | {r["seller_zip_code_prefix"] for r in keep["olist_sellers"]}
    keep["olist_geolocation"] = [r for r in rows["olist_geolocation"] if r["geolocation_zip_code_prefix"] in zips]
    kinds = {r["product_category_name"] for r in keep["olist_products"]}
    keep["product_category_name_translation"] = [r for r in rows["product_category_name_translation"] if r["product_category_name"] in kinds]
    day = tables(spark, os.path.join(landing, DAY))
    for d in DATASETS:
        want = sorted(tuple(str(r.get(c, "")) for c in d.columns) for r in keep[d.table_name])
        assert values(day[d.table_name], *d.columns) == want, d.table_name
        assert counts[d.filename] == len(want)
    digest = slice_digest(tables(spark, os.path.join(scratch, "src")), DAY).groupBy("table_name").sum("copies").collect()
    assert {r[0]: r[1] for r in digest} == {t: len(v) for t, v in keep.items() if v}


def test_a_day_without_orders_is_an_error_and_leaves_nothing(spark, scratch):
    landing = os.path.join(scratch, "landing")
    t = tables(spark, put_source(os.path.join(scratch, "src")))
    with pytest.raises(SourceDataError, match=EMPTY_DAY):
        write_daily_slice(daily_slice(t, EMPTY_DAY), landing, EMPTY_DAY)
    assert not os.path.exists(os.path.join(landing, EMPTY_DAY))


def test_columns_are_bound_by_name_in_every_file(spark, scratch):
    row = {"seller_id": "s1", "seller_city": "a", "seller_state": "X", "seller_zip_code_prefix": "1", "phone": "9"}
    name = BY_TABLE["olist_sellers"].filename
    headers = {
        "2021-01-01": ["seller_state", "seller_city", "seller_zip_code_prefix", "seller_id"],
        "2021-01-02": ["seller_id", "seller_city", "seller_state"],
        "2021-01-03": ["phone", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    }
    for day, header in headers.items():
        put_csv(os.path.join(scratch, day, name), header, [row], bom=day.endswith("3"))
    found = read_landing_csv(spark, f"{scratch}/*/{name}", "olist_sellers")
    assert values(found, *BY_TABLE["olist_sellers"].columns) == [("s1", "", "a", "X"), ("s1", "1", "a", "X"), ("s1", "1", "a", "X")]
    alone = read_landing_csv(spark, os.path.join(scratch, "2021-01-01"), "olist_sellers").first()
    assert (alone.seller_id, alone.seller_zip_code_prefix, alone.seller_state) == ("s1", "1", "X")


def test_blank_is_the_empty_string_however_it_is_written(spark, scratch):
    name = BY_TABLE["olist_sellers"].filename
    path = os.path.join(scratch, name)
    with open(path, "w") as out:
        out.write('seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,,X\ns1,1,"",X\ns1,1\n')
    assert values(read_landing_csv(spark, path, "olist_sellers"), *BY_TABLE["olist_sellers"].columns) == [
        ("s1", "1", "", ""), ("s1", "1", "", "X"), ("s1", "1", "", "X")]


def test_a_slice_hands_its_small_tables_to_the_others_stored(spark, scratch):
    put_source(scratch)
    sliced = daily_slice(tables(spark, scratch), DAY)
    assert all("slice-orders" in f for f in sliced["olist_orders"].inputFiles())
    plan = sliced["olist_order_payments"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan

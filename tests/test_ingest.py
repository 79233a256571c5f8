import datetime as dt
import hashlib
import os
import shutil
import tempfile
from decimal import Decimal

import pytest

from retail_lakehouse.operators.slice import daily_slice
from retail_lakehouse.plans import ingest as I
from retail_lakehouse.plans.layers import Lakehouse
from retail_lakehouse.schemas import BY_TABLE, DATASETS
from retail_lakehouse.session import materialize
from retail_lakehouse.sources.landing import read_landing_csv, write_daily_slice
from retail_lakehouse.streaming.bronze_stream import merge_epoch, stream_bronze

from fixtures import DAY, NEXT_DAY, put_csv, put_source, source_rows


CUSTOMERS = BY_TABLE["olist_customers"]


_SLICED: list[str] = []  # both days of the stationery source, sliced and written once


def _landing(spark, scratch):
    """A copy of the landing area of both days."""
    if not _SLICED:
        made = tempfile.mkdtemp(prefix="rl-landing-")
        src = put_source(os.path.join(made, "source"))
        tables = {d.table_name: materialize(read_landing_csv(spark, os.path.join(src, d.filename), d)) for d in DATASETS}
        for day in (DAY, NEXT_DAY):
            write_daily_slice(daily_slice(tables, day), os.path.join(made, "landing"), day)
        _SLICED.append(os.path.join(made, "landing"))
    return shutil.copytree(_SLICED[0], os.path.join(scratch, "landing"))


def _put_customers(landing, day, *rows, header=None):
    return put_csv(os.path.join(landing, day, CUSTOMERS.filename), header or list(CUSTOMERS.columns), list(rows))


ANA = {"customer_id": "ana", "customer_unique_id": "u1", "customer_zip_code_prefix": "1"}
RUI = {"customer_id": "rui", "customer_unique_id": "u2", "customer_zip_code_prefix": "2"}


def _ids(spark, bronze):
    return sorted(r.customer_id for r in I.read_bronze(spark, bronze, "olist_customers").collect())


def test_a_day_is_loaded_once(spark, scratch):
    landing, bronze = _landing(spark, scratch), os.path.join(scratch, "bronze")
    first = I.ingest_batch(spark, landing, bronze, DAY)
    assert (first["olist_orders"], first["olist_order_items"], first["olist_geolocation"]) == (2, 3, 3)
    assert set(I.ingest_batch(spark, landing, bronze, DAY).values()) == {0}
    assert I.read_bronze(spark, bronze, "olist_orders").count() == 2
    assert [r.status for r in I.latest_runs(spark, bronze).collect()] == ["succeeded"] * 2
    assert I.invalid_run_statuses(I.run_ledger(spark, bronze)).isEmpty()
    files = I.file_ledger(spark, bronze).collect()
    assert {r.table_name for r in files} == {d.table_name for d in DATASETS}
    for r in files:
        with open("/" + r.source_file.removeprefix("file:").lstrip("/"), "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == r.sha256


def test_a_missing_file_fails_the_whole_day_with_its_full_message(spark, scratch):
    landing, bronze = _landing(spark, scratch), os.path.join(scratch, "bronze")
    broken = os.path.join(landing, "2021-03-09")
    os.makedirs(broken)
    for d in DATASETS[:-1]:
        os.symlink(os.path.join(landing, DAY, d.filename), os.path.join(broken, d.filename))
    with pytest.raises(FileNotFoundError):
        I.ingest_batch(spark, landing, bronze, "2021-03-09")
    run = I.latest_runs(spark, bronze).first()
    assert run.status == "failed" and run.error_message.endswith(DATASETS[-1].filename)
    assert I.read_bronze(spark, bronze, "olist_orders") is None and I.file_ledger(spark, bronze).count() == 0


def test_rows_of_a_run_that_failed_later_stay_invisible(spark, scratch, monkeypatch):
    landing, bronze = _landing(spark, scratch), os.path.join(scratch, "bronze")
    stage = I._stage

    def failing(df, root, table, batch_id):
        if table == "olist_sellers":
            raise RuntimeError("x" * 5000)
        return stage(df, root, table, batch_id)

    monkeypatch.setattr(I, "_stage", failing)
    with pytest.raises(RuntimeError):
        I.ingest_batch(spark, landing, bronze, DAY)
    assert len(I.latest_runs(spark, bronze).first().error_message) == 5000
    assert I.read_bronze(spark, bronze, "olist_orders").count() == 0 and I.file_ledger(spark, bronze).count() == 0


def test_run_status_domain_over_a_stored_ledger(spark, scratch):
    with pytest.raises(ValueError):
        I.record_run(spark, scratch, "b1", None, "paused")
    stored = spark.createDataFrame([("a", "succeeded"), ("b", "paused"), ("c", "paused"), ("d", None)], "batch_id string, status string")
    assert {r.status: r.n_records for r in I.invalid_run_statuses(stored).collect()} == {"paused": 2, None: 1}


def test_scan_keeps_the_earliest_landing_and_parses_no_loaded_file(spark, scratch, monkeypatch):
    landing, bronze = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    _put_customers(landing, NEXT_DAY, ANA)
    _put_customers(landing, DAY, ANA, ANA)
    assert I.ingest_bronze(spark, landing, bronze, [CUSTOMERS]) == {"olist_customers": 1}
    rows = I.read_bronze(spark, bronze, "olist_customers").collect()
    assert [r._batch_date for r in rows] == [dt.date.fromisoformat(DAY)]
    parsed = []
    real = I.read_landing_csv
    monkeypatch.setattr(I, "read_landing_csv", lambda s, paths, *a: parsed.append(list(paths)) or real(s, paths, *a))
    assert I.ingest_bronze(spark, landing, bronze, [CUSTOMERS]) == {"olist_customers": 0}
    assert parsed == []
    _put_customers(landing, "2021-03-05", ANA, RUI, header=["customer_unique_id", "customer_id", "customer_zip_code_prefix"])
    assert I.ingest_bronze(spark, landing, bronze, [CUSTOMERS]) == {"olist_customers": 1}
    assert len(parsed) == 1 and all("2021-03-05" in p for p in parsed[0])
    assert _ids(spark, bronze) == ["ana", "rui"]


def test_stream_equals_scan(spark, scratch):
    landing = _landing(spark, scratch)
    s_bronze, b_bronze, state = (os.path.join(scratch, n) for n in ("s_bronze", "b_bronze", "state"))
    stream_bronze(spark, landing, s_bronze, state)
    before = I.run_ledger(spark, s_bronze).count()
    stream_bronze(spark, landing, s_bronze, state)  # nothing new
    assert I.run_ledger(spark, s_bronze).count() == before
    I.ingest_bronze(spark, landing, b_bronze)
    for d in DATASETS:
        cols = [*d.columns, "_row_hash", "_batch_date"]
        both = [sorted(map(tuple, I.read_bronze(spark, b, d.table_name).select(cols).collect())) for b in (s_bronze, b_bronze)]
        assert both[0] == both[1], d.table_name


def _epoch(spark, landing, day):
    return spark.createDataFrame([(os.path.join(landing, day, CUSTOMERS.filename),)], "path string")


def test_a_replayed_epoch_changes_nothing(spark, scratch):
    landing, bronze = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    _put_customers(landing, DAY, ANA, RUI)
    merge = merge_epoch(spark, bronze, CUSTOMERS, "t")
    for _ in range(2):
        merge(_epoch(spark, landing, DAY), 0)
        assert _ids(spark, bronze) == ["ana", "rui"]


@pytest.mark.parametrize("dies_at", ["_stage", "record_succeeded"])
def test_an_epoch_that_died_ends_with_the_same_rows(spark, scratch, monkeypatch, dies_at):
    """Death before the rows are staged, or between staging and the commit mark."""
    landing, bronze = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    _put_customers(landing, DAY, ANA, RUI)
    _put_customers(landing, NEXT_DAY, RUI)
    merge = merge_epoch(spark, bronze, CUSTOMERS, "t")
    merge(_epoch(spark, landing, NEXT_DAY), 0)

    class Died(BaseException):
        """Not an error the run can still record."""

    record = I.record_run

    def dying_stage(*a):
        raise Died

    def dying_record(s, root, batch_id, day, status, **kw):
        if status == "succeeded":
            raise Died
        record(s, root, batch_id, day, status, **kw)

    with monkeypatch.context() as m:
        m.setattr(I, *(("_stage", dying_stage) if dies_at == "_stage" else ("record_run", dying_record)))
        with pytest.raises(Died):
            merge(_epoch(spark, landing, DAY), 1)
    assert _ids(spark, bronze) == ["rui"]
    for _ in range(2):
        merge(_epoch(spark, landing, DAY), 1)
        assert _ids(spark, bronze) == ["ana", "rui"]


def test_layers_from_ingested_bronze(spark, scratch):
    landing, bronze = _landing(spark, scratch), os.path.join(scratch, "bronze")
    I.ingest_bronze(spark, landing, bronze)
    lh = Lakehouse.from_bronze(spark, I.bronze_tables(spark, bronze))
    fo = {r.order_id: r for r in lh.gold("fct_orders").collect()}
    assert fo["A-17"].order_line_total == Decimal("12.00") and fo["A-17"].payment_total == Decimal("12.00")
    assert fo["A-17"].average_review_score == Decimal("4.00")
    # A-18: its one line has no freight, so no line total; no payment, no review
    assert (fo["A-18"].item_count, fo["A-18"].order_line_total) == (1, Decimal("0.00"))
    assert fo["A-18"].payment_count == 0 and fo["A-18"].average_review_score is None
    dp = {str(r.order_purchase_date): r for r in lh.mart("mart_delivery_performance").collect()}
    # A-17 came 15 seconds late, after midnight; B-01 long before its estimate
    assert (dp[DAY].delivered_order_count, dp[DAY].late_delivery_count) == (1, 1)
    assert (dp[DAY].late_delivery_rate, dp[DAY].average_days_vs_estimate) == (Decimal("1.0000"), Decimal("1.00"))
    assert dp[NEXT_DAY].late_delivery_rate == Decimal("0.0000")
    el = Lakehouse.from_bronze(spark, I.bronze_tables(spark, bronze), day_basis="elapsed")
    assert {str(r.order_purchase_date): r for r in el.mart("mart_delivery_performance").collect()}[DAY].average_days_vs_estimate == Decimal("0.00")
    assert {r.zip_code_prefix for r in lh.silver("geolocation").collect()} == {40100, 40300, 40500}
    assert {r.product_id: r.product_category_name_english for r in lh.gold("dim_products").collect()} == {
        "sku-pen": "writing", "sku-pad": "paper", "sku-ink": "unknown"}
    kpi = lh.report("report_executive_kpis").first()
    assert (kpi.total_orders, kpi.total_items) == (len(source_rows()["olist_orders"]), 5)


def test_build_all_writes_every_layer_and_runs_checks(spark, scratch):
    from retail_lakehouse.plans.build import build_all
    landing, bronze = _landing(spark, scratch), os.path.join(scratch, "bronze")
    I.ingest_bronze(spark, landing, bronze)
    out = build_all(spark, Lakehouse.from_bronze(spark, I.bronze_tables(spark, bronze)), os.path.join(scratch, "lake"))
    assert out["rows"]["silver.orders"] == out["rows"]["gold.fct_orders"] == 3
    assert out["rows"]["gold.mart_customer_rfm"] == 2  # the order of nobody is nobody's
    assert out["reports"]["report_executive_kpis"] == 1
    assert "accepted_values_silver_orders_order_status" not in out["failed_checks"]
    # blank customer, as landed
    assert "not_null_silver_orders_customer_id" in out["failed_checks"]


def test_a_scan_after_the_stream_parses_no_file_and_the_other_way_round(spark, scratch, monkeypatch):
    landing = _landing(spark, scratch)
    bronze, state = os.path.join(scratch, "bronze"), os.path.join(scratch, "state")
    stream_bronze(spark, landing, bronze, state)
    files = {(r.table_name, r.source_file) for r in I.file_ledger(spark, bronze).collect()}
    assert {t for t, _ in files} == {d.table_name for d in DATASETS}
    monkeypatch.setattr(I, "read_landing_csv", lambda *a: pytest.fail("a loaded file was parsed"))
    assert set(I.ingest_bronze(spark, landing, bronze).values()) == {0}
    monkeypatch.undo()
    scanned, fresh_state = os.path.join(scratch, "scanned"), os.path.join(scratch, "state2")
    I.ingest_bronze(spark, landing, scanned)
    monkeypatch.setattr(I, "read_landing_csv", lambda *a: pytest.fail("a loaded file was parsed"))
    stream_bronze(spark, landing, scanned, fresh_state)


def test_one_failing_stream_fails_the_load_and_the_others_end(spark, scratch, monkeypatch):
    from pyspark.errors import StreamingQueryException

    landing, bronze = _landing(spark, scratch), os.path.join(scratch, "bronze")
    real = I.bronze_rows
    monkeypatch.setattr(I, "bronze_rows", lambda raw, ds, *a: 1 / 0 if ds.table_name == "olist_orders" else real(raw, ds, *a))
    with pytest.raises(StreamingQueryException):
        stream_bronze(spark, landing, bronze, os.path.join(scratch, "state"))
    assert not spark.streams.active
    assert I.read_bronze(spark, bronze, "olist_orders") is None and I.read_bronze(spark, bronze, "olist_customers").count() > 0
    monkeypatch.undo()
    stream_bronze(spark, landing, bronze, os.path.join(scratch, "state"))
    assert I.read_bronze(spark, bronze, "olist_orders").count() > 0


def test_a_row_like_its_header_is_data(spark, scratch):
    landing = os.path.join(scratch, "landing")
    header = list(CUSTOMERS.columns)
    _put_customers(landing, DAY, ANA, dict(zip(header, header)), RUI)
    found = read_landing_csv(spark, os.path.join(landing, DAY, CUSTOMERS.filename), CUSTOMERS).collect()
    assert sorted(r.customer_id for r in found) == ["ana", "customer_id", "rui"]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_plain_files_are_read_in_splits_and_others_whole(spark, scratch):
    from retail_lakehouse.sources.landing import file_facts

    header, place = ",".join(CUSTOMERS.columns), os.path.join(scratch, CUSTOMERS.filename)
    lines = [f'c{i},u{i},{i % 7},"city ""{i}"", x",st' for i in range(20_000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        _write(place, header + "\n" + "\n".join(lines) + "\n")
        assert [r.multiline for r in file_facts(spark, place).collect()] == [False]
        plain = read_landing_csv(spark, place, CUSTOMERS)
        assert plain.rdd.getNumPartitions() > 4
        rows = sorted(plain.select("customer_id", "customer_city").collect())
        assert len(rows) == 20_000 and rows[0] == ("c0", 'city "0", x')
        _write(place, header + "\n" + "\n".join(lines) + '\nlast,u,1,"two\nlines",st\n')
        assert [r.multiline for r in file_facts(spark, place).collect()] == [True]
        whole = read_landing_csv(spark, place, CUSTOMERS)
        assert whole.rdd.getNumPartitions() == 1
        assert sorted(whole.select("customer_id", "customer_city").collect()) == sorted(rows + [("last", "two\nlines")])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_ends_in_quotes_are_found_across_blocks():
    from retail_lakehouse.sources.landing import line_end_in_quotes as spans

    def whole(text, size):
        quotes, found = 0, False
        for at in range(0, len(text), size):
            hit, quotes = spans(text[at:at + size], quotes)
            found = found or hit
        return found

    for size in (1, 2, 3, 100):
        assert whole(b'a,"b\nc"\n', size) and whole(b'a,"b\rc"\n', size) and whole(b'"x""\n""y"\n', size)
        assert not whole(b'a,"b ""c"""\n"d",e\r\n', size) and not whole(b"", size)


def test_compressed_parts_are_read_hashed_and_bound_like_plain_ones(spark, scratch):
    import gzip

    from retail_lakehouse.sources.landing import file_facts, write_csv_counted
    rows = spark.createDataFrame([("ana", 'a "b",\nc'), ("rui", "")], "customer_id string, customer_city string")
    plain, zipped = os.path.join(scratch, "plain"), os.path.join(scratch, "zipped")
    assert write_csv_counted(rows.coalesce(1), plain) == write_csv_counted(rows.coalesce(1), zipped, "gzip") == 2
    name = next(f for f in os.listdir(zipped) if f.endswith(".csv.gz"))
    with open(os.path.join(zipped, name), "rb") as f:
        stored = f.read()
    fact = file_facts(spark, zipped).first()
    assert (fact.sha256, fact.bytes, fact.header, fact.multiline) == (
        hashlib.sha256(stored).hexdigest(), len(stored), ["customer_id", "customer_city"], True)
    got = [sorted(tuple(r)[:-1] for r in read_landing_csv(spark, p, CUSTOMERS).collect()) for p in (plain, zipped)]
    assert got[0] == got[1] and len(got[0]) == 2
    # Several members, as appended files have, and blocks that unpack to more than one.
    from retail_lakehouse.sources import landing as L
    big = os.urandom(1000) * 9000
    member = gzip.compress(big) + gzip.compress(b"end")
    assert b"".join(L.unzipped(member[i:i + 7001] for i in range(0, len(member), 7001))) == big + b"end"


def test_a_load_shuffles_neither_hashes_nor_file_names(spark, scratch):
    """Equal rows meet under a number for the file; the earliest day, then file, stays."""
    files = materialize(I.landing_order(spark.createDataFrame(
        [(f"x/{d}/customers.csv/{f}",) for d in (NEXT_DAY, DAY) for f in "ab"] + [("x/none/c",)], "source_file string")))
    place = {r._source_file: r._place for r in files.collect()}
    order = sorted(place, key=place.get)
    assert order == [f"x/{DAY}/customers.csv/a", f"x/{DAY}/customers.csv/b", f"x/{NEXT_DAY}/customers.csv/a", f"x/{NEXT_DAY}/customers.csv/b", "x/none/c"]
    raw = spark.createDataFrame([("ana", place[order[3]]), ("ana", place[order[1]]), ("rui", place["x/none/c"])], "customer_id string, _place long") \
        .selectExpr("customer_id", *[f"'' AS {c}" for c in CUSTOMERS.columns if c != "customer_id"], "_place")
    out = I.bronze_rows(raw, CUSTOMERS, "b", "struct", files)
    assert sorted((r.customer_id, r._source_file, r._batch_date and str(r._batch_date)) for r in out.collect()) == [
        ("ana", order[1], DAY), ("rui", "x/none/c", None)]
    shuffled = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not any("_row_hash" in line or "_source_file" in line for line in shuffled)

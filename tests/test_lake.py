import datetime as dt
import re

from pyspark.sql import functions as F

from tradewind import schema
from tradewind.operators.cleaning import key_audit, one_row_per_key
from tradewind.sources import lake, reports
from tradewind.sources import lake as lake_tables

BOM = "﻿"


def write(path, text):
    path.write_text(BOM + text, encoding="utf-8")
    return str(path)


CLIENTS = """client_id,name,age,city,signup_date,segment,channel
1,Awa,30,Lyra,2025-01-01,Gold,web
2,Bintou,zz,Orsa,zz,New,web
,Nobody,20,Lyra,2025-01-01,New,web
1,Awa,30,Lyra,2025-01-01,Gold,web
3,Zoe,50,Lyra,2025-02-02,New,shop
3,Ali,50,Lyra,2025-02-02,New,shop
"""


def test_typed_and_lenient_csv_agree_on_bad_fields(spark, tmp_path):
    path = write(tmp_path / "clients.csv", CLIENTS)
    for read in (lake.read_csv, lake.read_csv_lenient):
        df = read(spark, path, schema.CLIENTS)
        assert dict(df.dtypes) == {f.name: f.dataType.simpleString() for f in schema.CLIENTS.schema}
        rows = {r.name: r for r in df.collect()}
        assert rows["Awa"].client_id == 1 and rows["Awa"].signup_date == dt.date(2025, 1, 1)
        assert rows["Bintou"].age is None and rows["Bintou"].signup_date is None
        assert rows["Nobody"].client_id is None


def test_lenient_date_with_time(spark, tmp_path):
    path = write(tmp_path / "clients.csv", CLIENTS.replace("2025-02-02", "2025-02-02 10:00:00"))
    df = lake.read_csv_lenient(spark, path, schema.CLIENTS).where("client_id = 3")
    assert {r.signup_date for r in df.collect()} == {dt.date(2025, 2, 2)}


def test_one_row_per_key_keeps_the_smallest(spark, tmp_path):
    path = write(tmp_path / "clients.csv", CLIENTS)
    kept = one_row_per_key(lake.read_csv(spark, path, schema.CLIENTS), "client_id").orderBy("client_id").collect()
    assert [(r.client_id, r.name) for r in kept] == [(1, "Awa"), (2, "Bintou"), (3, "Ali")]


def test_ingest_writes_once_and_again(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    write(raw / "clients.csv", CLIENTS)
    write(raw / "products.csv", "product_id,name,category,brand,list_price,unit_cost,stock\n1,a,x,b,100,60,5\n")
    write(raw / "promotions.csv", "promo_id,campaign,kind,rate,start_date,end_date\n0,none,none,0.0,,\n")
    write(raw / "sales.csv", "sale_id,client_id,product_id,promo_id,sale_date,quantity,unit_price,amount\n"
                             "1,1,1,0,2025-03-01,2,100,200\n")
    write(raw / "events.csv", "event_id,client_id,product_id,ts,action\n1,1,1,2025-03-01 10:00:00,view\n")
    for lenient in (False, True):
        audit = {r.table_name: r for r in lake.ingest(spark, str(raw), out, lenient).collect()}
        assert (audit["clients"].rows_read, audit["clients"].rows_kept, audit["clients"].rows_removed) == (6, 3, 3)
        assert audit["sales"].rows_removed == 0
        assert lake.read_lake(spark, out, "clients").count() == 3
    lake.register_views(spark, out)
    assert spark.sql("SELECT sum(amount) FROM sales JOIN products USING (product_id)").first()[0] == 200
    promo = lake.read_lake(spark, out, "promotions").first()
    assert promo.start_date is None and promo.rate == 0.0


def test_key_audit_counts_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    row = key_audit({"t": (df, "k")}).first()
    assert (row.rows_read, row.rows_kept, row.rows_removed) == (3, 1, 2)


def test_report_round_trip(spark, tmp_path):
    df = spark.sql("SELECT DATE '2025-01-01' AS ds, 1.5D AS yhat")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        reports.write_report(df, path, fmt)
        back = reports.read_report(spark, path, fmt, "ds date, yhat double")
        assert back.collect() == df.collect()


def test_run_all(spark, sf_dir, tmp_path):
    from tradewind.plans.run_all import run_all
    from tradewind.sources.star import SALES_WINDOW, Star

    s = Star(spark, sf_dir)
    ids = s.sales.withColumn("sale_id", F.xxhash64("sale_id").cast("string"))
    # the raw files carry whole-number sale ids
    ids = ids.withColumn("sale_id", F.pmod(F.hash("sale_id"), F.lit(2**31 - 1)).cast("int"))
    for name, df in (("products", s.products), ("clients", s.clients), ("promotions", s.promotions),
                     ("sales", ids), ("events", s.events)):
        df.write.option("header", True).csv(str(tmp_path / "raw" / f"{name}.csv"))
    report = run_all(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), str(tmp_path / "reports"), SALES_WINDOW)
    assert report.count() == 21
    published = reports.read_report(spark, str(tmp_path / "reports" / "forecast"))
    assert published.where("kind = 'forecast'").count() == 6 * 30
    features = reports.read_report(spark, str(tmp_path / "reports/models/product_features"))
    assert features.count() == 200 and {"category", "brand", "p", "m"} <= set(features.columns)


def month_sales(spark, rows):
    return spark.createDataFrame(rows, "sale_id string, sale_date date, amount bigint")


def test_one_month_is_replaced_and_the_others_stay(spark, tmp_path):
    lake = str(tmp_path)
    day = dt.date
    lake_tables.write_sales_by_month(month_sales(spark, [("a", day(2024, 1, 5), 1), ("b", day(2024, 2, 1), 2), ("c", day(2024, 2, 9), 3), ("d", None, 4)]), lake)
    lake_tables.write_sales_by_month(month_sales(spark, [("e", day(2024, 2, 2), 5)]), lake)
    assert {r.sale_id for r in lake_tables.read_sales_between(spark, lake).collect()} == {"a", "d", "e"}
    some = lake_tables.read_sales_between(spark, lake, "2024-02-01", "2024-02-29")
    assert [tuple(r) for r in some.collect()] == [("e", day(2024, 2, 2), 5)]
    plan = some._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)


def test_malformed_lines_are_put_aside(spark, tmp_path):
    from tradewind.schema import PRODUCTS

    (tmp_path / "p.csv").write_text("product_id,name,category,brand,list_price,unit_cost,stock\n1,a,c,b,10,5,3\n2,a,c,b,ten,5,3\n"
                                    "1,a,c,b,10,5,3\n3,a,c,b,10\n,a,c,b,10,5,3\n")
    audit = lake_tables.ingest_checked(spark, str(tmp_path / "p.csv"), str(tmp_path / "lake"), PRODUCTS).first()
    assert tuple(audit) == ("products", 5, 1, 2, 2)
    aside = lake_tables.read_lake(spark, f"{tmp_path}/lake/quarantine", "products").collect()
    assert {(r.key, r.line) for r in aside} == {("2", "2,a,c,b,ten,5,3"), ("3", "3,a,c,b,10")}
    assert [r.product_id for r in lake_tables.read_lake(spark, f"{tmp_path}/lake", "products").collect()] == [1]

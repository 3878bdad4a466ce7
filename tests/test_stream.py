import datetime as dt

from tradewind.streaming import sales_stream as st

SALE = "sale_id bigint, client_id bigint, product_id bigint, sale_date date, quantity int, amount bigint"


def sales(spark, ids):
    rows = [(i, i % 3, i % 4, dt.date(2025, 1, 1 + i % 5), 1, 10 * i) for i in ids]
    return spark.createDataFrame(rows, SALE)


def products(spark):
    return spark.createDataFrame([(0, "p0", "a"), (1, "p1", "a"), (2, "p2", "b")],
                                 "product_id bigint, name string, category string")


def send(spark, folder, ids):
    st.encode(st.enrich(sales(spark, ids), products(spark))).coalesce(1).write.mode("append").text(folder)


def expected(spark, ids):
    return {tuple(r) for r in st.totals_by_category(st.enrich(sales(spark, ids), products(spark))).collect()}


def test_unknown_product_and_round_trip(spark):
    events = st.enrich(sales(spark, [3]), products(spark))
    assert (events.first().product, events.first().category) == ("?", "?")
    assert st.decode(st.encode(events)).collect() == events.collect()


def test_totals_equal_batch_and_survive_a_restart(spark, tmp_path):
    inbox, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    send(spark, inbox, range(0, 10))
    send(spark, inbox, range(10, 17))

    def run():
        live = st.totals_by_category(st.decode(st.text_source(spark, inbox, maxFilesPerTrigger="1")))
        st.run_complete(live, out, checkpoint)
        return {tuple(r) for r in st.read_current(spark, out).collect()}

    assert run() == expected(spark, range(17))
    send(spark, inbox, range(17, 30))
    assert run() == expected(spark, range(30))


def test_readers_see_whole_versions_and_a_new_run_leaves_nothing_stale(spark, tmp_path):
    out = str(tmp_path / "out")

    def run(inbox, checkpoint):
        live = st.totals_by_category(st.decode(st.text_source(spark, str(tmp_path / inbox), maxFilesPerTrigger="1")))
        st.run_complete(live, out, str(tmp_path / checkpoint))

    for ids in (range(0, 8), range(8, 30)):
        send(spark, str(tmp_path / "first"), ids)
    run("first", "c1")
    held = st.read_current(spark, out)                  # a reader that keeps its version
    before = {tuple(r) for r in held.collect()}
    assert before == expected(spark, range(30))
    send(spark, str(tmp_path / "second"), [0, 4])       # fewer categories than before
    run("second", "c2")
    assert {tuple(r) for r in st.read_current(spark, out).collect()} == expected(spark, [0, 4])
    assert {tuple(r) for r in held.collect()} == before
    (tmp_path / "third").mkdir()
    run("third", "c3")                                   # a stream without messages: a result without rows
    assert st.read_current(spark, out).count() == 0
    send(spark, str(tmp_path / "second"), [8])
    run("second", "c2")                                  # a checkpoint from before goes on with its totals
    assert {tuple(r) for r in st.read_current(spark, out).collect()} == expected(spark, [0, 4, 8])
    run("second", "c2")                                  # and without new messages the result stays
    assert {tuple(r) for r in st.read_current(spark, out).collect()} == expected(spark, [0, 4, 8])


def test_running_totals_across_batches(spark, tmp_path):
    inbox, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        live = st.decode(st.text_source(spark, inbox, maxFilesPerTrigger="1"))
        st.run_running_totals(live, out, checkpoint, ["sale_date", "sale_id"])
        return spark.read.parquet(f"{out}/rows").orderBy("total_sales").collect()

    send(spark, inbox, range(0, 5))
    send(spark, inbox, range(5, 9))
    assert [r.total_sales for r in run()] == list(range(1, 10))
    send(spark, inbox, range(9, 12))
    rows = run()
    assert [r.total_sales for r in rows] == list(range(1, 13))
    total = 0
    for r in rows:
        total += r.amount
        assert r.total_revenue == total


def test_streamed_messages_equal_batch(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    sales(spark, range(20)).write.parquet(raw)
    live = st.file_source(spark, raw, sales(spark, []).schema)
    st.run_append(st.encode(st.enrich(live, products(spark))), out, str(tmp_path / "c"), "text")
    got = sorted(map(tuple, st.decode(spark.read.text(out)).collect()))
    assert got == sorted(map(tuple, st.enrich(sales(spark, range(20)), products(spark)).collect()))


def test_empty_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    live = st.decode(st.text_source(spark, str(inbox)))
    st.run_complete(st.totals_by_category(live), str(tmp_path / "out"), str(tmp_path / "c"))
    assert st.read_current(spark, str(tmp_path / "out")).count() == 0


def test_sales_stream_reads_a_table_of_many_files(spark, sf_dir, tmp_path):
    from pathlib import Path

    from tradewind.sources.star import Star

    for table in ("orders", "part"):
        (tmp_path / f"{table}.parquet").symlink_to(Path(sf_dir) / f"{table}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    def live(name):
        s = Star(spark, str(tmp_path))
        out = str(tmp_path / f"out-{name}")
        st.run_append(s.sales_stream(), out, str(tmp_path / f"checkpoint-{name}"))
        return sorted(map(tuple, spark.read.schema(s.sales.schema).parquet(out).collect()))

    lines.repartition(5).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert live("many") == sorted(map(tuple, Star(spark, sf_dir).sales.collect()))
    lines.limit(0).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert live("none") == []

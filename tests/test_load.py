"""Raw files, typed load, rejects, staging and incremental load."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import frames as t
import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.schemas import NOW, Table
from basketry.scratch import Scratch
from basketry.sources import ledger, load, raw, snapshot, staging
from basketry.warehouse import Warehouse
from basketry.streaming import ingest

DAY = date(2024, 6, 30)
SMALL = Table("small", {"id": "int", "name": "text", "amount": "money", "ts": "time"}, ("id",), ("id",))


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, newline="")
    return str(tmp_path / name)


LINES = (
    "id,name,amount,ts\n"
    '1,"a, b",10.50,2024-01-01 10:00:00\n'
    "2,,NULL,\n"
    '3,"NULL",abc,2024-01-02 00:00:00\n'
    '4,"q ""x""",4.00,2024-01-01 10:00:00\n'
    "5,short\n"
)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_fixture(spark, tmp_path, multi_line):
    path = put(tmp_path, "small.csv", LINES)
    good, bad = load.load(spark, path, SMALL, t.RUN_TS, multi_line=multi_line)
    moment = datetime(2024, 1, 1, 10)
    assert sorted(good.drop("_loaded_at").collect()) == [
        (1, "a, b", Decimal("10.50"), moment), (2, None, None, None), (4, 'q "x"', Decimal("4.00"), moment),
    ]
    assert sorted((r.reason, r.raw) for r in bad.collect()) == [
        ("bad value: amount", '{"id":"3","amount":"abc","ts":"2024-01-02 00:00:00"}'),
        ("malformed record", "5,short"),
    ]
    assert {r._loaded_at for r in good.collect()} == {t.RUN_TS}
    assert (good.count(), bad.count()) == (3, 2), "counts agree with collected rows"
    assert good.select("id").count() == 3 and good.select("name").count() == 3


def test_line_break_inside_quotes(spark, tmp_path):
    path = put(tmp_path, "small.csv", 'id,name,amount,ts\n1,"two\nlines",1.00,\n')
    good, bad = load.load(spark, path, SMALL, t.RUN_TS, multi_line=True)
    assert [r.name for r in good.collect()] == ["two\nlines"] and bad.count() == 0


def test_too_many_fields_and_whole_numbers_written_as_decimals(spark, tmp_path):
    path = put(tmp_path, "small.csv", "id,name,amount,ts\n1.0,a,1,\n2,b,1,,extra\n99999999999,c,1,\n")
    good, bad = load.load(spark, path, SMALL, t.RUN_TS, multi_line=True)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == ["bad value: id", "malformed record"]


def test_numbers_that_would_lose_decimals_are_rejects(spark, tmp_path):
    path = put(tmp_path, "small.csv", "id,name,amount,ts\n12.7,a,1,\n2,b,10.999,\n3,c,10.9900,\n4.00,d,7,\n5,e,1e2,\n")
    good, bad = load.load(spark, path, SMALL, t.RUN_TS, multi_line=False)
    assert sorted((r.id, r.amount) for r in good.collect()) == [(3, Decimal("10.99")), (4, 7), (5, 100)]
    assert sorted(r.reason for r in bad.collect()) == ["bad value: amount", "bad value: id"]


def test_a_file_without_line_breaks_in_quotes_is_split(spark, tmp_path):
    path = put(tmp_path, "small.csv", "id,name,amount,ts\n" + "".join(f"{k},name {k},1.00,\n" for k in range(60_000)))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        good, bad = load.load(spark, path, SMALL, t.RUN_TS, multi_line=False)
        assert good.rdd.getNumPartitions() > 4 and (good.count(), bad.count()) == (60_000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_empty_export_leaves_no_old_files(spark, tmp_path):
    root = str(tmp_path)
    rows = t.products(spark, (1, "a", "Toys"))
    assert raw.write_raw(rows, root, schemas.PRODUCTS, DAY)
    assert raw.write_raw(rows.limit(0), root, schemas.PRODUCTS, DAY) is None
    assert not (tmp_path / "raw/postgres/products/2024-06-30").exists()
    assert raw.write_raw(rows.where("id > 5"), root, schemas.PRODUCTS, DAY) is None


def test_exports_are_compressed(spark, tmp_path):
    text = spark.createDataFrame([(1, "error", '{"a": 1}')], "id long, event_type string, metadata string")
    events = text.selectExpr("id", "id AS user_id", "event_type", "CAST(NULL AS TIMESTAMP_NTZ) AS event_ts", "metadata")
    for rows, table in ((t.products(spark, (1, "a", "Toys")), schemas.PRODUCTS), (events, schemas.EVENTS)):
        path = raw.write_raw(rows, str(tmp_path), table, DAY)
        assert {p.suffix for p in Path(path).glob("part-*")} == {".gz"}
        assert load.load(spark, path, table, t.RUN_TS, multi_line=False)[0].count() == 1


def test_export_computes_its_source_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    p = t.products(spark, *[(k, f"p{k}", "Toys") for k in range(20)])
    watched = spark.createDataFrame(p.rdd.mapPartitions(count), p.schema)
    raw.write_raw(watched, str(tmp_path), schemas.PRODUCTS, DAY)
    assert seen.value == 20


def test_metadata_that_is_no_json_is_kept_as_text(spark, tmp_path):
    rows = [(1, 2, "error", None, '{"a": 1}'), (2, 2, "error", None, "{oops")]
    df = spark.createDataFrame(rows, "id long, user_id long, event_type string, event_ts timestamp_ntz, metadata string")
    path = raw.write_raw(df, str(tmp_path), schemas.EVENTS, DAY)
    good, bad = load.load(spark, path, schemas.EVENTS, t.RUN_TS)
    assert bad.count() == 0
    assert sorted(r.m for r in good.select(F.to_json("metadata").alias("m")).collect()) == ['"{oops"', '{"a":1}']


def test_latest_snapshot_keeps_rows_without_a_key(spark):
    rows = [(None, 1), (None, 2), (None, 1), (5, 1), (5, 2)]
    got = staging.latest_snapshot(spark.createDataFrame(rows, "id long, v int"), newest=("v",))
    assert sorted(got.collect(), key=str) == sorted([(None, 1), (None, 2), (None, 1), (5, 2)], key=str)


def test_texts_longer_than_their_column(spark, tmp_path):
    path = put(tmp_path, "orders.csv", "id,user_id,created_at,total_amount,status,country,payment_method\n"
               "1,1,,5,paid,France,x\n2,1,,5,paid,FRA,x\n")  # fmt: skip
    good, bad = load.load(spark, path, schemas.ORDERS, t.RUN_TS, multi_line=True)
    assert [r.id for r in good.collect()] == [2]
    assert [r.reason for r in bad.collect()] == ["bad value: country"]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NULL",), ("null",), ("",), ("x",), (None,)], "c string")
    assert [r.c for r in load.apply_null_tokens(df).collect()] == [None, "null", None, "x", None]
    assert [r.c for r in load.apply_null_tokens(df, load.NULL_TOKENS_WIDE).collect()] == [None, None, None, "x", None]


def test_write_loaded_counts_rejects(spark, tmp_path):
    path, out = put(tmp_path, "small.csv", LINES), str(tmp_path)
    rows = load.load_typed(spark, path, SMALL, multi_line=False)
    assert load.write_loaded(rows, SMALL, t.RUN_TS, out + "/small") == 2
    assert {r.accepted: r["count"] for r in spark.read.parquet(out + "/small").groupBy("accepted").count().collect()} == {"true": 3, "false": 2}


@pytest.mark.parametrize(
    "text, options",
    [
        ('[{"id":1,"event_type":"page_view","event_ts":"2024-01-01T10:00:00.000","metadata":{"device":"mobile"}}, '
         '{"id":2,"event_type":"error","event_ts":null,"metadata":{}}]', {}),
        ('{"id":1,"event_type":"page_view","event_ts":"2024-01-01T10:00:00.000","metadata":{"device":"mobile"}}\n'
         '{"id":2,"event_type":"error","metadata":{}}\n', {}),
        ('[\n {"id":1,"event_type":"page_view","event_ts":"2024-01-01T10:00:00Z",\n "metadata":{"device":"mobile"}},\n'
         ' {"id":2.0,"event_type":"error","metadata":{}}\n]', {"multi_line": True}),
    ],
)
def test_json_fixture(spark, tmp_path, text, options):
    good, bad = load.load(spark, put(tmp_path, "events.json", text), schemas.EVENTS, t.RUN_TS, **options)
    rows = good.select("id", "event_ts", F.try_variant_get("metadata", "$.device", "string").alias("device")).collect()
    assert sorted(rows) == [(1, datetime(2024, 1, 1, 10), "mobile"), (2, None, None)]
    assert bad.count() == 0


def test_json_rejects(spark, tmp_path):
    path = put(tmp_path, "events.json", '{"id":1,"event_type":"a"}\n{"id": oops\n{"id":"x","event_type":"b"}\n')
    good, bad = load.load(spark, path, schemas.EVENTS, t.RUN_TS)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == ["bad value: id", "malformed record"]


def test_raw_round_trip_of_awkward_texts(spark, tmp_path):
    names = ["a,b", 'say "hi"', "two\nlines", " spaced ", "back\\slash", "it's", "é", "\\", '"', "trailing\\"]
    p = t.products(spark, *[(k, n, "Toys") for k, n in enumerate(names)])
    path = raw.write_raw(p, str(tmp_path), schemas.PRODUCTS, DAY)
    assert path.endswith("/raw/postgres/products/2024-06-30")
    good, bad = load.load(spark, path, schemas.PRODUCTS, t.RUN_TS, multi_line=True)
    assert bad.count() == 0
    assert sorted(good.drop("_loaded_at").collect()) == sorted(p.collect())


def test_export_replaces_its_day_only(spark, tmp_path):
    root = str(tmp_path)
    first = t.products(spark, (1, "a", "Toys"), (2, "b", "Toys"))
    for day, df in ((DAY, first), (date(2024, 6, 29), first), (DAY, first.limit(1))):
        raw.write_raw(df, root, schemas.PRODUCTS, day)
    counts = [
        load.read_raw_csv(spark, raw.raw_folder(root, schemas.PRODUCTS, d), schemas.PRODUCTS, multi_line=True).count()
        for d in (date(2024, 6, 29), DAY)
    ]
    assert counts == [2, 1]


def test_empty_table_exports_nothing(spark, tmp_path):
    assert raw.write_raw(t.products(spark), str(tmp_path), schemas.PRODUCTS, DAY) is None
    assert not list(tmp_path.glob("raw/postgres/products/*"))


def test_jdbc_options_cover_all_ids():
    o = snapshot.jdbc_options("jdbc:x", schemas.ORDERS, 1, 1000, 16)
    assert (o["dbtable"], o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == (
        "orders", "id", "1", "1000", "16",
    )


def test_staging_days(spark, tmp_path):
    root, other = str(tmp_path), date(2024, 6, 29)
    o = t.orders(spark, (1, 1, t.days_ago(1), 5, "paid"), (2, 1, t.days_ago(1), 5, "paid"))
    stamped = o.withColumn("_loaded_at", F.lit("2024-06-30 02:00:00").cast("timestamp_ntz"))
    for day in (other, DAY, DAY):
        staging.append_staging(stamped, root, schemas.ORDERS, day)
    everything = staging.read_staging(spark, root, schemas.ORDERS)
    assert everything.count() == 4
    one_day = staging.read_staging(spark, root, schemas.ORDERS, DAY)
    assert one_day.count() == 2
    text = one_day._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(ingest_date" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_latest_snapshot_with_many_copies(spark):
    """A third of all rows are copies of one key."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id") % 500).alias("id"),
        F.expr("date_add(date'2024-01-01', cast(id % 11 as int))").alias("ingest_date"),
        (F.col("id") * 3).alias("v"),
    )
    got = {r.id: (r.ingest_date, r.v) for r in staging.latest_snapshot(df).collect()}
    newest = {}
    for r in df.collect():
        if r.id not in newest or r.ingest_date > newest[r.id]:
            newest[r.id] = r.ingest_date
    assert {k: v[0] for k, v in got.items()} == newest
    again = {r.id: (r.ingest_date, r.v) for r in staging.latest_snapshot(df.repartition(5)).collect()}
    assert got == again, "equally new rows are told apart the same way"
    assert "Window" not in staging.latest_snapshot(df)._jdf.queryExecution().executedPlan().toString()


def test_latest_snapshot_of_events(spark, tmp_path):
    """Semi-structured columns pass through."""
    e = t.events(spark, (1, None, "error", t.days_ago(1), '{"a":1}'), (1, None, "error", t.days_ago(1), '{"a":2}'))
    rows = e.select("id", F.parse_json("metadata").alias("metadata"), F.lit(DAY).alias("ingest_date"))
    got = [r[0] for r in staging.latest_snapshot(rows).select(F.to_json("metadata")).collect()]
    again = [r[0] for r in staging.latest_snapshot(rows.repartition(3)).select(F.to_json("metadata")).collect()]
    assert len(got) == 1 and got == again


def daily(spark, root, *days):
    """(day, load hour, {key: value}): staged one after the other; a value may be a list for several rows."""
    for day, hour, values in days:
        rows = [(k, x) for k, v in values.items() for x in (v if isinstance(v, list) else [v])]
        o = t.orders(spark, *[(k, 1, t.days_ago(1), x, "paid") for k, x in rows])
        o = o.withColumn("_loaded_at", F.lit(f"2024-06-30 {hour:02d}:00:00").cast("timestamp_ntz"))
        staging.append_staging(o, root, schemas.ORDERS, day)
        yield day, staging.read_staging(spark, root, schemas.ORDERS).where(F.col("ingest_date") == F.lit(day))


DAYS = [date(2024, 6, n) for n in (27, 28, 29, 30)]


def found_orders(df):
    return sorted((r.id, r.ingest_date.day, r.total_amount) for r in df.collect())


def test_state_follows_the_days(spark, tmp_path):
    """Keys come, change, go, come back, stay as they are and occur twice; no earlier day is read to merge one more."""
    root, state = str(tmp_path), None
    days = daily(
        spark, root,
        (DAYS[0], 1, {1: 10, 2: 10, 3: 10, 4: [5, 7]}),
        (DAYS[1], 2, {1: 10, 2: 20, 5: 1}),
        (DAYS[2], 3, {1: 10, 3: 30, 6: [2, 2]}),
        (DAYS[2], 4, {1: 11, 3: 30, 6: [2, 2], 7: 1}),
    )
    for day, rows in days:
        merged = staging.merge_state(state, rows)
        if state is not None:
            text = merged._jdf.queryExecution().executedPlan().toString()
            assert all(str(d) not in text for d in DAYS if d < day)
        state = Scratch(spark).keep(merged)
        everything = staging.read_staging(spark, root, schemas.ORDERS)
        assert found_orders(staging.rows_of_best(everything, state, "id")) == found_orders(staging.latest_snapshot(everything))
    got = {(i, d): v for i, d, v in found_orders(staging.latest_snapshot(everything))}
    assert {k: int(v) for k, v in got.items() if k[0] != 4} == {(1, 29): 11, (2, 28): 20, (3, 29): 30, (5, 28): 1, (6, 29): 2, (7, 29): 1}
    assert sum(k[0] == 4 for k in got) == 1


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_an_unchanged_day_shuffles_keys_and_hashes_only(spark, tmp_path):
    same = {k: k for k in range(1, 60)}
    list(daily(spark, str(tmp_path), (DAYS[0], 1, same), (DAYS[1], 2, same)))
    rows = staging.read_staging(spark, str(tmp_path), schemas.ORDERS)
    best = staging.best_ranks(staging.ranked(rows, "id"))
    moved = exchanges(best)
    assert moved and all("payment_method" not in line and "total_amount" not in line for line in moved)
    got = staging.latest_snapshot(rows, scratch=Scratch(spark))
    assert found_orders(got) == [(k, 28, k) for k in range(1, 60)]
    # There are no exceptions, so the newest day's rows go straight from the scan to the result.
    text = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    straight = text[text.index("Union") : text.index("Subquery")]
    assert "FileScan parquet" in straight and "Exchange" not in straight and "Join" not in straight


def put_orders(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    head = ",".join(schemas.ORDERS.columns)
    (folder / name).write_text("\n".join([head, *(f"{i},1,2024-06-01 10:00:00,{v},paid,fra,PayPal" for i, v in rows)]) + "\n")


def ids(spark, target):
    return sorted((r.id, int(r.total_amount), r.ingest_date.day) for r in ledger.read_loaded(spark, target, schemas.ORDERS).collect())


def test_ledger_loads_new_and_replaced_files_once(spark, tmp_path):
    root, target = str(tmp_path / "src"), str(tmp_path / "dst")
    days = tmp_path / "src/raw/postgres/orders"

    def run(**options):
        return ledger.ingest_files(spark, root, schemas.ORDERS, target, t.RUN_TS, multi_line=False, **options)

    assert run() == 0, "no folder yet"
    put_orders(days / "2024-06-29", "a.csv", (1, 10), (2, 10))
    put_orders(days / "2024-06-29", "b.csv", (3, 10), ("x", 1))
    put_orders(days / "2024-06-30", "a.csv", (4, 10))
    assert run(files_per_load=2) == 3
    want = [(1, 10, 29), (2, 10, 29), (3, 10, 29), (4, 10, 30)]
    assert ids(spark, target) == want
    assert [r.raw[:8] for r in ledger.read_loaded_rejects(spark, target, schemas.ORDERS).collect()] == ['{"id":"x']
    assert run() == 0 and ids(spark, target) == want, "nothing new"
    put_orders(days / "2024-06-29", "b.csv", (3, 99), (5, 10))  # the same name, other content
    assert run() == 1
    assert ids(spark, target) == [(1, 10, 29), (2, 10, 29), (3, 99, 29), (4, 10, 30), (5, 10, 29)]
    assert ledger.read_loaded_rejects(spark, target, schemas.ORDERS).count() == 0
    # A day is exported anew under other names; another day's folder is tidied away.
    for old in (days / "2024-06-29").iterdir():
        old.unlink()
    put_orders(days / "2024-06-29", "c.csv", (6, 10))
    (days / "2024-06-30" / "a.csv").unlink()
    assert run() == 1
    assert ids(spark, target) == [(4, 10, 30), (6, 10, 29)]
    history = ledger.read_ledger(Warehouse(spark, target), schemas.ORDERS).collect()
    assert len(history) == 5 and sum(r.superseded_by is None for r in history) == 2


def test_a_load_that_fails_is_repeated_without_duplicates(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "src"), str(tmp_path / "dst")
    put_orders(tmp_path / "src/raw/postgres/orders/2024-06-30", "a.csv", (1, 10))
    real = ledger.next_ledger
    monkeypatch.setattr(ledger, "next_ledger", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ledger.ingest_files(spark, root, schemas.ORDERS, target, t.RUN_TS, multi_line=False)
    assert Warehouse(spark, target).version() == 0
    monkeypatch.setattr(ledger, "next_ledger", real)
    assert ledger.ingest_files(spark, root, schemas.ORDERS, target, t.RUN_TS, multi_line=False) == 1
    assert ids(spark, target) == [(1, 10, 30)]


def test_rejects_and_rows_come_from_one_pass(spark, tmp_path):
    path = put(tmp_path, "orders.csv", "id,user_id,created_at,total_amount,status,country,payment_method\n1,1,,5,paid,fra,x\n2,1\n")
    rows = load.load_typed(spark, path, schemas.ORDERS, multi_line=False)
    target = f"{tmp_path}/staged/ingest_date=2024-06-30"
    assert load.write_loaded(rows, schemas.ORDERS, t.RUN_TS, target) == 1
    text = load.with_verdict(rows, schemas.ORDERS, t.RUN_TS)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan csv") == 1
    good = staging.read_accepted(spark, f"{tmp_path}/staged", staging.staging_schema(schemas.ORDERS))
    assert [(r.id, r.ingest_date) for r in good.collect()] == [(1, DAY)]
    bad = staging.read_rejected(spark, f"{tmp_path}/staged", schemas.ORDERS).collect()
    assert [(r.reason, r.raw, r.ingest_date) for r in bad] == [("malformed record", "2,1", DAY)]


def test_defaults(spark):
    df = spark.createDataFrame([(1, "e", None)], "id long, email string, plan_type string")
    row = load.apply_defaults(df, schemas.USERS, t.RUN_TS).first()
    assert (row.plan_type, row.created_at, row.is_active, row.country) == (None, t.RUN_TS, True, None)
    filled = load.apply_defaults(df, schemas.USERS, t.RUN_TS, fill_nulls=True).first()
    assert filled.plan_type == "freemium"
    assert schemas.ORDERS.defaults["created_at"] is NOW


def test_incremental_load(spark, tmp_path):
    root, target, day2 = str(tmp_path / "src"), str(tmp_path / "dst"), date(2024, 7, 1)
    o = t.orders(spark, (1, 1, t.days_ago(1), 5, "paid"), (2, 1, t.days_ago(1), 5, "paid"))

    def run():
        ingest.ingest(spark, root, schemas.ORDERS, target, t.RUN_TS, multi_line=True)
        return ingest.read_ingested(spark, target, schemas.ORDERS)

    raw.write_raw(o, root, schemas.ORDERS, DAY)
    (tmp_path / "src/raw/postgres/orders/2024-06-30/extra.csv").write_text("id,user_id\n9,1\n")
    assert run().count() == 2
    assert run().count() == 2, "nothing new"
    raw.write_raw(o.withColumn("status", F.lit("shipped")), root, schemas.ORDERS, day2)
    both = run()
    assert sorted((r.id, r.status, r.ingest_date) for r in both.collect()) == [
        (1, "paid", DAY), (1, "shipped", day2), (2, "paid", DAY), (2, "shipped", day2),
    ]
    assert {r.status for r in staging.latest_snapshot(both).collect()} == {"shipped"}
    rejects = ingest.read_ingest_rejects(spark, target, schemas.ORDERS)
    assert [(r.reason, r.raw) for r in rejects.collect()] == [("malformed record", "9,1")]


def test_incremental_load_equals_batch_load(spark, tmp_path):
    root, target = str(tmp_path / "src"), str(tmp_path / "dst")
    p = t.products(spark, *[(k, f"p{k}", "Toys") for k in range(50)])
    path = raw.write_raw(p, root, schemas.PRODUCTS, DAY)
    ingest.ingest(spark, root, schemas.PRODUCTS, target, t.RUN_TS, multi_line=True)
    stream = ingest.read_ingested(spark, target, schemas.PRODUCTS).drop("ingest_date")
    batch, _ = load.load(spark, path, schemas.PRODUCTS, t.RUN_TS, multi_line=True)
    assert sorted(stream.collect()) == sorted(batch.collect())


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: "/shared/x/" if key == "spark.checkpoint.dir" else default)

    from basketry.scratch import shared_folder

    assert shared_folder(Fake) == "/shared/x"

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:1"

    with pytest.raises(ValueError):
        shared_folder(Bare)


def test_scratch_closes(spark, tmp_path):
    scratch = Scratch(spark, str(tmp_path))
    assert scratch.keep(spark.range(3)).count() == 3
    assert len(list(tmp_path.iterdir())) == 1
    scratch.close()
    assert list(tmp_path.iterdir()) == []

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from shelfline.streaming import activity, cdc

NOW = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_change_feed(spark, folder):
    inbox = {"products": f"{folder}/in/products", "pos_store_sales": f"{folder}/in/pos", "orders": f"{folder}/in/none"}
    feed = cdc.ChangeFeed(spark, inbox, f"{folder}/ods")
    head = "product_id,name,category,price_cents,stock_quantity,supplier_country\n"
    put(f"{folder}/in/products/1.csv", head + "p1,a,Food,5,1,X\np2,b,Food,6,,X\n")
    put(f"{folder}/in/pos/1.json", json.dumps([{"sale_id": "s1", "quantity": 3}]))
    assert feed.micro_batch(NOW) == ["micro_20240501_120000"]
    before = {r.source_key: r for r in feed.store.read().collect()}
    assert set(before) == {"p1", "p2", "s1"}
    assert json.loads(before["p2"].payload)["stock_quantity"] is None
    assert before["s1"].source_system == "pos"
    # Nothing new: nothing happens. For the stream a changed file lands under a new name.
    assert feed.micro_batch(NOW + dt.timedelta(seconds=1)) == []
    put(f"{folder}/in/products/2.csv", head + "p1,a,Food,9,1,X\n")
    later = NOW + dt.timedelta(seconds=2)
    feed.micro_batch(later)
    after = {r.source_key: r for r in feed.store.read().collect()}
    assert json.loads(after["p1"].payload)["price_cents"] == 9
    assert after["p1"].batch_id == "micro_20240501_120002" and after["p1"].record_id == before["p1"].record_id
    assert after["p2"] == before["p2"] and len(after) == 3


def test_poll_reads_a_changed_file_once_per_change(spark, folder):
    inbox = {"products": f"{folder}/in/p d+1", "pos_store_sales": f"{folder}/in/pos"}
    feed = cdc.ChangeFeed(spark, inbox, f"{folder}/ods")

    def at(path, text, second):
        put(path, text)
        os.utime(path, (1_700_000_000 + second, 1_700_000_000 + second + 0.25))

    moments = iter(NOW + dt.timedelta(seconds=s) for s in range(100))
    one, two, pos = f"{folder}/in/p d+1/1.csv", f"{folder}/in/p d+1/sub/2.csv", f"{folder}/in/pos/1.json"
    at(one, "product_id,name\np1,a\np2,b\nproduct_id,name\n", 0)
    at(two, "name,product_id\nc,p3\n", 500)
    at(pos, json.dumps([{"sale_id": "s1"}]), 0)
    feed.poll(0, [next(moments)])
    assert {r.source_key: r.batch_id[-2:] for r in feed.store.read().collect()} == dict.fromkeys(["p1", "p2", "product_id", "p3", "s1"], "00")
    assert feed.poll_once(next(moments)) == []
    # the same name, older than another file that was taken in
    at(one, "product_id,name\np1,A\n", 100)
    assert feed.poll_once(next(moments)) == ["poll_20240501_120002"]
    # another size at the same time
    at(pos, json.dumps([{"sale_id": "s1", "quantity": 5}, {"sale_id": "s2"}]), 0)
    assert feed.poll_once(next(moments)) == ["poll_20240501_120003"]
    assert feed.poll_once(next(moments)) == []
    got = {r.source_key: (r.batch_id[-2:], json.loads(r.payload)) for r in feed.store.read().collect()}
    assert got["p1"] == ("02", {"product_id": "p1", "name": "A"}) and got["p2"][0] == "00" and got["p3"][0] == "00"
    assert got["s1"] == ("03", {"sale_id": "s1", "quantity": 5}) and got["s2"][0] == "03"
    assert feed.ledger("products").entries().count() == 2
    # touched back to a state it had before: a change, too
    at(one, "product_id,name\np1,a\np2,b\nproduct_id,name\n", 0)
    assert len(feed.poll_once(next(moments))) == 1 and feed.poll_once(next(moments)) == []


def test_batch_without_entries_is_taken_in_anew(spark, folder, monkeypatch):
    feed = cdc.ChangeFeed(spark, {"products": f"{folder}/in"}, f"{folder}/ods")
    put(f"{folder}/in/1.csv", "product_id,name\np1,a\n")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(cdc.FileLedger, "commit", fails)
        with pytest.raises(RuntimeError):
            feed.poll_once(NOW)
    assert feed.merge() == [] and feed.store.read().count() == 0
    later = NOW + dt.timedelta(seconds=5)
    assert feed.poll_once(later) == ["poll_20240501_120005"] and feed.poll_once(later) == []
    assert [r.batch_id for r in feed.store.read().collect()] == ["poll_20240501_120005"]


def test_newest_file_wins_within_a_pass(spark, folder):
    inbox = {"products": f"{folder}/in"}
    feed = cdc.ChangeFeed(spark, inbox, f"{folder}/ods")
    head = "product_id,name,category,price_cents,stock_quantity,supplier_country\n"
    for n, price in ((1, 9), (2, 5)):
        put(f"{folder}/in/{n}.csv", head + f"p1,a,Food,{price},1,X\n")
        os.utime(f"{folder}/in/{n}.csv", (time.time() - 100 + n * 10,) * 2)
    feed.micro_batch(NOW)
    assert json.loads(feed.store.read().first().payload)["price_cents"] == 5


def test_columns_go_by_name_and_all_of_them_are_kept(spark, folder):
    inbox = {"products": f"{folder}/in/p d", "pos_store_sales": f"{folder}/in/pos"}
    feed = cdc.ChangeFeed(spark, inbox, f"{folder}/ods")
    put(f"{folder}/in/p d/1.csv", 'name,product_id,price_cents,colour\n"Pen, ""fine""",p1,7,red\nInk,p2,seven,\n')
    put(f"{folder}/in/p d/2.csv", "product_id,name\np3,Nib\n")
    put(f"{folder}/in/pos/1.json", json.dumps([{"sale_id": "s1", "note": {"a": [1, None]}}, {"sale_id": "s2", "quantity": 2}], indent=1))
    put(f"{folder}/in/pos/2.json", json.dumps({"quantity": 1}))
    feed.micro_batch(NOW)
    got = {r.source_key: json.loads(r.payload) for r in feed.store.read().collect()}
    assert got == {
        "p1": {"name": 'Pen, "fine"', "product_id": "p1", "price_cents": 7, "colour": "red"},
        "p2": {"name": "Ink", "product_id": "p2", "price_cents": None, "colour": None, "_uncast": {"price_cents": "seven"}},
        "p3": {"product_id": "p3", "name": "Nib"},
        "s1": {"sale_id": "s1", "note": {"a": [1, None]}}, "s2": {"sale_id": "s2", "quantity": 2}, "": {"quantity": 1},
    }


def test_batches_merge_by_time(spark, folder):
    feed = cdc.ChangeFeed(spark, {"products": f"{folder}/in"}, f"{folder}/ods")
    for n, (prefix, hour) in enumerate((("poll", 1), ("micro", 2))):
        put(f"{folder}/in/{n}.csv", f"product_id,name\np1,{prefix}\n")
        moment = NOW + dt.timedelta(hours=hour)
        feed.append(f"{prefix}_{moment:%Y%m%d_%H%M%S}", moment)
    assert [b.split("_")[0] for b in feed.merge()] == ["poll", "micro"]
    assert json.loads(feed.store.read().first().payload)["name"] == "micro"


def test_unmerged_batch_is_picked_up(spark, folder):
    feed = cdc.ChangeFeed(spark, {"products": f"{folder}/in"}, f"{folder}/ods")
    put(f"{folder}/in/1.csv", "product_id,name,category,price_cents,stock_quantity,supplier_country\np1,a,Food,5,1,X\n")
    feed.append("micro_1", NOW)
    assert feed.micro_batch(NOW) == ["micro_1"]
    assert feed.store.read().count() == 1


def test_minute_activity_equals_batch_over_closed_minutes(spark, folder):
    schema = "kind string, ts timestamp_ntz"
    start = dt.datetime(2024, 1, 1)
    first = [("a", start + dt.timedelta(seconds=20 * i)) for i in range(180)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{folder}/in/x=1")
    src = spark.readStream.schema(schema).parquet(f"{folder}/in/x=*")
    stream = activity.minute_activity(src, "kind", "ts")
    table = activity.run_to_table(stream, f"{folder}/out", f"{folder}/progress")
    got = {r.minute_bucket: r.txn_count for r in table.collect()}
    closed = [t for _, t in first if t.replace(second=0) + dt.timedelta(minutes=1) <= first[-1][1] - dt.timedelta(minutes=10)]
    want = {}
    for t in closed:
        want[t.replace(second=0)] = want.get(t.replace(second=0), 0) + 1
    assert got == want
    # One row far behind the watermark is dropped, one still in time is counted.
    late = [("a", start), ("a", first[-1][1] - dt.timedelta(minutes=5)), ("a", start + dt.timedelta(hours=3))]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{folder}/in/x=2")
    table = activity.run_to_table(
        activity.minute_activity(spark.readStream.schema(schema).parquet(f"{folder}/in/x=*"), "kind", "ts"),
        f"{folder}/out", f"{folder}/progress")
    counts = {r.minute_bucket: r.txn_count for r in table.collect()}
    assert counts[start] == 3
    assert counts[(first[-1][1] - dt.timedelta(minutes=5)).replace(second=0)] == 4
    assert sum(counts.values()) == len(first) + 1


def test_payload_keys_without_the_key_column(spark):
    rows = cdc.to_records(spark.range(1), "orders", "order_id", "b", F.lit(NOW)).collect()
    assert rows[0].source_key == ""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
import itertools

import pytest
from pyspark.sql import Row, functions as F

from shelfline.operators import scd, upsert
from shelfline.plans import staging
from shelfline.schemas import ODS
from shelfline.sources import paths, versions
from shelfline.sources.star import DAILY, Star

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 4, 7)]


def batch(spark, day, people):
    rows = [
        (f"c-{e}", "A", "B", e, "X", city, dt.date(2020, 1, 1), 30, "Other", day) for e, city in people.items()
    ]
    return spark.createDataFrame(
        rows, "customer_id string, first_name string, last_name string, email string, country string, city string, "
              "signup_date date, age int, gender string, _execution_date date")


@pytest.fixture(scope="module")
def batches(spark):
    states = [
        {"same": "a", "changed": "a", "gone": "a", "back": "a"},
        {"same": "a", "changed": "b", "gone": "a"},
        {"same": "a", "changed": "b", "back": "a", "new": "z"},
        {"same": "a", "changed": "a", "back": "a", "new": "z"},
    ]
    return [batch(spark, d, s) for d, s in zip(DAYS, states)]


def union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def facts(df):
    return sorted((r.email, r.city, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in df.collect())


def empty(spark, batches):
    return scd.versions(batches[0]).limit(0)


def test_window_form_equals_batch_by_batch(spark, batches):
    history = empty(spark, batches)
    for day, b in zip(DAYS, batches):
        history = scd.add_batch(history, b, day)
        again = scd.add_batch(history, b, day)
        assert facts(again) == facts(history)
    assert facts(history) == facts(scd.versions(union(batches)))


def test_changed_versions(spark, batches):
    got = facts(scd.changed_versions(union(batches)))
    d1, d2, d4, d7 = map(str, DAYS)
    assert got == sorted([
        ("same", "a", d1, "None"),
        ("changed", "a", d1, d2), ("changed", "b", d2, d7), ("changed", "a", d7, "None"),
        ("gone", "a", d1, d4),
        ("back", "a", d1, d2), ("back", "a", d4, "None"),
        ("new", "z", d4, "None"),
    ])


def test_changed_form_equals_batch_by_batch(spark, folder, batches):
    history = empty(spark, batches)
    for n, (day, b) in enumerate(zip(DAYS, batches)):
        scd.add_changed_batch(history, b, day).write.parquet(f"{folder}/{n}")
        history = spark.read.parquet(f"{folder}/{n}")
        assert facts(scd.add_changed_batch(history, b, day)) == facts(history)
    assert facts(history) == facts(scd.changed_versions(union(batches)))


@pytest.mark.parametrize("changes_only", [False, True])
def test_stored_history(spark, folder, batches, changes_only):
    table = scd.HistoryTable(spark, f"{folder}/h", changes_only)
    form = scd.changed_versions if changes_only else scd.versions
    for n, (day, b) in enumerate(zip(DAYS, batches), 1):
        # A wrong batch first: the repeated run must leave no trace of it.
        table.apply(batches[0].limit(0 if n == 2 else 1), day)
        table.apply(b, day)
        table.apply(b, day)
        assert facts(table.read()) == facts(form(union(batches[:n])))
    with pytest.raises(ValueError):
        table.apply(batches[0], DAYS[0])


@pytest.mark.parametrize("form", [scd.versions, scd.changed_versions])
def test_intervals_do_not_overlap(batches, form):
    rows = sorted(form(union(batches)).collect(), key=lambda r: (r.email, r.dbt_valid_from))
    for _, chain in itertools.groupby(rows, key=lambda r: r.email):
        chain = list(chain)
        assert sum(r.dbt_valid_to is None for r in chain) <= 1
        for a, b in zip(chain, chain[1:]):
            assert a.dbt_valid_to <= b.dbt_valid_from


def test_as_of_against_brute_force(spark, batches):
    history = scd.versions(union(batches))
    days = [dt.date(2023, 12, 30) + dt.timedelta(i) for i in range(14)]
    keys = ["c-same", "c-gone", "c-back", "c-new", "c-none"]
    orders = spark.createDataFrame([(k, d) for k in keys for d in days] + [("c-same", None)], "customer_id string, day date")
    got = {(r.customer_id, r.day): r.v_dbt_valid_from for r in
           scd.as_of(orders, history, "customer_id", "day", scd.batch_calendar(union(batches))).collect()}
    stored = history.collect()
    for (k, d), start in got.items():
        want = [v.dbt_valid_from for v in stored if d and v.customer_id == k and v.dbt_valid_from <= d
                and (v.dbt_valid_to is None or d < v.dbt_valid_to)]
        assert [start] == (want or [None])
    assert len(got) == orders.count()


def test_history_of_the_star(spark):
    star = Star(spark, "/root/testdata/sf0.001")
    table = star.customers()
    staged = staging.customer_batches(table)
    history = scd.versions(staged).limit(0)
    for day in DAILY:
        history = scd.add_batch(history, staged.where(F.col("_execution_date") == F.lit(day)), day)
    assert facts(history) == facts(scd.versions(staged))


# --- incremental fact and record store --------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark, *rows):
    return spark.createDataFrame(
        [(o, dt.date.fromisoformat(d) if d else None, q) for o, d, q in rows],
        "order_id string, order_date date, quantity int")


def listed(df):
    return sorted(((r.order_id, str(r.order_date), r.quantity) for r in df.collect()))


FIRST = [("a", "2024-01-05", 1), ("b", "2024-02-10", 1), ("c", "2024-02-20", 1)]


@pytest.mark.parametrize("source", [
    FIRST + [("d", "2024-02-20", 1), ("e", "2024-03-01", 1)],
    FIRST + [("late", "2024-01-01", 1), ("nodate", None, 1)],
    [("a", "2024-03-05", 2), ("b", "2024-02-10", 9), ("c", "2024-02-20", 5)],
    [],
])
def test_incremental_fact(spark, folder, source):
    target = lines(spark, *FIRST)
    fresh = lines(spark, *source)
    newest = "2024-02-20"
    taken = [r for r in source if r[1] and r[1] >= newest]
    want = sorted(
        [(o, d, q) for o, d, q in FIRST if o not in {t[0] for t in taken}] + taken
    )
    assert listed(upsert.incremental_fact(target, fresh)) == want
    fact = upsert.MonthlyFact(spark, f"{folder}/fact", target.schema)
    fact.refresh(target)
    assert fact.update(fresh) == dt.date(2024, 2, 20)
    assert listed(fact.read()) == want
    # Repeating a run that broke off, with its bound, changes nothing.
    fact.update(fresh, since=dt.date(2024, 2, 20))
    assert listed(fact.read()) == want
    fact.refresh(fresh)
    assert listed(fact.read()) == sorted((o, str(d), q) for o, d, q in source)


def test_update_reads_index_buckets_and_touched_months(spark, folder):
    months = [f"2024-{m:02d}-03" for m in range(1, 13)]
    target = lines(spark, *((f"{d}-{i}", d, i) for d in months for i in range(9)))
    fact = upsert.MonthlyFact(spark, f"{folder}/fact", target.schema)
    fact.refresh(target)
    key, late = f"{months[2]}-4", dt.date(2024, 12, 9)
    now, fresh = fact.table.snapshot(), lines(spark, (key, "2024-12-09", 77))
    held = now.holding(fresh, fact.schema)
    bucket = fresh.select(fact.table.bucket(fact.table.hash())).first()[0]
    assert [r[0] for r in held.collect()] == ["2024-03"]
    scans = [line for line in plan(held).splitlines() if "FileScan" in line]
    assert scans and all(f"= {bucket})]" in line and "ReadSchema: struct<key_hash:bigint,order_month:string>" in line for line in scans)
    read = {r[0] for r in now.keys([bucket]).select(F.input_file_name()).collect()}
    assert read and all(f"/keys/run={now.held['2024-03']}/bucket={bucket}/" in f for f in read)
    # the other months are neither read nor written
    before = dict(now.held)
    for month in set(before) - {"2024-03", "2024-12"}:
        paths.delete(spark, f"{folder}/fact/data/run={before[month]}/order_month={month}")
    assert fact.update(fresh, since=late) == late
    after = fact.table.snapshot()
    assert {m for m in before if after.held[m] != before[m]} == {"2024-03", "2024-12"}
    rows = after.read(fact.schema, ["2024-03", "2024-12"]).drop("order_month")
    kept = [(f"{d}-{i}", d, i) for d in (months[2], months[11]) for i in range(9) if f"{d}-{i}" != key]
    assert listed(rows) == sorted([*kept, (key, "2024-12-09", 77)])
    # the key has moved in the index, too
    assert [r[0] for r in after.holding(fresh, fact.schema).collect()] == ["2024-12"]


def test_index_of_repeats_nulls_and_months_without_one(spark, folder):
    target = lines(spark, ("a", "2024-01-05", 1), ("a", "2024-01-06", 2), ("a", "2024-02-01", 3), (None, "2024-02-02", 4), ("b", None, 5))
    fact = upsert.MonthlyFact(spark, f"{folder}/fact", target.schema, buckets=3)
    fact.refresh(target)
    found = sorted(r.order_month for r in fact.table.snapshot().keys().collect())
    assert found == ["2024-01", "2024-02", "2024-02", "none"]
    # an older table has no index: its months are looked through until they are rewritten
    for run in fact.table.indexed_runs():
        paths.delete(spark, f"{folder}/fact/keys/run={run}")
    fresh = lines(spark, ("a", "2024-02-09", 9))
    assert {r[0] for r in fact.table.snapshot().holding(fresh, fact.schema).collect()} == {"2024-01", "2024-02"}
    fact.update(fresh)
    assert listed(fact.read().where("order_id is not null")) == [("a", "2024-02-09", 9), ("b", "None", 5)]
    assert sorted(r.order_month for r in fact.table.snapshot().keys().collect()) == ["2024-02", "2024-02"]
    # an empty table, and the index of runs that no list keeps
    fact.refresh(target.limit(0))
    assert fact.table.snapshot().keys().count() == 0
    fact.table.clean(keep=1)
    assert not fact.table.indexed_runs()


def test_first_update_loads_everything(spark, folder):
    fact = upsert.MonthlyFact(spark, f"{folder}/fact", lines(spark, *FIRST).schema)
    assert fact.update(lines(spark, *FIRST)) is None
    assert listed(fact.read()) == sorted(FIRST)
    assert listed(upsert.incremental_fact(None, lines(spark, *FIRST))) == sorted(FIRST)
    assert listed(upsert.incremental_fact(lines(spark, *FIRST), lines(spark, FIRST[0]), full_refresh=True)) == FIRST[:1]


def test_record_store_repeats_safely_and_the_newest_wins(spark, folder):
    store = upsert.RecordStore(spark, f"{folder}/ods")

    def changes(hour, *rows):
        at = dt.datetime(2024, 1, 1, hour)
        return spark.createDataFrame([(i, "s", i, payload, at, f"b{hour}") for i, payload in rows], ODS)

    store.merge(changes(1, ("aa1", "old"), ("bb1", "old")))
    new = changes(3, ("aa1", "new"), ("cc1", "new"))
    store.merge(new)
    store.merge(new)
    store.merge(changes(2, ("aa1", "late"), ("bb1", "late")))
    got = sorted((r.record_id, r.payload) for r in store.read().collect())
    assert got == [("aa1", "new"), ("bb1", "late"), ("cc1", "new")]


@pytest.mark.parametrize("step", ["overwrite_partitions", "write_text", "move_new"])
def test_a_run_that_breaks_off_leaves_the_table_whole(spark, folder, monkeypatch, step):
    table = versions.VersionedTable(spark, f"{folder}/t", "p")
    schema = "k string, p string"
    table.replace(spark.createDataFrame([("a", "1"), ("b", "2")], schema))

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions.paths, step, broken)
        with pytest.raises(OSError):
            table.replace(spark.createDataFrame([("c", "1")], schema), ["1"])
    assert sorted(map(tuple, table.read(schema).collect())) == [("a", "1"), ("b", "2")]
    table.replace(spark.createDataFrame([("c", "1")], schema), ["1", "2"])
    table.clean(keep=1)
    assert sorted(map(tuple, table.read(schema).collect())) == [("c", "1")]
    # the run that broke off may have left a folder, which goes once it is old
    monkeypatch.setattr(versions, "ORPHAN_HOURS", -1)
    table.clean(keep=1)
    assert len(paths.glob(spark, f"{folder}/t/data/run=*")) == 1 and not paths.glob(spark, f"{folder}/t/draft/*.json")


def test_two_writers_lose_nothing(spark, folder):
    table = versions.VersionedTable(spark, f"{folder}/t", "p")
    schema = "k string, p string"

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), schema)

    def now():
        return sorted(map(tuple, table.read(schema).collect()))

    table.replace(rows(("a", "1"), ("b", "2")))
    first, second, third = table.snapshot(), table.snapshot(), table.snapshot()
    first.replace(rows(("a2", "1")), ["1"])
    # another partition: both changes hold
    second.replace(rows(("b2", "2")), ["2"])
    assert now() == [("a2", "1"), ("b2", "2")]
    # the same one, one that was looked at, one that is filled, or all of them: the later writer is told
    for values, looked_at, made in (
        (["1"], (), ("x", "1")), (["3"], ["2"], ("x", "3")), (["3"], (), ("x", "2")), (None, (), ("x", "9")),
    ):
        with pytest.raises(versions.ConcurrentChange):
            third.replace(rows(made), values, looked_at)
    with pytest.raises(versions.ConcurrentChange):
        third.replace(rows(("x", "3")), ["3"], at_all=True)
    assert now() == [("a2", "1"), ("b2", "2")]
    # work that is overtaken starts over from what is there
    seen = []

    def work(snapshot):
        held = snapshot.read(schema, ["1"])
        seen.append(snapshot.number)
        if len(seen) < 3:
            table.replace(rows((f"other{len(seen)}", "1")), ["1"])
        snapshot.replace(held.selectExpr("concat(k, '+') AS k", "p"), ["1"])

    table.change(work)
    assert len(seen) == 3 and now() == [("b2", "2"), ("other2+", "1")]
    with pytest.raises(versions.ConcurrentChange):
        table.change(lambda s: (table.replace(rows(("y", "1")), ["1"]), s.replace(rows(("z", "1")), ["1"])), attempts=2)


def test_writers_at_the_same_time(spark, folder):
    store = upsert.RecordStore(spark, f"{folder}/ods", digits=1)

    def merge(n):
        at = dt.datetime(2024, 1, 1, n)
        own = [(f"{i}{n}", "s", f"{i}{n}", "x", at, f"b{n}") for i in range(3)] + [("ff", "s", "ff", f"by{n}", at, f"b{n}")]
        store.merge(spark.createDataFrame(own, ODS))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(merge, range(3)))
    got = {r.record_id: r.payload for r in store.read().collect()}
    assert len(got) == 10 and got["ff"] == "by2"


@pytest.mark.parametrize("put", [None, "_linked", "_renamed"])
def test_a_name_is_given_once(spark, folder, monkeypatch, put):
    if put:
        monkeypatch.setattr(paths, "_linked", getattr(paths, put))
    drafts = [paths.write_text(spark, f"{folder}/draft/{i}", str(i)) for i in range(3)]
    assert [paths.move_new(spark, d, f"{folder}/list/1") for d in drafts] == [True, False, False]
    assert paths.read_text(spark, f"{folder}/list/1") == "0" and paths.glob(spark, f"{folder}/draft/*") == []


def test_old_lists_and_folders_go(spark, folder):
    table = versions.VersionedTable(spark, f"{folder}/t", "p", keep=2)
    schema = "k string, p string"
    table.replace(spark.createDataFrame([("a", "1"), ("b", "2")], schema))
    for i in range(5):
        before = table.snapshot()
        table.replace(spark.createDataFrame([(f"a{i}", "1")], schema), ["1"])
        assert len(paths.glob(spark, f"{folder}/t/list/*")) <= 2
        assert len(paths.glob(spark, f"{folder}/t/data/run=*/p=*")) <= 3  # partition 2, and two states of 1
        # a reader of the list before still finds its files
        assert before.read(schema).count() == 2
    assert sorted(map(tuple, table.read(schema).collect())) == [("a4", "1"), ("b", "2")]


def test_as_of_in_a_history_of_changes(spark, batches):
    history = scd.changed_versions(union(batches))
    days = [dt.date(2023, 12, 30) + dt.timedelta(i) for i in range(14)]
    keys = ["c-same", "c-gone", "c-back", "c-new", "c-none"]
    orders = spark.createDataFrame([(k, d) for k in keys for d in days], "customer_id string, day date")
    got = {(r.customer_id, r.day): r.v_dbt_valid_from for r in
           scd.as_of(orders, history, "customer_id", "day", scd.batch_calendar(union(batches))).collect()}
    stored = history.collect()
    for (k, d), start in got.items():
        want = [v.dbt_valid_from for v in stored if v.customer_id == k and v.dbt_valid_from <= d
                and (v.dbt_valid_to is None or d < v.dbt_valid_to)]
        assert [start] == (want or [None])


def test_latest_change_wins(spark):
    df = spark.createDataFrame([Row(record_id="a", at=i % 7, seq=i) for i in range(50)])
    got = upsert.latest_changes(df, [F.desc("at"), F.desc("seq")]).collect()
    assert [(r.at, r.seq) for r in got] == [(6, 48)]

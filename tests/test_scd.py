import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright import session as sessions
from martwright.operators import scd
from martwright.plans import history as stored

TRACKED = ["city", "country"]
T0 = dt.datetime(2024, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


@pytest.fixture
def history(spark):
    dim = spark.createDataFrame(
        [(1, "Paris", "FR", "2020"), (2, "Rome", "IT", "2021"), (3, None, "DE", "2022")],
        "customer_id int, city string, country string, signup string")
    return scd.scd2_init(dim, T0)


def changes(spark, data):
    return spark.createDataFrame(data, "customer_id int, city string, country string, changed_at timestamp")


def apply(history, batch):
    return scd.scd2_apply(history, batch, "customer_id", TRACKED, "changed_at")


def state(history, key):
    return [(r.version, r.city, r.country, r.effective_from, r.is_current, r.change_type)
            for r in scd.scd_history(history, "customer_id", key).collect()]


def check_invariants(history):
    by_key = {}
    for r in history.collect():
        by_key.setdefault(r.customer_id, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.version)
        assert [r.version for r in versions] == list(range(1, len(versions) + 1))
        assert [r.is_current for r in versions] == [0] * (len(versions) - 1) + [1]
        for a, b in zip(versions, versions[1:]):
            assert a.effective_to == b.effective_from
        assert versions[-1].effective_to.year == 9999


def test_one_change(spark, history):
    after, log = apply(history, changes(spark, [(1, "Lyon", None, day(1))]))
    check_invariants(after)
    assert state(after, 1) == [(1, "Paris", "FR", T0, 0, "INSERT"), (2, "Lyon", "FR", day(1), 1, "UPDATE")]
    assert after.filter("customer_id = 1").select("signup").distinct().count() == 1
    assert rows(log, "record_id", "changed_fields", "old_values", "new_values") == [
        (1, "city", '{"city":"Paris"}', '{"city":"Lyon"}')]


def test_no_effect(spark, history):
    batch = changes(spark, [(1, "Paris", None, day(1)), (9, "Oslo", "NO", day(1)), (2, None, None, day(2)), (None, "x", "y", day(1))])
    after, log = apply(history, batch)
    assert rows(after) == rows(history) and log.count() == 0


def test_changes_of_one_key_chain_in_time_order(spark, history):
    batch = changes(spark, [(1, "Nice", None, day(3)), (1, "Lyon", None, day(1)), (1, "Lyon", "CH", day(2)), (1, "Nice", "CH", day(4))])
    after, log = apply(history, batch)
    check_invariants(after)
    assert [s[1:3] for s in state(after, 1)] == [("Paris", "FR"), ("Lyon", "FR"), ("Lyon", "CH"), ("Nice", "CH")]
    assert log.count() == 3


def test_replay_changes_nothing(spark, history):
    batch = changes(spark, [(1, "Lyon", None, day(1)), (1, "Nice", None, day(2)), (2, None, "CH", day(1))])
    once, _ = apply(history, batch)
    twice, log = apply(once, batch)
    assert rows(once) == rows(twice) and log.count() == 0


def test_null_value_is_filled_by_a_change(spark, history):
    after, log = apply(history, changes(spark, [(3, "Bonn", None, day(1))]))
    assert [s[1] for s in state(after, 3)] == [None, "Bonn"]
    assert log.first().changed_fields == "city"


def test_second_batch_and_as_of(spark, history):
    after, _ = apply(history, changes(spark, [(1, "Lyon", None, day(1))]))
    after, _ = apply(after, changes(spark, [(1, "Nice", None, day(5)), (2, "Bari", None, day(6))]))
    check_invariants(after)
    at = lambda n: {r.customer_id: r.city for r in scd.scd_as_of(after, day(n)).collect()}
    assert at(0)[1] == "Paris" and at(1)[1] == "Lyon" and at(5)[1] == "Nice" and at(5)[2] == "Rome"
    assert scd.scd_current(after).count() == 3


def test_one_key_owns_most_changes(many_buckets, history):
    rng = random.Random(3)
    batch = changes(many_buckets, [
        (1 if rng.random() < 0.8 else 2, rng.choice([None, "a", "b"]), rng.choice([None, "X", "Y"]), day(1 + i)) for i in range(200)])
    after, log = apply(history, batch)
    check_invariants(after)
    expected = {1: ["Paris", "FR"], 2: ["Rome", "IT"]}
    versions = {1: 1, 2: 1}
    for r in sorted(batch.collect(), key=lambda r: r.changed_at):
        new = [r.city or expected[r.customer_id][0], r.country or expected[r.customer_id][1]]
        versions[r.customer_id] += new != expected[r.customer_id]
        expected[r.customer_id] = new
    for key in (1, 2):
        last = state(after, key)[-1]
        assert last[0] == versions[key] and list(last[1:3]) == expected[key]
    assert log.count() == sum(versions.values()) - 2


def test_join_as_of(many_buckets, spark, history):
    after, _ = apply(history, changes(spark, [(1, f"c{i}", None, day(i)) for i in range(1, 20)]))
    facts = spark.createDataFrame([(i, 1 if i % 3 else 2, day(i % 25 - 2)) for i in range(100)] + [(100, None, day(1)), (101, 9, day(1))],
                                  "fact int, customer_id int, at timestamp")
    got = {r.fact: r.version for r in scd.scd_join_as_of(facts, after, "customer_id", "at").collect()}
    window = (F.col("h.effective_from") <= F.col("f.at")) & (F.col("f.at") < F.col("h.effective_to"))
    want = facts.alias("f").join(after.alias("h"), (F.col("f.customer_id") == F.col("h.customer_id")) & window, "left")
    assert got == {r.fact: r.version for r in want.select("fact", "version").collect()}
    assert got[100] is None and got[101] is None


def test_join_as_of_over_many_slices(spark):
    """Keys of 1, 63, 64, 65 and 400 versions; some share a start, one does so across the border of two slices."""
    rng, starts = random.Random(5), []
    for key, n in ((1, 1), (2, 63), (3, 64), (4, 65), (5, 400)):
        at = 0
        for version in range(1, n + 1):
            starts.append((key, day(at), version))
            at += 0 if version in (63, 70, 127) else rng.randrange(1, 4)
    versions = spark.createDataFrame(starts, "customer_id int, effective_from timestamp, version int")
    given = [(i, rng.choice([1, 2, 3, 4, 5, 5, 5, 6, None]), rng.choice([None, *[day(rng.randrange(-3, 900)) for _ in range(9)]])) for i in range(1500)]
    facts = spark.createDataFrame(given, "_key int, customer_id int, at timestamp").withColumn("_slice", F.col("_key"))
    found = scd.scd_join_as_of(facts, versions, "customer_id", "at", "valid")
    assert found.columns == ["_key", "customer_id", "at", "_slice", "valid"]

    def brute(key, at):
        return max((((s, v)) for k, s, v in starts if k == key and at is not None and s <= at), default=(None, None))[1]

    assert {r["_key"]: r.valid for r in found.collect()} == {i: brute(key, at) for i, key, at in given}
    assert scd.scd_join_as_of(facts, versions.limit(0), "customer_id", "at").filter("version IS NULL").count() == 1500
    assert scd.scd_join_as_of(facts.limit(0), versions, "customer_id", "at").count() == 0


def test_join_as_of_shuffles_facts_once(spark):
    facts = spark.range(1000).selectExpr("id", "cast(id % 7 as int) customer_id", "timestamp_seconds(id) at")
    versions = spark.range(70).selectExpr("cast(id % 7 as int) customer_id", "timestamp_seconds(id * 10) effective_from", "cast(id div 7 + 1 as int) version")
    plan = scd.scd_join_as_of(facts, versions.hint("merge"), "customer_id", "at")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_types_one_and_three(spark, history):
    dim = scd.scd_current(history).select("customer_id", "city", "country")
    batch = changes(spark, [(1, "Lyon", None, day(1)), (1, "Nice", None, day(2)), (2, "Rome", "CH", day(1))])
    assert rows(scd.scd1_apply(dim, batch, "customer_id", TRACKED, "changed_at")) == [
        (1, "Nice", "FR"), (2, "Rome", "CH"), (3, None, "DE")]
    three = scd.scd3_apply(dim, batch, "customer_id", TRACKED, "changed_at")
    assert rows(three, "customer_id", "previous_city", "previous_country") == [(1, "Paris", None), (2, None, "IT"), (3, None, None)]
    again = scd.scd3_apply(three, changes(spark, [(2, "Bari", None, day(9))]), "customer_id", TRACKED, "changed_at")
    assert rows(again, "customer_id", "previous_city", "previous_country") == [(1, "Paris", None), (2, "Rome", "IT"), (3, None, None)]


def test_surrogate_keys_are_stable(spark, history):
    keyed = history.withColumn("surrogate_key", scd.surrogate_key("customer_id"))
    after, _ = apply(keyed, changes(spark, [(1, "Lyon", None, day(1))]))
    assert after.select("surrogate_key").distinct().count() == after.count() == 4
    assert keyed.join(after, "surrogate_key", "left_anti").count() == 0


def test_late_changes_are_named_and_replays_are_not(spark, history):
    batch = changes(spark, [(1, "Lyon", None, day(60)), (2, "Oslo", "NO", day(31))])
    after, _ = apply(history, batch)
    late = [(1, "Nice", None, day(31)), (2, "Turin", None, day(31)), (9, "Bern", None, day(1))]
    again = changes(spark, late + [(1, "Lyon", None, day(60)), (2, "Oslo", "NO", day(31)), (3, "Kiel", None, day(90))])
    found = scd.scd2_late(after, again, "customer_id", TRACKED, "changed_at")
    assert rows(found) == sorted(late[:2], key=repr)


def test_a_replay_of_a_change_without_effect_is_not_late(spark, history):
    batch = changes(spark, [(1, "Paris", None, day(31)), (1, "Lyon", None, day(60))])
    after, _ = apply(history, batch)
    assert scd.scd2_late(after, batch, "customer_id", TRACKED, "changed_at").count() == 0


SCHEMA = "id int, city string, zip string"
GIVEN = [  # some give one column, some repeat a value, some share a time, one is before the first version
    (1, "b", None, dt.datetime(2024, 3, 1)), (1, "a", None, dt.datetime(2024, 4, 1)), (1, None, "9", dt.datetime(2024, 4, 1)),
    (1, "a", "1", dt.datetime(2024, 2, 1)), (1, "z", None, dt.datetime(2023, 1, 1)), (2, "x", None, dt.datetime(2024, 2, 1)), (7, "q", None, dt.datetime(2024, 2, 1))]


def by_hand(given):
    """Versions and log of id 1 and 2, by going through the changes in order."""
    versions, log = [], []
    for key, city, code in ((1, "a", "1"), (2, "b", "2")):
        now, since, n = {"city": city, "zip": code}, dt.datetime(2024, 1, 1), 1
        for g in sorted({g for g in given if g[0] == key and g[3] > since}, key=lambda g: (g[3], [(x is not None, x or "") for x in g[1:3]])):
            new = {c: v if v is not None else now[c] for c, v in zip(("city", "zip"), g[1:3])}
            if new != now:
                versions.append((key, *now.values(), since, g[3], 0, n))
                log.append((str(key), g[3], ",".join(c for c in new if new[c] != now[c])))
                now, since, n = new, g[3], n + 1
        versions.append((key, *now.values(), since, dt.datetime(9999, 12, 31), 1, n))
    return sorted(versions), sorted(log)


def stored_after(spark, root, batches):
    first = spark.createDataFrame([(1, "a", "1"), (2, "b", "2")], SCHEMA)
    stored.start(spark, root, "dim_x", first, dt.datetime(2024, 1, 1))
    schema = scd.scd2_init(first, dt.datetime(2024, 1, 1)).schema
    wrote = [stored.apply(spark, root, "dim_x", spark.createDataFrame(b, SCHEMA + ", at timestamp"), "id", ["city", "zip"], "at", ddl=schema) for b in batches]
    found = stored.open_history(spark, root, "dim_x", schema)
    versions = sorted(tuple(r) for r in found.select("id", "city", "zip", "effective_from", "effective_to", "is_current", "version").collect())
    log = sorted((r.record_id, r.changed_at, r.changed_fields) for r in stored.change_log(spark, root, "dim_x").collect())
    return versions, log, wrote, schema


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_changes_gives_one_history(spark, tmp_path, seed):
    import random

    given = random.Random(seed).sample(GIVEN, len(GIVEN))
    batches = [given[:4 - seed], given[4 - seed:], given[:3]]  # the last is a replay
    versions, log, wrote, schema = stored_after(spark, str(tmp_path), batches)
    assert (versions, log) == by_hand(GIVEN) and wrote[-1] == 0
    late = stored.late_changes(spark, str(tmp_path), "dim_x", "id", "at", SCHEMA + ", at timestamp", schema).collect()
    assert [tuple(r) for r in late] == [(1, "z", None, dt.datetime(2023, 1, 1))] or sorted(r.city for r in late) == ["z"]


def test_a_batch_of_one_key_writes_one_bucket(spark, tmp_path):
    root = str(tmp_path)
    first = spark.range(500).selectExpr("cast(id as int) id", "'a' city", "'1' zip")
    stored.start(spark, root, "dim_x", first, dt.datetime(2024, 1, 1))
    schema = scd.scd2_init(first, dt.datetime(2024, 1, 1)).schema
    before = set(tmp_path.rglob("*.parquet"))
    one = spark.createDataFrame([(7, "b", dt.datetime(2024, 2, 1))], "id int, city string, at timestamp")  # without the other tracked column
    assert stored.apply(spark, root, "dim_x", one, "id", ["city", "zip"], "at", ddl=schema) == 1
    new = set(tmp_path.rglob("*.parquet")) - before
    buckets = {p.parent.name for p in new if p.parent.name.startswith("bucket=")}
    assert len(buckets) == 1
    found = stored.open_history(spark, root, "dim_x", schema)
    assert found.count() == 501 and rows(found.filter("id = 7"), "city", "zip", "version") == [("a", "1", 1), ("b", "1", 2)]
    assert stored.open_history(spark, root, "dim_customers").count() == 0


def test_tasks_of_a_batch_follow_its_rows(spark, tmp_path, monkeypatch):
    """3,000 changes and 60 versions are dealt to 7 tasks, whatever few bytes they shrink to."""
    monkeypatch.setattr(sessions, "ROWS_A_TASK", 500)
    monkeypatch.setattr(stored, "ROWS_A_TASK", 500)
    shuffles, splice = [], scd.scd2_splice
    monkeypatch.setattr(scd, "scd2_splice", lambda *a, **b: shuffles.append(spark.range(3000).groupBy(F.col("id") * 7).count().rdd.getNumPartitions()) or splice(*a, **b))
    first = spark.range(60).selectExpr("cast(id as int) id", "'a' city", "'1' zip")
    stored.start(spark, str(tmp_path), "dim_x", first, T0)
    batch = spark.range(3000).selectExpr("cast(id % 60 as int) id", "cast(id as string) city", "timestamp '2024-02-01 00:00:00' + make_dt_interval(id) at")
    schema = scd.scd2_init(first, T0).schema
    assert stored.apply(spark, str(tmp_path), "dim_x", batch, "id", ["city", "zip"], "at", ddl=schema) == 3000
    found = stored.open_history(spark, str(tmp_path), "dim_x", schema)
    assert found.count() == 3060 and found.filter("is_current = 1").count() == 60
    assert shuffles == [7]

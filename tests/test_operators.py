"""Operators against brute force on small seeded data, and the properties they promise."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators import cdc, fact, joins, merge, scd
from starloom.operators.segments import with_neighbour

START = datetime(2024, 1, 1)
LOG = "k string, a string, b int, cdc_operation string, ingested_at timestamp_ntz, seq bigint"


def random_log(seed, rows=400, keys=6, hot=0.4, days=12):
    """A log where one key has a large share; times per key are distinct."""
    rng = random.Random(seed)
    out, used = [], set()
    for seq in range(rows):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        ts = START + timedelta(minutes=rng.randrange(days * 1440))
        if (key, ts) in used:
            continue
        used.add((key, ts))
        out.append((key, rng.choice(["x", "y", None]), rng.choice([1, 2]), rng.choice("IUD"), ts, seq))
    return out


def by_key(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    return {k: sorted(v, key=lambda r: (r[4], r[5])) for k, v in groups.items()}


def brute_versions(rows):
    out = set()
    for key, events in by_key(rows).items():
        kept = [e for i, e in enumerate(events) if i == 0 or e[1:3] != events[i - 1][1:3]]
        for e, nxt in zip(kept, kept[1:] + [None]):
            out.add((key, e[1], e[2], e[4], nxt[4] if nxt else None))
    return out


@pytest.mark.parametrize("seed,segment", [(1, 86400), (2, 900), (3, 5 * 86400), (4, 3600)])
def test_history_equals_brute_force(spark, seed, segment):
    rows = random_log(seed)
    history = scd.scd2_history(spark.createDataFrame(rows, LOG), "k", ["a", "b"], ["a", "b"], segment_seconds=segment)
    got = [tuple(r) for r in history.select("k", "a", "b", "valid_from", "valid_to").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_versions(rows)


def test_history_backdates_only_the_first_version(spark):
    rows = random_log(5)
    history = scd.scd2_history(spark.createDataFrame(rows, LOG), "k", ["a", "b"], ["a", "b"], backdate_first=True)
    starts = defaultdict(list)
    for r in history.collect():
        starts[r.k].append(r.valid_from)
    for times in starts.values():
        assert sorted(times)[0] == datetime(1900, 1, 1)
        assert all(t > START - timedelta(days=1) for t in sorted(times)[1:])


def test_history_equals_folding_snapshots(spark):
    rows = random_log(6, rows=60, keys=3, days=4)
    log = spark.createDataFrame(rows, LOG)
    folded = None
    for moment in sorted({r[4] for r in rows}):
        state = cdc.latest_event(log.filter(F.col("ingested_at") <= F.lit(moment).cast("timestamp_ntz")), ["k"])
        seen = [] if folded is None else [tuple(r) for r in folded.collect()]
        history = None if folded is None else spark.createDataFrame(seen, folded.schema)
        folded = scd.snapshot_check(history, state.select("k", "a", "b"), "k", ["a", "b"], moment)
    got = {tuple(r) for r in folded.select("k", "a", "b", "valid_from", "valid_to").collect()}
    assert got == brute_versions(rows)


def test_snapshot_hard_delete_and_return(spark):
    schema = "k string, a string"
    t = [START + timedelta(days=i) for i in range(4)]
    states = [[("1", "x"), ("2", "x")], [("1", "x")], [("1", "x"), ("2", "x")], [("1", "x"), ("2", "z")]]
    history = None
    for moment, rows in zip(t, states):
        history = scd.snapshot_check(history, spark.createDataFrame(rows, schema), "k", ["a"], moment, backdate_first=True)
    old = datetime(1900, 1, 1)
    assert {tuple(r) for r in history.collect()} == {
        ("1", "x", old, None), ("2", "x", old, t[1]), ("2", "x", t[2], t[3]), ("2", "z", t[3], None)}


def test_snapshot_without_hard_deletes_keeps_missing_keys(spark):
    first = scd.snapshot_check(None, spark.createDataFrame([("1", "x")], "k string, a string"), "k", ["a"], START)
    later = scd.snapshot_check(first, spark.createDataFrame([("2", "y")], "k string, a string"), "k", ["a"],
                               START + timedelta(days=1), hard_deletes=False)
    assert {(r.k, r.valid_to) for r in later.collect()} == {("1", None), ("2", None)}


@pytest.mark.parametrize("forward", [False, True])
def test_neighbours_equal_brute_force(spark, forward):
    rows = random_log(7)
    df = with_neighbour(spark.createDataFrame(rows, LOG), ["k"], ["ingested_at", "seq"], "ingested_at", F.col("seq"), "n",
                        forward=forward, seconds=7200)
    want = {}
    for events in by_key(rows).values():
        ids = [e[5] for e in events]
        other = ids[1:] + [None] if forward else [None] + ids[:-1]
        want.update(zip(ids, other))
    assert {r.seq: r.n for r in df.collect()} == want


@pytest.mark.parametrize("seed", [8, 9])
def test_overlaps_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        start = START + timedelta(hours=rng.randrange(24 * 20))
        rows.append((rng.choice("aab"), start, start + timedelta(hours=rng.randrange(1, 30)), i))
    df = joins.overlaps(spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, i int"), ["k"], "s", "e")
    want = {a[3] for a in rows for b in rows if a[0] == b[0] and a[1] != b[1] and a[1] < b[2] and b[1] < a[2]}
    got = [r.i for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_latest_event_does_not_depend_on_input_order(spark):
    rows = random_log(10) + [("tie", "x", 1, "U", START, 1), ("tie", "y", 1, "U", START, 1)]
    one = cdc.latest_event(spark.createDataFrame(rows, LOG), ["k"]).collect()
    random.Random(0).shuffle(rows)
    two = cdc.latest_event(spark.createDataFrame(rows, LOG).repartition(7), ["k"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_net_changes_equal_brute_force(spark):
    rows = random_log(11)
    log = spark.createDataFrame(rows, LOG).withColumn("day", F.to_date("ingested_at"))
    got = {(r.k, r.day): (r.cdc_operation, r.seq) for r in cdc.net_changes(log, ["k"], ["day"]).collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[(r[0], r[4].date())].append(r)
    want = {}
    for g, events in groups.items():
        events.sort(key=lambda r: (r[4], r[5]))
        first, last = events[0][3], events[-1][3]
        if not (first == "I" and last == "D"):
            want[g] = ("I" if first == "I" else "D" if last == "D" else "U", events[-1][5])
    assert got == want


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B", 5), (3, "C", 6)], "k int, v string, extra int")
    once = merge.upsert(target, batch, ["k"])
    twice = merge.upsert(once, batch, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {tuple(r) for r in once.collect()} == {(1, "a", None), (2, "B", 5), (3, "C", 6)}


def test_normalised_duplicates_stay_when_referenced(spark):
    rows = [("c1", " Ann "), ("c2", "ANN"), ("c3", "ann"), ("c4", "Bob"), ("c5", None), ("c6", None)]
    customers = spark.createDataFrame(rows, "id string, name string")
    refs = spark.createDataFrame([("c3",), ("c3",)], "customer string")
    kept = cdc.dedup_normalised(customers, "id", ["name"], [refs])
    assert {r.id for r in kept.collect()} == {"c1", "c3", "c4", "c5", "c6"}
    assert {r.id for r in cdc.dedup_normalised(customers, "id", ["name"]).collect()} == {"c1", "c4", "c5", "c6"}


def test_scd2_lookup_takes_the_version_in_force_once(spark):
    dim = spark.createDataFrame([("p", 1, START, START + timedelta(days=1)), ("p", 2, START + timedelta(days=1),
                                datetime(9999, 12, 31))],
                                "id string, key int, valido_desde timestamp_ntz, valido_hasta timestamp_ntz")
    moments = [START - timedelta(days=1), START, START + timedelta(days=1), START + timedelta(days=9)]
    rows = spark.createDataFrame([("p", m) for m in moments] + [(None, START)], "id string, t timestamp_ntz")
    got = joins.scd2_lookup(rows, dim, "id", "t", {"key": "key"})
    assert {(r.id, r.t): r.key for r in got.collect()} == dict(zip(
        [("p", m) for m in moments] + [(None, START)], [None, 1, 2, 2, None]))


@pytest.mark.parametrize("split", ["month", "day", "year"])
def test_split_lookup_equals_plain_lookup(spark, split):
    rng = random.Random(12)
    dims, rows = [], []
    for key in ("hot", "calm", "gap"):
        steps = sorted({rng.randrange(200 * 24) for _ in range(600 if key == "hot" else 3)})
        ends = [START + timedelta(hours=h) for h in steps[1:]] + [datetime(9999, 12, 31)]
        dims += [(key, i, START + timedelta(hours=h), e) for i, (h, e) in enumerate(zip(steps, ends))
                 if not (key == "gap" and i == 1)]
        rows += [(key, START + timedelta(minutes=rng.randrange(-999, 210 * 1440))) for _ in range(150)]
    rows += [(None, START), ("none", START), ("hot", None)]
    dim = spark.createDataFrame(dims, "id string, key int, valido_desde timestamp_ntz, valido_hasta timestamp_ntz")
    facts = spark.createDataFrame(rows, "id string, t timestamp_ntz")
    plain = joins.scd2_lookup(facts, dim, "id", "t", {"key": "version"})
    parts = joins.scd2_lookup(facts, dim, "id", "t", {"key": "version"}, split=split)
    assert plain.columns == parts.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, parts.collect()))


def test_fact_drops_lines_that_no_longer_qualify(spark):
    target = spark.createDataFrame([("l1", 1), ("l2", 2), ("l3", 3)], "venta_detalle_id string, x int")
    changed = spark.createDataFrame([("l1",), ("l2",), ("l4",)], "venta_detalle_id string")
    rows = spark.createDataFrame([("l1", 10), ("l4", 40)], "venta_detalle_id string, x int")
    got = {tuple(r) for r in fact.fact_incremental(target, changed, rows).collect()}
    assert got == {("l1", 10), ("l3", 3), ("l4", 40)}


def test_reconcile_flags_missing_and_differing_sides(spark):
    a = spark.createDataFrame([(1, 2, 10.0), (2, 1, 5.0), (3, 1, 1.0)], "d int, n int, v double").withColumn(
        "v", F.col("v").cast("decimal(19,4)"))
    b = spark.createDataFrame([(1, 2, 10.0), (2, 1, 5.02), (4, 1, 1.0)], "d int, m int, w double").withColumn(
        "w", F.col("w").cast("decimal(19,4)"))
    got = {r.d: r.is_match for r in joins.reconcile(a, b, ["d"], ("n", "m"), ("v", "w")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_events_as_of_a_moment_and_now_are_those_of_two_logs_from_one_shuffle(spark):
    moment = datetime(2024, 5, 1)
    days = [None, datetime(2024, 4, 1), moment, datetime(2024, 5, 2)]
    rows = [(k, d, s, v) for i, k in enumerate(["a", "b", "c", "d", None]) for d in days[i % 3:] for s in (1, None) for v in ("x", "y", None)][:-7]
    log = spark.createDataFrame([*rows, ("late", datetime(2025, 1, 1), 5, "z"), ("null", None, 1, "z")], "k string, ingested_at timestamp_ntz, seq int, v string")
    then, now = cdc.latest_as_of(log, ["k"], moment)
    early = log.filter(F.col("ingested_at") <= F.lit(moment).cast("timestamp_ntz"))
    assert Counter(map(tuple, then.collect())) == Counter(map(tuple, cdc.latest_event(early, ["k"]).select(*log.columns).collect()))
    assert Counter(map(tuple, now.collect())) == Counter(map(tuple, cdc.latest_event(log, ["k"]).select(*log.columns).collect()))
    kept = now.join(spark.createDataFrame([("a",), ("late",)], "k string"), "k", "left_semi").select("k", "v")
    both = then.select("k", "v").unionByName(kept)  # one side asks for keys that are not NULL
    assert sorted(r["k"] or "" for r in both.collect()) == ["", "a", "a", "b", "c", "d", "late"]
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


def test_lines_of_named_orders_count_as_changed(spark):
    at = datetime(2024, 1, 1)
    lines = spark.createDataFrame([("l1", "o1", at), ("l2", "o2", at), ("l3", None, at)], "venta_detalle_id string, venta_id string, ingested_at timestamp_ntz")
    headers = spark.createDataFrame([("o1", at), ("o2", at)], "venta_id string, ingested_at timestamp_ntz")
    orders = spark.createDataFrame([("o2",), ("o2",), (None,)], "sales_order_id string")
    assert [r[0] for r in fact.changed_lines(lines, headers, datetime(2024, 2, 1), orders).collect()] == ["l2"]
    assert fact.changed_lines(lines, headers, datetime(2024, 2, 1)).count() == 0

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.operators import aggregates, hierarchy, joins, ordinals, sampling, sizing, validity, windows

DAY0 = date(2024, 1, 1)


def on(n):
    return DAY0 + timedelta(days=n)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- windows -------------------------------------------------------------------


def test_missing_days_are_missing(spark):
    df = frame(spark, [("a", on(0), 1), ("a", on(1), 2), ("a", on(9), 4), (None, on(1), 8)], "k STRING, d DATE, v BIGINT")
    got = {
        (r.k, r.d): (r.before, r.t, r.with_today)
        for r in df.select(
            "k", "d",
            windows.value_days_ago("v", ["k"], "d", 1).alias("before"),
            windows.trailing("v", ["k"], "d", 7).alias("t"),
            windows.trailing("v", ["k"], "d", 7, include_today=True).alias("with_today"),
        ).collect()
    }
    assert got[("a", on(0))] == (None, None, 1)
    assert got[("a", on(1))] == (1, 1, 3)
    assert got[("a", on(9))] == (None, None, 4)  # day 1 is 8 days back
    assert got[(None, on(1))] == (None, None, 8)


def test_year_to_date_restarts(spark):
    df = frame(spark, [(date(2023, 12, 31), 5), (date(2024, 1, 1), 7), (date(2024, 12, 31), 1)], "d DATE, v BIGINT")
    got = {r.d: (r.ytd, r.total) for r in df.select(
        "d", windows.period_to_date("v", [], "d").alias("ytd"), windows.running_total("v", [], "d").alias("total")
    ).collect()}
    assert got == {date(2023, 12, 31): (5, 5), date(2024, 1, 1): (7, 12), date(2024, 12, 31): (8, 13)}


@pytest.mark.parametrize(("length", "include_today"), [(1, False), (7, False), (7, True), (30, True)])
def test_trailing_distinct_matches_brute_force(spark, length, include_today):
    rng = random.Random(length)
    facts = [
        (rng.choice(["a", "b", None]), on(rng.randrange(60)), rng.choice([None, 1, 1, 1, 2, 3, 4, 5])) for _ in range(300)
    ]
    days = sorted({(k, d) for k, d, _ in facts if rng.random() < 0.8}, key=str)
    got = windows.with_trailing_distinct(
        frame(spark, [(k, d, 1) for k, d in days], "k STRING, d DATE, v INT"),
        frame(spark, facts, "k STRING, d DATE, m BIGINT"), ["k"], "d", "m", length, "n", include_today,
    )
    first, last = (length - 1, 0) if include_today else (length, 1)
    want = {
        (k, d): len({m for fk, fd, m in facts if fk == k and m is not None
                     and d - timedelta(days=first) <= fd <= d - timedelta(days=last)})
        for k, d in days
    }
    assert {(r.k, r.d): r.n for r in got.collect()} == want


def test_spine_and_last_day(spark):
    df = frame(spark, [("a", on(0), 1), ("a", on(3), 2), ("b", on(2), 5)], "k STRING, d DATE, v BIGINT")
    full = joins.on_spine(windows.spine_days(df, "d", ["k"]), df, "d", ["k"]).collect()
    assert sorted((r.k, (r.d - DAY0).days, r.v) for r in full if r.k == "a") == [
        ("a", 0, 1), ("a", 1, None), ("a", 2, None), ("a", 3, 2),
    ]
    assert sorted((r.d - DAY0).days for r in full if r.k == "b") == [0, 1, 2, 3]
    assert sorted(map(str, windows.fill_days(df, "d", ["k"]).select("k", "d", "v").collect())) == sorted(map(str, full))
    last = {r.k: r.v for r in windows.last_in_group(df, ["k"], "d", ["v"]).collect()}
    assert last == {"a": 2, "b": 5}


def test_filled_days_carry_earlier_values(spark):
    rows = [("a", on(0), 1, None), ("a", on(2), None, 7), ("a", on(9), 2, 3), (None, on(1), 8, 1), ("b", on(12), 5, 5), ("c", None, 6, 6)]
    df = frame(spark, rows, "k STRING, d DATE, v BIGINT, w BIGINT").withColumn("w", F.col("w").cast("decimal(12,4)"))
    for keys in (["k"], []):
        some = df if keys else df.where("k = 'a'").drop("k")
        filled = windows.fill_days(some, "d", keys)
        want = filled.select("*", windows.value_days_ago("v", keys, "d", 2).alias("v2"), windows.value_days_ago("w", keys, "d", 7).alias("w7"))
        got = windows.fill_days(some, "d", keys, {"v2": ("v", 2), "w7": ("w", 7)})
        assert got.dtypes == want.dtypes
        # windows sort the rows, never the days that fill the gaps
        assert got._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        windows.fill_days(df, "d", ["k"], {"v": ("v", windows.CARRIED_DAYS + 1)})


# --- joins ---------------------------------------------------------------------


def test_tasks_of_a_large_join_follow_the_bytes(spark, tmp_path, monkeypatch, no_broadcast):
    lines = [(i % 50 if i % 7 else None, i) for i in range(300)]
    frame(spark, lines, "l BIGINT, v BIGINT").write.parquet(f"{tmp_path}/lines")
    frame(spark, [(i, -i) for i in range(40)] + [(3, 9), (None, 1)], "o BIGINT, w BIGINT").write.parquet(f"{tmp_path}/orders")
    left, right = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("lines", "orders"))
    plain = joins.large_inner(left, right, "l", "o")
    assert "repartition" not in str(plain._jdf.queryExecution().logical()).lower()
    monkeypatch.setattr(joins, "TASK_BYTES", 100)
    dealt = joins.large_inner(left, right, "l", "o")
    tasks = -(-(joins.input_bytes(left) + joins.input_bytes(right)) // 100)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert tasks > 4 and plan.count(f", {tasks})") == 2, plan
    assert plan.count("Exchange") == 2  # the join needs no other
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))


def test_lookup_of_hot_and_missing_keys(spark, no_broadcast):
    rows = [(i, None if i % 3 == 0 else 0 if i % 3 == 1 else i % 7) for i in range(400)]
    fact = frame(spark, rows, "id BIGINT, k BIGINT")
    dim = frame(spark, [(k, f"n{k}") for k in range(5)], "k BIGINT, name STRING")
    for hot in ((), (0,)):
        got = joins.many_to_one(fact, dim, "k", hot_keys=hot)
        assert got.columns == ["id", "k", "name"]
        assert {r.id: r.name for r in got.collect()} == {i: f"n{k}" if k is not None and k < 5 else None for i, k in rows}
        assert got.count() == 400
    inner = joins.many_to_one(fact, dim, "k", how="inner", hot_keys=(0,))
    assert inner.count() == sum(1 for _, k in rows if k is not None and k < 5)


def test_hot_keys_are_spread(spark, no_broadcast):
    fact = spark.range(2000).select(F.col("id"), F.lit(0).cast("bigint").alias("k"))
    dim = frame(spark, [(0, "guest")], "k BIGINT, name STRING")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        used = joins.many_to_one(fact, dim, "k", hot_keys=(0,)).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert used == 4


def test_a_table_that_shrinks_in_its_files_is_not_broadcast(spark, tmp_path):
    """Few bytes of files may be very many rows, and leaving columns out makes no row less."""
    texts = {f"t{i}": F.lit("the same words in every row") for i in range(4)}
    spark.range(1_000_000).withColumns(texts).coalesce(1).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    assert sizing.input_bytes(dim) < 16 * 1024 * 1024
    assert not sizing.is_small(dim) and not sizing.is_small(dim.select("id", "t0"))
    assert sizing.memory_bytes(dim) >= 1_000_000 * 48
    assert sizing.is_small(dim.limit(100)) and sizing.is_small(spark.range(1000))


def test_a_large_lookup_is_not_broadcast_by_the_optimizer(spark, monkeypatch):
    fact = spark.range(300).select("id", (F.col("id") % 7).alias("k"))
    dim = spark.range(5).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    assert "BroadcastHashJoin" in joins.many_to_one(fact, dim, "k")._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "is_small", lambda df, limit=0: False)
    for guarded in (True, False):
        found = joins.many_to_one(fact, dim, "k", guarded=guarded)
        assert {r.id: r.name for r in found.collect()} == {i: f"n{i % 7}" if i % 7 < 5 else None for i in range(300)}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan


def test_promotion_validity_is_inclusive(spark):
    sales = frame(spark, [(1, on(5), 9), (2, on(6), 9), (3, on(7), 9), (4, on(5), None)], "id INT, transaction_date DATE, promotion_sk INT")
    promos = frame(spark, [(9, on(4), on(6))], "promotion_sk INT, start_date DATE, end_date DATE")
    got = {r.id: r.promotion_sk for r in joins.valid_promotion(sales, promos).collect()}
    assert got == {1: 9, 2: 9, 3: None, 4: None}


def test_results_meet_on_null_keys(spark):
    a = frame(spark, [("x", 1), (None, 2)], "k STRING, a INT")
    b = frame(spark, [("y", 5), (None, 6)], "k STRING, b INT")
    got = {(r.k, r.a, r.b) for r in joins.merge_results([a, b], ["k"]).collect()}
    assert got == {("x", 1, None), (None, 2, 6), ("y", None, 5)}
    totals = joins.merge_results([a.agg(F.sum("a").alias("a")), b.agg(F.sum("b").alias("b"))], []).collect()
    assert [(r.a, r.b) for r in totals] == [(3, 11)]


def test_orphans_flags_and_offsets(spark):
    fact = frame(spark, [(1,), (1,), (2,), (None,)], "k BIGINT")
    dim = frame(spark, [(1,), (3,)], "k BIGINT")
    assert [r.orphan_key for r in joins.orphans(fact, "k", dim, "k").collect()] == [2]
    flags = joins.flag_matches(fact, dim.union(dim), "k", "k", "f").collect()
    assert sorted(((r.k or 0), r.f) for r in flags) == [(0, "N"), (1, "Y"), (1, "Y"), (2, "N")]
    daily = frame(spark, [(on(0), 3), (on(2), 4)], "d DATE, v INT")
    shifted = {r.d: r.old for r in joins.offset_by_days(daily, "d", "v", 2, "old").collect()}
    assert shifted == {on(0): None, on(2): 3}


def test_left_composite_fills_zero(spark):
    a = frame(spark, [(1, 1, 10), (1, 2, 20)], "p INT, d INT, v INT")
    b = frame(spark, [(1, 2, 5), (1, 3, 9)], "p INT, d INT, r INT")
    assert sorted((r.d, r.r) for r in joins.left_composite(a, b, ["p", "d"], ["r"]).collect()) == [(1, 0), (2, 5)]


# --- ordinals and aggregates ---------------------------------------------------


def test_ordinals_match_a_plain_row_number(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 500 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 15), 16, 10).cast("bigint").alias("k"),
    )
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("bigint"))
    assert sorted(map(str, ordinals.ordinal_within(df, ["g"], "k", "n").collect())) == sorted(map(str, plain.collect()))


def test_key_pages_are_bounded_and_whole(spark):
    df = spark.range(25).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"))
    pages = aggregates.key_pages(df, "g", "k", page_size=4).collect()
    assert max(len(r["keys"]) for r in pages) == 4
    members = defaultdict(list)
    for r in sorted(pages, key=lambda r: r.page):
        members[r.g] += r["keys"]
    assert members == {0: list(range(0, 25, 2)), 1: list(range(1, 25, 2))}


def test_subtotals_add_up(spark):
    df = frame(spark, [("a", "x", 1), ("a", "y", 2), ("b", "x", 4), (None, "x", 8)], "p STRING, q STRING, v INT")
    rows = aggregates.grouping_set_totals(df, [("p",), ("p", "q"), ()], ["v"], flags={"p": "p_total", "q": "q_total"}).collect()
    grand = [r.v for r in rows if r.p_total == 1]
    assert grand == [15]
    assert sum(r.v for r in rows if r.p_total == 0 and r.q_total == 1) == 15
    assert [r.v for r in rows if r.p is None and r.p_total == 0 and r.q_total == 1] == [8]
    rolled = aggregates.rollup_totals(df, ["p", "q"], ["v"]).collect()
    assert len(rolled) == 4 + 3 + 1


def test_latest_rows(spark):
    df = frame(spark, [(on(0), 1), (on(2), 2), (on(2), 3)], "d DATE, v INT")
    assert sorted(r.v for r in aggregates.latest_rows(df, "d").collect()) == [2, 3]


def test_samples_repeat(spark):
    df = spark.range(1000)
    assert sampling.sample_percent(df, F.col("id"), 8).count() == 80
    assert sampling.sample_rows(df, "id", 50).collect() == sampling.sample_rows(df.repartition(7), "id", 50).collect()


# --- hierarchies, validities, keys ------------------------------------------------


def test_hierarchy_of_any_depth(spark):
    chain = [(i, i + 1 if i < 9 else None, f"n{i}") for i in range(10)]
    nodes = [*chain, (20, 3, "side"), (21, 99, "lost parent"), (22, None, "alone"), (23, 20, "leaf")]
    df = frame(spark, nodes, "k INT, p INT, name STRING")
    parents, names = {k: p for k, p, _ in nodes}, {k: n for k, _, n in nodes}

    def up(k):
        out = []
        while (k := parents[k]) in names:
            out.append(names[k])
        return out

    got = {r.k: list(r.ancestor_names) for r in hierarchy.with_ancestors(df, key="k", parent="p", name="name").collect()}
    assert got == {k: up(k) for k in names}
    fixed = {r.k: (r.parent_1_name, r.parent_5_name) for r in hierarchy.with_ancestors(df, 5, "k", "p", "name").collect()}
    assert fixed == {k: ((up(k) + [None] * 5)[0], (up(k) + [None] * 5)[4]) for k in names}


def test_circles_and_repeated_nodes_raise(spark):
    for circle in ([(1, 2, "a"), (2, 3, "b"), (3, 1, "c")], [(1, 1, "self")], [(0, 1, "in"), (1, 2, "a"), (2, 1, "b")]):
        with pytest.raises(ValueError, match="circle"):
            hierarchy.with_ancestors(frame(spark, circle, "k INT, p INT, name STRING"), key="k", parent="p", name="name")
    with pytest.raises(Exception, match="repeated key"):
        hierarchy.with_ancestors(frame(spark, [(1, None, "a"), (1, None, "b"), (2, 1, "c")], "k INT, p INT, name STRING"), key="k", parent="p", name="name")


def test_repeated_dimension_keys_raise(spark):
    fact = frame(spark, [(1, 1), (2, 2)], "id BIGINT, k BIGINT")
    dim = frame(spark, [(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k BIGINT, name STRING")
    with pytest.raises(Exception, match="repeated key k: 1"):
        joins.many_to_one(fact, dim, "k").collect()
    assert joins.many_to_one(fact, dim, "k").count() == 2
    assert sorted(map(tuple, joins.many_to_one(fact, dim.where("name != 'b'"), "k").collect())) == [(1, 1, "a"), (2, 2, None)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_overlapping_validities(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(4)
    offers = [(rng.randint(1, 4), on(b := rng.randint(0, 400)), on(b + rng.choice([0, 3, 40, 5000])), f"o{i}") for i in range(60)]
    offers += [(1, on(9), on(2), "upside down"), (None, on(0), on(99), "no key"), (2, on(-900), date(9999, 12, 31), "always")]
    sales = [(i, rng.choice([1, 1, 1, 2, 3, 4, 5, None]), None if i % 40 == 0 else on(rng.randint(-30, 460))) for i in range(400)]
    facts = frame(spark, sales, "id INT, k INT, d DATE").repartition(5)
    known = frame(spark, offers, "k INT, a DATE, b DATE, name STRING")

    def valid(k, d):
        return [(a, b, n) for ok, a, b, n in offers if ok is not None and ok == k and d is not None and a <= d <= b]

    every = sorted((r.id, r.name) for r in validity.every_valid(facts, known, "k", "d", "a", "b", ["name"]).collect())
    assert every == sorted((i, n) for i, k, d in sales for _, _, n in valid(k, d))
    best = {r.id: (r._covered, r.name) for r in validity.best_valid(facts, known, "k", "d", "a", "b", ["name"]).collect()}
    want = {}
    for i, k, d in sales:
        held = sorted(valid(k, d), key=lambda o: (-o[0].toordinal(), o[1], o[2]))
        want[i] = (bool(held), held[0][2] if held else None)
    assert best == want


def test_flags_by_natural_keys_when_surrogates_collide(spark):
    left = frame(spark, [(7, "A", 1), (7, "A", 2), (7, "B", 1), (8, None, 1)], "sk BIGINT, order_id STRING, line INT")
    right = frame(spark, [(7, "A", 2), (7, None, 1)], "sk BIGINT, o STRING, n INT")
    got = {(r.order_id, r.line): r.f for r in joins.flag_matches(left, right, ["order_id", "line"], ["o", "n"], "f").collect()}
    assert got == {("A", 1): "N", ("A", 2): "Y", ("B", 1): "N", (None, 1): "N"}


def test_pairs_in_order(spark):
    rng = random.Random(6)
    left = [(rng.choice(["x", "x", "y", None]), k, rng.choice([True, True, False, None]), f"row{k}") for k in rng.sample(range(2**58), 120)]
    right = [(rng.choice(["x", "y", "z", None]), k) for k in rng.sample(range(2**58), 60)]
    got = joins.pair_in_order(frame(spark, left, "g STRING, k BIGINT, active BOOLEAN, note STRING"), frame(spark, right, "g STRING, t BIGINT"), "g", "k", "t", "active")
    want = {k: None for _, k, _, _ in left}
    for g in ("x", "y"):
        ours = sorted(k for h, k, a, _ in left if h == g and a)
        theirs = sorted(t for h, t in right if h == g)
        want |= dict(zip(ours, theirs))
    rows = got.collect()
    assert got.columns == ["g", "k", "active", "note", "t"] and len(rows) == len(left)
    assert {r.k: r.t for r in rows} == want and all(r.note == f"row{r.k}" for r in rows)

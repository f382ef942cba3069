"""Predicate trees: their forms against three-valued logic, and where their parts end up in a plan."""

import random
from dataclasses import replace
from decimal import Decimal

import pytest

from shelfline.metrics.layers import NET, SEMANTIC_LAYER, TRANSACTIONS
from shelfline.metrics.model import All, Any, Condition, Dimension, Not, Simple, Sources
from shelfline.metrics.predicates import Clause, can_hold_without, conjuncts, implied, resolved
from shelfline.metrics.query import metric_query

DIMS = {n: Dimension(n, n, column=n, entity=e) for n, e in (("f", None), ("g", None), ("s", "store"), ("c", "customer"))}


def some_tree(rng, depth):
    kind = rng.choice(["test"] if depth == 0 else ["test", "and", "or", "not"])
    if kind == "test":
        op = rng.choice(["=", "!=", "<", ">=", "in", "not in", "between", "is null", "is not null"])
        value = {"in": [1, 2], "not in": [0, 3], "between": (1, 2)}.get(op, 2)
        return Condition(rng.choice("fgsc"), op, value)
    parts = [some_tree(rng, depth - 1) for _ in range(rng.randint(1, 3))]
    return Not(parts[0]) if kind == "not" else (All if kind == "and" else Any)(tuple(parts))


def truth(p, row):
    """True, False or None."""
    if isinstance(p, Not):
        t = truth(p.part, row)
        return None if t is None else not t
    if isinstance(p, (All, Any)):
        seen = {truth(part, row) for part in p.parts}
        strong = isinstance(p, Any)
        return strong if strong in seen else None if None in seen else not strong
    name = p.dimension.name if isinstance(p, Clause) else p.dimension
    x, v = row[name], p.value
    if p.op in ("is null", "is not null"):
        return (x is None) == (p.op == "is null")
    if x is None:
        return None
    return {
        "=": lambda: x == v, "!=": lambda: x != v, "<": lambda: x < v, "<=": lambda: x <= v, ">": lambda: x > v, ">=": lambda: x >= v,
        "in": lambda: x in v, "not in": lambda: x not in v, "between": lambda: v[0] <= x <= v[1], "not between": lambda: not v[0] <= x <= v[1],
    }[p.op]()


def test_forms_against_three_valued_logic():
    rng = random.Random(1)
    rows = [{k: rng.choice([None, 0, 1, 2, 3]) for k in "fgsc"} for _ in range(60)]
    for _ in range(400):
        tree = some_tree(rng, 3)
        plain = resolved(tree, DIMS.__getitem__)
        parts = conjuncts(plain)
        of_fact = implied(plain, lambda c: c.entity is None)
        of_store = implied(plain, lambda c: c.entity == "store")
        for row in rows:
            want = truth(tree, row)
            assert truth(plain, row) == want
            assert (all(truth(p, row) is True for p in parts)) == (want is True)
            for weaker in (of_fact, of_store):
                assert want is not True or weaker is None or truth(weaker, row) is True
            if not can_hold_without(plain, "store"):
                assert truth(plain, row | {"s": None}) is not True


def test_unknown_tests_are_refused():
    with pytest.raises(ValueError, match="unknown test"):
        resolved(Condition("f", "~", 1), DIMS.__getitem__)


ROWS = [(f"t{i % 40}", i % 7, i % 5 or None, f"2024-01-{1 + i % 28:02d}", Decimal(i), "NY"[i % 2], ["Low-Value", "High-Value", None][i % 3]) for i in range(200)]


@pytest.fixture(scope="module")
def stored_sources(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("star"))
    fact = spark.createDataFrame(ROWS, "transaction_id STRING, store_sk INT, customer_sk INT, day STRING, net_revenue_usd DECIMAL(14,4), return_flag STRING, revenue_tier STRING")
    fact.selectExpr("* except (day)", "cast(day as date) as transaction_date").write.parquet(f"{path}/fact")
    spark.createDataFrame([(i, f"Region {i % 3}") for i in range(6)], "store_sk INT, region_name STRING").write.parquet(f"{path}/store")
    spark.createDataFrame([(i, ["Gold", "Silver", None][i % 3]) for i in range(1, 4)], "customer_sk INT, loyalty_tier STRING").write.parquet(f"{path}/customer")

    def read(name):
        return lambda columns: spark.read.parquet(f"{path}/{name}").select(*columns)

    return Sources(read("fact"), {"store": read("store"), "customer": read("customer")})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_go_where_they_can_be_tested(stored_sources, no_broadcast):
    gold = Condition("customer__loyalty_tier", "=", "Gold")
    high = Condition("transaction__revenue_tier", "=", "High-Value")
    plan = plan_of(metric_query(SEMANTIC_LAYER, stored_sources, ["total_net_revenue"], ["store__region_name"], where=[gold, ~Condition("transaction__return_flag", "in", ["Y", "Z"]), Condition("metric_time__day", ">=", "2024-01-05")]))
    scan = next(line for line in plan.splitlines() if "fact" in line and "PushedFilters" in line)
    assert "Not(In(return_flag" in scan and "GreaterThanOrEqual(transaction_date" in scan
    assert "LeftSemi" in plan and "EqualTo(loyalty_tier,Gold)" in plan
    # an or across tables waits for the join, but what it asks of the fact in each of its arms does not
    mixed = (gold & Condition("transaction__return_flag", "=", "N")) | (high & Condition("transaction__return_flag", "=", "Y"))
    plan = plan_of(metric_query(SEMANTIC_LAYER, stored_sources, ["total_net_revenue"], ["store__region_name"], where=mixed))
    scan = next(line for line in plan.splitlines() if "fact" in line and "PushedFilters" in line)
    assert "Or(EqualTo(return_flag,N)," in scan
    assert "LeftSemi" not in plan


def revenue(rows, test):
    stores = {i: f"Region {i % 3}" for i in range(6)}
    tiers = {i: ["Gold", "Silver", None][i % 3] for i in range(1, 4)}
    return sum((r[4] for r in rows if test(r, stores.get(r[1]), tiers.get(r[2]))), Decimal(0))


@pytest.mark.parametrize(
    ("where", "test"),
    [
        (Condition("customer__loyalty_tier", "is null"), lambda r, s, t: t is None),
        (~Condition("customer__loyalty_tier", "=", "Gold"), lambda r, s, t: t == "Silver"),
        (Condition("customer__loyalty_tier", "=", "Gold") | Condition("store__region_name", "like", "%1"), lambda r, s, t: t == "Gold" or s == "Region 1"),
        (Condition("customer__loyalty_tier", "=", "Gold") | Condition("customer__loyalty_tier", "is null"), lambda r, s, t: t in ("Gold", None)),
        (~(Condition("transaction__revenue_tier", "=", "High-Value") | Condition("store__region_name", "=", "Region 2")), lambda r, s, t: r[6] == "Low-Value" and s in ("Region 0", "Region 1")),
        (Condition("metric_time__day", "<", "2024-01-10") | Condition("customer__loyalty_tier", "=", "Silver"), lambda r, s, t: r[3] < "2024-01-10" or t == "Silver"),
    ],
)
def test_rows_chosen(stored_sources, no_broadcast, where, test):
    got = metric_query(SEMANTIC_LAYER, stored_sources, ["total_net_revenue"], ["store__region_name"], where=where).collect()
    assert sum((r.total_net_revenue for r in got), Decimal(0)) == revenue(ROWS, test)


def test_metric_with_a_condition_on_a_joined_table(stored_sources):
    gold = Simple("gold", "Gold", measure=NET, where=Condition("customer__loyalty_tier", "=", "Gold") & ~Condition("return_flag", "=", "Y"))
    count = Simple("gold_sales", "Gold sales", measure=TRANSACTIONS, where=Condition("customer__loyalty_tier", "=", "Gold"))
    layer = replace(SEMANTIC_LAYER, metrics=SEMANTIC_LAYER.metrics | {"gold": gold, "gold_sales": count})
    row = metric_query(layer, stored_sources, ["gold", "gold_sales", "total_net_revenue"]).first()
    assert row.gold == revenue(ROWS, lambda r, s, t: t == "Gold" and r[5] != "Y")
    assert row.gold_sales == len({r[0] for r in ROWS if r[2] == 3})
    assert row.total_net_revenue == revenue(ROWS, lambda r, s, t: True)


def test_counts_without_multiplied_rows(stored_sources):
    names = ["total_net_revenue", "transaction_count", "return_transactions", "unique_customers"]
    assert "Expand" not in plan_of(metric_query(SEMANTIC_LAYER, stored_sources, names, ["store__region_name"]))

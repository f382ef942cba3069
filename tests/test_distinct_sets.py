"""Mergeable distinct counts against sets in Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfline.operators.distinct_sets import dictionary, grouping_set_sizes, merged, set_sizes, sets_of, sizes, union_of, with_numbers


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    numbers = [1, 2, 32_767, 32_768, 32_769, 65_536, 65_537, 10**12, 0, -1, -5, -32_768, None]
    return [(rng.choice(["a", "b", None]), rng.randint(1, 4), rng.choice(numbers), rng.choice(["x", "é", "", "y y", None])) for _ in range(500)]


@pytest.fixture(scope="module")
def facts(spark, rows):
    return spark.createDataFrame(rows, "g string, day int, n long, word string").repartition(4)


def members(rows, key, value):
    out = defaultdict(set)
    for r in rows:
        if value(r) is not None:
            out[key(r)].add(value(r))
    return {k: len(v) for k, v in out.items()}


def test_sets_merge_to_coarser_groups(facts, rows):
    sets = sets_of(facts, ["g", "day"], "n").cache()
    got = {(r.g, r.day): r.c for r in sizes(sets, ["g", "day"], "c").collect()}
    assert got == members(rows, lambda r: (r[0], r[1]), lambda r: r[2])
    half = {"half": F.ceil(F.col("day") / 2), "g": F.col("g")}
    got = {(r.half, r.g): r.c for r in set_sizes(sets, half, "c").collect()}
    assert got == members(rows, lambda r: ((r[1] + 1) // 2, r[0]), lambda r: r[2])
    early, late = sets.where("day < 3"), sets.where("day >= 3")
    got = {r.g: r.c for r in sizes(union_of([merged(early, ["g"]), merged(late, ["g"])], ["g"]), ["g"], "c").collect()}
    assert got == members(rows, lambda r: r[0], lambda r: r[2])


def test_dictionary_is_dense(facts, rows):
    for slots in (1, 3, 4096):
        numbers = dictionary(facts, "word", slots=slots).collect()
        assert sorted(r.number for r in numbers) == list(range(1, 5)) and len({r.word for r in numbers}) == 4
    sets = sets_of(with_numbers(facts, dictionary(facts, "word"), "word"), ["day"], "number")
    assert {r.day: r.c for r in sizes(sets, ["day"], "c").collect()} == members(rows, lambda r: r[1], lambda r: r[3])


def test_key_sets_tell_null_keys_from_totals(facts, rows):
    sets = sets_of(facts, ["g", "day"], "n")
    got = grouping_set_sizes(sets, [["g", "day"], ["g"], []], "c", {"g": "all_g", "day": "all_days"}).collect()
    want = {(0, 0, *k): c for k, c in members(rows, lambda r: (r[0], r[1]), lambda r: r[2]).items()}
    want |= {(0, 1, k, None): c for k, c in members(rows, lambda r: r[0], lambda r: r[2]).items()}
    want |= {(1, 1, None, None): c for c in members(rows, lambda r: 0, lambda r: r[2]).values()}
    assert {(r.all_g, r.all_days, r.g, r.day): r.c for r in got} == want


def test_no_rows(facts):
    empty = facts.limit(0)
    assert sizes(sets_of(empty, ["g"], "n"), ["g"], "c").count() == 0
    assert dictionary(empty, "word").count() == 0

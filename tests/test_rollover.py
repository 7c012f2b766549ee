"""Carried allowances: months combined in any grouping, and loads that go on from a state."""

import random
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from meterline.plans import rollover

USERS = "user_id string, base_mb decimal(26,3)"
MONTHS = "user_id string, month date, used_mb decimal(26,3)"


def month(number):
    return date(2020 + number // 12, number % 12 + 1, 1)


def fold(base, used):
    """(month, carry in) of all months from the first to the last with usage, and what the last carries out."""
    carry, rows = D(0), []
    for n in range(min(used), max(used) + 1):
        rows.append((month(n), carry))
        carry = min(max(base + carry - used.get(n, D(0)), D(0)), base)
    return rows, carry


def some_users(count=40):
    rng = random.Random(5)
    users = {f"u{k}": D(rng.choice([0, 5, 100])) for k in range(count)}
    used = {u: {n: D(rng.randrange(0, 250)) for n in rng.sample(range(30), rng.randint(1, 20))} for u in users}
    return users, used


def frames(spark, users, used):
    months = [(u, month(n), x) for u, by in used.items() for n, x in by.items()]
    return spark.createDataFrame(list(users.items()), USERS), spark.createDataFrame(months, MONTHS)


def test_spans_in_any_grouping(spark):
    users, used = some_users()
    people, months = frames(spark, users, used)
    cuts = [month(0), month(8), month(9), month(20), month(40)]
    parts = [
        rollover.span_maps(people, months.where(F.col("month").between(F.lit(a), F.add_months(F.lit(b), -1))))
        for a, b in zip(cuts, cuts[1:])
    ]
    left, right = parts[0], parts[-1]
    for part in parts[1:]:
        left = rollover.joined_spans(left, part)
    for part in parts[-2::-1]:
        right = rollover.joined_spans(part, right)
    wanted = {u: (month(min(by)), month(max(by)), fold(users[u], by)[1]) for u, by in used.items()}
    for whole in (left, right):
        out = rollover.carried_out(F.col("map"), F.lit(D(0)).cast("decimal(26,3)")).alias("out")
        assert {r.user_id: (r["first"], r["last"], r.out) for r in whole.select("*", out).collect()} == wanted


def test_loads_go_on_from_states(spark):
    users, used = some_users()
    people, months = frames(spark, users, used)
    early, late = months.where(F.col("month") < month(11)), months.where(F.col("month") >= month(11))
    first = rollover.rollover_rows(people, early)
    states = rollover.states_of(first)
    second = rollover.rollover_rows(people, late, states)
    rows = {(r.user_id, r.usage_month): r.carryover_mb for r in first.unionByName(second).collect()}
    assert rows == {(u, m): c for u, by in used.items() for m, c in fold(users[u], by)[0]}
    last = {r.user_id: (r.month, r.carry_mb) for r in rollover.states_of(second, states).collect()}
    assert last == {u: (month(max(by)), fold(users[u], by)[1]) for u, by in used.items()}
    # The same months once more change nothing: a state leaves out what it has counted.
    again = rollover.rollover_rows(people, months, rollover.states_of(second, states))
    assert again.count() == 0


def test_nothing_to_carry(spark):
    people, months = frames(spark, {"u": D(5)}, {"u": {3: D(1)}})
    none = months.limit(0)
    assert rollover.rollover_rows(people, none).count() == 0
    assert rollover.rollover_rows(people.limit(0), months).count() == 0
    odd = months.unionByName(spark.createDataFrame([("u", None, D(2)), (None, month(1), D(2)), ("x", month(1), D(2))], MONTHS))
    assert [r.usage_month for r in rollover.rollover_rows(people, odd).collect()] == [month(3)]
    states = rollover.states_of(rollover.rollover_rows(people, months))
    kept = rollover.states_of(rollover.rollover_rows(people, none, states), states)
    assert [tuple(r) for r in kept.collect()] == [("u", month(3), D(4))]

import itertools
import random
from collections import Counter, defaultdict

import pytest

from martwright import session as sessions
from martwright.operators import basket
from martwright.operators.basket import pair_counts
from martwright.plans.advanced import market_basket


def brute_force(lines, min_count, top):
    baskets = defaultdict(Counter)
    for customer, date, product in lines:
        baskets[customer, date][product] += 1
    co, who = Counter(), defaultdict(set)
    for (customer, _), items in baskets.items():
        for a, b in itertools.combinations(sorted(items), 2):
            co[a, b] += items[a] * items[b]
            who[a, b].add(customer)
    kept = [(*pair, n, len(who[pair])) for pair, n in co.items() if n >= min_count]
    return sorted(kept, key=lambda r: (-r[2], r[0], r[1]))[:top]


def found(spark, lines, min_count, top, share):
    df = spark.createDataFrame(lines, "customer_id int, date_id int, product_id int")
    pairs = pair_counts(df, min_count, top, share).collect()
    kept = [(r.product_id_a, r.product_id_b, r.co_occurrence, r.unique_customers) for r in pairs]
    return sorted(kept, key=lambda r: (-r[2], r[0], r[1]))


def small_baskets(rng, n, products=12):
    return [(rng.randrange(15), rng.randrange(4), rng.randrange(products)) for _ in range(n)]


@pytest.mark.parametrize("share", [1, 3, 100])
def test_the_share_of_a_task_changes_nothing(spark, share):
    lines = small_baskets(random.Random(share), 200) + [(None, 1, 2), (1, None, 2), (1, 1, None)]
    known = [line for line in lines if None not in line]
    assert found(spark, lines, 3, 20, share) == brute_force(known, 3, 20)


@pytest.mark.parametrize("seed", range(2))
def test_wide_baskets_are_exact(spark, seed):
    rng = random.Random(seed)
    lines = small_baskets(rng, 150, products=25)
    # One basket owns a third of all rows, two more are wide too.
    lines += [(99, 1, rng.randrange(40)) for _ in range(100)]
    lines += [(98, d, rng.randrange(30)) for d in (1, 2) for _ in range(25)]
    for top in (1, 5, 20):
        assert found(spark, lines, 3, top, share=6) == brute_force(lines, 3, top)


def test_wide_basket_full_of_ties(spark):
    # Every pair of the wide basket counts the same; the report's order decides.
    lines = [(1, 1, p) for p in range(30) for _ in range(2)]
    assert found(spark, lines, 3, 10, share=5) == brute_force(lines, 3, 10)


def test_pairs_below_the_minimum_are_dropped(spark):
    lines = [(1, 1, p) for p in range(30)] + [(2, 1, 3), (2, 1, 4), (3, 1, 3), (3, 1, 4)]
    assert found(spark, lines, 3, 10, share=5) == [(3, 4, 3, 3)] == brute_force(lines, 3, 10)


def test_no_lines(spark):
    assert found(spark, [], 3, 10, share=5) == []


def test_report(spark):
    sales = spark.createDataFrame(
        [(i, c, 1, p) for i, (c, p) in enumerate(itertools.product([1, 2, 3], [10, 20]))],
        "sale_id int, customer_id int, date_id int, product_id int")
    products = spark.createDataFrame([(10, "lamp", "home"), (20, "rug", "home")], "product_id int, product_name string, category string")
    row = market_basket(sales, products).first()
    assert (row.product_a, row.product_b, row.co_occurrence, row.unique_customers, row.support_pct) == ("lamp", "rug", 3, 3, 50.0)


def test_tasks_follow_the_number_of_sales(spark, monkeypatch):
    monkeypatch.setattr(sessions, "ROWS_A_TASK", 50)
    rng, written, cut = random.Random(3), [], basket.cut
    lines = [(rng.randrange(60), rng.randrange(9), rng.randrange(12)) for _ in range(1500)]
    monkeypatch.setattr(basket, "cut", lambda df: written.append(df.rdd.getNumPartitions()) or cut(df))
    assert found(spark, lines, 3, 10, share=5) == brute_force(lines, 3, 10)
    assert written[0] == 30  # basket lines

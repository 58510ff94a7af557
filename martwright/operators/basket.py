"""Product pairs that are bought together, exact and without forming pairs that cannot matter.

A basket is what one customer buys on one day. Its lines are first reduced to (basket, product, n);
a pair then co-occurs n_a * n_b times in it, the number of line pairs.

With w the sum of n^2 of a product over all baskets, the count of a pair is at most sqrt(w_a * w_b)
(Cauchy-Schwarz). The pairs among the heaviest products give a floor: the `top`-th best of them is a
true lower bound of the `top`-th best of all. A product whose bound with the heaviest one stays below
the floor leaves before the join, a pair whose bound does leaves inside it. A pair that can at best tie
with the floor stays only if it comes first in the report's order.

A basket may own a third of all rows, and its pairs grow with the square. Its products are spread over
parts, one for every `share` of them, and the other side goes to each part: the share decides how many
tasks work on a basket and nothing else. Pair counts never carry customers; these are counted
afterwards, for the pairs of the report alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.session import cut, dealt_by_rows

BASKET = ["customer_id", "date_id"]
PAIR = ["product_id_a", "product_id_b"]
SHARE = 256  # products of a basket that one task pairs with all the others


def _sides(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Basket lines as left and right side of a pair."""
    return tuple(
        lines.withColumnsRenamed({c: f"{c}_{side}" for c in ("product_id", "n", "w") if c in lines.columns}) for side in "ab")


def _counted(lines: DataFrame, share: int, keep: Column | None = None) -> DataFrame:
    """(pair, co_occurrence) of basket lines, of those pairs that `keep` lets through."""
    widths = lines.groupBy(*BASKET).agg(F.count("*").alias("width")).filter(F.col("width") > share)
    parts = F.ceil(F.coalesce("width", F.lit(1)) / F.lit(share)).cast("int")
    spread = lines.join(widths, BASKET, "left").withColumn("parts", parts).drop("width")
    left, right = _sides(spread)
    left = left.withColumn("part", F.pmod(F.xxhash64("product_id_a"), F.col("parts")).cast("int")).drop("parts")
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    pairs = left.join(right, [*BASKET, "part"]).filter(F.col("product_id_a") < F.col("product_id_b"))
    if keep is not None:
        pairs = pairs.filter(keep)
    return pairs.groupBy(*PAIR).agg(F.sum(F.col("n_a") * F.col("n_b")).alias("co_occurrence"))


def _best(pairs: DataFrame, top: int, min_count: int) -> DataFrame:
    enough = pairs.filter(F.col("co_occurrence") >= min_count)
    return enough.orderBy(F.desc("co_occurrence"), *PAIR).limit(top)


def pair_counts(sales: DataFrame, min_count: int, top: int, share: int = SHARE, rows: int | None = None) -> DataFrame:
    """The `top` best pairs of at least `min_count`, by count and then product ids:
    (product_id_a, product_id_b, co_occurrence, unique_customers).

    `rows` is the number of `sales`, for callers that know it without a pass over them.
    """
    with dealt_by_rows(sales.sparkSession, sales.count() if rows is None else rows):
        return _pair_counts(sales, min_count, top, share)


def _pair_counts(sales: DataFrame, min_count: int, top: int, share: int) -> DataFrame:
    known = [F.col(c).isNotNull() for c in (*BASKET, "product_id")]
    lines = sales.filter(known[0] & known[1] & known[2])
    basket = cut(lines.groupBy(*BASKET, "product_id").agg(F.count("*").alias("n")))
    weight = cut(basket.groupBy("product_id").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("w")))

    heaviest = weight.orderBy(F.desc("w"), "product_id").limit(2 * top)  # bounded by the report's size
    seed = basket.join(F.broadcast(heaviest.select("product_id")), "product_id", "left_semi")
    seeded = _best(_counted(seed, share), top, min_count).collect()
    floor, first = (seeded[-1].co_occurrence, seeded[-1].product_id_a) if len(seeded) == top else (min_count, None)
    square, slack = float(floor) ** 2, 0.5 * floor  # whole numbers: half a count is no pair's distance to the floor

    def reaches(bound: Column, product_a: Column) -> Column:
        ties = bound >= F.lit(square - slack)
        return ties if first is None else (bound > F.lit(square + slack)) | (ties & (product_a <= F.lit(first)))

    peak = weight.agg(F.max("w")).scalar()
    hopeful = weight.filter(F.col("w") * peak >= F.lit(square - slack))
    rows = basket.join(hopeful, "product_id")
    counted = _counted(rows, share, reaches(F.col("w_a") * F.col("w_b"), F.col("product_id_a")))
    best = cut(_best(counted, top, min_count))

    # Customers of the chosen pairs: for a product of a pair, the baskets' lines of both products meet.
    chosen = F.broadcast(best.select(*PAIR))  # `top` rows
    left, right = _sides(basket.drop("n"))
    who = left.join(chosen, "product_id_a").join(right.join(chosen, "product_id_b"), [*BASKET, *PAIR])
    customers = who.groupBy(*PAIR).agg(F.countDistinct("customer_id").alias("unique_customers"))
    return best.join(customers, PAIR)

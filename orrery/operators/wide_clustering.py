"""K-Means over a category with any number of values, and a few numbers.

The features are those of ``operators.clustering``: the category as a one-hot block whose
distances count ``weight`` times, and the numbers after it. The block is never laid out. A row
keeps the slot of its category; a centre's block holds, for each category, the share of the
cluster's rows that carry it, and is stored as rows (slot, cluster, share). The squared distance
of a row with slot j and numbers x to a centre with shares p and means m is

    |x - m|^2 + weight * (1 - 2 p[j] + |p|^2)

so a row needs the shares of its own category only: at most one per cluster, joined by slot.
The driver holds, per centre, its means, its size and |p|^2, and while starting some 4 k rows.

Rows without a category take no part in training. Numbers that are NULL or NaN become the mean
of the column; a column without any valid number is left out, and no column at all is fine. An
empty table raises ``ValueError``. Of equally near centres the first wins; a centre that loses
all its rows stays where it is. Fewer distinct rows than ``k`` give fewer centres. Other columns
do not matter in training; ``infer_wide`` keeps them, replaces a column named ``prediction``, and
refuses columns named ``_slot``, ``_held`` or ``_near``.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orrery.operators.clean import fill_missing, mean_valid, present, require_rows, rows_present
from orrery.operators.clustering import KMeansConfig
from orrery.operators.encode import category_frequency
from orrery.operators.joins import lookup_join
from orrery.runtime import freeze, remove_path, scratch_path

# Each starting round draws about this many rows per centre; two rounds are made.
OVERSAMPLING = 2
START_ROUNDS = 2
# Draws of starting centres among the sampled rows; the cheapest is taken.
START_DRAWS = 10

SHARES = "slot bigint, cluster int, share double"


@dataclass(frozen=True)
class WideFitted:
    """``dictionary``: (category, n, idx). ``shares``: (slot, cluster, share). The rest is one entry per centre."""

    dictionary: DataFrame
    shares: DataFrame
    means: dict[str, float]
    centers: list[list[float]]
    norms: list[float]
    sizes: list[int]
    weight: int
    category: str
    cost: float
    iterations: int


def fit_wide(
    df: DataFrame, cfg: KMeansConfig = KMeansConfig(), start: list[tuple[object, list[float]]] | None = None,
    tol: float = 1e-4,
) -> WideFitted:
    """Train; ``start`` gives the first centres as (category, numbers) instead of drawing them.

    ``cost`` adds up the distances of the last assignment, before the centres moved once more.
    """
    spark = df.sparkSession
    known = rows_present(df, cfg.category)
    dictionary = freeze(category_frequency(known, cfg.category), "dictionary")
    require_rows(dictionary, f"no rows with a {cfg.category} to train on")
    means = _valid_means(known, cfg.numeric)
    x = list(means)
    rows = freeze(_encoded(known, dictionary, means, cfg.category).select("_slot", *x), "wide-rows")
    if start is None:
        seeds = _draw_start(rows, x, cfg)
    else:
        seeds = _given_start(dictionary, start, cfg.category)
    centers = [numbers for _, numbers in seeds]
    norms, sizes = [0.0 if slot is None else 1.0 for slot, _ in seeds], [0] * len(seeds)
    held = [(slot, i, 1.0) for i, (slot, _) in enumerate(seeds) if slot is not None]
    shares = spark.createDataFrame(held, SHARES)
    base, cost, turn = scratch_path(spark, "wide-centres"), math.nan, 0
    for turn in range(1, cfg.max_iter + 1):
        path, sums = f"{base}/{turn}", [F.sum(c).alias(c) for c in x]
        _by_slot(shares).write.parquet(f"{path}-held")
        assigned = _nearest(rows, x, centers, norms, spark.read.parquet(f"{path}-held"), cfg.weight)
        assigned.groupBy(F.col("_near.cluster").alias("cluster"), F.col("_slot").alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("_near.distance").alias("cost"), *sums
        ).write.parquet(f"{path}-counts")
        counts = spark.read.parquet(f"{path}-counts")
        squares = F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")
        total = {
            r["cluster"]: r for r in counts.groupBy("cluster").agg(
                F.sum("n").alias("size"), squares, F.sum("cost").alias("cost"), *sums
            ).collect()
        }
        cost = math.fsum(r["cost"] for r in total.values())
        moved = _moved_shares(counts, shares, {i: r["size"] for i, r in total.items()})
        moved.write.parquet(f"{path}-shares")
        later = spark.read.parquet(f"{path}-shares")
        shift = _share_shift(shares, later)
        for i, r in total.items():
            mean = [r[c] / r["size"] for c in x]
            shift[i] = cfg.weight * shift.get(i, 0.0) + sum((a - b) ** 2 for a, b in zip(mean, centers[i]))
            centers[i], norms[i] = mean, r["squares"] / r["size"] ** 2
        sizes = [total[i]["size"] if i in total else 0 for i in range(len(centers))]
        shares = later
        for old in (f"{path}-held", f"{path}-counts", f"{base}/{turn - 1}-shares"):
            remove_path(spark, old)
        if all(shift[i] <= tol * tol for i in total):
            break
    return WideFitted(dictionary, shares, means, centers, norms, sizes, cfg.weight, cfg.category, cost, turn)


def infer_wide(df: DataFrame, fitted: WideFitted) -> DataFrame:
    """``df`` with ``prediction``; a category that training never saw, or none, has an empty block."""
    clash = {"_slot", "_held", "_near"} & set(df.columns)
    if clash:
        raise ValueError(f"columns with reserved names: {sorted(clash)}")
    number = {c: f"_wide{i}" for i, c in enumerate(fitted.means)}
    # The numbers are filled in copies: the caller's columns come out as they were.
    copies = df.drop("prediction").withColumns({v: F.col(c).cast("double") for c, v in number.items()})
    rows = _encoded(copies, fitted.dictionary, {number[c]: m for c, m in fitted.means.items()}, fitted.category)
    held = freeze(_by_slot(fitted.shares), "wide-held")
    near = _nearest(rows, list(number.values()), fitted.centers, fitted.norms, held, fitted.weight)
    return near.select(*[c for c in df.columns if c != "prediction"], F.col("_near.cluster").alias("prediction"))


def wide_center_rows(fitted: WideFitted) -> DataFrame:
    """Centres in long form (cluster, slot, value): set category slots only, then the numbers.

    Values are those of the scaled block, ``sqrt(weight)`` times the share.
    """
    spark = fitted.shares.sparkSession
    first = int(fitted.dictionary.agg(F.max("idx")).first()[0]) + 1
    numbers = [(i, first + j, float(v)) for i, c in enumerate(fitted.centers) for j, v in enumerate(c)]
    block = fitted.shares.select("cluster", "slot", (F.col("share") * math.sqrt(fitted.weight)).alias("value"))
    return block.unionByName(spark.createDataFrame(numbers, "cluster int, slot bigint, value double"))


def save_wide(fitted: WideFitted, base: str) -> None:
    """Write the model below ``base``, replacing an earlier one there."""
    spark = fitted.shares.sparkSession
    state = {
        "means": fitted.means, "centers": fitted.centers, "norms": fitted.norms, "sizes": fitted.sizes,
        "weight": fitted.weight, "category": fitted.category, "cost": fitted.cost, "iterations": fitted.iterations,
    }
    fitted.dictionary.write.mode("overwrite").parquet(f"{base}/dictionary")
    fitted.shares.write.mode("overwrite").parquet(f"{base}/shares")
    text = spark.createDataFrame([(json.dumps(state),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{base}/centres")


def load_wide(spark: SparkSession, base: str) -> WideFitted:
    state = json.loads(spark.read.text(f"{base}/centres").first()["value"])
    return WideFitted(spark.read.parquet(f"{base}/dictionary"), spark.read.parquet(f"{base}/shares"), **state)


# --- rows -----------------------------------------------------------------------------

def _valid_means(df: DataFrame, numeric: list[str]) -> dict[str, float]:
    names = present(df, numeric)
    if not names:
        return {}
    found = mean_valid(df, names).first()
    return {c: found[f"{c}_mean"] for c in names if found[f"{c}_mean"] is not None}


def _encoded(df: DataFrame, dictionary: DataFrame, means: dict[str, float], category: str) -> DataFrame:
    """``df`` with ``_slot`` (NULL for an unknown category) and its numbers filled."""
    slots = dictionary.select(category, F.col("idx").cast("bigint").alias("_slot"))
    filled = fill_missing(lookup_join(df, slots, category, "left"), means)
    return filled.withColumns({c: F.col(c).cast("double") for c in means}) if means else filled


def _by_slot(shares: DataFrame) -> DataFrame:
    """(_slot, _held): for every category its shares, at most one per cluster."""
    pairs = F.collect_list(F.struct("cluster", "share")).alias("_held")
    return shares.groupBy(F.col("slot").alias("_slot")).agg(pairs)


def _nearest(
    rows: DataFrame, x: list[str], centers: list[list[float]], norms: list[float], held: DataFrame, weight: int
) -> DataFrame:
    """``rows`` with ``_near`` (distance, cluster).

    A share only brings a centre nearer, so the nearest one is either the nearest of all
    without shares or one of the few that hold the row's category.
    """
    own = F.when(F.col("_slot").isNull(), F.lit(0.0)).otherwise(F.lit(float(weight)))
    plain = F.array(*[_squared(x, c) + F.lit(weight * p) + own for c, p in zip(centers, norms)])
    joined = lookup_join(rows, held, "_slot", "left").withColumn("_plain", plain)
    alone = F.transform("_plain", lambda d, i: F.struct(d.alias("distance"), i.cast("int").alias("cluster")))
    shared = F.transform(
        F.coalesce("_held", F.array().cast("array<struct<cluster:int,share:double>>")),
        lambda s: F.struct(
            (F.get("_plain", s["cluster"]) - F.lit(2.0 * weight) * s["share"]).alias("distance"),
            s["cluster"].alias("cluster"),
        ),
    )
    return joined.withColumn("_near", F.array_min(F.concat(alone, shared))).drop("_plain", "_held")


def _squared(x: list[str], center: list[float]) -> Column:
    total = F.lit(0.0)
    for c, v in zip(x, center):
        total = total + (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
    return total


# --- centres --------------------------------------------------------------------------

def _moved_shares(counts: DataFrame, shares: DataFrame, size: dict[int, int]) -> DataFrame:
    """(slot, cluster, share) after a turn; clusters without rows keep what they had."""
    pairs = [p for i, n in size.items() for p in (F.lit(i), F.lit(float(n)))]
    of_cluster = F.element_at(F.create_map(*pairs), F.col("cluster"))
    fresh = counts.select("slot", "cluster", (F.col("n") / of_cluster).alias("share"))
    return fresh.unionByName(shares.filter(~F.col("cluster").isin(list(size))))


def _share_shift(before: DataFrame, after: DataFrame) -> dict[int, float]:
    """Squared move of every centre's shares."""
    change = after.unionByName(before.withColumn("share", -F.col("share")))
    per_slot = change.groupBy("cluster", "slot").agg(F.sum("share").alias("d"))
    moved = per_slot.groupBy("cluster").agg(F.sum(F.col("d") * F.col("d")).alias("shift"))
    return {r["cluster"]: r["shift"] for r in moved.collect()}


# --- starting centres -----------------------------------------------------------------

def _given_start(dictionary: DataFrame, start: list[tuple[object, list[float]]], category: str) -> list:
    wanted = dictionary.filter(F.col(category).isin([c for c, _ in start])).collect()
    slots = {r[category]: r["idx"] for r in wanted}
    return [(slots.get(c), [float(v) for v in numbers]) for c, numbers in start]


def _draw_start(rows: DataFrame, x: list[str], cfg: KMeansConfig) -> list[tuple[int, list[float]]]:
    """Rows drawn in rounds by their share of the cost, then the best of some weighted draws among them."""
    columns = ["_slot", *x]
    first = rows.orderBy(F.xxhash64(F.lit(cfg.seed), *columns), *columns).first()
    found = [tuple(first)]
    for turn in range(START_ROUNDS):
        near = rows.withColumn("_cost", F.array_min(_to_candidates(found, x, cfg.weight)))
        total = near.agg(F.sum("_cost")).first()[0]
        if not total:
            break
        chance = F.col("_cost") * F.lit(OVERSAMPLING * cfg.k / total)
        # The expected number of rows drawn is at most OVERSAMPLING * k, whatever the table's size.
        drawn = near.filter(F.rand(cfg.seed + turn) < chance).select(*columns).distinct().collect()
        found = list(dict.fromkeys(found + sorted(tuple(r) for r in drawn)))
    if len(found) <= cfg.k:
        return [(c[0], list(c[1:])) for c in found]
    distances = _to_candidates(found, x, cfg.weight)
    place = F.array_position(distances, F.array_min(distances)).alias("place")
    counts = {int(r["place"]) - 1: r["count"] for r in rows.select(place).groupBy("place").count().collect()}
    weights = np.array([counts.get(i, 0) for i in range(len(found))], dtype=float)
    return [(found[i][0], list(found[i][1:])) for i in _seed_places(found, weights, cfg)]


def _to_candidates(found: list[tuple], x: list[str], weight: int) -> Column:
    """Squared distances of a row to some rows (slot, numbers)."""
    names = ["s", *[f"v{i}" for i in range(len(x))]]
    points = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, c)]) for c in found])

    def distance(p: Column) -> Column:
        total = F.when(F.col("_slot") == p["s"], F.lit(0.0)).otherwise(F.lit(2.0 * weight))
        for i, c in enumerate(x):
            total = total + (F.col(c) - p[f"v{i}"]) * (F.col(c) - p[f"v{i}"])
        return total

    return F.transform(points, distance)


def _seed_places(found: list[tuple], weights: np.ndarray, cfg: KMeansConfig) -> list[int]:
    """Places of k of the sampled rows: each draw takes rows by weight times squared distance."""
    slots, numbers = np.array([c[0] for c in found]), np.array([c[1:] for c in found], dtype=float)
    apart = 2.0 * cfg.weight * (slots[:, None] != slots[None]) + ((numbers[:, None] - numbers[None]) ** 2).sum(axis=2)
    random, best = np.random.default_rng(cfg.seed), (math.inf, [])
    for _ in range(START_DRAWS):
        taken = [int(random.choice(len(found), p=weights / weights.sum()))]
        while len(taken) < cfg.k:
            cost = weights * apart[taken].min(axis=0)
            if cost.sum() == 0:
                break
            taken.append(int(random.choice(len(found), p=cost / cost.sum())))
        best = min(best, (float((weights * apart[taken].min(axis=0)).sum()), taken))
    return best[1]

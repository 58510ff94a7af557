"""Slowly changing dimensions as set operations over whole change batches.

Type 2 keeps one row per version with the half-open interval [effective_from, effective_to). All
changes of a batch are applied at once: several changes of a key chain in the order of their time.
The chain is worked out with the two-level operators of `ordered`, so one key may own any share of
the changes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.ordered import Ordered

OPEN_END = "9999-12-31 00:00:00"
VALIDITY = ["effective_from", "effective_to", "is_current", "version", "change_type"]
SEQUENCE = "_sequence"
SLICE = 64  # versions of a key that stand in one row of the as-of join


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def surrogate_key(key: str) -> Column:
    """A key per version that needs no counter: the hash of business key and version."""
    return F.xxhash64(F.col(key), F.col("version"))


def scd2_init(dim: DataFrame, at: Column | dt.datetime) -> DataFrame:
    """Version 1 of every row, valid from `at` on."""
    at = at if isinstance(at, Column) else F.lit(at)
    return dim.withColumns({
        "effective_from": at.cast("timestamp"),
        "effective_to": _open_end(),
        "is_current": F.lit(1),
        "version": F.lit(1),
        "change_type": F.lit("INSERT"),
    })


def scd2_apply(history: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str,
               tie_break: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """New history and change log after a batch of `changes` (key, some tracked columns, time `at`).

    A NULL or missing tracked column leaves the value as it is; values compare as text. A change has
    no effect when its key is unknown, when it alters nothing, or when it is not later than the start
    of the current version; a replayed batch therefore changes nothing. `tie_break` orders changes of
    one key and time; by default their values do. `scd2_late` gives the changes that came too late.
    """
    tracked = [c for c in tracked if c in changes.columns]  # the others never change
    batch = changes.filter(F.col(key).isNotNull()).select(
        key,
        F.col(at).cast("timestamp").alias("effective_from"),
        *[F.col(c).cast(history.schema[c].dataType).alias(c) for c in tracked],
        F.struct(*(tie_break or tracked)).alias("_tie"),
    )
    current = history.filter(F.col("is_current") == 1)
    # The row each chain starts from: the current version of a key that has changes.
    base = current.join(batch.select(key).distinct(), key, "left_semi").select(
        key, "effective_from", *tracked, F.col("version").alias("_base"))
    since = current.select(key, F.col("effective_from").alias("_since"))
    known = batch.join(since, key).filter(F.col("effective_from") > F.col("_since")).drop("_since").distinct()
    rows = base.withColumn("_tie", F.lit(None).cast(batch.schema["_tie"].dataType)).unionByName(
        known.withColumn("_base", F.lit(None).cast("int")))

    order = [F.asc(key), F.col("_base").isNull().asc(), F.asc("effective_from"), F.asc_nulls_first("_tie")]
    chain = Ordered.of(rows, order, by=[key])
    # State after each change, and the state before it. Columns that no change gives stay put.
    chain = chain.fill_forward([*tracked, "_base"]).previous(tracked, "_old")
    differs = {c: ~F.col(f"_old.{c}").cast("string").eqNullSafe(F.col(c).cast("string")) for c in tracked}
    changed = F.array_compact(F.array(*[F.when(d, F.lit(c)) for c, d in differs.items()]))
    first = F.col("_old").isNull()
    chain = chain.with_columns({"_changed": F.when(~first, changed), "_step": F.when(first, 0).otherwise(1)})
    chain = chain.filter((F.col("_step") == 0) | (F.size("_changed") > 0)).cut()
    chain = chain.running_sum("_step", "_steps").following(["effective_from"], "_next")
    steps = chain.with_columns({
        "version": (F.col("_base") + F.col("_steps")).cast("int"),
        "effective_to": F.coalesce(F.col("_next.effective_from"), _open_end()),
        "is_current": F.when(F.col("_next").isNull(), 1).otherwise(0),
    }).plain()

    carried = [c for c in history.columns if c not in {key, *tracked, *VALIDITY, "surrogate_key"}]
    new = steps.filter(F.col("_step") == 1).withColumn("change_type", F.lit("UPDATE"))
    columns = [c for c in history.columns if c != "surrogate_key"]
    versions = new.select(key, *tracked, *VALIDITY)
    if carried:
        versions = versions.join(current.select(key, *carried), key)
    closing = steps.filter((F.col("_step") == 0) & F.col("_next").isNotNull()).select(
        key, F.col("version"), F.col("effective_to").alias("_closed"))
    kept = history.select(*columns).join(closing, [key, "version"], "left").withColumns({
        "is_current": F.when(F.col("_closed").isNotNull(), 0).otherwise(F.col("is_current")),
        "effective_to": F.coalesce("_closed", "effective_to"),
    }).drop("_closed")
    after = kept.select(*columns).unionByName(versions.select(*columns))
    if "surrogate_key" in history.columns:
        after = after.withColumn("surrogate_key", surrogate_key(key)).select(*history.columns)

    def values(side: str) -> Column:
        entries = F.map_from_arrays(
            F.array(*map(F.lit, tracked)),
            F.array(*[F.col(f"_old.{c}" if side == "old" else c).cast("string") for c in tracked]))
        return F.to_json(F.map_filter(entries, lambda k, _: F.array_contains("_changed", k)))

    log = new.select(
        F.col(key).alias("record_id"),
        "change_type",
        F.array_join("_changed", ",").alias("changed_fields"),
        values("old").alias("old_values"),
        values("new").alias("new_values"),
        F.col("effective_from").alias("changed_at"),
    )
    return after, log


def scd2_splice(history: DataFrame, known: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str,
                tie_break: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, change log and rebuilt keys after `changes` that may lie anywhere in time.

    `known` holds all changes given before, with the columns of `changes`, those without effect too: a change that repeated a value
    matters as soon as an earlier one with another value turns up. The versions of a key are an outcome of its first version and the set of
    its changes, whatever the order they come in. A key whose new changes are all later than what it knows goes on from its current version;
    the others are split and joined anew from their first version on, and their log entries, which are all given, replace the
    former ones. Changes that are known already have no effect; nor have those that are not later than the first version.
    """
    columns = list(dict.fromkeys([key, at, *tracked, *tie_break]))
    known, fresh = known.select(*columns), changes.select(*columns).filter(F.col(key).isNotNull()).distinct()
    same = F.lit(True)
    for c in columns:
        same &= F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    fresh = fresh.alias("new").join(known.alias("old"), same, "left_anti")
    latest = known.groupBy(key).agg(F.max(at).cast("timestamp").alias("_latest"))
    since = history.filter(F.col("is_current") == 1).select(key, F.col("effective_from").alias("_since"))
    first = fresh.groupBy(key).agg(F.min(at).cast("timestamp").alias("_first"))
    rebuilt = first.join(since, key).join(latest, key, "left").filter(
        F.col("_first") <= F.greatest("_since", F.coalesce("_latest", "_since"))).select(key)

    untouched = history.join(rebuilt, key, "left_anti")
    reopened = history.filter(F.col("version") == 1).join(rebuilt, key, "left_semi").withColumns({"effective_to": _open_end(), "is_current": F.lit(1)})
    every = fresh.unionByName(known.join(rebuilt, key, "left_semi"))
    after, log = scd2_apply(untouched.unionByName(reopened), every, key, tracked, at, tie_break)
    return after, log, rebuilt


def scd2_late(history: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str) -> DataFrame:
    """The rows of `changes` that `scd2_apply` leaves out because they are not later than the current version.

    A change that gives the values which were valid at its time, be it a replay or without effect from the start, is not
    late. Late changes can be kept, or be applied by `scd2_splice`.
    """
    tracked = [c for c in tracked if c in changes.columns]
    since = scd_current(history).select(F.col(key).alias("_key"), F.col("effective_from").alias("_since"))
    moment = F.col(at).cast("timestamp")
    late = changes.join(since, (F.col(key) == F.col("_key")) & (moment <= F.col("_since")), "left_semi")
    placed = scd_join_as_of(late, history, key, at, "_version")
    held = history.select(
        F.col(key).alias("_key"), F.col("version").alias("_of"), *[F.col(c).cast("string").alias(f"_{c}") for c in tracked])
    valid = (F.col(key) == F.col("_key")) & (F.col("_version") == F.col("_of"))
    for c in tracked:
        valid &= F.col(c).isNull() | F.col(c).cast("string").eqNullSafe(F.col(f"_{c}"))
    return placed.join(held, valid, "left_anti").drop("_version")


def scd_history(history: DataFrame, key: str, value) -> DataFrame:
    """All versions of one key in order."""
    return history.filter(F.col(key) == F.lit(value)).orderBy("version")


def scd_current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current") == 1)


def scd_as_of(history: DataFrame, at: Column | dt.datetime | str) -> DataFrame:
    """The versions that were valid at a point in time."""
    at = at if isinstance(at, Column) else F.lit(at)
    return history.filter((F.col("effective_from") <= at) & (at < F.col("effective_to")))


def scd_join_as_of(facts: DataFrame, history: DataFrame, key: str, at: str, out: str = "version") -> DataFrame:
    """Facts with the version that was valid at their time; NULL before the first one, without a key and without a time.

    The versions of a key are cut into slices of SLICE by their number, which rises with their time as in all histories of
    this module. A slice is one row with the time it begins and the time the next one does, so that one slice at most fits a
    fact. Facts are shuffled once, on their key, and not sorted as a whole; the slices of a key with many facts go to as many
    tasks as its facts are split into. Within the slice the version is the last one that begins in time.
    """
    begins, number = F.col("effective_from"), F.col("version").cast("int")
    slices = (
        history.filter(F.col(key).isNotNull() & begins.isNotNull())
        .groupBy(F.col(key).alias("_key"), F.floor(number / SLICE).alias("_slice"))
        .agg(F.min(begins).alias("_first"), F.collect_set(F.struct(begins.alias("begins"), number.alias("number"))).alias("_starts"))
    )
    following = F.lead("_first").over(Window.partitionBy("_key").orderBy("_slice"))  # one row a slice
    slices = slices.withColumn("_until", following)
    fact = F.col("_fact")
    moment = fact[at].cast("timestamp")
    fits = (fact[key] == F.col("_key")) & (moment >= F.col("_first")) & (F.col("_until").isNull() | (moment < F.col("_until")))
    placed = facts.select(F.struct(*facts.columns).alias("_fact")).join(slices, fits, "left")
    last = F.array_max(F.filter("_starts", lambda start: start["begins"] <= moment))
    return placed.select("_fact.*", last["number"].alias(out))


def scd1_apply(dim: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str) -> DataFrame:
    """Type 1: overwrite with the latest non-NULL value of each column; unknown keys are ignored."""
    given = [c for c in tracked if c in changes.columns]
    latest = changes.groupBy(key).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(at), F.col(c)))).alias(f"_{c}") for c in given])
    joined = dim.join(latest, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in given}).select(*dim.columns)


def scd3_apply(dim: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str) -> DataFrame:
    """Type 3: overwrite, and keep the value before in `previous_<column>`."""
    after = scd1_apply(dim, changes, key, tracked, at)
    before = dim.select(key, *[F.col(c).alias(f"_{c}") for c in tracked])
    had = {f"previous_{c}" for c in tracked} & set(dim.columns)
    joined = after.join(before, key)
    return joined.withColumns({
        f"previous_{c}": F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.col(f"_{c}")).otherwise(
            F.col(f"previous_{c}") if f"previous_{c}" in had else F.lit(None))
        for c in tracked
    }).drop(*[f"_{c}" for c in tracked])

"""Maintain a Type-2 dimension from a batch of new snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions.fingerprint import fingerprint
from annalist.operators.conform import one_row_per_day
from annalist.operators.keys import dense_keys
from annalist.operators.versions import build_versions, versions_from_states
from annalist.sources.scratch import materialize, materialize_counting
from annalist.spec import EntitySpec

_VERSION_COLUMNS = ("effective_start_date", "effective_end_date", "is_current", "hash_diff", "last_seen_date")


def late_keys(dim: DataFrame, batch: DataFrame, spec: EntitySpec) -> DataFrame:
    """Entities for which the batch holds a day on or before the last day already seen.

    One pre-aggregated pass over the open versions and the batch, keys and dates only.
    """
    known = dim.filter("is_current").select(
        spec.key, F.col("last_seen_date").alias("_known"), F.lit(None).cast("date").alias("_new")
    )
    fresh = batch.select(
        spec.key, F.lit(None).cast("date").alias("_known"), F.col(spec.date).alias("_new")
    )
    spans = (
        known.unionByName(fresh)
        .groupBy(spec.key)
        .agg(F.max("_known").alias("_known"), F.min("_new").alias("_new"))
    )
    return spans.filter(F.col("_new") <= F.col("_known")).select(spec.key)


def _rekeyed(changed: DataFrame, known: DataFrame, spec: EntitySpec, sk: str, highest: int) -> DataFrame:
    """``changed`` with the keys its versions had in ``known``; new versions get keys above ``highest``."""
    where = [spec.key, "effective_start_date"]
    changed = materialize(changed.join(known.select(*where, sk), where, "left"), "changed")
    fresh = dense_keys(changed.where(F.col(sk).isNull()).drop(sk), where, sk)
    return changed.where(F.col(sk).isNotNull()).unionByName(fresh.withColumn(sk, F.col(sk) + highest))


def batch_versions(
    opened: DataFrame, batch: DataFrame, spec: EntitySpec, history: DataFrame | None = None, conformed: bool = False
) -> tuple[DataFrame, DataFrame, int]:
    """What the versions of a batch's entities are afterwards, the late entities, and their number.

    ``opened`` holds the open versions before the batch, of its entities at least, with
    ``last_seen_date``; ``batch`` one row per entity and day.  For an entity whose new days all follow
    the last day seen these are its open version, now perhaps closed, and the ones after it; for a late
    one (listed by ``late_keys``) all its versions, rebuilt from ``history``, the snapshots including
    the batch.  ``conformed``: it has one row per entity and day already, so only what versions are built
    from is moved, and once.

    The late entities are listed first, by one small job.  Without any, which is the usual case, the
    history is not read.
    """
    late, count = materialize_counting(late_keys(opened, batch, spec), "late", "true")
    if count and history is None:
        raise ValueError("the batch has late entities; pass the snapshot history to rebuild them")
    # An open version may show values taken from several of its days, so it takes part by
    # its stored fingerprint, not by one computed from what it shows.
    digest = fingerprint(
        [F.col(c) for c in spec.tracked], spec.separator, spec.null_safe, spec.missing
    )
    seeds = opened.join(batch.select(spec.key).distinct(), spec.key, "left_semi").select(
        F.col(spec.key),
        F.col("effective_start_date").alias("_day"),
        F.col("last_seen_date").alias("_seen"),
        F.struct(*spec.tracked).alias("_now"),
        F.col("hash_diff").alias("_hash"),
    )
    fresh = batch.select(
        F.col(spec.key),
        F.col(spec.date).alias("_day"),
        F.col(spec.date).alias("_seen"),
        F.struct(*spec.tracked).alias("_now"),
        digest.alias("_hash"),
    )
    states = seeds.unionByName(fresh)
    if count:
        states = states.join(late, spec.key, "left_anti")
    changed = versions_from_states(states, spec, with_last_seen=True)
    if count:
        again = history.join(late, spec.key, "left_semi")
        again = again if conformed else one_row_per_day(again, spec)
        changed = changed.unionByName(build_versions(again, spec, with_last_seen=True))
    return changed, late, count


def apply_batch(
    dim: DataFrame,
    batch: DataFrame,
    spec: EntitySpec,
    history: DataFrame | None = None,
    sk: str | None = None,
    highest: int | None = None,
    conformed: bool = False,
) -> DataFrame:
    """The dimension after ``batch``, equal to a full build over all snapshots so far.

    ``dim`` must carry ``last_seen_date``.  Entities whose new days all follow the last day
    seen are extended: their open version becomes a seed row in front of the new days.
    Entities with late days or corrections are rebuilt from ``history``, the snapshots
    including the batch (see ``batch_versions`` for ``conformed``).  Closed versions of the others, and the open versions of entities
    that are not in the batch, pass through untouched.

    ``sk`` names the surrogate key of ``dim``, if it has one.  A version that stays, by entity and
    start, keeps its key; a new one gets the next number above the highest, so keys of the
    published dimension never move.  Where ``dim`` is only a part of the dimension, ``highest`` is
    the highest key of all.

    The late entities are listed first, by one small job.  Without any, which is the usual
    case, the history is not read.  Whether a list of entities is broadcast is left to Spark's
    measured sizes.  Without ``history`` the batch must contain no late entity.
    """
    if "last_seen_date" not in dim.columns:
        raise ValueError("the dimension needs last_seen_date to be maintained incrementally")
    columns = dim.columns
    other = set(columns) - {spec.key, *spec.tracked, *_VERSION_COLUMNS, sk}
    if other:
        raise ValueError(f"the dimension has columns that no snapshot gives: {sorted(other)}")
    batch = one_row_per_day(batch, spec)
    present = batch.select(spec.key).distinct()
    opened = dim.filter("is_current")
    moving = opened.join(present, spec.key, "left_semi")
    kept = dim.filter(~F.col("is_current"))
    changed, late, count = batch_versions(opened, batch, spec, history, conformed)
    known = moving
    if count:
        known = known.unionByName(kept.join(late, spec.key, "left_semi"))
        kept = kept.join(late, spec.key, "left_anti")
    if sk:
        if highest is None:
            highest = dim.agg(F.max(sk)).first()[0] or 0
        changed = _rekeyed(changed, known, spec, sk, highest)
    untouched = opened.join(present, spec.key, "left_anti")
    return kept.unionByName(untouched).select(*columns).unionByName(changed.select(*columns))

"""Queries answered by intervals: headcount by day, overlapping versions, people below a manager."""

from __future__ import annotations

from pyspark.sql import functions as F

from annalist.operators import intervals, sweeps
from annalist.plans import inputs, oracle
from annalist.plans.history import PEOPLE_SNAP, people_snapshot, people_versions
from annalist.plans.inputs import PEOPLE_SPEC
from annalist.plans.registry import query

_DIM = oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC), "hi AS (SELECT max(snapshot_date) AS last FROM people)")
_DAYS = (
    "FROM (SELECT unnest(generate_series(lo, last, INTERVAL 1 DAY))::DATE AS date{by} FROM (SELECT {by_first}min(effective_start_date) AS lo"
    " FROM dim WHERE status = 'active' {group}), hi) c JOIN dim d ON d.status = 'active' AND c.date BETWEEN d.effective_start_date AND"
    " d.effective_end_date{match}"
)


def _last_day(spark, sf_dir):
    return F.lit(people_snapshot(spark, sf_dir).agg(F.max("snapshot_date")).first()[0])


@query(
    _DIM + "SELECT c.date, count(*) FILTER (WHERE d.employee_id IS NOT NULL) AS headcount "
    + _DAYS.format(by="", by_first="", group="", match="").replace(" c JOIN", " c LEFT JOIN") + " GROUP BY c.date"
)
def headcount_from_versions(spark, sf_dir):
    """Active employees on every day of the calendar, missing days bridged, from the ends of versions."""
    dim = people_versions(spark, sf_dir)
    return sweeps.headcount_from_versions(dim, F.col("status") == "active", _last_day(spark, sf_dir))


@query(
    _DIM + "SELECT c.date, c.work_mode, count(*) FILTER (WHERE d.employee_id IS NOT NULL) AS headcount "
    + _DAYS.format(by=", work_mode", by_first="work_mode, ", group="GROUP BY work_mode", match=" AND d.work_mode = c.work_mode").replace(" c JOIN", " c LEFT JOIN")
    + " GROUP BY c.date, c.work_mode"
)
def headcount_from_versions_by_mode(spark, sf_dir):
    dim = people_versions(spark, sf_dir)
    return sweeps.headcount_from_versions(dim, F.col("status") == "active", _last_day(spark, sf_dir), ["work_mode"])


#: Spells that overlap as those of a damaged dimension do: each order lasts some weeks.
_SPELLS = {
    "employee_id": "o_custkey",
    "effective_start_date": "CAST(o_orderdate AS DATE)",
    "effective_end_date": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT)",
}


@query(
    "WITH spells AS (SELECT o_orderkey, " + ", ".join(f"{e} AS {n}" for n, e in _SPELLS.items()) + " FROM orders)"
    " SELECT a.employee_id, max(m) AS versions, count(*) AS overlapping_pairs FROM spells a JOIN spells b ON a.employee_id = b.employee_id AND"
    " a.o_orderkey < b.o_orderkey AND a.effective_start_date <= b.effective_end_date AND b.effective_start_date <= a.effective_end_date"
    " JOIN (SELECT employee_id, count(*) AS m FROM spells GROUP BY 1) c ON c.employee_id = a.employee_id GROUP BY a.employee_id"
)
def overlapping_pairs(spark, sf_dir):
    orders = inputs.read(spark, sf_dir, "orders")
    return sweeps.overlapping_pairs(orders.selectExpr(*[f"{e} AS {n}" for n, e in _SPELLS.items()]), "employee_id")


# The forest: the smallest member of a cycle loses the edge above it.
_FOREST = f"""WITH RECURSIVE edges AS ({inputs.CYCLIC_EDGES_SQL}), reach AS (
  SELECT employee_id AS node, manager_id AS spot, least(employee_id, manager_id) AS low, 1 AS steps FROM edges
  UNION SELECT r.node, e.manager_id, least(r.low, e.manager_id), r.steps + 1 FROM reach r JOIN edges e ON e.employee_id = r.spot
  WHERE r.spot <> r.node AND r.steps <= (SELECT count(*) FROM edges)
), tops AS (SELECT DISTINCT node FROM reach WHERE spot = node AND low = node),
everyone AS (SELECT employee_id AS node FROM edges UNION SELECT manager_id FROM edges),
forest AS (SELECT employee_id AS node, manager_id AS parent FROM edges WHERE employee_id NOT IN (SELECT node FROM tops)),
pairs AS (
  SELECT parent AS top, node, 1 AS levels FROM forest UNION ALL SELECT p.top, f.node, p.levels + 1 FROM pairs p JOIN forest f ON f.parent = p.node
), people AS (
  SELECT e.node, coalesce((SELECT max(levels) FROM pairs p WHERE p.node = e.node), 0)::BIGINT AS level,
    (SELECT count(*) FROM pairs p WHERE p.top = e.node) AS people_below, e.node IN (SELECT node FROM tops) AS top_of_cycle FROM everyone e
) """


def _intervals(spark, sf_dir):
    return intervals.subtree_intervals(inputs.cyclic_edges(spark, sf_dir), "employee_id", "manager_id")


@query(_FOREST + "SELECT node, level, people_below, top_of_cycle FROM people")
def subtree_intervals(spark, sf_dir):
    """Level and number of people below everyone, on a feed full of cycles."""
    below = F.floor((F.col("leave") - F.col("enter") - 1) / 2).alias("people_below")
    return _intervals(spark, sf_dir).select("node", "level", below, F.col("cycle").isNotNull().alias("top_of_cycle"))


@query(
    _FOREST + "SELECT top, node, levels::BIGINT AS levels FROM pairs WHERE top = (SELECT node FROM people WHERE level > 0 ORDER BY people_below DESC, node LIMIT 1)"
)
def people_below(spark, sf_dir):
    """Everyone below the manager with the most people under them that has a manager, too; a range of the walk."""
    found = _intervals(spark, sf_dir)
    size = F.col("leave") - F.col("enter")
    top = found.where("level > 0").orderBy(size.desc(), "node").first()
    rows = intervals.below(found, top["enter"], top["leave"])
    return rows.select(F.lit(top["node"]).cast("long").alias("top"), "node", (F.col("level") - top["level"]).alias("levels"))

"""Hold rows back until the runs they depend on are complete.

``deps`` is configuration: table -> prerequisites. ``run_log`` has (table_name, run_date, status).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from graphlib import CycleError, TopologicalSorter
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.session import new_run_dir

# The condition name and the status of a finished run.
SNAPSHOT_PREVIOUS_DAY = "snapshot_previous_day"
COMPLETE = "SUCCESS"

#: A run of the same day; tables may not wait for each other in a circle of it.
SAME_DAY = "same_day"
#: How many days before the wanted run the required one lies.
DAYS_BACK = {SNAPSHOT_PREVIOUS_DAY: 1, SAME_DAY: 0}


def normalise(deps: Mapping[str, Sequence]) -> list[tuple[str, str, str]]:
    """(table, condition, required table) triples; a bare condition name requires the table itself.

    A circle of tables that require each other on the same day can never start and is an error.
    """
    triples = []
    for table, conditions in deps.items():
        for item in conditions or ():
            condition, requires = (item, table) if isinstance(item, str) else (item["condition"], item["requires"])
            if condition not in DAYS_BACK:
                raise ValueError(f"unknown dependency condition: {condition}")
            triples.append((table, condition, requires))
    same_day = TopologicalSorter()
    for table, condition, requires in triples:
        if not DAYS_BACK[condition]:
            same_day.add(table, requires)
    try:
        same_day.prepare()
    except CycleError as error:
        raise ValueError(f"tables require each other on the same day: {' > '.join(error.args[1][::-1])}") from None
    return triples


def completed_runs(run_log: DataFrame) -> DataFrame:
    """Finished (table, day) pairs, once each."""
    return (
        run_log.where(F.col("status") == COMPLETE)
        .select(F.col("table_name").alias("done_table"), F.col("run_date").alias("done_date"))
        .distinct()
    )


def required_runs(wanted: DataFrame, deps: Mapping[str, Sequence]) -> DataFrame:
    """Prerequisites of the wanted (table_name, run_date) pairs.

    The configuration is a literal array, so each pair looks its prerequisites up without a join.
    """
    triples = normalise(deps)
    pairs = wanted.select("table_name", "run_date").distinct()
    entries = "array<struct<t:string,condition:string,requires:string,back:int>>"
    literal = (
        F.array(
            *[
                F.struct(F.lit(t).alias("t"), F.lit(c).alias("condition"), F.lit(r).alias("requires"), F.lit(DAYS_BACK[c]).alias("back"))
                for t, c, r in triples
            ]
        )
        if triples
        else F.array().cast(entries)
    )
    mine = F.filter(literal, lambda d: d["t"] == F.col("table_name"))
    return (
        pairs.withColumn("_dep", F.explode(mine))
        .select(
            "table_name",
            "run_date",
            F.col("_dep.condition").alias("condition"),
            F.col("_dep.requires").alias("requires"),
            F.date_sub("run_date", F.col("_dep.back")).alias("required_date"),
        )
    )


def unmet(wanted: DataFrame, deps: Mapping[str, Sequence], run_log: DataFrame) -> DataFrame:
    """Prerequisites that no finished run meets; empty means all wanted runs may start."""
    done = completed_runs(run_log)
    condition = (F.col("requires") == F.col("done_table")) & (F.col("required_date") == F.col("done_date"))
    return required_runs(wanted, deps).join(done, condition, "left_anti")


def met(wanted: DataFrame, deps: Mapping[str, Sequence], run_log: DataFrame) -> DataFrame:
    """Prerequisites met by a finished run."""
    done = completed_runs(run_log)
    condition = (F.col("requires") == F.col("done_table")) & (F.col("required_date") == F.col("done_date"))
    return required_runs(wanted, deps).join(done, condition, "left_semi")


def unmet_chain(
    wanted: DataFrame, deps: Mapping[str, Sequence], run_log: DataFrame, since: str | None = None
) -> DataFrame:
    """All unfinished runs that the wanted ones wait for, however many steps away.

    (table_name, run_date) of the wanted run, (requires, required_date) of the unfinished one, ``steps`` between them, and ``path``:
    ``table@day`` of each run on the way, joined by `` > ``; of several ways the shortest, of those the least text. Behind a
    finished run nothing is looked for, nor behind one before ``since`` (a day; else the first finished day of the log), which is
    itself listed. A wanted run without a date has unmet prerequisites without a date.

    A breadth-first search: what each step finds is written, and the next one starts from the runs that no earlier
    step has found. So each pair of runs is followed once, where listing all ways would double with every fork, and a lost executor
    costs one step. Days go back and same-day circles are errors, so it ends after at most tables times days steps.
    """
    spark = wanted.sparkSession
    root = new_run_dir(spark, "unmet-chain")
    done = completed_runs(run_log)
    first = F.lit(since).cast("date") if since is not None else F.lit(done.agg(F.min("done_date")).first()[0]).cast("date")
    pair = ("_from_table", "_from_date")
    found = pair + ("requires", "required_date")

    def step(number: int, open_runs: DataFrame) -> DataFrame:
        """Unmet prerequisites of ``open_runs`` (wanted pair, table_name, run_date, path), written."""
        need = required_runs(open_runs, deps)
        met_by = (F.col("requires") == F.col("done_table")) & (F.col("required_date") == F.col("done_date"))
        need = need.join(done, met_by, "left_anti").select(
            F.col("table_name").alias("_t"), F.col("run_date").alias("_d"), "requires", "required_date"
        )
        same = F.col("table_name").eqNullSafe(F.col("_t")) & F.col("run_date").eqNullSafe(F.col("_d"))
        longer = F.concat("path", F.lit(" > "), _run_name("requires", "required_date"))
        new = open_runs.join(need.distinct(), same).select(*pair, "requires", "required_date", longer.alias("path"))
        new = new.groupBy(*found).agg(F.min("path").alias("path"))
        if number > 1:
            before = spark.read.parquet(*[f"{root}/{n}" for n in range(1, number)]).select(*[F.col(c).alias(f"_s{c}") for c in found])
            seen = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in found])
            new = new.join(before, seen, "left_anti")
        new.withColumn("steps", F.lit(number)).write.parquet(f"{root}/{number}")
        return spark.read.parquet(f"{root}/{number}")

    at = wanted.select("table_name", "run_date").distinct()
    open_runs = at.select(
        F.col("table_name").alias("_from_table"), F.col("run_date").alias("_from_date"), "table_name", "run_date",
        _run_name("table_name", "run_date").alias("path"),
    )
    number = 0
    while number == 0 or not open_runs.isEmpty():
        number += 1
        rows = step(number, open_runs)
        open_runs = rows.where(F.col("required_date") >= first).select(
            *pair, F.col("requires").alias("table_name"), F.col("required_date").alias("run_date"), "path"
        )
    rows = spark.read.parquet(*[f"{root}/{n}" for n in range(1, number + 1)])
    return rows.select(
        F.col("_from_table").alias("table_name"), F.col("_from_date").alias("run_date"), "requires", "required_date", "steps", "path"
    )


def _run_name(table: str, day: str) -> Column:
    return F.concat(F.coalesce(table, F.lit("?")), F.lit("@"), F.coalesce(F.col(day).cast("string"), F.lit("?")))


def _blocked(rows: DataFrame, deps: Mapping[str, Sequence], run_log: DataFrame) -> DataFrame:
    return (
        unmet(rows, deps, run_log)
        .select(F.col("table_name").alias("_b_table"), F.col("run_date").alias("_b_date"))
        .distinct()
    )


def _is_blocked() -> Column:
    return F.col("table_name").eqNullSafe(F.col("_b_table")) & F.col("run_date").eqNullSafe(F.col("_b_date"))


def gate(rows: DataFrame, deps: Mapping[str, Sequence], run_log: DataFrame) -> DataFrame:
    """Rows (with ``table_name`` and ``run_date``) whose prerequisites are all met.

    The gate fails closed: a row of a gated table without a date has a prerequisite that no run meets. The blocked side
    holds one row per table and day; Spark broadcasts it if it is small enough, and splits a busy table and day
    otherwise. ``rows`` is read twice, so it should be a table, not a computation.
    """
    return rows.join(_blocked(rows, deps, run_log), _is_blocked(), "left_anti")


def held_back(rows: DataFrame, deps: Mapping[str, Sequence], run_log: DataFrame) -> DataFrame:
    """The rows that ``gate`` does not pass."""
    return rows.join(_blocked(rows, deps, run_log), _is_blocked(), "left_semi")

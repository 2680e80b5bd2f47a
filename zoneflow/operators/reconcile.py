"""Compare target records with a legacy snapshot.

Both sides are first reduced to distinct value sets with their row counts (map-side combine), so
copies of one record are compared once however many there are. Snapshot column names must be
mapped to target names before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.text import differs, fingerprint, stable_id
from zoneflow.operators.limits import limit_per_group
from zoneflow.operators.skew import DEFAULT_SKEW, SkewPlan, skew_join
from zoneflow.session import new_run_dir
from zoneflow.sources.snapshots import variant_columns, variant_text

SAMPLE_LIMIT = 5  # fixed value: mismatch samples kept per result


def compared_columns(records: DataFrame, snapshot: DataFrame, id_column: str) -> list[str]:
    """Columns of either side in order, without the id and without ``_`` metadata columns."""
    names = dict.fromkeys([*records.columns, *snapshot.columns])
    return [c for c in names if c != id_column and not c.startswith("_")]


def _as_text(df: DataFrame, id_column: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(id_column).cast("string").alias(id_column)] + [
        (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in columns
    ]


def variants(
    df: DataFrame, id_column: str, columns: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Distinct (id, carried columns, values as text) with their number of rows ``_n``."""
    return (
        df.select(*carry, *_as_text(df, id_column, columns))
        .groupBy(id_column, *carry, *columns)
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _ids(df: DataFrame, id_column: str, alias: str, within: Sequence[str] = ()) -> DataFrame:
    """Just the join keys of all rows: hot ids are looked for here, before anything is grouped."""
    return df.select(F.col(id_column).cast("string").alias(alias), *within)


def snapshot_counts(snapshot: DataFrame, id_column: str, within: Sequence[str] = ()) -> DataFrame:
    return (
        snapshot.select(F.col(id_column).cast("string").alias(id_column), *within)
        .where(F.col(id_column).isNotNull())
        .groupBy(id_column, *within)
        .agg(F.count(F.lit(1)).alias("aws_count"))
    )


def match_counts(
    records: DataFrame,
    snapshot: DataFrame,
    id_column: str = "record_id",
    *,
    spread_by: Column,
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """Each record with ``gcp_count`` (1), ``aws_count`` (snapshot rows of its id) and ``count_match``.

    The snapshot side is one row per id. Records of a hot id are spread by ``spread_by``, which
    must differ between them.
    """
    counts = snapshot_counts(snapshot, id_column).withColumnRenamed(id_column, "_id")
    keyed = records.withColumn("_id", F.col(id_column).cast("string"))
    joined = skew_join(keyed, counts, ["_id"], "left", spread_by=spread_by, plan=skew).drop("_id")
    aws = F.coalesce(F.col("aws_count"), F.lit(0).cast("bigint"))
    return joined.withColumns({"gcp_count": F.lit(1).cast("bigint"), "aws_count": aws}).withColumn(
        "count_match", F.col("gcp_count") == F.col("aws_count")
    )


def variant_counts(
    records: DataFrame,
    snapshot: DataFrame,
    id_column: str = "record_id",
    carry: Sequence[str] = (),
    within: Sequence[str] = (),
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """``match_counts`` summed per id (and the other columns), for totals and logs.

    ``within`` are columns of both sides that must be equal, such as the zone; ``carry`` are record
    columns to keep apart, such as the window. Both sides are reduced to one row per id before the
    join; only an id with very many carried values can be hot, and those rows are spread.
    """
    keys = [id_column, *within]
    per_id = (
        records.select(F.col(id_column).cast("string").alias(id_column), *within, *carry)
        .groupBy(*keys, *carry)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = snapshot_counts(snapshot, id_column, within)
    joined = skew_join(
        per_id,
        counts,
        keys,
        "left",
        spread_by=F.xxhash64(id_column, *carry),
        plan=skew if carry else None,
        look_at=_ids(records, id_column, id_column, within),
    )
    found = F.coalesce(F.col("aws_count"), F.lit(0).cast("bigint"))
    return joined.select(
        *keys,
        *carry,
        F.col("_n").alias("gcp_count"),
        (F.col("_n") * found).alias("aws_count"),
        (found == 1).alias("count_match"),
        F.col("_n").alias("n_records"),
    )


def mismatch_columns(columns: Sequence[str], left: str = "g", right: str = "a") -> Column:
    """Comma-joined sorted names of the columns whose text differs."""
    bad = [F.when(differs(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")), F.lit(c)) for c in sorted(columns)]
    return F.concat_ws(",", *bad)


def column_diff(
    records: DataFrame,
    snapshot: DataFrame,
    id_column: str = "record_id",
    columns: Sequence[str] | None = None,
    carry: Sequence[str] = (),
    within: Sequence[str] = (),
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """Mismatches as (id, ``columns``, ``pairs``): how many record/snapshot pairs differ in these columns.

    Equal pairs give no row. Only distinct value sets are paired, so a repeated record costs one
    comparison per distinct snapshot version of its id. ``within`` and ``carry`` are as above.
    """
    names = list(columns) if columns is not None else compared_columns(records, snapshot, id_column)
    keys = ["_id", *within]
    ours = variants(records, id_column, names, [*within, *carry]).select(
        F.col(id_column).alias("_id"), *within, *carry, F.struct(*names, "_n").alias("g")
    )
    theirs = variants(snapshot, id_column, names, within).select(
        F.col(id_column).alias("_id"), *within, F.struct(*names, "_n").alias("a")
    )
    pairs = skew_join(
        ours.where(F.col("_id").isNotNull()),
        theirs,
        keys,
        "inner",
        spread_by=F.xxhash64("g", *carry),
        spread_right_by=F.xxhash64("a"),
        plan=skew,
        look_at=_ids(records, id_column, "_id", within),
        look_at_right=_ids(snapshot, id_column, "_id", within),
    )
    return (
        pairs.select(
            F.col("_id").alias(id_column),
            *within,
            *carry,
            mismatch_columns(names).alias("columns"),
            (F.col("g._n") * F.col("a._n")).alias("pairs"),
        )
        .where(F.col("columns") != "")
        .groupBy(id_column, *within, *carry, "columns")
        .agg(F.sum("pairs").cast("bigint").alias("pairs"))
    )


# -- hash tree -------------------------------------------------------------------------------------------------------

#: Bits of a key's hash by level, from the root's children to the leaves.
TREE_LEVELS = (6, 12, 18)
_DIGEST = ("_rows", "_s0", "_s1", "_s2", "_s3")


def key_range(id_column: str, bits: int) -> Column:
    """The leaf of a key: the upper bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_column).cast("string")), 64 - bits)


def range_digests(
    df: DataFrame, id_column: str, columns: Sequence[str], levels: Sequence[int] = TREE_LEVELS
) -> DataFrame:
    """(``_range``, row count and four sums) for each leaf that has rows; at most ``2 ** levels[-1]`` rows.

    The sums are over the four words of the rows' fingerprints, so neither order nor partitioning matters, and those of a
    range are the sums over the ranges in it. One pass with map-side combine; the result may be kept beside a snapshot
    that does not change.
    """
    mark = fingerprint(_as_text(df, id_column, columns))
    words = [F.conv(F.substring("_mark", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    rows = df.where(F.col(id_column).isNotNull()).select(key_range(id_column, levels[-1]).alias("_range"), mark.alias("_mark"))
    return rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(w).alias(f"_s{i}") for i, w in enumerate(words)])


def differing_ranges(ours: DataFrame, theirs: DataFrame, levels: Sequence[int] = TREE_LEVELS) -> DataFrame:
    """(``_range``): leaves whose digests differ, found from the root down; below a range that is equal nothing is compared."""

    def at(side: DataFrame, bits: int) -> DataFrame:
        place = F.shiftright("_range", levels[-1] - bits)
        return side.groupBy(place.alias("_range")).agg(*[F.sum(c).alias(c) for c in _DIGEST])

    open_ranges = None
    for above, bits in zip((0, *levels), levels):
        sides = []
        for side, name in ((ours, "g"), (theirs, "a")):
            level = at(side, bits)
            if open_ranges is not None:
                parent = F.shiftright("_range", bits - above)
                level = level.join(F.broadcast(open_ranges.withColumnRenamed("_range", "_parent")), parent == F.col("_parent"), "left_semi")
            sides.append(level.select("_range", F.struct(*_DIGEST).alias(name)))
        met = sides[0].join(sides[1], "_range", "full_outer")
        open_ranges = met.where(~F.col("g").eqNullSafe(F.col("a"))).select("_range")
    return open_ranges


def hash_tree_diff(
    records: DataFrame,
    snapshot: DataFrame,
    id_column: str = "record_id",
    columns: Sequence[str] | None = None,
    levels: Sequence[int] = TREE_LEVELS,
    our_digests: DataFrame | None = None,
    their_digests: DataFrame | None = None,
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """``column_diff`` that joins only key ranges in which the sides differ.

    Both sides are summed up by key range without moving their rows; digests kept from before spare even that. Rows of equal
    ranges are left out before anything is shuffled. An id that has the same several rows on both sides, in
    a range that is equal, counts as equal here, while ``column_diff`` pairs its rows crosswise.
    """
    names = list(columns) if columns is not None else compared_columns(records, snapshot, id_column)
    spark = records.sparkSession

    def kept(digests: DataFrame, name: str) -> DataFrame:
        path = new_run_dir(spark, name)
        digests.write.parquet(path)
        return spark.read.schema(digests.schema).parquet(path)

    ours = our_digests if our_digests is not None else kept(range_digests(records, id_column, names, levels), "digests-ours")
    theirs = their_digests if their_digests is not None else kept(range_digests(snapshot, id_column, names, levels), "digests-theirs")
    open_ranges = kept(differing_ranges(ours, theirs, levels), "open-ranges")

    def within(side: DataFrame) -> DataFrame:
        place = key_range(id_column, levels[-1])
        listed = open_ranges.withColumnRenamed("_range", "_open_range")
        return side.join(F.broadcast(listed), place == F.col("_open_range"), "left_semi")

    return column_diff(within(records), within(snapshot), id_column, names, skew=skew)


def map_diff(ours: Column, theirs: Column) -> Column:
    """Comma-joined sorted names of differing keys of two ``map<string,string>`` rows.

    A key that one side lacks counts as null there; keys starting with ``_`` are left out.
    """
    names = F.array_sort(F.array_union(F.map_keys(ours), F.map_keys(theirs)))
    bad = F.filter(
        names,
        lambda k: ~k.startswith("_") & differs(F.try_element_at(ours, k), F.try_element_at(theirs, k)),
    )
    return F.array_join(bad, ",")


def map_column_diff(
    ours: DataFrame,
    theirs: DataFrame,
    id_column: str = "record_id",
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """``column_diff`` for rows in map form (id, ``row map<string,string>``) with open-ended keys."""
    left = _map_variants(ours, id_column, "g")
    right = _map_variants(theirs, id_column, "a")
    pairs = skew_join(
        left,
        right,
        ["_id"],
        "inner",
        spread_by=F.xxhash64("g"),
        spread_right_by=F.xxhash64("a"),
        plan=skew,
        look_at=_ids(ours, id_column, "_id"),
        look_at_right=_ids(theirs, id_column, "_id"),
    )
    diff = map_diff(F.map_from_entries("g"), F.map_from_entries("a"))
    return (
        pairs.select(F.col("_id").alias(id_column), diff.alias("columns"), (F.col("_n_g") * F.col("_n_a")).alias("pairs"))
        .where(F.col("columns") != "")
        .groupBy(id_column, "columns")
        .agg(F.sum("pairs").cast("bigint").alias("pairs"))
    )


def _map_variants(df: DataFrame, id_column: str, name: str) -> DataFrame:
    entries = F.array_sort(F.map_entries("row"))
    return (
        df.select(F.col(id_column).cast("string").alias("_id"), entries.alias(name))
        .where(F.col("_id").isNotNull())
        .groupBy("_id", name)
        .agg(F.count(F.lit(1)).alias(f"_n_{name}"))
    )


def variant_column_diff(
    ours: DataFrame,
    theirs: DataFrame,
    id_column: str = "record_id",
    renames: Mapping[str, str] | None = None,
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """``column_diff`` for rows of JSON objects (``row variant``) whose keys differ by row and are declared nowhere.

    The compared columns are all keys that a row of either side has, apart from the id and those that begin with ``_``; a key
    that a row lacks counts as null there. ``renames`` maps keys of ``theirs`` to ours. Each side is parsed once, into a table
    that both the search for keys and the comparison read. Keys never become column names, so any text may be one.
    """
    spark = ours.sparkSession
    sides = []
    for side, name in ((ours, "variant-ours"), (theirs, "variant-theirs")):
        path = new_run_dir(spark, name)
        side.select("row").write.parquet(path)
        sides.append(spark.read.schema("row variant").parquet(path))
    new = dict(renames or {})
    old = {target: key for key, target in new.items()}
    found = {*variant_columns(sides[0]), *(new.get(k, k) for k in variant_columns(sides[1]))}
    names = sorted(k for k in found if k != id_column and not k.startswith("_"))

    def reduced(side: DataFrame, keys: Mapping[str, str], name: str) -> DataFrame:
        values = F.array(*[variant_text(F.col("row"), keys.get(c, c)) for c in names]).cast("array<string>")
        own = variant_text(F.col("row"), keys.get(id_column, id_column))
        rows = side.select(own.alias("_id"), values.alias(name)).where(F.col("_id").isNotNull())
        return rows.groupBy("_id", name).agg(F.count(F.lit(1)).alias(f"_n_{name}"))

    def own_ids(side: DataFrame, keys: Mapping[str, str]) -> DataFrame:
        return side.select(variant_text(F.col("row"), keys.get(id_column, id_column)).alias("_id"))

    pairs = skew_join(
        reduced(sides[0], {}, "g"),
        reduced(sides[1], old, "a"),
        ["_id"],
        "inner",
        spread_by=F.xxhash64("g"),
        spread_right_by=F.xxhash64("a"),
        plan=skew,
        look_at=own_ids(sides[0], {}),
        look_at_right=own_ids(sides[1], old),
    )
    bad = [F.when(differs(F.get("g", F.lit(i)), F.get("a", F.lit(i))), F.lit(c)) for i, c in enumerate(names)]
    return (
        pairs.select(F.col("_id").alias(id_column), F.concat_ws(",", *bad).alias("columns"), (F.col("_n_g") * F.col("_n_a")).alias("pairs"))
        .where(F.col("columns") != "")
        .groupBy(id_column, "columns")
        .agg(F.sum("pairs").cast("bigint").alias("pairs"))
    )


def mismatch_samples(
    diffs: DataFrame,
    groups: Sequence[str],
    id_column: str = "record_id",
    limit: int = SAMPLE_LIMIT,
) -> DataFrame:
    """First ``limit`` mismatches per group as ``mismatch_samples``, ordered by id and columns.

    The limit is applied before the rows are collected into the array.
    """
    kept = limit_per_group(diffs, groups, [id_column, "columns"], limit)
    sample = F.struct(F.col(id_column).alias("record_id"), F.col("columns"))
    return kept.groupBy(*groups).agg(F.array_sort(F.collect_list(sample)).alias("mismatch_samples"))


def presence(records: DataFrame, snapshot: DataFrame, id_column: str = "record_id") -> DataFrame:
    """Ids of either side with ``n_target``, ``n_legacy`` and ``status``.

    A full outer comparison as one aggregate over both sides: one shuffle, counts combined before it.
    """
    ours = records.select(F.col(id_column).cast("string").alias(id_column), F.lit(1).alias("_t"), F.lit(0).alias("_l"))
    theirs = snapshot.select(F.col(id_column).cast("string").alias(id_column), F.lit(0).alias("_t"), F.lit(1).alias("_l"))
    status = (
        F.when(F.col("n_legacy") == 0, F.lit("only_target"))
        .when(F.col("n_target") == 0, F.lit("only_legacy"))
        .when(F.col("n_target") == F.col("n_legacy"), F.lit("matched"))
        .otherwise(F.lit("count_mismatch"))
    )
    return (
        ours.unionByName(theirs)
        .groupBy(id_column)
        .agg(F.sum("_t").alias("n_target"), F.sum("_l").alias("n_legacy"))
        .withColumn("status", status)
    )


def totals(counts: DataFrame) -> DataFrame:
    """Records that matched and records that did not, from ``variant_counts``."""
    matched = F.when(F.col("count_match"), F.col("n_records")).otherwise(0)
    return counts.agg(
        F.coalesce(F.sum(matched), F.lit(0)).alias("success_count"),
        F.coalesce(F.sum(F.col("n_records") - matched), F.lit(0)).alias("failure_count"),
    )


def reconcile_log(
    matched: DataFrame,
    diffs: DataFrame,
    groups: Mapping[str, Column],
    domain: str,
    id_column: str = "record_id",
    limit: int = SAMPLE_LIMIT,
) -> DataFrame:
    """Log rows per group: summed counts, whether every record matched, and mismatch samples.

    ``matched`` has ``gcp_count, aws_count, count_match`` and the group columns, ``diffs`` the id,
    ``columns`` and the group columns. Both sides are one row per group when they are joined.
    """
    names = list(groups)
    summed = matched.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        F.sum("gcp_count").alias("gcp_count"),
        F.sum("aws_count").alias("aws_count"),
        F.bool_and("count_match").alias("count_match"),
    )
    samples = mismatch_samples(diffs, names, id_column, limit).withColumnsRenamed({n: f"_s_{n}" for n in names})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_s_{n}")) for n in names])
    joined = summed.join(samples, same, "left").drop(*[f"_s_{n}" for n in names])
    empty = F.array().cast("array<struct<record_id:string,columns:string>>")
    return joined.withColumns(
        {
            "mismatch_samples": F.coalesce("mismatch_samples", empty),
            "reconcile_id": stable_id(F.lit(domain), *[F.col(n) for n in names]),
            "domain": F.lit(domain),
        }
    )

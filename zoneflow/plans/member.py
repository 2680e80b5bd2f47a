"""Member domain: refined and analytics transforms, used as hooks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.casts import to_double, to_long
from zoneflow.operators.cdc import DELETE
from zoneflow.operators.skew import skew_join
from zoneflow.plans.kpis import KpiStore, Measures


def order_totals(orders: DataFrame) -> DataFrame:
    """One row per customer: number of orders and exact total."""
    return orders.groupBy(F.col("o_custkey").cast("string").alias("_order_member")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("order_total"),
    )


def _spread(members: DataFrame) -> Column:
    """What tells the rows of one member apart: the notification if there is one."""
    names = [c for c in ("_notif_message_id", "record_id") if c in members.columns]
    return F.xxhash64(*names)


def refine_members(members: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame) -> DataFrame:
    """Members with nation, region, order totals and derived attributes; every member row stays.

    Orders are reduced to one row per customer before the join, and a member with very many rows
    is split. Nation and region are joined together first; Spark broadcasts that side if it is small enough, and
    splits a busy nation's rows otherwise.
    """
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("_nation"), F.col("n_name"), F.col("r_name")
    )
    keyed = members.withColumn("_order_member", F.col("record_id"))
    spent = skew_join(keyed, order_totals(orders), ["_order_member"], "left", spread_by=_spread(members))
    joined = spent.withColumn("_member_nation", to_long(F.col("nation_key"))).join(
        places, F.col("_member_nation") == F.col("_nation"), "left"
    )
    balance = to_double(F.col("balance"))
    amount = F.when(F.isnan(balance), None).otherwise(balance)
    has_domain = F.contains(F.col("email"), F.lit("@"))
    return joined.withColumns(
        {
            "nation_name": F.col("n_name"),
            "region_name": F.col("r_name"),
            "email_domain": F.when(has_domain, F.substring_index("email", "@", -1)),
            "balance_value": amount.cast("decimal(18,2)"),
            "is_active": F.col("_event_op") != DELETE,
            "n_orders": F.coalesce("n_orders", F.lit(0).cast("bigint")),
            "order_total": F.coalesce("order_total", F.lit(0).cast("decimal(18,2)")).cast("decimal(28,2)"),
        }
    ).drop("n_name", "r_name", "_nation", "_member_nation", "_order_member")


def member_kpis(refined: DataFrame) -> DataFrame:
    """Key figures per region."""
    return refined.groupBy(F.coalesce("region_name", F.lit("UNKNOWN")).alias("region_name")).agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if("is_active").alias("active_members"),
        F.count_if(F.col("email_domain").isNotNull()).alias("reachable_members"),
        F.sum("balance_value").cast("double").alias("total_balance"),
        F.sum("n_orders").alias("n_orders"),
        F.sum("order_total").cast("double").alias("order_total"),
    )


#: What ``member_kpis`` counts, as sums that changes can be added to and taken out of.
MEMBER_MEASURES = Measures(
    groups={"region_name": "coalesce(region_name, 'UNKNOWN')"},
    amounts={
        "members": "1",
        "active_members": "CASE WHEN is_active THEN 1 ELSE 0 END",
        "reachable_members": "CASE WHEN email_domain IS NOT NULL THEN 1 ELSE 0 END",
        "total_balance": "balance_value",
        "n_orders": "n_orders",
        "order_total": "order_total",
    },
)


def member_figures(store: KpiStore) -> DataFrame:
    """The maintained figures in the form of ``member_kpis``."""
    whole = ("members", "active_members", "reachable_members", "n_orders")
    return store.figures().withColumns(
        {n: F.col(n).cast("bigint" if n in whole else "double") for n in MEMBER_MEASURES.amounts}
    )

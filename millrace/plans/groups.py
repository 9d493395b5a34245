"""Conversion of communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import top_k


def group_conversion(
    groups: DataFrame, membership: DataFrame, events: DataFrame, dialogs: DataFrame,
    user_messages: DataFrame, oldest: int = 10,
) -> DataFrame:
    """For the oldest groups: users added, users who wrote, and their ratio, best first.

    The report's groups are chosen first (never more than ``oldest`` rows, hence the broadcast), so
    the large links are cut down before they are joined.
    """
    chosen = F.broadcast(
        top_k(groups, oldest, "registration_dt", "group_id").select("hk_group_id")
    )
    added = (
        membership.join(chosen, "hk_group_id", "left_semi")
        .join(events.filter(F.col("event") == "add").select("hk_l_user_group_activity"),
              "hk_l_user_group_activity", "left_semi")
        .groupBy("hk_group_id")
        .agg(F.count_distinct("hk_user_id").alias("cnt_added_users"))
    )
    wrote = (
        dialogs.join(chosen, "hk_group_id", "left_semi")
        .join(user_messages, "hk_message_id")
        .groupBy("hk_group_id")
        .agg(F.count_distinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )
    ratio = F.col("cnt_users_in_group_with_messages") / F.col("cnt_added_users")
    return (
        added.join(wrote, "hk_group_id", "left")
        .select("hk_group_id", "cnt_added_users", "cnt_users_in_group_with_messages",
                ratio.alias("group_conversion"))
        .orderBy(F.col("group_conversion").desc_nulls_last(), "hk_group_id")
    )

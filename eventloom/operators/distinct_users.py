"""Exact distinct users of any period from bitmaps.

Every user has a number; a team's users of a day are bits in chunks of 32,768
numbers.  The users of a period are the bits set on any of its days, so a count
over years reads one short row per team, day and chunk and no user rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# New users are numbered in so many parts at once.
_PARTS = 64


def new_numbers(users: DataFrame, known: DataFrame, parts: int = _PARTS) -> DataFrame:
    """(user_id, user_no) of the users that ``known`` does not hold.

    Users are dealt to parts by hash and numbered within them; numbers of the
    parts interleave, so they stay nearly dense.  The same users and parts give
    the same numbers, whatever task does the work.
    """
    unknown = users.select("user_id").distinct().join(known.select("user_id"), "user_id", "left_anti")
    first = known.agg(F.max("user_no")).first()[0] or 0
    part = F.pmod(F.xxhash64("user_id"), F.lit(parts))
    place = F.row_number().over(Window.partitionBy("part").orderBy("user_id")) - 1
    return unknown.withColumn("part", part).select(
        "user_id", (F.lit(first + 1) + place.cast("bigint") * parts + F.col("part")).alias("user_no"))


def number_users(users: DataFrame) -> DataFrame:
    """Numbers of all distinct users of a frame."""
    none = users.sparkSession.createDataFrame([], "user_id string, user_no bigint")
    return new_numbers(users, none)


def user_days(user_sum: DataFrame, numbers: DataFrame) -> DataFrame:
    """(summary_date, team_id, chunk, users): the bits of each team's users of a day."""
    bits = user_sum.select("summary_date", "team_id", "user_id").join(numbers, "user_id")
    return bits.groupBy(
        "summary_date", "team_id", F.bitmap_bucket_number("user_no").alias("chunk")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users"))


def user_counts(days: DataFrame, periods: Mapping[str, Column]) -> DataFrame:
    """One row: the distinct users over the days that meet each condition."""
    chunks = days.groupBy("chunk").agg(
        *[F.bitmap_or_agg(F.when(condition, F.col("users"))).alias(name)
          for name, condition in periods.items()])
    return chunks.agg(*[
        F.coalesce(F.sum(F.bitmap_count(name)), F.lit(0)).alias(name) for name in periods])

"""Reply threads to their roots (JN13 beyond one level): pointer doubling over the parent graph.

Every comment points to its parent in the same episode.  In round r a comment knows its
ancestor ``2^r`` levels up, if there is one, and how many comments lie fewer than ``2^r`` levels below
it.  A join with the ancestor's own pointer doubles the distance; the ancestor adds up what its
comments at that distance know.  ``log2(depth)`` rounds suffice; no comment meets all others of its thread.

Joins are on (episode, comment), the side of the pointers may repeat a key (a comment with very
many replies): adaptive execution splits it, the other side has each key once.  Sums are partial aggregates.

Defined results: a comment without a parent is a root at depth 0; one whose parent is not among the
episode's comments (or is NULL by id) is a root with ``lost_parent``; a comment on a cycle of
parents, or below one, has no root, depth or size and ``in_cycle``; of comments that repeat a key the smallest
row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castline.operators.maintain import first_rows
from castline.session import staged

col = F.col
KEY = ["episode_id", "platform_comment_id"]


def comment_thread_roots(comments: DataFrame) -> DataFrame:
    """``episode_id, platform_comment_id, root_comment_id, depth, replies, subtree_size, lost_parent, in_cycle``.

    ``replies`` counts direct replies, ``subtree_size`` the comment and all below it.
    """
    rows = first_rows(comments.where("platform_comment_id IS NOT NULL").select(*KEY, col("parent_platform_comment_id").alias("parent")), KEY)
    keys = rows.select(col("episode_id").alias("p_episode"), col("platform_comment_id").alias("p_id"))
    linked = rows.join(keys, (col("episode_id") == col("p_episode")) & (col("parent") == col("p_id")), "left").select(
        col("episode_id").alias("episode"), col("platform_comment_id").alias("id"), col("p_id").alias("up"),
        (col("parent").isNotNull() & col("p_id").isNull()).alias("lost"))
    # up: the ancestor at exactly `span` levels, or NULL; top, steps: the highest ancestor met so far; size: comments
    # fewer than `span` levels below, itself included.
    now = staged(linked.select("episode", "id", "up", F.coalesce("up", "id").alias("top"),
                               F.when(col("up").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.lit(1).cast("long").alias("size"),
                               "lost"), "threads")
    direct = now.where("up IS NOT NULL").groupBy(col("episode").alias("r_episode"), col("up").alias("r_id")).agg(
        F.count(F.lit(1)).alias("replies"))
    still = now.where("up IS NOT NULL").count()
    while still:
        below = now.where("up IS NOT NULL").groupBy(col("episode").alias("b_episode"), col("up").alias("b_id")).agg(
            F.sum("size").alias("more"))
        above = now.select(col("episode").alias("a_episode"), col("id").alias("a_id"), col("up").alias("a_up"), col("top").alias("a_top"),
                           col("steps").alias("a_steps"))
        now = staged(
            now.join(above, (col("episode") == col("a_episode")) & (col("up") == col("a_id")), "left")
            .join(below, (col("episode") == col("b_episode")) & (col("id") == col("b_id")), "left")
            .select("episode", "id", col("a_up").alias("up"), F.coalesce("a_top", "top").alias("top"),
                    (col("steps") + F.coalesce("a_steps", F.lit(0))).alias("steps"),
                    (col("size") + F.coalesce("more", F.lit(0))).alias("size"), "lost"), "threads")
        left = now.where("up IS NOT NULL").count()
        if left == still:       # depths have no gaps: who is still on the way after such a round never arrives
            break
        still = left
    ends = col("up").isNull()
    return now.join(direct, (col("episode") == col("r_episode")) & (col("id") == col("r_id")), "left").select(
        col("episode").alias("episode_id"), col("id").alias("platform_comment_id"),
        F.when(ends, col("top")).alias("root_comment_id"), F.when(ends, col("steps")).alias("depth"),
        F.coalesce("replies", F.lit(0)).alias("replies"), F.when(ends, col("size")).alias("subtree_size"),
        col("lost").alias("lost_parent"), (~ends).alias("in_cycle"))

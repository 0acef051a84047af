"""The team network: who played whom, over how many steps."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage
from .ranking import zip_with_index


def team_edges(matches: DataFrame) -> DataFrame:
    """Distinct directed edges first team → second team."""
    return matches.select("team_a_id", "team_b_id").distinct()


def team_network(matches: DataFrame) -> DataFrame:
    """The traversal query as its rules work out: direct edges, then one further step.

    After the second step the query's direction column holds a path, which never equals a team, so
    there is no third. The second step runs over matches, not edges; instead of repeating equal rows
    per match, ``n_rows`` says how often each row occurs.
    """
    played = matches.groupBy(
        F.col("team_a_id").cast("string").alias("a"), F.col("team_b_id").cast("string").alias("b")
    ).agg(F.count(F.lit(1)).alias("n"))
    first = played.select(
        F.col("a").alias("teamname"),
        F.col("b").alias("direction"),
        F.lit(1).alias("level"),
        F.concat("a", F.lit("->"), "b").alias("full_path"),
        F.lit(1).cast("long").alias("n_rows"),
    )
    step = played.select(F.col("a").alias("mid"), F.col("b").alias("far"), F.col("n"))
    edge = first.select(F.col("direction").alias("mid"), "full_path")
    second = edge.join(step, "mid").filter("mid <> far")  # no team after itself; the way back is allowed
    return first.unionByName(
        second.select(
            F.col("mid").alias("teamname"),
            F.concat("mid", F.lit("->"), "far").alias("direction"),
            F.lit(2).alias("level"),
            F.concat("full_path", F.lit("->"), "far").alias("full_path"),
            F.col("n").alias("n_rows"),
        )
    )


def _distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col(edges.columns[0]).alias("src"), F.col(edges.columns[1]).alias("dst")).distinct()


def team_paths(edges: DataFrame, max_level: int) -> DataFrame:
    """Simple paths of up to ``max_level`` steps from every team; each level is written before the next.

    The number of paths grows with the number of neighbours at every level: for a dense network of many
    teams use ``team_path_counts`` or ``team_reach``.
    """
    step = cut_lineage(_distinct_edges(edges))
    level = step.filter("src <> dst").select(
        F.col("src").alias("team_id"), F.col("dst").alias("reached_id"), F.array("src", "dst").alias("path")
    )
    result = level.withColumn("level", F.lit(1))
    for depth in range(2, max_level + 1):
        level = (
            level.join(step.withColumnRenamed("src", "reached_id"), "reached_id")
            .filter(~F.array_contains("path", F.col("dst")))
            .select("team_id", F.col("dst").alias("reached_id"), F.array_append("path", F.col("dst")).alias("path"))
        )
        if depth < max_level:
            level = cut_lineage(level)
            if level.isEmpty():
                break
        result = result.unionByName(level.withColumn("level", F.lit(depth)))
    shown = F.array_join(F.transform("path", lambda team: team.cast("string")), "->")
    return result.select("team_id", "reached_id", "level", shown.alias("full_path"))


def team_path_counts(edges: DataFrame, max_level: int) -> DataFrame:
    """How many simple paths of each length up to ``max_level`` lead from a team to another, without listing them.

    What can follow a path depends on its ends and on which teams it holds, not on their order; so paths that share
    these are one row with their number. Sets are sorted arrays of team numbers. Each level is added up in the tasks
    and written before the next.
    """
    step = _distinct_edges(edges).filter("src <> dst")
    teams = step.select(F.col("src").alias("team")).union(step.select("dst")).distinct()
    numbered = cut_lineage(zip_with_index(teams, [F.asc("team")], "number"))
    known = numbered.withColumn("number", F.col("number").cast("int"))
    from_, to = (known.select(F.col("team").alias(c), F.col("number").alias(f"{c}_at")) for c in ("src", "dst"))
    step = cut_lineage(step.join(from_, "src").join(to, "dst").select("src_at", "dst_at"))
    level = step.select(
        F.col("src_at").alias("start"), F.col("dst_at").alias("end"), F.array_sort(F.array("src_at", "dst_at")).alias("held"), F.lit(1).cast("long").alias("n")
    )
    result = None
    for depth in range(1, max_level + 1):
        if depth > 1:
            onward = level.join(step, F.col("end") == F.col("src_at")).filter(~F.array_contains("held", F.col("dst_at")))
            held = F.array_sort(F.array_append("held", F.col("dst_at"))).alias("held")
            level = cut_lineage(onward.select("start", F.col("dst_at").alias("end"), held, "n").groupBy("start", "end", "held").agg(F.sum("n").alias("n")))
        counted = level.groupBy("start", "end").agg(F.sum("n").alias("n_paths")).withColumn("level", F.lit(depth))
        if depth > 1 and level.isEmpty():
            break
        result = counted if result is None else result.unionByName(counted)
    named = result.join(known.select(F.col("team").alias("team_id"), F.col("number").alias("start")), "start")
    named = named.join(known.select(F.col("team").alias("reached_id"), F.col("number").alias("end")), "end")
    return named.select("team_id", "reached_id", "level", "n_paths")


def team_reach(edges: DataFrame, max_level: int | None = None) -> DataFrame:
    """Fewest steps from each team to every other team it can reach; in ``max_level`` steps if that is given.

    Ends when a step finds no new pair.
    """
    step = cut_lineage(_distinct_edges(edges).filter("src <> dst"))
    reached = frontier = step.select(
        F.col("src").alias("team_id"), F.col("dst").alias("reached_id"), F.lit(1).alias("hops")
    )
    for hops in count(2) if max_level is None else range(2, max_level + 1):
        further = (
            frontier.select("team_id", F.col("reached_id").alias("src"))
            .join(step, "src")
            .select("team_id", F.col("dst").alias("reached_id"))
            .filter("team_id <> reached_id")
            .distinct()
        )
        frontier = cut_lineage(
            further.join(reached, ["team_id", "reached_id"], "left_anti").withColumn("hops", F.lit(hops))
        )
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached

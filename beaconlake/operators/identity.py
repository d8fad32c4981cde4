"""Visitors' identifiers resolved into profiles.

Every event links the identifiers it carries. A profile is a connected component of that graph, named after its
smallest identifier. Components are found with alternating large-star and small-star rounds (Kiveris et al., SoCC
2014): joins and minimum aggregations only, with a logarithmic number of rounds in practice even on long chains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.operators.skew import MAX_GROUP_ROWS, lookup_join


def event_nodes(avid_col: str = "avid", use_contacts: bool = False) -> Column:
    """The sorted, distinct identifiers of an event: visitor id, external ids and, on request, e-mail and phone."""
    external = F.transform(
        F.filter("user_external_ids", lambda e: e["key"].isNotNull() & e["value"].isNotNull()),
        lambda e: F.concat(F.lit("ext:"), e["key"], F.lit(":"), e["value"]),
    )
    single = [F.concat(F.lit("avid:"), F.col(avid_col))]
    if use_contacts:
        email = F.lower(F.trim("user_data.email"))
        phone = F.regexp_replace("user_data.phone_number", r"[^0-9]", "")
        single += [
            F.when(email != "", F.concat(F.lit("email:"), email)),
            F.when(phone != "", F.concat(F.lit("phone:"), phone)),
        ]
    nodes = F.concat(F.array_compact(F.array(*single)), F.coalesce(external, F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(nodes))


def event_edges(nodes: DataFrame) -> DataFrame:
    """Distinct links (``larger``, ``smaller``) between the smallest identifier of an event and its other ones."""
    return (
        nodes.where(F.size("nodes") > 1)
        .select(F.col("nodes")[0].alias("smaller"), F.explode(F.slice("nodes", 2, F.size("nodes"))).alias("larger"))
        .distinct()
        .select("larger", "smaller")
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.inline(
            F.array(
                F.struct(F.col("larger").alias("node"), F.col("smaller").alias("neighbour")),
                F.struct(F.col("smaller").alias("node"), F.col("larger").alias("neighbour")),
            )
        )
    )


def _large_star(edges: DataFrame, join) -> DataFrame:
    """Link the larger neighbours of each node to the smallest identifier in its neighbourhood."""
    both = _both_ways(edges)
    centre = both.groupBy("node").agg(F.min("neighbour").alias("low"))
    centre = centre.select("node", F.least("node", "low").alias("low"))
    linked = join(both.where("neighbour > node"), centre)
    return linked.select(F.col("neighbour").alias("larger"), F.col("low").alias("smaller")).distinct()


def _small_star(edges: DataFrame, join) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.col("larger").alias("node"), F.col("smaller").alias("neighbour"))
    centre = down.groupBy("node").agg(F.min("neighbour").alias("low"))
    linked = join(down, centre)
    moved = linked.select(
        F.inline(
            F.array(
                F.struct(F.col("neighbour").alias("larger"), F.col("low").alias("smaller")),
                F.struct(F.col("node").alias("larger"), F.col("low").alias("smaller")),
            )
        )
    )
    return moved.where("larger > smaller").distinct()


def _unsettled(edges: DataFrame) -> bool:
    """Whether another round would change anything: a node with two centres, or one that is centre and linked."""
    both = _both_ways(edges)
    state = both.groupBy("node").agg(
        F.count_if(F.col("neighbour") < F.col("node")).alias("centres"),
        F.count_if(F.col("neighbour") > F.col("node")).alias("linked"),
    )
    return not state.where("centres > 1 or (centres = 1 and linked > 0)").isEmpty()


def components(edges: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Component of every linked node as (``node``, ``profile_id``); the smallest node of a component is its name.

    ``edges`` holds distinct (``larger``, ``smaller``) pairs. Each round is cut off with a checkpoint in the shared
    folder. A node with very many neighbours is joined by broadcast of its one aggregated row, not by shuffling them.
    """
    edges = edges.checkpoint()
    # A round never has more links than the one before, and a node at most one row per link in each join.
    crowded = edges.count() > max_group_rows

    def join(rows: DataFrame, centre: DataFrame) -> DataFrame:
        return lookup_join(rows, centre, ["node"], "inner", max_group_rows=max_group_rows, look_for_heavy=crowded)

    while _unsettled(edges):
        edges = _small_star(_large_star(edges, join).checkpoint() if crowded else _large_star(edges, join), join)
        edges = edges.checkpoint()
    members = edges.select(F.col("larger").alias("node"), F.col("smaller").alias("profile_id"))
    centres = edges.select(F.col("smaller").alias("node"), F.col("smaller").alias("profile_id")).distinct()
    return members.unionByName(centres)


def identity_components(
    raw: DataFrame, avid_col: str = "avid", use_contacts: bool = False, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every identifier of the events with its profile, as (``node``, ``profile_id``)."""
    nodes = raw.select("event_id", event_nodes(avid_col, use_contacts).alias("nodes"))
    linked = components(event_edges(nodes), max_group_rows).checkpoint()
    alone = nodes.select(F.explode("nodes").alias("node")).distinct().join(linked, "node", "left_anti")
    return linked.unionByName(alone.select("node", F.col("node").alias("profile_id")))


def identify_events(
    raw: DataFrame,
    inserted_at: Column | None = None,
    avid_col: str = "avid",
    use_contacts: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Raw events with ``profile_id`` and ``inserted_at``, in the column order of the identified table.

    All identifiers of an event share a profile, so one of them finds it.
    """
    inserted_at = F.unix_millis(F.current_timestamp()) if inserted_at is None else inserted_at
    nodes = raw.select("event_id", event_nodes(avid_col, use_contacts).alias("nodes"))
    profiles = components(event_edges(nodes), max_group_rows)
    return with_profiles(raw, profiles, avid_col, inserted_at, use_contacts, max_group_rows)


def with_profiles(
    raw: DataFrame, profiles: DataFrame, avid_col: str, inserted_at: Column, use_contacts: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS, look_for_heavy: bool = True,
) -> DataFrame:
    """Raw events with the profile that ``profiles`` (node, profile_id) gives one of their identifiers.

    Without ``look_for_heavy`` the caller knows that no identifier has more than ``max_group_rows`` events.
    """
    with_nodes = raw.withColumn("_nodes", event_nodes(avid_col, use_contacts))
    keyed = with_nodes.withColumn("node", F.get("_nodes", F.lit(0)))
    found = lookup_join(keyed, profiles, ["node"], max_group_rows=max_group_rows, look_for_heavy=look_for_heavy)
    columns = [F.col(f"`{name}`") for name in raw.columns]
    position = raw.columns.index(avid_col)
    return found.select(
        *columns[:position],
        F.coalesce("profile_id", "node").alias("profile_id"),
        *columns[position:],
        inserted_at.cast("bigint").alias("inserted_at"),
    )


def merge_profiles(known: DataFrame, new_edges: DataFrame, look_for_heavy: bool = True) -> tuple[DataFrame, DataFrame]:
    """Profiles after new links: (nodes of the links with their profile, renamed profiles).

    ``known`` has the present profile of every stored node among the links' ends, and only of those: history is not
    needed. The second frame is (old_profile_id, profile_id). The smallest identifier names a profile, so the smallest of
    the merged profiles' names and the new nodes is the name of all. ``look_for_heavy`` as above.
    """
    def named(links: DataFrame, side: str) -> DataFrame:
        lookup = known.select(F.col("node").alias(side), F.col("profile_id").alias(f"_{side}"))
        return lookup_join(links, lookup, [side], look_for_heavy=look_for_heavy)

    both = named(named(new_edges, "larger"), "smaller")
    ends = both.select(
        F.coalesce("_larger", "larger").alias("a"), F.coalesce("_smaller", "smaller").alias("b"),
    ).where("a <> b")
    linked = ends.select(F.greatest("a", "b").alias("larger"), F.least("a", "b").alias("smaller")).distinct()
    moved = components(linked).checkpoint()
    old_names = known.select(F.col("profile_id").alias("node")).distinct()
    renamed = moved.where("node <> profile_id").join(old_names, "node", "left_semi").select(
        F.col("node").alias("old_profile_id"), "profile_id"
    )
    nodes = new_edges.select(F.explode(F.array("larger", "smaller")).alias("node")).distinct()
    present = nodes.join(known.withColumnRenamed("profile_id", "_profile"), "node", "left")
    present = present.select(F.col("node").alias("_node"), F.coalesce("_profile", "node").alias("node"))
    result = lookup_join(present, moved, ["node"], look_for_heavy=look_for_heavy).select(
        F.col("_node").alias("node"), F.coalesce("profile_id", "node").alias("profile_id")
    )
    # Nodes of a renamed profile that no new link names keep their stored name, and find the new one by its alias.
    return result, renamed


def extend_aliases(aliases: DataFrame, renamed: DataFrame, look_for_heavy: bool = True) -> DataFrame:
    """All names that profiles ever had with the present one, after further renaming."""
    later = renamed.select(F.col("old_profile_id").alias("profile_id"), F.col("profile_id").alias("_now"))
    moved = lookup_join(aliases, later, ["profile_id"], look_for_heavy=look_for_heavy).select("old_profile_id", F.coalesce("_now", "profile_id").alias("profile_id"))
    return moved.unionByName(renamed)


def extend_profiles(profiles: DataFrame, new_edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add new links to stored profiles: (all nodes with their profile, alias table of renamed profiles).

    Only the links between profiles are resolved again. The alias table maps ``old_profile_id`` to the
    ``profile_id`` it became, so that older partitions of identified events can be read under the new names.
    """
    def named(links: DataFrame, side: str) -> DataFrame:
        known = profiles.select(F.col("node").alias(side), F.col("profile_id").alias(f"_{side}"))
        joined = lookup_join(links, known, [side])
        return joined.withColumn(side, F.coalesce(f"_{side}", side)).drop(f"_{side}")

    contracted = named(named(new_edges, "larger"), "smaller").where("larger <> smaller")
    contracted = contracted.select(
        F.greatest("larger", "smaller").alias("larger"), F.least("larger", "smaller").alias("smaller")
    ).distinct()
    moved = components(contracted).withColumnRenamed("profile_id", "_new").checkpoint()
    aliases = moved.where("node <> _new").select(
        F.col("node").alias("old_profile_id"), F.col("_new").alias("profile_id")
    )
    renamed = lookup_join(profiles.withColumnRenamed("node", "_node").withColumnRenamed("profile_id", "node"),
                          moved, ["node"])
    old = renamed.select(F.col("_node").alias("node"), F.coalesce("_new", "node").alias("profile_id"))
    seen = new_edges.select(F.explode(F.array("larger", "smaller")).alias("node")).distinct()
    fresh = seen.join(profiles.select("node"), "node", "left_anti").join(moved, "node", "left").select(
        "node", F.coalesce("_new", "node").alias("profile_id")
    )
    known_profiles = profiles.select(F.col("profile_id").alias("old_profile_id")).distinct()
    return old.unionByName(fresh), aliases.join(known_profiles, "old_profile_id", "left_semi")

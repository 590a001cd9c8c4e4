"""Candidate pairs of names for the same concept, and why they are candidates.

Pairs are unordered: ``a`` is the lesser name. A reason is a kind (key, vector, acronym, acronym-def) with a similarity for
vectors. Names of one key that are many are not paired off: a key's group is a star around its least name where all pairs
are not asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.names import acronym_definitions, acronym_like, initials, lexical_overlap, norm_key
from weftgraph.operators.aliases import pair

#: Types that agree with every type.
OPEN_TYPES = ("other", "unknown")


def key_groups(nodes: DataFrame) -> DataFrame:
    """(name, key, size, focused): names whose key others share; focused if any of the group is in focus."""
    keyed = nodes.select("name", "focus", norm_key(F.col("name")).alias("key"))
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("focus").alias("focused")).where("size > 1")
    return keyed.join(groups, "key").select("name", "key", "size", "focused")


def key_pairs(nodes: DataFrame, every: bool = True, left: DataFrame | None = None) -> DataFrame:
    """(a, b) of names with the same key, of groups in focus; with ``every`` false only pairs with a group's least name.

    The pairs of a group grow with the square of its size, the stars with its size; both connect the same names as long as
    no pair and no name is taken out. Of the names in ``left`` alone, if it is given, groups are in focus as they are in
    ``nodes``: after code merges a group has one name of each type, so all its pairs are few.
    """
    groups = key_groups(nodes).where("focused")
    if left is not None:
        groups = groups.join(left.select("name"), "name", "left_semi")
    if every:
        other = groups.select(F.col("name").alias("b"), "key")
        return groups.select(F.col("name").alias("a"), "key").join(other, "key").where("a < b").select("a", "b")
    least = groups.groupBy("key").agg(F.min("name").alias("a"))
    return groups.join(least, "key").where("name <> a").select("a", F.col("name").alias("b"))


def accepted_neighbours(neighbours: DataFrame, nodes: DataFrame, strong: float = 0.90) -> DataFrame:
    """(a, b, sim) of neighbours (name, neighbour, sim) with a strong similarity and agreeing types, or lexical support."""
    types = nodes.select("name", "type")
    typed = neighbours.join(types, "name").join(types.withColumnsRenamed({"name": "neighbour", "type": "other_type"}), "neighbour")
    a, b = F.col("name"), F.col("neighbour")
    agree = (F.col("type") == F.col("other_type")) | F.col("type").isin(*OPEN_TYPES) | F.col("other_type").isin(*OPEN_TYPES)
    support = lexical_overlap(a, b) | acronym_like(a, b)
    kept = typed.where(((F.col("sim") >= strong) & agree) | support)
    return kept.select(*pair("name", "neighbour"), "sim").groupBy("a", "b").agg(F.max("sim").alias("sim"))


def acronym_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of names of several words and capital acronyms of two to eight letters that are their initials; one in focus."""
    words = F.size(F.split(F.trim("name"), r"\s+"))
    full = nodes.where(words >= 2).select(
        F.col("name").alias("full"),
        F.col("focus").alias("full_focus"),
        F.explode(F.array_distinct(F.array(initials(F.col("name"), True), initials(F.col("name"), False)))).alias("key"),
    )
    compact = F.regexp_replace("name", "[^A-Za-z0-9]", "")
    short = nodes.select("name", "focus", compact.alias("compact")).where(F.col("compact").rlike("^[A-Z]{2,8}$"))
    short = short.select("name", "focus", F.lower("compact").alias("key"))
    return full.join(short, "key").where("(focus OR full_focus) AND name <> full").select(*pair("name", "full")).distinct()


def defined_acronyms(nodes: DataFrame) -> DataFrame:
    """(a, b) where a description in focus defines one node's name as an acronym of another's, in any case of letters.

    Of a defined full name the longest run of last words counts whose initials are the acronym and which is a node's name.
    """
    found = nodes.where("focus").select(F.col("name").alias("of"), F.posexplode(acronym_definitions(F.col("description"))).alias("n", "d"))
    words = F.split("full", r"\s+")
    tails = found.select("of", "n", "d.*").select(
        "of", "n", "acronym", F.explode(F.sequence(F.lit(1), F.size(words))).alias("first"), words.alias("words")
    )
    tails = tails.select("of", "n", "first", F.lower("acronym").alias("short"), F.array_join(F.slice("words", F.col("first"), 99), " ").alias("full"))
    tails = tails.where(initials(F.col("full")) == F.col("short")).withColumn("full", F.lower("full"))
    names = nodes.groupBy(F.lower("name").alias("lower")).agg(F.max("name").alias("node"))
    both = tails.join(names.select(F.col("lower").alias("full"), F.col("node").alias("x")), "full").join(
        names.select(F.col("lower").alias("short"), F.col("node").alias("y")), "short"
    )
    longest = F.row_number().over(Window.partitionBy("of", "n").orderBy("first"))
    return both.withColumn("nth", longest).where("nth = 1 AND x <> y").select(*pair("x", "y")).distinct()


def candidates(parts: dict[str, DataFrame], decided: DataFrame | None = None) -> DataFrame:
    """(a, b, sim, kinds): the union of pairs by kind, without decided pairs; kinds are sorted and joined by ``+``."""
    union = None
    for kind, part in parts.items():
        sim = F.col("sim") if "sim" in part.columns else F.lit(None)
        rows = part.select("a", "b", F.lit(kind).alias("kind"), sim.cast("double").alias("sim"))
        union = rows if union is None else union.unionByName(rows)
    pairs = union.groupBy("a", "b").agg(
        F.max("sim").alias("sim"), F.array_join(F.sort_array(F.collect_set("kind")), "+").alias("kinds")
    )
    return pairs if decided is None else pairs.join(decided, ["a", "b"], "left_anti")


def paper_counts(nodes: DataFrame, extracted: DataFrame, canonical: DataFrame) -> DataFrame:
    """(name, papers): different documents whose names lead to the node in one step, or else its own different files."""
    mapped = extracted.join(canonical.select(F.col("alias").alias("name"), "canonical"), "name", "left").select(
        F.coalesce("canonical", "name").alias("name"), "doc"
    )
    counts = mapped.groupBy("name").agg(F.countDistinct("doc").alias("n"))
    own = F.size(F.array_distinct("files"))
    return nodes.select("name", "files").join(counts, "name", "left").select("name", F.coalesce("n", own).cast("bigint").alias("papers"))

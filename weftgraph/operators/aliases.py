"""The alias table: who is merged into whom, what has been decided, and chains of aliases."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.names import norm_key
from weftgraph.functions.strings import filled, trimmed
from weftgraph.plans.lineage import cut

#: Most aliases that one task follows; about 200 bytes each.
BOUND = 500_000


def decided(rows: DataFrame) -> DataFrame:
    """Rows with trimmed names and lower-case verdicts; rows without both names are left out."""
    return rows.select(
        "seq", filled("alias").alias("alias"), filled("canonical").alias("canonical"), F.lower(trimmed("verdict")).alias("verdict")
    ).where("alias IS NOT NULL AND canonical IS NOT NULL")


def canonical_of(rows: DataFrame) -> DataFrame:
    """(alias, canonical) of the verdict ``same``; of several rows of an alias the last by seq counts."""
    return (
        decided(rows)
        .where("verdict = 'same'")
        .groupBy("alias")
        .agg(F.max(F.struct("seq", "canonical")).alias("last"))
        .select("alias", F.col("last.canonical").alias("canonical"))
    )


def pair(a: Column | str, b: Column | str) -> list[Column]:
    """Columns a and b of an unordered pair."""
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def decided_pairs(rows: DataFrame) -> DataFrame:
    """Unordered pairs (a, b) that were found different, related or unsure, each once."""
    return decided(rows).where("verdict IN ('different', 'related', 'unsure')").select(*pair("alias", "canonical")).distinct()


def _doubled(step: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(at, to) after as many steps as it takes until ``to`` is no alias, and the rows whose ``to`` always is one.

    Each round joins the table of successors with itself. If a round closes no row, the open ones lead to cycles: a longer
    chain would have had rows that close in it.
    """
    aliases = step.select(F.col("at").alias("to"))
    open_now = cut(step.join(aliases, "to", "left_semi").select("at", "to"))
    closed = [step.join(aliases, "to", "left_anti").select("at", "to")]
    whole, size = step, open_now.count()
    while size:
        onward = whole.select(F.col("at").alias("to"), F.col("to").alias("next"))
        moved = cut(open_now.join(onward, "to").select("at", F.col("next").alias("to")))
        still = moved.join(aliases, "to", "left_semi").select("at", "to")
        closed.append(moved.join(aliases, "to", "left_anti").select("at", "to"))
        left = still.count()
        if left == size:
            open_now = still
            break
        done = closed[0]
        for part in closed[1:]:
            done = done.unionByName(part)
        whole, open_now, size = cut(done.unionByName(still)), still, left
    done = closed[0]
    for part in closed[1:]:
        done = done.unionByName(part)
    return done, open_now


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows every alias of one task's table to its end, or to the first name seen before."""
    step: dict[str, str] = {}
    for batch in batches:
        step.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    final: dict[str, str] = {}
    for start in step:
        trail, here = {}, start
        while here in step and here not in trail and here not in final:
            trail[here] = len(trail)
            here = step[here]
        if here in trail:
            final.update({n: n if i >= trail[here] else here for n, i in trail.items()})
        else:
            final.update(dict.fromkeys(trail, final.get(here, here)))
    yield pa.RecordBatch.from_pydict({"at": pa.array(list(final), pa.string()), "to": pa.array(list(final.values()), pa.string())})


def resolved(aliases: DataFrame, names: DataFrame, name: str = "name", bound: int = BOUND) -> DataFrame:
    """(name, final): where each name leads by following (alias, canonical) until it is no alias, or has been seen before.

    A name on a cycle leads to itself, a name that leads to a cycle to the first name on it. Names that are no alias lead
    to themselves. ``aliases`` must have one row per alias. At most ``bound`` aliases are followed by one task; of more,
    chains of n aliases take log n rounds of joins.
    """
    step = cut(aliases.select(F.col("alias").alias("at"), F.col("canonical").alias("to")).where("at <> to"))
    if step.count() <= bound:
        found = step.coalesce(1).mapInArrow(_followed, "at string, to string")
    else:
        found, stuck = _doubled(step)
        cycles = cut(stuck.select(F.col("to").alias("at")).distinct())
        if not cycles.isEmpty():
            found = _doubled(cut(step.join(cycles, "at", "left_anti")))[0]
    found = found.select(F.col("at").alias(name), F.col("to").alias("final"))
    return names.select(name).join(found, name, "left").select(name, F.coalesce("final", name).alias("final"))


def recovered(names: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, canonical) for names that are neither nodes nor aliases: the node with the same key and most degree, or null.

    ``nodes`` has (name, degree); ties go to the greater name.
    """
    lost = names.select("name").distinct().join(nodes, "name", "left_anti")
    lost = lost.join(aliases.select(F.col("alias").alias("name")), "name", "left_anti").withColumn("key", norm_key(F.col("name")))
    best = nodes.groupBy(norm_key(F.col("name")).alias("key")).agg(F.max(F.struct("degree", "name")).alias("best"))
    return lost.join(best, "key", "left").select("name", F.col("best.name").alias("canonical"))

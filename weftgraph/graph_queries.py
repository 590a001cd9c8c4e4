"""Queries on names, aliases, candidates, merges and the graph, over whole tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import sql
from weftgraph.functions.names import initials, norm_key, stem_set
from weftgraph.functions.strings import filled
from weftgraph.operators import aliases, candidates, clusters, graph, merging
from weftgraph.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    """Register a query under its name, with its SQL if it has one."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


#: Nodes of the concept graph: one row per name of ``entities``.
NODES_SQL = """
  nodes AS (
    SELECT trim(name) AS name, min(lower(trim(entity_type))) AS type, max(CASE WHEN degree >= 0 THEN degree END) AS degree,
      count(DISTINCT entity_row) AS rows_n
    FROM entities WHERE trim(name) <> '' GROUP BY trim(name)
  )"""


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    """(name, type, degree, rows_n): trimmed names; the least type, the greatest degree that isn't negative."""
    rows = table(spark, folder, "entities", "entity_row", "name", "entity_type", "degree")
    return (
        rows.withColumn("name", filled("name"))
        .where("name IS NOT NULL")
        .groupBy("name")
        .agg(
            F.min(F.lower(F.trim("entity_type"))).alias("type"),
            F.max(F.when(F.col("degree") >= 0, F.col("degree"))).alias("degree"),
            F.countDistinct("entity_row").alias("rows_n"),
        )
    )


#: Edges of a bipartite graph: which supplier delivered which part how often.
EDGES_SQL = """
  edges AS (
    SELECT 'part ' || l_partkey AS src, 'supplier ' || l_suppkey AS dst, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2
  )"""


def edges(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem", "l_partkey", "l_suppkey").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(
        F.concat(F.lit("part "), "l_partkey").alias("src"), F.concat(F.lit("supplier "), "l_suppkey").alias("dst"), "n"
    )


@query(f"WITH {NODES_SQL} SELECT {sql.norm_key('name')} AS key, CAST(count(*) AS BIGINT) AS n, min(name) AS least FROM nodes GROUP BY 1 HAVING count(*) > 1")
def norm_key_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that several names share."""
    grouped = nodes(spark, folder).groupBy(norm_key(F.col("name")).alias("key"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("least")).where("n > 1")


@query(
    f"""WITH {NODES_SQL}, keyed AS (SELECT *, {sql.norm_key('name')} AS key FROM nodes),
    best AS (
      SELECT key, type, first(name ORDER BY rows_n DESC, degree DESC NULLS LAST, length(name), name DESC) AS canonical
      FROM keyed GROUP BY key, type HAVING count(*) > 1
    )
    SELECT k.name, b.canonical, k.key, k.type FROM keyed AS k JOIN best AS b ON k.key = b.key AND k.type IS NOT DISTINCT FROM b.type"""
)
def code_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the same key and type and the name they are merged into."""
    return merging.code_merges(nodes(spark, folder).withColumnRenamed("rows_n", "papers"))


@query(
    f"""WITH known AS (
      SELECT DISTINCT name FROM (
        SELECT trim(name) AS name FROM entities UNION ALL SELECT trim(alias) FROM alias_table UNION ALL SELECT trim(canonical) FROM alias_table
      ) WHERE name <> ''
    ), names AS (
      SELECT name FROM known UNION SELECT upper({sql.initials('name')}) FROM known WHERE regexp_matches(name, '\\s')
    ), full_names AS (
      SELECT name, unnest(list_distinct([{sql.initials('name')}, {sql.initials('name', False)}])) AS key FROM names
      WHERE len(regexp_split_to_array(trim(name), '\\s+')) >= 2
    ), short AS (SELECT name, regexp_replace(name, '[^A-Za-z0-9]', '', 'g') AS compact FROM names)
    SELECT DISTINCT least(f.name, s.name) AS a, greatest(f.name, s.name) AS b
    FROM full_names AS f JOIN short AS s ON f.key = lower(s.compact)
    WHERE regexp_matches(s.compact, '^[A-Z]{{2,8}}$') AND f.name <> s.name"""
)
def acronym_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Names of several words and the acronyms that spell their initials, among nodes, names of the alias table and their acronyms."""
    links = table(spark, folder, "alias_table", F.explode(F.array("alias", "canonical")).alias("name"))
    names = table(spark, folder, "entities", "name").unionAll(links).select(filled("name").alias("name")).where("name IS NOT NULL")
    made = names.where(F.col("name").rlike(r"\s")).select(F.upper(initials(F.col("name"))).alias("name"))
    names = names.unionAll(made).distinct()
    return candidates.acronym_pairs(names.withColumn("focus", F.lit(True)))


@query(
    f"""WITH pairs AS (
      SELECT DISTINCT least(trim(alias), trim(canonical)) AS a, greatest(trim(alias), trim(canonical)) AS b FROM alias_table
      WHERE trim(alias) <> '' AND trim(canonical) <> ''
    ), stems AS (SELECT a, b, {sql.stem_set('a')} AS x, {sql.stem_set('b')} AS y FROM pairs)
    SELECT a, b, CAST(len(x) AS BIGINT) AS stems_a, CAST(len(y) AS BIGINT) AS stems_b FROM stems WHERE {sql.lexical_overlap('x', 'y')}"""
)
def lexical_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of the alias table whose names share at least half of their stems."""
    rows = table(spark, folder, "alias_table", "alias", "canonical").select(filled("alias").alias("x"), filled("canonical").alias("y"))
    pairs = rows.where("x IS NOT NULL AND y IS NOT NULL").select(*aliases.pair("x", "y")).distinct()
    kept = pairs.where(candidates.lexical_overlap(F.col("a"), F.col("b")))
    return kept.select(
        "a", "b", F.size(stem_set(F.col("a"))).cast("bigint").alias("stems_a"), F.size(stem_set(F.col("b"))).cast("bigint").alias("stems_b")
    )


@query(
    f"""WITH {NODES_SQL}, keyed AS (SELECT name, {sql.norm_key('name')} AS key FROM nodes),
    least_names AS (SELECT key, min(name) AS a FROM keyed GROUP BY key)
    SELECT l.a, k.name AS b FROM keyed AS k JOIN least_names AS l USING (key) WHERE k.name <> l.a"""
)
def key_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that link all names of the same key: a star around each key's least name."""
    return candidates.key_pairs(nodes(spark, folder).withColumn("focus", F.lit(True)), every=False)


#: Decided rows of the alias table.
ALIAS_SQL = """
  decided AS (
    SELECT seq, trim(alias) AS alias, trim(canonical) AS canonical, lower(trim(verdict)) AS verdict
    FROM alias_table WHERE trim(alias) <> '' AND trim(canonical) <> ''
  ), canonical_of AS (
    SELECT alias, arg_max(canonical, seq) AS canonical FROM decided WHERE verdict = 'same' GROUP BY alias
  ), vetoed AS (
    SELECT DISTINCT least(alias, canonical) AS a, greatest(alias, canonical) AS b FROM decided
    WHERE verdict IN ('different', 'related', 'unsure')
  )"""


@query(f"WITH {ALIAS_SQL} SELECT alias, canonical FROM canonical_of")
def alias_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """What each alias is merged into by its last row."""
    return aliases.canonical_of(table(spark, folder, "alias_table"))


CHAIN_SQL = """
  steps AS (SELECT alias, canonical FROM canonical_of WHERE alias <> canonical),
  walk(name, here, path) AS (
    SELECT alias, alias, [alias] FROM steps
    UNION ALL
    SELECT w.name, s.canonical, list_append(w.path, s.canonical) FROM walk AS w JOIN steps AS s ON s.alias = w.here
    WHERE len(list_distinct(w.path)) = len(w.path)
  ), chain AS (SELECT name, arg_max(here, len(path)) AS final FROM walk GROUP BY name)"""


@query(f"WITH RECURSIVE {ALIAS_SQL}, {CHAIN_SQL} SELECT name, final FROM chain")
def alias_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Where each alias leads in the end."""
    known = aliases.canonical_of(table(spark, folder, "alias_table")).where("alias <> canonical")
    return aliases.resolved(known, known.select(F.col("alias").alias("name")))


@query(f"WITH RECURSIVE {ALIAS_SQL}, {CHAIN_SQL} SELECT name, final FROM chain")
def alias_chain_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Where each alias leads in the end, by joins alone, as for tables that no task could hold."""
    known = aliases.canonical_of(table(spark, folder, "alias_table")).where("alias <> canonical")
    return aliases.resolved(known, known.select(F.col("alias").alias("name")), bound=0)


@query(
    f"""WITH {ALIAS_SQL}, pairs AS (
      SELECT DISTINCT least(alias, canonical) AS a, greatest(alias, canonical) AS b FROM decided WHERE verdict = 'same'
    ) SELECT a, b FROM pairs ANTI JOIN vetoed USING (a, b)"""
)
def decided_pairs_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that were found the same and never different, related or unsure."""
    rows = table(spark, folder, "alias_table")
    same = aliases.decided(rows).where("verdict = 'same'").select(*aliases.pair("alias", "canonical")).distinct()
    return same.join(aliases.decided_pairs(rows), ["a", "b"], "left_anti")


@query(
    f"""WITH RECURSIVE {ALIAS_SQL}, links AS (
      SELECT alias AS a, canonical AS b FROM decided WHERE verdict IN ('same', 'related') AND alias <> canonical
    ), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(name, other) AS (SELECT a, a FROM both_ways UNION SELECT r.name, e.b FROM reach AS r JOIN both_ways AS e ON r.other = e.a)
    SELECT name, min(other) AS component FROM reach GROUP BY name"""
)
def connected_components(spark: SparkSession, folder: str) -> DataFrame:
    """Names linked by same or related, and the least name of each group."""
    rows = aliases.decided(table(spark, folder, "alias_table")).where("verdict IN ('same', 'related')")
    return clusters.components(rows.select(F.col("alias").alias("a"), F.col("canonical").alias("b")))


@query(
    f"""WITH RECURSIVE {ALIAS_SQL}, links AS (
      SELECT alias AS a, canonical AS b FROM decided WHERE verdict IN ('same', 'related') AND alias <> canonical
    ), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(name, other) AS (SELECT a, a FROM both_ways UNION SELECT r.name, e.b FROM reach AS r JOIN both_ways AS e ON r.other = e.a)
    SELECT name, min(other) AS component FROM reach GROUP BY name"""
)
def connected_components_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Names linked by same or related, by joins alone, as for graphs that no task could hold."""
    rows = aliases.decided(table(spark, folder, "alias_table")).where("verdict IN ('same', 'related')")
    return clusters.components(rows.select(F.col("alias").alias("a"), F.col("canonical").alias("b")), bound=0)


@query()
def ego_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of at most eight names that cover all linked pairs."""
    rows = aliases.decided(table(spark, folder, "alias_table")).where("verdict IN ('same', 'related', 'unsure')")
    return clusters.ego_cover(rows.select(F.col("alias").alias("a"), F.col("canonical").alias("b"), F.lit(1.0).alias("weight")))


@query(
    f"""WITH {NODES_SQL}, {ALIAS_SQL}, lost AS (
      SELECT DISTINCT trim(extracted_name) AS name FROM paper_concepts WHERE trim(extracted_name) <> ''
    ), keyed AS (SELECT name, degree, {sql.norm_key('name')} AS key FROM nodes),
    best AS (SELECT key, first(name ORDER BY degree DESC NULLS LAST, name DESC) AS canonical FROM keyed GROUP BY key)
    SELECT l.name, b.canonical FROM (
      SELECT name, {sql.norm_key('name')} AS key FROM lost
      WHERE name NOT IN (SELECT name FROM nodes) AND name NOT IN (SELECT alias FROM canonical_of)
    ) AS l LEFT JOIN best AS b USING (key)"""
)
def alias_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Extracted names that are neither nodes nor aliases, and the node with the same key."""
    found = table(spark, folder, "paper_concepts", "extracted_name").select(filled("extracted_name").alias("name")).where("name IS NOT NULL")
    return aliases.recovered(found, nodes(spark, folder), aliases.canonical_of(table(spark, folder, "alias_table")))


@query(f"WITH {EDGES_SQL}, ends AS (SELECT src AS name FROM edges UNION ALL SELECT dst FROM edges) SELECT name, CAST(count(*) AS BIGINT) AS degree FROM ends GROUP BY name")
def graph_degree(spark: SparkSession, folder: str) -> DataFrame:
    """Degree of every part and supplier."""
    return graph.degrees(edges(spark, folder))


@query(f"WITH {NODES_SQL} SELECT name, type, degree FROM nodes ORDER BY degree DESC NULLS LAST, name LIMIT 50")
def hubs_topn(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 nodes of greatest degree, as the review of hubs asks for."""
    return graph.hubs(nodes(spark, folder)).select("name", "type", "degree")


@query(
    """SELECT trim(name) AS name FROM entities WHERE trim(name) <> '' GROUP BY trim(name)
    HAVING count(DISTINCT CASE WHEN len(source_ids) > 0 THEN source_ids[1] END) <= 1 AND max(coalesce(len(list_distinct(source_ids)), 0)) <= 1
      AND coalesce(max(CASE WHEN degree >= 0 THEN degree END), 0) = 0"""
)
def low_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Names with at most one chunk and no edge."""
    rows = table(spark, folder, "entities", "name", "source_ids", "degree").withColumn("name", filled("name")).where("name IS NOT NULL")
    exploded = rows.select("name", "degree", F.explode_outer("source_ids").alias("chunk"))
    merged = exploded.groupBy("name").agg(
        F.collect_set("chunk").alias("source_ids"), F.max(F.when(F.col("degree") >= 0, F.col("degree"))).alias("degree")
    )
    return graph.low_evidence(merged)


@query(
    """WITH moved AS (
      SELECT trim(c.name) AS src, trim(d.name) AS dst FROM (
        SELECT canonical AS name, aliases FROM merges WHERE trim(canonical) <> ''
      ) AS c, unnest(c.aliases) AS d(name) WHERE trim(d.name) <> ''
    ) SELECT DISTINCT src, dst FROM moved WHERE src <> dst"""
)
def self_loop_removal(spark: SparkSession, folder: str) -> DataFrame:
    """Links from canonical names to their aliases, without loops."""
    rows = table(spark, folder, "merges", "canonical", "aliases").select(filled("canonical").alias("src"), F.explode("aliases").alias("d"))
    links = rows.select("src", filled("d").alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    return graph.without_loops(links)


@query(
    f"""WITH concepts AS (SELECT DISTINCT trim(concept) AS name FROM paper_concepts WHERE trim(concept) <> ''),
    stop AS (SELECT DISTINCT {sql.norm_key('name')} AS key FROM stop_names)
    SELECT name FROM concepts WHERE {sql.norm_key('name')} NOT IN (SELECT key FROM stop)"""
)
def stoplist_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    """Concepts that no generic name removes."""
    concepts = table(spark, folder, "paper_concepts", "concept").select(filled("concept").alias("name")).where("name IS NOT NULL").distinct()
    return graph.without_stopped(concepts, table(spark, folder, "stop_names"))


@query(
    f"""WITH {EDGES_SQL}, moved AS (
      SELECT 'brand ' || p.p_brand AS src, e.dst, e.n FROM edges AS e JOIN part AS p ON e.src = 'part ' || p.p_partkey
    ) SELECT src, dst, CAST(sum(n) AS BIGINT) AS weight FROM (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, n FROM moved) GROUP BY src, dst"""
)
def merged_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges after parts are merged into their brands."""
    rows = table(spark, folder, "part", "p_partkey", "p_brand")
    mapping = rows.select(F.concat(F.lit("part "), "p_partkey").alias("name"), F.concat(F.lit("brand "), "p_brand").alias("canonical"))
    found = edges(spark, folder).select("src", "dst", F.col("n").alias("weight"), F.lit("delivers").alias("description"))
    return merging.merged_edges(found, mapping).select("src", "dst", "weight")


@query(
    f"""WITH {ALIAS_SQL}, pairs AS (SELECT DISTINCT least(alias, canonical) AS a, greatest(alias, canonical) AS b FROM decided),
    firsts AS (SELECT least(alias, canonical) AS a, greatest(alias, canonical) AS b, arg_min(verdict, seq) AS verdict FROM decided WHERE verdict IS NOT NULL GROUP BY 1, 2)
    SELECT verdict, CAST(count(*) AS BIGINT) AS n FROM firsts GROUP BY verdict"""
)
def first_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """How often each verdict was a pair's first."""
    from weftgraph.operators.quality import first_verdicts as firsts

    rows = aliases.decided(table(spark, folder, "alias_table")).where("verdict IS NOT NULL")
    return firsts(rows).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))

"""Queries on vectors, quality and exports, over whole tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.strings import filled
from weftgraph.graph_queries import ALIAS_SQL, CHAIN_SQL, NODES_SQL, nodes
from weftgraph.operators import aliases, candidates, clusters, decisions, export, quality, vectors
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


#: Exact cosines of the stated queries, every id that 20 divides, against all vectors of the table of embeddings.
NEAR_SQL = """
  unit AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
  sims AS (
    SELECT q.id, e.id AS neighbour, round(list_inner_product(q.v, e.v) / sqrt(list_inner_product(q.v, q.v)) / sqrt(list_inner_product(e.v, e.v)), 4) AS sim
    FROM unit AS q JOIN unit AS e ON q.id <> e.id WHERE q.id % 20 = 0
  ), near AS (
    SELECT id, neighbour, sim, CAST(row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS INT) AS rank FROM sims
  )"""


def _near(spark: SparkSession, folder: str, k: int) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.top_neighbours(rows, rows.where("id % 20 = 0"), k)


@query(f"WITH {NEAR_SQL} SELECT id, neighbour, sim, rank FROM near WHERE rank <= 10")
def nn_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten most similar vectors of every twentieth one, exactly."""
    return _near(spark, folder, 10)


@query(
    f"WITH {NEAR_SQL} SELECT DISTINCT sim, least(id, neighbour) AS a, greatest(id, neighbour) AS b FROM near WHERE rank <= 5 ORDER BY sim DESC, a DESC, b DESC LIMIT 100"
)
def missed_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The hundred most similar pairs that are still separate, for review."""
    pairs = _near(spark, folder, 5).select("sim", *aliases.pair("id", "neighbour")).distinct()
    return pairs.orderBy(F.desc("sim"), F.desc("a"), F.desc("b")).limit(100)


@query(
    f"""WITH {NEAR_SQL}, shares AS (
      SELECT n.id, avg(CAST(x.label = y.label AS INT)) AS share FROM near AS n JOIN unit AS x ON x.id = n.id JOIN unit AS y ON y.id = n.neighbour
      WHERE rank <= 5 GROUP BY n.id
    ) SELECT round(avg(share), 4) AS agreement, CAST(count(*) AS BIGINT) AS vectors FROM shares"""
)
def nn_label_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """How often the five nearest vectors have the same label."""
    labels = table(spark, folder, "embeddings", "vec_id", "label").select(F.col("vec_id").alias("id"), "label")
    return export.agreement(_near(spark, folder, 5), labels)


@query("SELECT vec_id, name, 'ent-' || md5(name) AS computed, ent_id = 'ent-' || md5(name) AS agrees FROM vectors_entities WHERE name IS NOT NULL")
def vector_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of entity vectors from their names."""
    rows = table(spark, folder, "vectors_entities", "vec_id", "name", "ent_id").where("name IS NOT NULL")
    return rows.select("vec_id", "name", export.vector_id("name").alias("computed"), (F.col("ent_id") == export.vector_id("name")).alias("agrees"))


@query()
def pca_map(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings in the plane of their first two principal components."""
    return export.plane(table(spark, folder, "embeddings", "vec_id", "embedding").where("embedding IS NOT NULL"), "vec_id", "embedding")


EXTRACTED_SQL = """
  extracted AS (SELECT DISTINCT arxiv_id, trim(extracted_name) AS name FROM paper_concepts WHERE trim(extracted_name) <> '')"""


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "paper_concepts", "arxiv_id", "extracted_name")
    return rows.select("arxiv_id", filled("extracted_name").alias("name")).where("name IS NOT NULL")


@query(
    f"""WITH RECURSIVE {NODES_SQL}, {ALIAS_SQL}, {CHAIN_SQL}, {EXTRACTED_SQL}
    SELECT e.arxiv_id, n.name AS concept, n.type, e.name AS extracted_name FROM extracted AS e LEFT JOIN chain AS c ON c.name = e.name
    JOIN nodes AS n ON n.name = coalesce(c.final, e.name)"""
)
def paper_concepts(spark: SparkSession, folder: str) -> DataFrame:
    """Papers and the concepts their names lead to."""
    known = aliases.canonical_of(table(spark, folder, "alias_table")).where("alias <> canonical")
    return export.paper_concepts(_extracted(spark, folder), nodes(spark, folder), known)


@query(
    f"""WITH {ALIAS_SQL}, {EXTRACTED_SQL} SELECT CAST(count(c.alias) AS BIGINT) AS stale, CAST(count(*) AS BIGINT) AS pairs
    FROM extracted AS e LEFT JOIN canonical_of AS c ON c.alias = e.name"""
)
def stale_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """How many extracted names are still aliases."""
    return export.stale_rows(_extracted(spark, folder), aliases.canonical_of(table(spark, folder, "alias_table")))


@query(
    f"""WITH {NODES_SQL}, {ALIAS_SQL}, {EXTRACTED_SQL}, counts AS (
      SELECT coalesce(c.canonical, e.name) AS name, count(DISTINCT e.arxiv_id) AS n FROM extracted AS e LEFT JOIN canonical_of AS c ON c.alias = e.name GROUP BY 1
    ), files AS (
      SELECT trim(name) AS name, count(DISTINCT f) AS n FROM (SELECT name, unnest(file_paths) AS f FROM entities) WHERE trim(name) <> '' GROUP BY 1
    )
    SELECT nodes.name, CAST(coalesce(counts.n, files.n, 0) AS BIGINT) AS papers FROM nodes LEFT JOIN counts USING (name) LEFT JOIN files USING (name)"""
)
def paper_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Papers of each node."""
    rows = table(spark, folder, "entities", "name", "file_paths").withColumn("name", filled("name")).where("name IS NOT NULL")
    files = rows.select("name", F.explode_outer("file_paths").alias("f")).groupBy("name").agg(F.collect_set("f").alias("files"))
    extracted = _extracted(spark, folder).withColumnRenamed("arxiv_id", "doc")
    return candidates.paper_counts(files, extracted, aliases.canonical_of(table(spark, folder, "alias_table")))


@query(
    f"""WITH {EXTRACTED_SQL}, papers AS (
      SELECT arxiv_id, CAST(floor((row_number() OVER (ORDER BY arxiv_id) - 1) / 50) AS BIGINT) AS batch FROM (SELECT DISTINCT arxiv_id FROM extracted WHERE arxiv_id IS NOT NULL)
    ), seen AS (SELECT DISTINCT batch, name FROM extracted JOIN papers USING (arxiv_id)),
    firsts AS (SELECT name, min(batch) AS first FROM seen GROUP BY name),
    counted AS (
      SELECT batch, count(*) AS names, count(*) FILTER (WHERE batch = first) AS new_names FROM seen JOIN firsts USING (name) GROUP BY batch
    ), sizes AS (SELECT batch, count(*) AS papers FROM papers GROUP BY batch)
    SELECT batch, CAST(papers AS BIGINT) AS papers, CAST(names AS BIGINT) AS names, CAST(new_names AS BIGINT) AS new_names FROM sizes JOIN counted USING (batch)"""
)
def batch_new_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names by batch of fifty papers, and those no earlier batch had."""
    return quality.new_by_batch(_extracted(spark, folder).withColumnRenamed("arxiv_id", "paper"), 50)


@query(
    """SELECT coalesce(nullif(lower(trim(entity_type)), ''), 'other') AS type, CAST(count(*) AS BIGINT) AS n FROM entities GROUP BY 1"""
)
def type_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Entity rows by type."""
    return quality.type_distribution(table(spark, folder, "entities", "entity_type").withColumnRenamed("entity_type", "type"))


@query(
    """WITH kinds AS (SELECT coalesce(nullif(lower(trim(entity_type)), ''), 'other') AS type FROM entities)
    SELECT CAST(count(*) AS BIGINT) AS nodes, CAST(count(*) FILTER (WHERE type IN ('other', 'unknown')) AS BIGINT) AS open_nodes,
      count(*) FILTER (WHERE type IN ('other', 'unknown')) < 0.15 * greatest(count(*), 1) AS passed FROM kinds"""
)
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether few enough entity rows are of no known type."""
    return quality.type_gate(table(spark, folder, "entities", "entity_type").withColumnRenamed("entity_type", "type"))


@query(
    f"""WITH {NEAR_SQL}, pairs AS (SELECT DISTINCT least(id, neighbour) AS a, greatest(id, neighbour) AS b, sim FROM near WHERE rank <= 10),
    verdicts AS (
      SELECT p.a, p.b, CASE WHEN x.label = y.label THEN 'same' ELSE 'different' END AS verdict FROM pairs AS p
      JOIN unit AS x ON x.id = p.a JOIN unit AS y ON y.id = p.b WHERE x.label = y.label
    )
    SELECT (floor(sim * 100) - floor(sim * 100) % 2) / 100 AS band, coalesce(v.verdict, 'kept separate') AS verdict, CAST(count(*) AS BIGINT) AS n
    FROM pairs AS p LEFT JOIN verdicts AS v USING (a, b) GROUP BY 1, 2"""
)
def threshold_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbour pairs by similarity band and whether their labels agree."""
    pairs = _near(spark, folder, 10).select(*aliases.pair("id", "neighbour"), "sim").distinct()
    labels = table(spark, folder, "embeddings", "vec_id", "label")
    x, y = (labels.withColumnsRenamed({"vec_id": e, "label": f"l{e}"}) for e in ("a", "b"))
    same = pairs.join(x, "a").join(y, "b").where("la = lb").select("a", "b", F.lit("same").alias("verdict"))
    return quality.bands(pairs, same)


@query(
    """WITH base AS (SELECT DISTINCT arxiv_id AS paper, lower(extracted_name) AS name FROM paper_concepts WHERE extracted_name IS NOT NULL AND arxiv_id IS NOT NULL),
    more AS (SELECT DISTINCT arxiv_id AS paper, lower(concept) AS name FROM paper_concepts WHERE concept IS NOT NULL AND arxiv_id IS NOT NULL),
    rows AS (SELECT coalesce(b.paper, m.paper) AS paper, coalesce(b.name, m.name) AS name, b.name IS NOT NULL AS x, m.name IS NOT NULL AS y
      FROM base AS b FULL JOIN more AS m ON b.paper = m.paper AND b.name = m.name),
    placed AS (SELECT *, row_number() OVER (PARTITION BY paper, x ORDER BY name) AS place FROM rows)
    SELECT paper, CAST(count(*) FILTER (WHERE x) AS BIGINT) AS base_names, CAST(count(*) FILTER (WHERE y) AS BIGINT) AS more_names,
      CAST(count(*) FILTER (WHERE NOT x) AS BIGINT) AS only_more,
      coalesce(string_agg(name, '|' ORDER BY name) FILTER (WHERE NOT x AND place <= 15), '') AS sample
    FROM placed GROUP BY paper HAVING count(*) FILTER (WHERE x) > 0 AND count(*) FILTER (WHERE y) > 0"""
)
def appendix_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Names by paper that only one of two runs has: extracted names against resolved ones."""
    rows = table(spark, folder, "paper_concepts", "arxiv_id", "concept", "extracted_name").where("arxiv_id IS NOT NULL")
    base = rows.where("extracted_name IS NOT NULL").select(F.col("arxiv_id").alias("paper"), F.col("extracted_name").alias("name"))
    more = rows.where("concept IS NOT NULL").select(F.col("arxiv_id").alias("paper"), F.col("concept").alias("name"))
    return quality.set_difference_by_paper(base, more)


@query(
    """WITH logged AS (SELECT DISTINCT merge_id, trim(canonical) AS canonical FROM merges WHERE trim(canonical) <> ''),
    once AS (SELECT merge_id, min(canonical) AS canonical FROM logged GROUP BY merge_id)
    SELECT merge_id, canonical FROM once ORDER BY md5('0|' || merge_id), merge_id LIMIT 100"""
)
def merge_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A hundred merges for review, in the order of a seeded hash: the review sheet's sample."""
    rows = table(spark, folder, "merges", "merge_id", "canonical").select("merge_id", filled("canonical").alias("canonical"))
    once = rows.where("canonical IS NOT NULL").groupBy("merge_id").agg(F.min("canonical").alias("canonical"))
    return quality.review_sample(once, "merge_id")


@query("SELECT status, CAST(count(*) AS BIGINT) AS calls, round(count(*) / max(papers), 2) AS per_paper FROM (SELECT lower(trim(status)) AS status, (SELECT count(DISTINCT arxiv_id) FROM manifest) AS papers FROM manifest WHERE status IS NOT NULL) GROUP BY status")
def calls_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest steps by status, and by paper: the form of the report on model calls."""
    rows = table(spark, folder, "manifest", "arxiv_id", "status")
    papers = rows.agg(F.countDistinct("arxiv_id").alias("papers"))
    counted = rows.where("status IS NOT NULL").groupBy(F.lower(F.trim("status")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return quality.calls_by_kind(counted.crossJoin(F.broadcast(papers))).withColumnRenamed("kind", "status")


@query()
def cluster_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """What the rule provider answers for clusters of names that share a key; a stand-in for a model.

    A group of more than eight names is covered by clusters of at most eight, so that any two of its names are in one of them.
    """
    found = nodes(spark, folder)
    focused = found.withColumn("focus", F.lit(True))
    groups = candidates.key_groups(focused)
    large = groups.where("size > 8").select("name", "key")
    covered = clusters.ego_cover(candidates.key_pairs(focused, left=large).withColumn("weight", F.lit(1.0))).join(large, "name")
    whole = groups.where("size <= 8").select(F.col("key").alias("cluster_id"), "name")
    asking = whole.unionByName(covered.select(F.concat_ws("-", "key", "cluster_no").alias("cluster_id"), "name"))
    rows = found.select("name", F.coalesce("type", F.lit("other")).alias("type"), F.col("rows_n").alias("papers"), F.array(F.lit("")).alias("fragments"))
    empty = rows.select("name", F.array().cast("array<string>").alias("examples"))
    asked = decisions.payloads(asking, rows, empty)
    return decisions.decide(asked, asked, decisions.RuleProvider()).select("cluster_id", F.size("same").alias("groups"), "second_look")

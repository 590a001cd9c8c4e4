"""Further queries, each of which runs an operator over whole tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import sql
from weftgraph.functions.names import acronym_like
from weftgraph.functions.strings import filled
from weftgraph.graph_queries import ALIAS_SQL, CHAIN_SQL, NODES_SQL, nodes
from weftgraph.operators import aliases, candidates, chunks, cleaning, decisions, export, graph, html, merging, quality, text, vectors
from weftgraph.quality_queries import EXTRACTED_SQL, _extracted, _near
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


#: Nodes with their different description fragments and chunks, both in order.
FULL_SQL = f"""
  {NODES_SQL}, pieces AS (
    SELECT DISTINCT trim(name) AS name, trim(f) AS f FROM (SELECT name, unnest(string_split(description, '<SEP>')) AS f FROM entities)
    WHERE trim(name) <> '' AND trim(f) <> ''
  ), chunked AS (
    SELECT DISTINCT trim(name) AS name, c FROM (SELECT name, unnest(source_ids) AS c FROM entities) WHERE trim(name) <> '' AND c IS NOT NULL
  ), full_nodes AS (
    SELECT n.*, coalesce(p.fragments, []) AS fragments, coalesce(c.source_ids, []) AS source_ids FROM nodes AS n
    LEFT JOIN (SELECT name, list_sort(list(f)) AS fragments FROM pieces GROUP BY name) AS p USING (name)
    LEFT JOIN (SELECT name, list_sort(list(c)) AS source_ids FROM chunked GROUP BY name) AS c USING (name)
  )"""


def full_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """(name, type, degree, papers, fragments, source_ids): fragments and chunks are different ones in order."""
    rows = table(spark, folder, "entities", "name", "description", "source_ids").withColumn("name", filled("name")).where("name IS NOT NULL")
    none = F.array().cast("array<string>")
    parts = rows.select("name", F.explode(F.split("description", "<SEP>")).alias("f")).select("name", F.trim("f").alias("f")).where("f <> ''")
    chunks = rows.select("name", F.explode("source_ids").alias("c")).where("c IS NOT NULL")
    lists = parts.groupBy("name").agg(F.sort_array(F.collect_set("f")).alias("fragments")).join(
        chunks.groupBy("name").agg(F.sort_array(F.collect_set("c")).alias("source_ids")), "name", "full"
    )
    joined = nodes(spark, folder).withColumnRenamed("rows_n", "papers").join(lists, "name", "left")
    return joined.withColumns({c: F.coalesce(c, none) for c in ("fragments", "source_ids")})


@query(
    f"""WITH RECURSIVE {FULL_SQL}, {ALIAS_SQL}, {CHAIN_SQL}, moved AS (SELECT coalesce(c.final, n.name) AS final, n.* FROM full_nodes AS n LEFT JOIN chain AS c USING (name))
    SELECT final AS name, first(type ORDER BY name <> final, name) AS type, CAST(sum(len(fragments)) AS BIGINT) AS n_fragments,
      CAST(sum(len(source_ids)) AS BIGINT) AS n_chunks, max(rows_n) AS papers,
      array_to_string(flatten(list(fragments ORDER BY name <> final, name)), '<SEP>') AS description
    FROM moved GROUP BY final"""
)
def merged_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes after all known aliases are merged: type of the canonical name, joined fragments and chunks."""
    known = aliases.canonical_of(table(spark, folder, "alias_table")).where("alias <> canonical")
    found = full_nodes(spark, folder)
    mapping = aliases.resolved(known, found.select("name")).withColumnRenamed("final", "canonical")
    return merging.merged_nodes(found, mapping).select(
        "name", "type", F.size("fragments").cast("bigint").alias("n_fragments"), F.size("source_ids").cast("bigint").alias("n_chunks"), "papers",
        F.array_join("fragments", "<SEP>").alias("description"),
    )


@query(
    f"""WITH {FULL_SQL} SELECT name, CAST(len(fragments) AS BIGINT) AS fragments, left(array_to_string(fragments, ' '), 1200) AS summary
    FROM full_nodes WHERE len(fragments) >= 8"""
)
def condensed(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes with at least eight fragments and what the rule provider makes of them."""
    return graph.condensed(full_nodes(spark, folder), decisions.RuleProvider())


#: Links of the alias table as edges of the graph.
LINKS_SQL = """
  links AS (SELECT DISTINCT alias AS src, canonical AS dst, coalesce(verdict, '') AS description FROM decided WHERE alias <> canonical)"""


def _links(spark: SparkSession, folder: str) -> DataFrame:
    rows = aliases.decided(table(spark, folder, "alias_table")).where("alias <> canonical")
    return rows.select(F.col("alias").alias("src"), F.col("canonical").alias("dst"), F.coalesce("verdict", F.lit("")).alias("description")).distinct()


SHOWN_SQL = f"""
  {FULL_SQL}, {ALIAS_SQL}, {LINKS_SQL}, top AS (SELECT * FROM full_nodes ORDER BY degree DESC NULLS LAST, name LIMIT 50),
  ends AS (SELECT src AS name, dst AS other, description FROM links UNION ALL SELECT dst, src, description FROM links),
  near AS (SELECT e.* FROM ends AS e JOIN top USING (name) QUALIFY row_number() OVER (PARTITION BY e.name ORDER BY other, description) <= 200),
  pool AS (SELECT name, unnest(fragments) AS t FROM top UNION ALL SELECT name, unnest(string_split(description, '<SEP>')) FROM near),
  placed AS (
    SELECT name, t, row_number() OVER (PARTITION BY name ORDER BY md5('0|' || name || '|' || t), t) AS place FROM pool WHERE trim(t) <> ''
  ), shown AS (SELECT name, list(left(t, 500) ORDER BY place) AS fragments FROM placed WHERE place <= 12 GROUP BY name)"""


def _shown(spark: SparkSession, folder: str) -> DataFrame:
    return graph.hub_evidence(graph.hubs(full_nodes(spark, folder)), _links(spark, folder))


@query(f"WITH {SHOWN_SQL} SELECT name, array_to_string(fragments, '|') AS fragments FROM shown")
def hub_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """What a reviewer is shown of the fifty greatest hubs: own fragments mixed with those of their links."""
    return _shown(spark, folder).select("name", F.array_join("fragments", "|").alias("fragments"))


@query(
    f"""WITH {SHOWN_SQL}, counted AS (
      SELECT name, len(fragments) AS n, len(list_filter(fragments, lambda f: contains(lower(f), lower(name)))) AS bearing FROM shown
    ) SELECT name, CASE WHEN bearing * 2 >= n THEN 'one' ELSE 'several' END AS verdict, '' AS senses, bearing || ' of ' || n || ' fragments name it' AS reason FROM counted"""
)
def hub_review(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the fragments of the fifty greatest hubs are of one concept, by the rule provider."""
    return graph.hub_verdicts(_shown(spark, folder), decisions.RuleProvider()).withColumn("senses", F.array_join("senses", "|"))


@query(
    f"""WITH {ALIAS_SQL}, pairs AS (SELECT DISTINCT least(alias, canonical) AS a, greatest(alias, canonical) AS b FROM decided WHERE alias <> canonical)
    SELECT a, b FROM pairs WHERE {sql.acronym_like('a', 'b')}"""
)
def acronym_links(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of the alias table of which one name spells the initials of the other."""
    rows = aliases.decided(table(spark, folder, "alias_table")).where("alias <> canonical").select(*aliases.pair("alias", "canonical")).distinct()
    return rows.where(acronym_like(F.col("a"), F.col("b")))


#: Cosines of every entity vector with all others, and the ten greatest of each.
ENTITY_NEAR_SQL = """
  whole AS (SELECT vec_id, trim(name) AS name, CAST(vectors AS DOUBLE[]) AS v FROM vectors_entities WHERE len(vectors) = 64 AND list_sum(list_transform(vectors, lambda x: abs(x))) > 0),
  sims AS (
    SELECT q.name, e.name AS neighbour, q.vec_id AS qid, e.vec_id AS eid,
      round(list_inner_product(q.v, e.v) / sqrt(list_inner_product(q.v, q.v)) / sqrt(list_inner_product(e.v, e.v)), 4) AS sim
    FROM whole AS q JOIN whole AS e ON q.vec_id <> e.vec_id
  ), near AS (SELECT * FROM sims QUALIFY row_number() OVER (PARTITION BY qid ORDER BY sim DESC, eid) <= 10)"""


def _entity_near(spark: SparkSession, folder: str) -> DataFrame:
    """(name, neighbour, sim) of every entity vector."""
    rows = table(spark, folder, "vectors_entities", "vec_id", "name", "vectors").withColumn("name", F.trim("name"))
    rows = rows.where((F.size("vectors") == 64) & F.exists("vectors", lambda x: x != 0))
    plain = rows.select(F.col("vec_id").alias("id"), F.col("vectors").alias("vector"))
    found = vectors.all_neighbours(plain, 10)
    names = rows.select(F.col("vec_id").alias("id"), "name")
    return found.join(names, "id").join(names.withColumnsRenamed({"id": "neighbour", "name": "other"}), "neighbour").select(
        "name", F.col("other").alias("neighbour"), "sim"
    )


@query(
    f"""WITH {NODES_SQL}, {ENTITY_NEAR_SQL}, typed AS (
      SELECT n.name, n.neighbour, n.sim, x.type AS t, y.type AS u, {sql.stem_set('n.name')} AS s, {sql.stem_set('n.neighbour')} AS r
      FROM near AS n JOIN nodes AS x ON x.name = n.name JOIN nodes AS y ON y.name = n.neighbour
    )
    SELECT least(name, neighbour) AS a, greatest(name, neighbour) AS b, max(sim) AS sim FROM typed
    WHERE (sim >= 0.9 AND (coalesce(t = u, false) OR coalesce(t IN ('other', 'unknown'), false) OR coalesce(u IN ('other', 'unknown'), false)))
      OR {sql.lexical_overlap('s', 'r')} OR {sql.acronym_like('name', 'neighbour')}
    GROUP BY 1, 2"""
)
def accepted_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours among the entity vectors that are strong and of agreeing types, or have lexical support."""
    return candidates.accepted_neighbours(_entity_near(spark, folder), nodes(spark, folder).select("name", "type"))


@query(
    f"""WITH {NODES_SQL}, keyed AS (SELECT name, {sql.norm_key('name')} AS key FROM nodes)
    SELECT x.name AS a, y.name AS b FROM keyed AS x JOIN keyed AS y ON x.key = y.key AND x.name < y.name"""
)
def key_pairs_all(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of names of the same key."""
    return candidates.key_pairs(nodes(spark, folder).withColumn("focus", F.lit(True)))


@query(
    f"""WITH {NODES_SQL}, {ALIAS_SQL}, {ENTITY_NEAR_SQL}, keyed AS (SELECT name, {sql.norm_key('name')} AS key FROM nodes),
    least_names AS (SELECT key, min(name) AS a FROM keyed GROUP BY key),
    parts AS (
      SELECT l.a, k.name AS b, 'key' AS kind, NULL AS sim FROM keyed AS k JOIN least_names AS l USING (key) WHERE k.name <> l.a
      UNION ALL SELECT least(name, neighbour), greatest(name, neighbour), 'vector', sim FROM near
    )
    SELECT a, b, max(sim) AS sim, string_agg(DISTINCT kind, '+' ORDER BY kind) AS kinds FROM parts ANTI JOIN vetoed USING (a, b) GROUP BY a, b"""
)
def candidate_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate pairs by key and by vector, with the reasons of both, without decided pairs."""
    keys = candidates.key_pairs(nodes(spark, folder).withColumn("focus", F.lit(True)), every=False)
    near = _entity_near(spark, folder).select(*aliases.pair("name", "neighbour"), "sim")
    return candidates.candidates({"key": keys, "vector": near}, aliases.decided_pairs(table(spark, folder, "alias_table")))


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the alias table as the validated answer on a cluster of two names."""
    rows = aliases.decided(table(spark, folder, "alias_table")).where("alias <> canonical")
    group = F.struct("canonical", F.array("canonical", "alias").alias("members"), F.lit("").alias("reason"))
    relation = F.struct(F.col("alias").alias("from"), F.col("canonical").alias("to"), F.lit("a part of").alias("relation"))
    difference = F.struct(F.col("alias").alias("a"), F.col("canonical").alias("b"))
    only = lambda verdict, item: F.filter(F.array(F.when(F.col("verdict") == verdict, item)), lambda x: x.isNotNull())
    return rows.select(
        F.col("seq").cast("string").alias("cluster_id"),
        F.array("alias", "canonical").alias("members"),
        only("same", group).alias("same"),
        only("related", relation).alias("related"),
        only("different", difference).alias("different"),
        only("unsure", F.col("alias")).alias("unsure"),
        F.lit(0).alias("rejected"),
        F.lit(False).alias("second_look"),
    )


GROUPS_SQL = f"""
  {NODES_SQL}, {ALIAS_SQL}, told AS (SELECT * FROM decided WHERE alias <> canonical),
  refused AS (SELECT DISTINCT least(alias, canonical) AS a, greatest(alias, canonical) AS b FROM told WHERE verdict = 'different'),
  linked AS (SELECT DISTINCT least(alias, canonical) AS a, greatest(alias, canonical) AS b FROM told WHERE verdict = 'same'),
  kept AS (SELECT a, b FROM linked ANTI JOIN refused USING (a, b)), both_ways AS (SELECT a, b FROM kept UNION SELECT b, a FROM kept),
  reach(name, other) AS (SELECT a, a FROM both_ways UNION SELECT r.name, e.b FROM reach AS r JOIN both_ways AS e ON r.other = e.a),
  grouped AS (SELECT name, min(other) AS component FROM reach GROUP BY name),
  votes AS (SELECT canonical AS name, 2 * count(*) AS votes FROM told WHERE verdict = 'same' GROUP BY canonical),
  rated AS (
    SELECT g.*, coalesce(v.votes, 0) AS votes, coalesce(n.rows_n, 0) AS papers, coalesce(n.degree, 0) AS degree
    FROM grouped AS g LEFT JOIN votes AS v USING (name) LEFT JOIN nodes AS n USING (name)
  ), best AS (
    SELECT component, first(name ORDER BY votes DESC, papers DESC, degree DESC, length(name), name DESC) AS canonical FROM rated GROUP BY component
  ), broken AS (
    SELECT DISTINCT x.component FROM refused AS r JOIN grouped AS x ON x.name = r.a JOIN grouped AS y ON y.name = r.b WHERE x.component = y.component
  )"""


def _groups(spark: SparkSession, folder: str, enforce: bool) -> DataFrame:
    known = nodes(spark, folder).withColumnRenamed("rows_n", "papers")
    return decisions.same_groups(_answers(spark, folder), known, enforce).withColumnRenamed("group", "component")


@query(f"WITH RECURSIVE {GROUPS_SQL} SELECT name, canonical, component FROM rated JOIN best USING (component) WHERE component NOT IN (SELECT component FROM broken)")
def same_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Names that decisions unite and what they are merged into; groups with names that were called different stay apart."""
    return _groups(spark, folder, True)


@query(f"WITH RECURSIVE {GROUPS_SQL} SELECT name, canonical, component FROM rated JOIN best USING (component)")
def same_groups_loose(spark: SparkSession, folder: str) -> DataFrame:
    """Names that decisions unite, where pairs called different only don't link."""
    return _groups(spark, folder, False)


@query(
    f"""WITH {ALIAS_SQL}, told AS (SELECT * FROM decided WHERE alias <> canonical)
    SELECT alias, canonical, verdict, CAST(seq AS VARCHAR) AS cluster_id, CASE verdict WHEN 'related' THEN 'a part of' ELSE '' END AS reason
    FROM told WHERE verdict IN ('related', 'different', 'unsure')"""
)
def alias_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows for the alias table of what was found related, different or unsure."""
    return decisions.alias_rows(_answers(spark, folder))


@query(
    f"""WITH {NODES_SQL}, {ALIAS_SQL}, related AS (
      SELECT DISTINCT least(alias, canonical) AS src, greatest(alias, canonical) AS dst FROM decided WHERE verdict = 'related' AND alias <> canonical
    ), known AS (
      SELECT DISTINCT trim(canonical) AS src, trim(a) AS dst FROM (SELECT canonical, unnest(aliases) AS a FROM merges) WHERE trim(canonical) <> '' AND trim(a) <> ''
    ), texts AS (
      SELECT least(alias, canonical) AS src, greatest(alias, canonical) AS dst,
        min(least(alias, canonical) || ' is a part of ' || greatest(alias, canonical)) AS t FROM decided WHERE verdict = 'related' AND alias <> canonical GROUP BY 1, 2
    )
    SELECT src, dst, 'a part of' AS keywords, CAST(1.0 AS DOUBLE) AS weight FROM related
    WHERE src IN (SELECT name FROM nodes) AND dst IN (SELECT name FROM nodes) AND (src, dst) NOT IN (SELECT (src, dst) FROM known)"""
)
def related_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges for related names that are nodes and have none in the merge log."""
    rows = table(spark, folder, "merges", "canonical", "aliases").select(filled("canonical").alias("src"), F.explode("aliases").alias("d"))
    known = rows.select("src", filled("d").alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    return decisions.related_edges(_answers(spark, folder), known, nodes(spark, folder)).select("src", "dst", "keywords", "weight")


PAPERS_SQL = """
  papers AS (
    SELECT arxiv_id, first(text ORDER BY cleaned_at DESC NULLS LAST, text DESC) AS text FROM clean_results
    WHERE arxiv_id IS NOT NULL AND text IS NOT NULL GROUP BY arxiv_id
  )"""


def latest_papers(spark: SparkSession, folder: str) -> DataFrame:
    """(arxiv_id, text): each paper's latest cleaned text."""
    rows = table(spark, folder, "clean_results", "arxiv_id", "text", "cleaned_at").where("arxiv_id IS NOT NULL AND text IS NOT NULL")
    return rows.groupBy("arxiv_id").agg(F.max(F.struct("cleaned_at", "text")).alias("last")).select("arxiv_id", "last.text")


@query(
    f"""WITH {PAPERS_SQL}, named AS (SELECT DISTINCT trim(concept) AS name, arxiv_id FROM paper_concepts WHERE trim(concept) <> '' AND arxiv_id IS NOT NULL),
    sentences AS (
      SELECT n.name, p.arxiv_id, list_filter(string_split(regexp_replace(p.text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: contains(lower(s), lower(n.name))) AS hits
      FROM named AS n JOIN papers AS p USING (arxiv_id)
    ), ranked AS (SELECT name, arxiv_id, hits[1] AS s, row_number() OVER (PARTITION BY name ORDER BY arxiv_id) AS place FROM sentences WHERE len(hits) > 0)
    SELECT name, string_agg(left(trim(regexp_replace(s, '\\s+', ' ', 'g')), 300), '|' ORDER BY place) AS examples FROM ranked WHERE place <= 2 GROUP BY name"""
)
def evidence(spark: SparkSession, folder: str) -> DataFrame:
    """The first sentences that name each concept, from two of its papers."""
    rows = table(spark, folder, "paper_concepts", "concept", "arxiv_id").select(filled("concept").alias("name"), "arxiv_id")
    rows = rows.where("name IS NOT NULL AND arxiv_id IS NOT NULL")
    sources = rows.groupBy("name").agg(F.sort_array(F.collect_set("arxiv_id")).alias("source_ids"))
    chunks = latest_papers(spark, folder).select(F.col("arxiv_id").alias("chunk_id"), F.col("text").alias("content"))
    return decisions.evidence(sources, chunks).select("name", F.array_join("examples", "|").alias("examples"))


@query(
    f"""WITH RECURSIVE {FULL_SQL}, {ALIAS_SQL}, {CHAIN_SQL}, {LINKS_SQL}, {EXTRACTED_SQL},
    ends AS (SELECT src AS name, dst AS n FROM links UNION ALL SELECT dst, src FROM links),
    around AS (SELECT name, count(*) AS degree, string_agg(DISTINCT n, '|' ORDER BY n) AS neighbours FROM ends GROUP BY name),
    led AS (SELECT final AS name, string_agg(DISTINCT name, '|' ORDER BY name) AS aliases FROM chain WHERE name <> final GROUP BY final),
    seen AS (SELECT name, string_agg(DISTINCT arxiv_id, '|' ORDER BY arxiv_id) AS papers FROM extracted WHERE arxiv_id IS NOT NULL GROUP BY name)
    SELECT n.name, coalesce(n.type, 'unknown') AS type, left(trim(n.fragments[1]), 260) AS description, coalesce(seen.papers, '') AS papers,
      CAST(coalesce(a.degree, 0) AS BIGINT) AS degree, coalesce(a.neighbours, '') AS neighbours, coalesce(l.aliases, '') AS aliases
    FROM full_nodes AS n LEFT JOIN around AS a USING (name) LEFT JOIN led AS l USING (name) LEFT JOIN seen USING (name)"""
)
def entity_records(spark: SparkSession, folder: str) -> DataFrame:
    """A record for each node: description, papers, neighbours and aliases."""
    known = aliases.canonical_of(table(spark, folder, "alias_table")).where("alias <> canonical")
    papers = _extracted(spark, folder).where("arxiv_id IS NOT NULL").groupBy("name").agg(F.collect_set("arxiv_id").alias("papers"))
    found = full_nodes(spark, folder).drop("papers", "degree").join(papers, "name", "left")
    found = found.withColumn("papers", F.coalesce("papers", F.array().cast("array<string>")))
    lists = {c: F.array_join(c, "|") for c in ("papers", "neighbours", "aliases")}
    return export.entity_records(found, _links(spark, folder), known).withColumns(lists)


BATCH_SQL = """
  counts AS (SELECT
    (SELECT count(DISTINCT arxiv_id) FROM manifest) AS papers, (SELECT sum(chunks) FROM manifest) AS chunks, (SELECT count(*) FROM entities) AS entity_rows,
    (SELECT count(*) FROM alias_table) AS relation_rows, (SELECT count(DISTINCT name) FROM entities) AS names, (SELECT count(DISTINCT name) FROM entity_batches) AS new_names,
    (SELECT count(*) FROM merges) AS clusters, (SELECT count(DISTINCT concept) FROM paper_concepts) AS names_in_clusters)"""


@query(
    f"""WITH {BATCH_SQL} SELECT round(chunks / papers, 2) AS c, round(entity_rows / chunks, 2) AS e, round(relation_rows / chunks, 2) AS r,
      round(new_names / entity_rows, 3) AS u, round(1 - new_names / names, 3) AS known_share, round(names_in_clusters / names, 3) AS p,
      round(names_in_clusters / clusters, 2) AS k, round(clusters / clusters, 3) AS q, round(names / clusters, 2) AS m,
      round(clusters / papers, 2) AS summaries_per_paper, round(clusters * 7 / (entity_rows + relation_rows), 3) AS h FROM counts"""
)
def batch_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """Derived parameters of a batch, from the counts of the tables."""
    one = lambda name, column, agg: table(spark, folder, name).agg(agg.alias(column))
    every = F.count(F.lit(1))
    counts = one("manifest", "papers", F.countDistinct("arxiv_id"))
    for row in (
        one("manifest", "chunks", F.sum("chunks")), one("entities", "entity_rows", every), one("alias_table", "relation_rows", every),
        one("entities", "names", F.countDistinct("name")), one("entity_batches", "new_names", F.countDistinct("name")),
        one("merges", "clusters", every), one("paper_concepts", "names_in_clusters", F.countDistinct("concept")),
    ):
        counts = counts.crossJoin(F.broadcast(row))  # single rows
    more = {"focus": "names", "second_looks": "clusters", "embedded": "names", "merged": "clusters", "summaries": "clusters"}
    return quality.batch_parameters(counts.select("*", *[F.col(old).alias(new) for new, old in more.items()]))


@query(
    """SELECT doc_id, regexp_replace(text, '([\\p{L}\\p{M}\\p{N}_])-\\n([\\p{L}\\p{M}\\p{N}_])', '\\1\\2', 'g') AS text FROM documents
    WHERE regexp_matches(text, '[\\p{L}\\p{M}\\p{N}_]-\\n[\\p{L}\\p{M}\\p{N}_]')"""
)
def rejoined_words(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with words broken at a line's end, with these joined."""
    rows = table(spark, folder, "documents", "doc_id", "text")
    return rows.select("doc_id", text.rejoined(F.col("text")).alias("text"), F.col("text").alias("old")).where("text <> old").drop("old")


@query(
    """WITH runs AS (SELECT l_orderkey, l_linenumber AS n, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM lineitem)
    SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM runs GROUP BY l_orderkey HAVING count(*) >= 5 AND count(*) FILTER (WHERE n = before + 1) >= 0.8 * (count(*) - 1)"""
)
def page_number_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders printed with their line numbers as page numbers, if these run on."""
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_linenumber").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("ns"))
    pages = F.array_join(F.transform("ns", lambda n: F.concat(F.lit("an item\n page "), n)), "\n")
    return text.page_number_runs(lines.select("l_orderkey", pages.alias("text")), ["l_orderkey"], "text")


@query(
    """WITH shares AS (
      SELECT DISTINCT arxiv_id, tokens_before, tokens_after, removed['appendix'] AS appendix,
        1 - tokens_after / nullif(tokens_before - coalesce(removed['appendix'], 0), 0) AS share FROM clean_results
    ) SELECT arxiv_id, tokens_before, tokens_after, share > 0.5 AS too_much, share < 0.02 AS too_little FROM shares"""
)
def removal_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Papers of which unusually much or little was removed."""
    rows = table(spark, folder, "clean_results", "arxiv_id", "tokens_before", "tokens_after", "removed")
    rows = rows.withColumn("appendix", F.try_element_at("removed", F.lit("appendix"))).drop("removed").distinct()
    rows = rows.withColumn("removed", F.create_map(F.lit("appendix_tokens"), "appendix"))
    return text.removal_flags(rows).select("arxiv_id", "tokens_before", "tokens_after", "too_much", "too_little")


@query(
    """WITH told AS (SELECT DISTINCT arxiv_id, batch_no, trim(name) AS name FROM entity_batches WHERE arxiv_id IS NOT NULL AND batch_no IS NOT NULL AND name IS NOT NULL),
    rows_n AS (SELECT arxiv_id, least(batch_no, 2) AS kind, count(*) AS n FROM told GROUP BY 1, 2),
    fit AS (SELECT DISTINCT arxiv_id, least(batch_no, 2) AS kind, lower(name) AS name FROM told WHERE regexp_matches(name, '^[^<\\n]+$')),
    firsts AS (SELECT arxiv_id, name, min(kind) AS kind FROM fit GROUP BY 1, 2),
    e AS (SELECT count(*) FILTER (WHERE kind = 1) AS extract_names, count(*) FILTER (WHERE kind = 2) AS glean_new_names FROM firsts),
    r AS (SELECT coalesce(sum(n) FILTER (WHERE kind = 1), 0) AS extract_relations, coalesce(sum(n) FILTER (WHERE kind = 2), 0) AS glean_relations FROM rows_n)
    SELECT CAST(extract_names AS BIGINT) AS extract_names, CAST(glean_new_names AS BIGINT) AS glean_new_names, CAST(extract_relations AS BIGINT) AS extract_relations,
      CAST(glean_relations AS BIGINT) AS glean_relations, round(glean_new_names / nullif(extract_names, 0), 3) AS name_rate,
      round(glean_relations / nullif(extract_relations, 0), 3) AS relation_rate FROM e, r"""
)
def gleaning_effect(spark: SparkSession, folder: str) -> DataFrame:
    """What later extraction calls add to the first, with the batches of names written as answers of a model."""
    rows = table(spark, folder, "entity_batches", "arxiv_id", "batch_no", "name").select("arxiv_id", "batch_no", F.trim("name").alias("name"))
    rows = rows.where("arxiv_id IS NOT NULL AND batch_no IS NOT NULL AND name IS NOT NULL").distinct()
    line = F.concat(F.lit("(entity<|#|>"), "name", F.lit("<|#|>x)\nrelation<|#|>"), "name", F.lit("<|#|>y"))
    calls = rows.groupBy("arxiv_id", F.least("batch_no", F.lit(2)).alias("kind")).agg(F.array_join(F.collect_list(line), "\n").alias("answer"))
    cache = calls.select(
        F.col("arxiv_id").alias("chunk_id"), F.lit("extract").alias("cache_type"),
        F.when(F.col("kind") == 1, "Extract.").otherwise(f"{quality.GLEANING}, add.").alias("prompt"), "answer",
    )
    return quality.gleaning_effect(quality.extraction_rows(cache))


@query("SELECT 'System ' || s_suppkey AS name, 'System ' || s_suppkey || ' (nation ' || s_nationkey || ')' AS renamed FROM supplier WHERE s_suppkey < 100")
def paper_local_rename(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers named as papers name their parts, each of one nation; names of more than two digits aren't such labels."""
    rows = table(spark, folder, "supplier", "s_suppkey", "s_nationkey")
    labels = rows.select(
        F.concat(F.lit("System "), "s_suppkey").alias("name"), F.array(F.concat(F.lit("nation "), "s_nationkey"), F.concat(F.lit("nation "), "s_nationkey")).alias("papers")
    )
    return graph.paper_local_names(labels)


CITED_SQL = """
  cited AS (
    SELECT DISTINCT arxiv_id, run_no, title || '. arXiv:' || arxiv_id || 'v' || run_no || ' doi 10.1234/' || lower(trim(content_hash)) || '.' AS raw,
      run_no || ', ' || chunks || '-' || (chunks + reference_entries) || ', x, 90 – 200' AS numbers, run_no AS one, chunks AS low, chunks + reference_entries AS high
    FROM manifest WHERE title IS NOT NULL AND arxiv_id IS NOT NULL AND run_no IS NOT NULL AND trim(content_hash) <> '' AND chunks IS NOT NULL AND reference_entries IS NOT NULL
  )"""


@query(
    f"""WITH {CITED_SQL} SELECT raw, nullif(regexp_extract(raw, '(?i)(?:arxiv[:\\s]*|arxiv\\.org/(?:abs|pdf)/)([0-9]{{4}}\\.[0-9]{{4,5}})', 1), '') AS paper,
      nullif(regexp_extract(raw, '\\b(10\\.[0-9]{{4,9}}/[^\\s"<>]+[^\\s"<>.,;)])', 1), '') AS doi,
      one || CASE WHEN high - low BETWEEN 0 AND 49 THEN ' ' || array_to_string(range(low, high + 1), ' ') ELSE '' END AS numbers FROM cited"""
)
def reference_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Paper ids, DOIs and expanded citation numbers of references made of the manifest's rows."""
    rows = table(spark, folder, "manifest", "arxiv_id", "run_no", "title", "content_hash", "chunks", "reference_entries")
    rows = rows.withColumn("h", F.lower(F.trim("content_hash"))).where("h <> ''").dropna(subset=["arxiv_id", "run_no", "title", "chunks", "reference_entries"])
    raw = F.concat("title", F.lit(". arXiv:"), "arxiv_id", F.lit("v"), "run_no", F.lit(" doi 10.1234/"), "h", F.lit("."))
    cited = F.concat("run_no", F.lit(", "), "chunks", F.lit("-"), F.col("chunks") + F.col("reference_entries"), F.lit(", x, 90 – 200"))
    rows = rows.select("arxiv_id", "run_no", raw.alias("raw"), cited.alias("cited")).distinct()
    numbers = F.transform(text.citation_numbers(F.col("cited")), lambda n: n.cast("string"))
    return rows.select("raw", text.paper_id(F.col("raw")).alias("paper"), text.doi(F.col("raw")).alias("doi"), F.array_join(numbers, " ").alias("numbers"))


@query(
    """SELECT s_suppkey AS id, s_name AS title, '# ' || s_name || chr(10) || chr(10) || 'Of **' || n_name || '**, see [1](#bib.bib1) and site,  $x_' || s_suppkey || '$ .' || chr(10) || chr(10)
      || 'a | ' || n_name || chr(10) || chr(10) || '## References' || chr(10) || chr(10) || '- [bib.bib1] ' || s_name || '.' || chr(10) AS markdown
    FROM supplier JOIN nation ON n_nationkey = s_nationkey"""
)
def html_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Pages about suppliers as Markdown: title, emphasis, links, formulas, tables, references, and what isn't text."""
    rows = table(spark, folder, "supplier", "s_suppkey", "s_name", "s_nationkey").join(
        table(spark, folder, "nation", "n_nationkey", "n_name"), F.col("n_nationkey") == F.col("s_nationkey")
    )
    page = F.format_string(
        '<html><head><title>no</title></head><body><nav>menu</nav><article class="ltx_document"><h1 class="ltx_title ltx_title_document">%s</h1>'
        '<div class="ltx_authors">nobody</div><p>Of <b>%s</b>, see <a href="#bib.bib1">1</a> and <a href="http://x">site</a>, <math alttext="x_%d">y</math>.</p>'
        '<table><tr><td></td><td></td></tr><tr><td>a</td><td>%s</td></tr></table>'
        '<section class="ltx_bibliography"><h2>Refs</h2><ul><li class="ltx_bibitem" id="bib.bib1">%s.</li></ul></section></article><footer>end</footer></body></html>',
        "s_name", "n_name", "s_suppkey", "n_name", "s_name",
    )
    return html.pages_to_markdown(rows.select(F.col("s_suppkey").alias("id"), page.alias("html")), ["id"], "html")


@query(
    f"""WITH {PAPERS_SQL}, s AS (SELECT DISTINCT arxiv_id, sec_no, heading_level, coalesce(trim(title), '') AS title, start_line, end_line,
      array_to_string(list_transform(section_path, lambda x: coalesce(x, '')), ' > ') AS path FROM sections WHERE heading_level > 0)
    SELECT s.*, CAST(coalesce((SELECT min(t.start_line) FROM s AS t WHERE t.arxiv_id = s.arxiv_id AND t.start_line > s.start_line AND t.heading_level <= s.heading_level),
      len(string_split(p.text, chr(10)))) AS INT) AS subtree_end FROM s JOIN papers AS p USING (arxiv_id)"""
)
def section_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Sections found in the cleaned texts, to be compared with the table of sections."""
    found = cleaning.sections(latest_papers(spark, folder), ["arxiv_id"], "text").where("heading_level > 0")
    return found.withColumn("path", F.array_join("section_path", " > ")).drop("section_path")


_SPACE = "[\\s\\x{0B}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_SHORT = "(?i:\\b(?:et al|e\\.g|i\\.e|cf|Figs?|Eqs?|Sec|Tab|vs|resp|approx)\\.)"


@query(
    f"""WITH marked AS (SELECT doc_id, regexp_replace(text, '([.!?]){_SPACE}+([A-Z\\[(])', '\\1' || chr(1) || '\\2', 'g') AS t FROM documents WHERE text IS NOT NULL),
    linked AS (SELECT doc_id, regexp_replace(t, '(\\[[^\\[\\]\\x{{01}}]*)\\x{{01}}([^\\[\\]]*\\]\\(#bib\\.bib[0-9]+\\))', '\\1 \\2', 'g') AS t FROM marked),
    parts AS (SELECT doc_id, unnest(string_split(regexp_replace(t, '({_SHORT})\\x{{01}}', '\\1 ', 'g'), chr(1))) AS s FROM linked)
    SELECT doc_id, CAST(count(*) AS BIGINT) AS sentences, CAST(max(length(s)) AS INT) AS longest FROM parts GROUP BY doc_id"""
)
def sentence_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences of every document."""
    rows = cleaning.sentences(table(spark, folder, "documents", "doc_id", "text"), ["doc_id"], "text")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sentences"), F.max(F.char_length("sentence")).alias("longest"))


_TOKENS = "len(regexp_extract_all({}, '\\p{{L}}{{1,6}}|\\p{{Nd}}{{1,3}}|[^\\p{{L}}\\p{{Nd}}\\s]'))"


@query(
    f"""WITH {PAPERS_SQL}, l AS (
      SELECT arxiv_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
      FROM (SELECT arxiv_id, regexp_replace(text, '([\\p{{L}}\\p{{M}}\\p{{N}}_])-\\n([\\p{{L}}\\p{{M}}\\p{{N}}_])', '\\1\\2', 'g') AS text FROM papers)
    ), live AS (SELECT arxiv_id, n, trim(line) AS bare FROM l WHERE trim(line) <> ''),
    spans AS (SELECT arxiv_id, max(n) - min(n) AS span FROM live GROUP BY arxiv_id),
    running AS (
      SELECT arxiv_id, bare FROM live JOIN spans USING (arxiv_id)
      WHERE length(bare) >= 15 AND regexp_matches(bare, '[A-Za-z]{{3}}') AND NOT contains(bare, '|') AND NOT regexp_matches(bare, '^([-*]|#{{1,6}}\\s)')
      GROUP BY arxiv_id, bare HAVING count(*) >= 4 AND max(n) - min(n) > 0.5 * max(span)
    ), kept AS (
      SELECT arxiv_id, string_agg(line, chr(10) ORDER BY n) AS text FROM l ANTI JOIN running ON running.arxiv_id = l.arxiv_id AND running.bare = trim(l.line) GROUP BY arxiv_id
    ), after AS (
      SELECT arxiv_id, trim(regexp_replace(regexp_replace(text, '\\[([^\\]]*)\\]\\(#bib\\.bib[0-9]+\\)', '\\1', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13)) || chr(10) AS text FROM kept
    ), counts AS (
      SELECT a.arxiv_id, a.text, {_TOKENS.format('b.text')} AS before, {_TOKENS.format('a.text')} AS after FROM after AS a JOIN papers AS b USING (arxiv_id)
    ), shares AS (SELECT *, CASE WHEN before = 0 THEN 0 ELSE 1 - after / before END AS share FROM counts)
    SELECT arxiv_id, text, CAST(before AS BIGINT) AS tokens_before, CAST(after AS BIGINT) AS tokens_after,
      CASE WHEN share > 0.5 THEN printf('removed %.0f%% of tokens (> 50%%); ', share * 100) WHEN share < 0.02 THEN printf('removed %.1f%% of tokens (< 2%%); ', share * 100) ELSE '' END
      || 'no reference entries found' AS flags FROM shares"""
)
def cleaned_papers(spark: SparkSession, folder: str) -> DataFrame:
    """What a second cleanup leaves of the cleaned papers; none of them has references or appendices any more."""
    found = cleaning.cleaned(latest_papers(spark, folder), ["arxiv_id"], "text")
    return found.select("arxiv_id", "text", "tokens_before", "tokens_after", F.array_join("flags", "; ").alias("flags"))


@query(
    f"""WITH RECURSIVE {PAPERS_SQL}, s AS (SELECT DISTINCT arxiv_id, sec_no, heading_level, start_line, end_line FROM sections),
    bodies AS (
      SELECT s.arxiv_id, s.sec_no, array_to_string(string_split(p.text, chr(10))[s.start_line + 1 + CAST(s.heading_level > 0 AS INT) : s.end_line], chr(10)) AS body
      FROM s JOIN papers AS p USING (arxiv_id)
    ), split AS (
      SELECT arxiv_id, sec_no, unnest(list_filter(list_transform(regexp_split_to_array(body, '\\n\\s*\\n'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '')) AS t,
        generate_subscripts(list_filter(list_transform(regexp_split_to_array(body, '\\n\\s*\\n'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> ''), 1) AS i FROM bodies
    ), paras AS (SELECT *, {_TOKENS.format('t')} AS n FROM split),
    walk(arxiv_id, sec_no, i, total, grp) AS (
      SELECT arxiv_id, sec_no, i, n, 0 FROM paras WHERE i = 1
      UNION ALL
      SELECT p.arxiv_id, p.sec_no, p.i, CASE WHEN w.total + p.n <= 120 THEN w.total + p.n ELSE p.n END, CASE WHEN w.total + p.n <= 120 THEN w.grp ELSE w.grp + 1 END
      FROM walk AS w JOIN paras AS p ON p.arxiv_id = w.arxiv_id AND p.sec_no = w.sec_no AND p.i = w.i + 1
    ), grouped AS (
      SELECT w.arxiv_id, w.sec_no, w.grp, string_agg(p.t, chr(10) || chr(10) ORDER BY p.i) AS content, sum(p.n) AS tokens
      FROM walk AS w JOIN paras AS p USING (arxiv_id, sec_no, i) GROUP BY ALL
    )
    SELECT arxiv_id, CAST(row_number() OVER (PARTITION BY arxiv_id ORDER BY sec_no, grp) - 1 AS INT) AS ord, CAST(tokens AS BIGINT) AS tokens, content FROM grouped"""
)
def paper_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of the papers of at most 120 tokens, a size at which their short sections are split too."""
    found = chunks.chunks(latest_papers(spark, folder), "arxiv_id", "text", 120)
    return found.select("arxiv_id", "ord", "tokens", "content")


@query(
    """WITH near AS (
      SELECT q.vec_id AS id, e.vec_id AS neighbour, row_number() OVER (PARTITION BY q.vec_id ORDER BY
        round(list_inner_product(q.v, e.v) / sqrt(list_inner_product(q.v, q.v)) / sqrt(list_inner_product(e.v, e.v)), 4) DESC, e.vec_id) AS rank
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0) AS q,
        (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) AS e WHERE q.vec_id <> e.vec_id QUALIFY rank <= 5
    ), papers AS (SELECT vec_id AS id, unnest([label, vec_id % 7 + 100]) AS paper FROM embeddings),
    shares AS (
      SELECT id, avg(CAST(EXISTS (SELECT 1 FROM papers AS x JOIN papers AS y USING (paper) WHERE x.id = near.id AND y.id = near.neighbour) AS INT)) AS share FROM near GROUP BY id
    ) SELECT round(avg(share), 4) AS agreement, CAST(count(*) AS BIGINT) AS names FROM shares"""
)
def nn_shared_papers(spark: SparkSession, folder: str) -> DataFrame:
    """How often the five nearest vectors have a paper in common; papers are made of labels and ids."""
    rows = table(spark, folder, "embeddings", "vec_id", "label")
    papers = rows.select(F.col("vec_id").alias("id"), F.explode(F.array(F.col("label").cast("bigint"), F.col("vec_id") % 7 + 100)).alias("paper"))
    return export.shared_papers(_near(spark, folder, 5), papers)


@query(
    """SELECT (SELECT count(DISTINCT trim(name)) FROM entities WHERE trim(name) <> '') AS entities,
      (SELECT count(*) FROM (SELECT DISTINCT trim(alias), trim(canonical), lower(trim(verdict)) FROM alias_table
        WHERE trim(alias) <> '' AND trim(canonical) <> '' AND trim(alias) <> trim(canonical))) AS edges,
      (SELECT count(DISTINCT arxiv_id) FROM manifest) AS papers"""
)
def explorer_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of nodes, links and papers."""
    return export.statistics(nodes(spark, folder), _links(spark, folder), table(spark, folder, "manifest", F.col("arxiv_id").alias("paper")))


@query(
    """SELECT merge_id, trim(canonical) AS canonical, array_to_string(aliases, ' | ') AS aliases, method, cluster_id, reason, '' AS "correct? (y/n)"
    FROM (SELECT DISTINCT merge_id, canonical, aliases, method, cluster_id, reason FROM merges WHERE trim(canonical) <> '')"""
)
def review_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The merge log as a sheet for reviewers."""
    rows = table(spark, folder, "merges", "merge_id", "canonical", "aliases", "method", "cluster_id", "reason").withColumn("canonical", filled("canonical"))
    return export.review_sheet(rows.where("canonical IS NOT NULL").distinct(), "correct? (y/n)")


@query(
    """SELECT v.ent_id AS id, v.name, len(v.vectors) AS length, e.type FROM (SELECT name, ent_id, vectors FROM vectors_entities WHERE vectors IS NOT NULL) AS v
    JOIN (SELECT trim(name) AS name, min(lower(trim(entity_type))) AS type FROM entities WHERE trim(name) <> '' GROUP BY 1) AS e ON 'ent-' || md5(e.name) = v.ent_id"""
)
def vector_export(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes with their vectors, as they are exported; the type is read back from the JSON of what is known of a name."""
    rows = table(spark, folder, "vectors_entities", F.col("ent_id").alias("id"), F.col("vectors").alias("vector")).where("vector IS NOT NULL")
    found = export.vector_rows(nodes(spark, folder).select("name", "type"), rows)
    return found.select("id", "name", F.size("vector").cast("bigint").alias("length"), F.get_json_object("meta", "$.type").alias("type"))

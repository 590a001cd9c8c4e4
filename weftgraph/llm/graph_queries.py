"""Queries on merged names: surviving records and groups of linked names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.strings import filled, trimmed
from weftgraph.llm.components import linked
from weftgraph.llm.golden import Bundle, Dependency, best_bundles
from weftgraph.sources.tables import table


def merge_names(merges: DataFrame) -> DataFrame:
    """(merge_id, name): the different names of each merge that has a canonical name, over all its log rows, trimmed."""
    names = merges.select(
        "merge_id",
        filled("canonical").isNotNull().alias("led"),
        F.explode_outer(F.concat(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"),
    )
    names = names.select("merge_id", "led", filled("name").alias("name")).where("merge_id IS NOT NULL")
    named = names.where("name IS NOT NULL").groupBy("merge_id", "name").agg(F.max("led").alias("led"))
    return named.join(named.where("led").select("merge_id").distinct(), "merge_id", "left_semi").select("merge_id", "name")


def fragments(description: Column, least_words: int = 4) -> Column:
    """Number of different fragments of at least so many words; case and outer blanks don't matter. 0 for null."""
    parts = F.transform(F.split(description, "<SEP>"), lambda x: F.lower(trimmed(x)))
    long = F.filter(parts, lambda x: F.size(F.split(x, r"(?U)\s+")) >= least_words)
    return F.coalesce(F.size(F.array_distinct(long)), F.lit(0))


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entities", "entity_row", "name", "entity_type", "description", "degree", "updated_at")
    return rows.withColumn("name", filled("name"))


def _degree() -> Column:
    return F.when(F.col("degree") >= 0, F.col("degree"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Per merge with at least two entity rows the rows that give the name and the description."""
    ties = (F.col("updated_at"), -F.col("entity_row"))
    rows = _entities(spark, folder).select(
        "name",
        "updated_at",
        "entity_row",
        F.col("entity_row").alias("name_row"),
        F.col("entity_row").alias("description_row"),
        _degree().alias("degree"),
        fragments(F.col("description")).alias("fragments"),
    )
    best = best_bundles(
        merge_names(table(spark, folder, "merges", "merge_id", "canonical", "aliases")),
        rows,
        "name",
        "merge_id",
        [Bundle("name", ("name_row",), F.col("degree"), ties), Bundle("text", ("description_row",), F.col("fragments"), ties)],
    )
    return best.where("n_rows >= 2").select("merge_id", "name_row", "description_row")


def p1_golden(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of each merge: name and degree, type, description; the name determines the type.

    Trust in a name grows with its degree, in a type with the number of fragments of its row.
    """
    ties = (F.col("updated_at"), -F.col("entity_row"))
    rows = _entities(spark, folder).select(
        F.col("name").alias("key"),
        "updated_at",
        "entity_row",
        F.col("name").alias("best_name"),
        _degree().alias("degree"),
        F.lower(filled("entity_type")).alias("entity_type"),
        F.col("description"),
        fragments(F.col("description")).alias("fragments"),
    )
    return best_bundles(
        merge_names(table(spark, folder, "merges", "merge_id", "canonical", "aliases")).withColumnRenamed("name", "key"),
        rows,
        "key",
        "merge_id",
        [
            Bundle("name", ("best_name", "degree"), F.col("degree"), ties),
            Bundle("type", ("entity_type",), F.col("fragments"), ties),
            Bundle("text", ("description",), F.col("fragments"), ties),
        ],
        [Dependency("best_name", "entity_type")],
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every linked name and its group's least name."""
    rows = table(spark, folder, "alias_table", "alias", "canonical", "verdict")
    return linked(rows.where(F.lower(trimmed("verdict")) == "same"), "alias", "canonical")


QUERIES = {"p1_found": p1_found, "p1_golden": p1_golden, "p2_found": p2_found}

ORACLES = {
    "p1_found": r"""
        WITH logged AS (
          SELECT merge_id, canonical, unnest(list_concat([canonical], coalesce(aliases, []))) AS name FROM merges
        ), names AS (
          SELECT DISTINCT merge_id, trim(name) AS name FROM logged
          WHERE trim(name) <> '' AND merge_id IN (SELECT merge_id FROM merges WHERE trim(canonical) <> '')
        ), rated AS (
          SELECT entity_row, trim(name) AS name, updated_at, CASE WHEN degree >= 0 THEN degree ELSE -1 END AS degree,
            len(list_distinct(list_filter(list_transform(string_split(coalesce(description, ''), '<SEP>'), lambda x: lower(trim(x))),
              lambda x: len(regexp_split_to_array(x, '\s+')) >= 4))) AS fragments
          FROM entities
        ), bearing AS (SELECT merge_id, r.* EXCLUDE (name) FROM names JOIN rated AS r USING (name))
        SELECT merge_id,
          first(entity_row ORDER BY degree DESC, updated_at DESC NULLS LAST, entity_row) AS name_row,
          first(entity_row ORDER BY fragments DESC, updated_at DESC NULLS LAST, entity_row) AS description_row
        FROM bearing GROUP BY merge_id HAVING count(*) >= 2""",
    "p1_golden": r"""
        WITH logged AS (
          SELECT merge_id, unnest(list_concat([canonical], coalesce(aliases, []))) AS name FROM merges
        ), names AS (
          SELECT DISTINCT merge_id, trim(name) AS name FROM logged
          WHERE trim(name) <> '' AND merge_id IN (SELECT merge_id FROM merges WHERE trim(canonical) <> '')
        ), rated AS (
          SELECT entity_row, trim(name) AS name, nullif(lower(trim(entity_type)), '') AS entity_type, description, updated_at,
            CASE WHEN degree >= 0 THEN degree END AS degree, coalesce(CASE WHEN degree >= 0 THEN degree END, -1) AS trust,
            len(list_distinct(list_filter(list_transform(string_split(coalesce(description, ''), '<SEP>'), lambda x: lower(trim(x))),
              lambda x: len(regexp_split_to_array(x, '\s+')) >= 4))) AS fragments
          FROM entities
        ), bearing AS (SELECT merge_id, r.* FROM names JOIN rated AS r USING (name)
        ), attested AS (SELECT DISTINCT merge_id, name, entity_type FROM bearing
        ), ranked AS (
          SELECT a.merge_id, a.name AS best_name, a.degree, b.entity_type, row_number() OVER (PARTITION BY a.merge_id ORDER BY
            a.trust + b.fragments DESC, a.trust DESC, a.updated_at DESC NULLS LAST, a.entity_row,
            b.fragments DESC, b.updated_at DESC NULLS LAST, b.entity_row) AS place
          FROM bearing AS a JOIN bearing AS b ON b.merge_id = a.merge_id
          JOIN attested AS t ON t.merge_id = a.merge_id AND t.name = a.name AND t.entity_type IS NOT DISTINCT FROM b.entity_type
        ), texts AS (
          SELECT merge_id, count(*) AS n_rows, first(description ORDER BY fragments DESC, updated_at DESC NULLS LAST, entity_row) AS description
          FROM bearing GROUP BY merge_id
        )
        SELECT merge_id, n_rows, best_name, degree, entity_type, description FROM ranked JOIN texts USING (merge_id) WHERE place = 1""",
    "p2_found": """
        WITH RECURSIVE edges AS (
          SELECT trim(alias) AS a, trim(canonical) AS b FROM alias_table
          WHERE lower(trim(verdict)) = 'same' AND trim(alias) <> '' AND trim(canonical) <> '' AND trim(alias) <> trim(canonical)
        ), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
        reach(name, other) AS (
          SELECT a, a FROM both_ways UNION SELECT r.name, e.b FROM reach AS r JOIN both_ways AS e ON r.other = e.a
        )
        SELECT name, min(other) AS group_name FROM reach GROUP BY name""",
}

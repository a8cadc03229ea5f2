"""Questions over entities, triples and pages; each is one DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.entities import best_label, coordinates, first_destination, has_claim, has_relation, label
from terrace.functions.refs import P, Q


def entities_with_relation(entities: DataFrame, prop: str, dest: str) -> DataFrame:
    """(id, label) of entities with a relation; nothing is exploded."""
    return entities.where(has_relation((prop, dest))).select("id", best_label().alias("label"))


def role_holders(entities: DataFrame, labels: DataFrame, role: tuple[str, str] = (P(39), Q(11696)), fictional: tuple[tuple[str, str], ...] = ((P(31), Q(95074)), (P(31), Q(15632617))), work: str = P(1441)) -> DataFrame:
    """(id, line): 'label (work)' for fictional holders of a role, 'label, REAL' for others."""
    held = entities.where(has_relation(role)).select("id", best_label().alias("label"), has_relation(*fictional).alias("fiction"), first_destination(work).alias("work"))
    named = held.join(labels.select(F.col("id").alias("work"), F.col("label").alias("work_label")), "work", "left")
    line = F.when(F.col("fiction"), F.format_string("%s (%s)", "label", F.coalesce("work_label", F.lit("unknown work")))).otherwise(F.format_string("%s, REAL", "label"))
    return named.select("id", line.alias("line"))


def count_relation_and_claim(entities: DataFrame, relation: tuple[str, str], claim: str) -> DataFrame:
    """(n): entities with a relation and any claim of a property. 0 for no entities."""
    return entities.agg(F.count_if(has_relation(relation) & has_claim(claim)).alias("n"))


def identical_labels(entities: DataFrame, a: str = "en", b: str = "de") -> DataFrame:
    """(identical, n): whether two languages have the same label; a missing one never has."""
    return entities.groupBy(F.coalesce(label(a) == label(b), F.lit(False)).alias("identical")).agg(F.count("*").alias("n"))


def entity_coordinates(entities: DataFrame, prop: str = "P625") -> DataFrame:
    """(id, label, latitude, longitude): one row per coordinate; unset numbers are 0."""
    each = entities.select("id", best_label().alias("label"), F.explode(coordinates(prop)).alias("c"))
    return each.select("id", "label", F.coalesce("c.latitude", F.lit(0.0)).alias("latitude"), F.coalesce("c.longitude", F.lit(0.0)).alias("longitude"))

"""Property-graph tables: vertices (identifier, type, properties JSON) and edges.

Properties are JSON text built with ``to_json`` keeping NULL members, or, after
``variant_properties``, VARIANT values: parsed once when a table is stored, so that the
reports look members up instead of parsing the text for each property. Reports
that join vertices to edges pre-aggregate the edge side on its subject first
(partial aggregation), so a vertex with a huge number of edges is folded on the
mappers instead of being shuffled row by row into one join task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from tessera.functions.columns import json_get, json_object, safe_ratio
from tessera.operators.keys import dedup


def variant_properties(table: DataFrame) -> DataFrame:
    """A vertex or edge table with its properties as VARIANT; the reports take either form."""
    return table.withColumn("properties", F.parse_json("properties"))


def _property(table: DataFrame, name: str, cast: str | None = None) -> Column:
    """A member of the table's properties (as text without ``cast``), NULL where it is missing or doesn't cast."""
    if isinstance(table.schema["properties"].dataType, VariantType):
        return F.try_variant_get("properties", f"$.{name}", cast or "string")
    return json_get("properties", name, cast)


def vertices_from_rows(df: DataFrame, id_col: str | Column, vtype: str,
                       props: Mapping[str, str | Column]) -> DataFrame:
    """One vertex per row (op 10)."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    return df.select(i.cast("string").alias("identifier"), F.lit(vtype).alias("type"),
                     json_object(props).alias("properties"))


def vertices_from_agg(df: DataFrame, id_col: str, vtype: str,
                      aggs: Mapping[str, Column]) -> DataFrame:
    """One vertex per group of rows; properties are aggregates (op 11)."""
    g = df.groupBy(id_col).agg(*[a.alias(k) for k, a in aggs.items()])
    return vertices_from_rows(g, id_col, vtype, {k: F.col(k) for k in aggs})


def vertices_dedup(df: DataFrame, id_col: str, vtype: str, props: Mapping[str, str | Column],
                   order: Sequence[str | Column]) -> DataFrame:
    """One vertex per identifier, first row under ``order`` (op 12)."""
    return vertices_from_rows(dedup(df, [id_col], order), id_col, vtype, props)


def edges_from_rows(df: DataFrame, subject: str, subject_type: str, obj: str,
                    object_type: str, edge_type: str, props: Mapping[str, str | Column],
                    order: Sequence[str | Column]) -> DataFrame:
    """One edge per (subject, object) pair, first row under ``order`` (op 13)."""
    d = dedup(df, [subject, obj], order)
    return d.select(F.col(subject).cast("string").alias("subject_identifier"),
                    F.lit(subject_type).alias("subject_type"),
                    F.col(obj).cast("string").alias("object_identifier"),
                    F.lit(object_type).alias("object_type"),
                    F.lit(edge_type).alias("edge_type"),
                    json_object(props).alias("properties"))


def vertex_counts(vertices: DataFrame) -> DataFrame:
    """Vertices per type (op 15)."""
    return vertices.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def edge_property_max(vertices: DataFrame, edges: DataFrame, name_prop: str,
                      edge_prop: str, cast: str = "int") -> DataFrame:
    """Per vertex name, the max of an integer edge property over its edges (op 16).

    Edges are reduced to one row per subject before the join; then vertex
    names (which may repeat across identifiers) are grouped again.
    """
    per_subject = (edges.groupBy("subject_identifier", "subject_type")
                        .agg(F.max(_property(edges, edge_prop, cast)).alias("_m")))
    v = vertices.select(F.col("identifier").alias("subject_identifier"),
                        F.col("type").alias("subject_type"),
                        _property(vertices, name_prop).alias(name_prop))
    j = v.join(per_subject, ["subject_identifier", "subject_type"], "inner")
    return (j.groupBy(name_prop).agg(F.max("_m").alias(f"max_{edge_prop}"))
             .orderBy(F.col(f"max_{edge_prop}").desc_nulls_first(), F.col(name_prop)))


def edge_ratio_report(vertices: DataFrame, edges: DataFrame, object_type: str,
                      name_prop: str, num_prop: str, den_prop: str,
                      edge_props: Sequence[str]) -> DataFrame:
    """Row-level vertex/edge report (op 17).

    For each edge whose object has ``object_type``: the subject vertex's name,
    the object id, the ratio of two numeric vertex properties (zero
    denominator -> 1) and the requested edge properties as text. The vertex
    side has one row per key; AQE turns the join into a broadcast when the
    measured vertex side is small, and otherwise splits hot subjects with its
    skew-join. (No up-front size check: on a derived vertex table it would
    cost a full extra pass.)
    """
    v = vertices.select(F.col("identifier").alias("subject_identifier"),
                        F.col("type").alias("subject_type"),
                        _property(vertices, name_prop).alias(name_prop),
                        safe_ratio(_property(vertices, num_prop, "double"),
                                   _property(vertices, den_prop, "double")).alias("ratio"))
    e = edges.where(F.col("object_type") == object_type)
    j = e.join(v, ["subject_identifier", "subject_type"], "inner")
    return j.select(name_prop, "object_identifier", "ratio",
                    *[_property(edges, p).alias(p) for p in edge_props])

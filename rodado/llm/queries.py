"""Registered queries of this subpackage and, where SQL can say it, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import canonical, cooccur, linkage, packing, plaintext, subjects, tokenize


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return linkage.same_facilities(table(spark, d, "catastro"), table(spark, d, "ways")).select("feature_id", "way_id")


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    return linkage.same_facilities(table(spark, d, "catastro"), table(spark, d, "ways")).select(
        "feature_id", "way_id", F.round("confidence", 4).alias("confidence"), F.round("share", 3).alias("share"), F.round("offset_m", 1).alias("offset_m")
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return plaintext.plain_all(table(spark, d, "catastro"), table(spark, d, "places"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return cooccur.tag_pairs(table(spark, d, "routes")).select("tag_a", "tag_b")


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    return cooccur.tag_pairs(table(spark, d, "routes")).select("tag_a", "tag_b", "n_ab", "n_a", "n_b", F.round("lift", 4).alias("lift"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    values = canonical.typed_values(table(spark, d, "routes"), table(spark, d, "places"))
    return canonical.map_values(values, table(spark, d, "ref_terms"))


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, with the number of records that hold them."""
    return p5_found(spark, d).where("term_id = 0").groupBy("field", "raw_value").agg(F.count("*").alias("records"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(packing.pack_documents(table(spark, d, "documents"))).withColumn("unused_share", F.round("unused_share", 6))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.unlabelled_areas(table(spark, d, "documents"), table(spark, d, "doc_labels")).select("doc_id", "subject").distinct()


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each subject; a document of several counts for each."""
    return subjects.subject_areas(table(spark, d, "documents"), table(spark, d, "doc_labels")).groupBy("subject").agg(
        F.countDistinct("doc_id").alias("documents"), F.round(F.avg("share"), 3).alias("mean_share")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_links, p2_found, p4_found, p4_pairs, p5_found, p5_unmatched, p6_ids, p7_containers, p7_fill, p8_found, p8_composition)
}

_TAG_PAIRS = """
WITH t AS (SELECT DISTINCT route_id, tag FROM (SELECT route_id, unnest(tags) AS tag FROM routes WHERE route_id IS NOT NULL)
           WHERE tag IS NOT NULL AND trim(tag, E' \\t\\n\\r\\f\\x0b\\u00a0\\u2009\\u3000') <> ''),
n AS (SELECT count(DISTINCT route_id) AS n FROM t),
c AS (SELECT tag, count(*) AS k FROM t GROUP BY tag),
p AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n_ab FROM t a JOIN t b ON a.route_id = b.route_id AND a.tag < b.tag GROUP BY 1, 2)
SELECT {} FROM p JOIN c ca ON ca.tag = tag_a JOIN c cb ON cb.tag = tag_b CROSS JOIN n
WHERE n_ab >= 4 AND 10000 * n_ab >= n AND n_ab * n >= 3 * ca.k * cb.k"""

SQL: dict[str, str] = {
    "p4_found": _TAG_PAIRS.format("tag_a, tag_b"),
    "p4_pairs": _TAG_PAIRS.format("tag_a, tag_b, n_ab, ca.k AS n_a, cb.k AS n_b, round(n_ab::DOUBLE * n / (ca.k::DOUBLE * cb.k), 4) AS lift"),
}

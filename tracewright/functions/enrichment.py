"""Geography, threat lists and techniques as columns of canonical events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import mapping, network
from .fixed_values import THREAT_NETS, THREATS

#: Lists up to this many entries become a CASE; longer ones a join.
INLINE = 200


def enrich(events: DataFrame, ips: dict | None = None, nets: list | None = None, threshold: float = network.MALICIOUS) -> DataFrame:
    """All enrichment columns of canonical events, in one narrow pass.

    Threat lists are asked for the source, or for the destination if there is no
    source; without a hit the columns keep what they had. A malicious hit turns a
    missing or uncertain label into attack and lifts its confidence to 0.85.
    """
    ips, nets = THREATS if ips is None else ips, THREAT_NETS if nets is None else nets
    if len(ips) + len(nets) > INLINE:
        raise ValueError("long lists belong into a table: use enrich_from")
    asked = F.coalesce("src_ip", "dst_ip")
    return _applied(events.withColumn("__ti", network.threat(asked, ips, nets, threshold)))


def enrich_from(events: DataFrame, listed: DataFrame, nets: list | None = None, threshold: float = network.MALICIOUS) -> DataFrame:
    """:func:`enrich` with a table (ip, source, score) of any size, joined by the
    address; Spark broadcasts it only below its own threshold. Of repeated
    addresses the highest score counts."""
    best = listed.groupBy("ip").agg(F.max(F.struct("score", "source")).alias("hit")).select(F.col("ip").alias("__ip"), F.col("hit.source").alias("__s"), F.col("hit.score").alias("__v"))
    asked = network.bare(F.coalesce("src_ip", "dst_ip"))
    out = events.withColumn("__ask", asked).join(best, F.col("__ask") == F.col("__ip"), "left")
    exact = F.struct(F.col("__v").cast("double").alias("score"), F.col("__s").alias("source"), (F.col("__v") >= threshold).alias("is_malicious"))
    out = out.withColumn("__ti", F.when(F.col("__ip").isNotNull(), exact).otherwise(network.threat(F.col("__ask"), {}, THREAT_NETS if nets is None else nets, threshold)))
    return _applied(out.drop("__ask", "__ip", "__s", "__v"))


def _applied(df: DataFrame) -> DataFrame:
    src, dst, hit = F.col("__src"), F.col("__dst"), F.col("__ti")
    there, bad = hit["score"] > 0, (hit["score"] > 0) & hit["is_malicious"]
    unsure = F.col("weak_label").isNull() | F.col("weak_label").isin("", "uncertain")
    old = F.coalesce("label_confidence", F.lit(0.0))
    has_src = F.coalesce("src_ip", F.lit("")) != ""
    has_dst = F.coalesce("dst_ip", F.lit("")) != ""
    raw_text = F.coalesce(F.nullif(F.col("threat_name"), F.lit("")), F.col("threat_signature_name"))
    tech = mapping.technique(raw_text, F.lit(None).cast("string"), F.col("http_url"), F.col("raw_log"), F.col("event_action"))
    df = df.withColumns({"__src": network.geo(F.col("src_ip")), "__dst": network.geo(F.col("dst_ip")), "__tech": tech})
    kept = {c: F.col(c) for c in ("mitre_tactic", "mitre_technique_id", "mitre_technique_name")}
    out = {
        "src_country": F.when(has_src, src["country"]).otherwise(F.col("src_country")),
        "src_city": F.when(has_src, src["city"]).otherwise(F.col("src_city")),
        "src_asn": F.when(has_src, src["asn"]).otherwise(F.col("src_asn")),
        "is_src_private": F.when(has_src, src["is_private"]).otherwise(F.col("is_src_private")),
        "dst_country": F.when(has_dst, dst["country"]).otherwise(F.col("dst_country")),
        "threat_intel_score": F.when(there, hit["score"]).otherwise(F.col("threat_intel_score")),
        "threat_intel_source": F.when(there, hit["source"]).otherwise(F.col("threat_intel_source")),
        "is_malicious": F.when(there, hit["is_malicious"]).otherwise(F.col("is_malicious")),
        "weak_label": F.when(bad & unsure, "attack").otherwise(F.col("weak_label")),
        "label_confidence": F.when(bad, F.greatest(old, F.lit(0.85))).otherwise(F.col("label_confidence")),
        "mitre_tactic": F.coalesce(F.col("__tech")["tactic"], kept["mitre_tactic"]),
        "mitre_technique_id": F.coalesce(F.col("__tech")["technique_id"], kept["mitre_technique_id"]),
        "mitre_technique_name": F.coalesce(F.col("__tech")["technique_name"], kept["mitre_technique_name"]),
    }
    return df.withColumns(out).drop("__src", "__dst", "__ti", "__tech")

"""Cleaning, labelling, splits and weights over structured log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, network

DERIVED = ("timestamp_normalized", "client_ip_canonical", "ip_version", "source_port_normalized")
SENTINEL = r"\N"


def require(df: DataFrame, *names: str) -> DataFrame:
    """Column contract: fails before anything runs."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df


def checked(ok: Column, value: Column, what: str) -> Column:
    """``value``; the query fails where ``ok`` is not true."""
    return F.when(F.coalesce(ok, F.lit(False)), value).otherwise(F.raise_error(F.lit(what)).cast("string"))


def clean(df: DataFrame) -> DataFrame:
    """Adds the four normalised columns; invalid values fail the query. Rows are
    neither dropped, imputed, merged nor sorted, and cleaning twice changes nothing."""
    require(df, "timestamp", "client_ip", "source_port")
    df = df.drop(*DERIVED)
    ts = F.try_to_timestamp(F.col("timestamp").cast("string"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    port = F.col("source_port").cast("string").try_cast("double")
    version = network.ip_version(F.col("client_ip"))
    return df.withColumns({
        "timestamp_normalized": checked(ts.isNotNull(), ts.cast("string"), "a timestamp is not yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz"),
        "client_ip_canonical": checked(version.isNotNull(), network.canonical_ip(F.col("client_ip")), "an IP address is invalid"),
        "ip_version": version.cast("tinyint"),
        "source_port_normalized": checked((port % 1 == 0) & port.between(0, 65535), port.cast("string"), "a port is no whole number from 0 to 65535").cast("double").cast("long"),
    })


def weak_labels(df: DataFrame) -> DataFrame:
    require(df, "user_agent", "category_type", "sub_key", "language", "metadata")
    return df.withColumns(labels.label_columns())


def calendar_split(ts: Column, validation_from: str = "2024-01-01", test_from: str = "2024-02-01") -> Column:
    return F.when(ts < F.lit(validation_from).cast("timestamp_ntz"), "train").when(ts < F.lit(test_from).cast("timestamp_ntz"), "validation").otherwise("test")


def positional_split(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """First 70 %, next 15 %, rest by rank of a unique ordinal. The rank is a sum
    of per-range counts, so no task sorts the whole table."""
    from pyspark.sql import Window

    n = df.agg(F.count(F.lit(1)).alias("__n"))
    lo_hi = df.agg(F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi"))
    cells = df.crossJoin(F.broadcast(lo_hi)).withColumn("__cell", F.floor((F.col(ordinal) - F.col("lo")) * 4096 / (F.col("hi") - F.col("lo") + 1)))
    counts = cells.groupBy("__cell").agg(F.count(F.lit(1)).alias("__c"))  # at most 4,096 rows
    before = F.coalesce(F.sum("__c").over(Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("__cell", before.alias("__before"))
    rank = F.col("__before") + F.row_number().over(Window.partitionBy("__cell").orderBy(ordinal)) - 1
    out = cells.join(F.broadcast(base), "__cell").crossJoin(F.broadcast(n)).withColumn("__rank", rank)
    split = F.when(F.col("__rank") < F.floor(F.col("__n") * 0.7), "train").when(F.col("__rank") < F.floor(F.col("__n") * 0.85), "validation").otherwise("test")
    return out.withColumn("data_split", split).drop("__cell", "__before", "__n", "__rank", "lo", "hi")


def class_weights(df: DataFrame) -> DataFrame:
    """weak_label, n, class_weight N/(K·n) and mean confidence of attack and benign."""
    per = df.where(F.col("weak_label").isin("attack", "benign")).groupBy("weak_label").agg(F.count(F.lit(1)).alias("n"), F.avg("label_confidence").alias("mean_confidence"))
    total = per.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    return per.crossJoin(F.broadcast(total)).select("weak_label", "n", (F.col("total") / (F.col("k") * F.col("n"))).alias("class_weight"), "mean_confidence")


def sample_weights(df: DataFrame) -> DataFrame:
    """training_sample_weight = class weight × confidence / mean class confidence, by
    the train split's classes; 0 outside it and for uncertain events."""
    w = class_weights(df.where("data_split = 'train'"))  # two rows
    out = df.join(F.broadcast(w.select("weak_label", "class_weight", "mean_confidence")), "weak_label", "left")
    supervised = F.col("weak_label").isin("attack", "benign")
    eligible = supervised & (F.col("data_split") == "train")
    return out.withColumns({
        "supervised_eligible": supervised.cast("tinyint"),
        "training_eligible": eligible.cast("tinyint"),
        "training_sample_weight": F.when(eligible, F.col("class_weight") * F.col("label_confidence") / F.col("mean_confidence")).otherwise(0.0),
    }).drop("class_weight", "mean_confidence")


def effective_sample_size(df: DataFrame, weight: str = "training_sample_weight") -> DataFrame:
    w = F.col(weight)
    return df.where(w > 0).agg(F.count(F.lit(1)).alias("n"), (F.pow(F.sum(w), 2) / F.sum(w * w)).alias("ess"))


def invalid_labels(df: DataFrame) -> DataFrame:
    """Rows whose label or confidence breaks the vocabulary."""
    c, label = F.col("label_confidence"), F.col("weak_label")
    bad = label.isNull() | ~label.isin("attack", "benign", "uncertain") | c.isNull() | ~c.between(0, 1) | ((label == "uncertain") & (c != 0)) | ((label != "uncertain") & (c <= 0))
    return df.where(bad)

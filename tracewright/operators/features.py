"""Event-local features and features of a client's past."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TAUS = (60, 300, 3600)


def cyclic(ts: Column) -> dict[str, Column]:
    hour = F.hour(ts) + F.minute(ts) / 60 + F.second(ts) / 3600
    day = F.weekday(ts) + hour / 24
    a, b = hour * (2 * math.pi / 24), day * (2 * math.pi / 7)
    return {"hour_sin": F.sin(a), "hour_cos": F.cos(a), "weekday_sin": F.sin(b), "weekday_cos": F.cos(b), "is_weekend": (F.weekday(ts) >= 5).cast("int")}


def event_local(df: DataFrame) -> DataFrame:
    """Eleven features of single events: no shuffle."""
    ts, port, lang = F.col("timestamp_normalized"), F.col("source_port_normalized").cast("int"), F.col("language")
    there = lang.isNotNull() & (lang != "") & (lang != r"\N")
    return df.withColumns(cyclic(ts) | {
        "source_port_value": port,
        "is_privileged_port": (port <= 1023).cast("int"),
        "is_registered_port": port.between(1024, 49151).cast("int"),
        "is_dynamic_port": (port >= 49152).cast("int"),
        "language_present": there.cast("int"),
        "language_length": F.when(there, F.length(lang)).otherwise(0),
    })


def past_only(df: DataFrame, client: str = "client_ip_canonical", ordinal: str = "ordinal", taus=TAUS) -> DataFrame:
    """Ten features of what a client did before, in arrival order.

    One shuffle by client: all windows are over client, or client and a further
    key. Decayed activity is the sum over earlier events of exp(-(M - M_j)/tau)
    with M the running maximum of time. It is split into stretches of 512 tau, in
    which exponentials stay within a double; a stretch adds to the next one and is
    below e^-512 for later ones.
    """
    t = F.unix_timestamp(F.col("timestamp_normalized").cast("timestamp"))
    by = Window.partitionBy(client)
    order = by.orderBy(ordinal)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    port, last, prev = F.col("source_port_normalized"), F.lag("__t").over(order), F.lag("source_port_normalized").over(order)
    df = df.withColumn("__t", t).withColumn("__seen", F.row_number().over(Window.partitionBy(client, "source_port_normalized").orderBy(ordinal)) > 1)
    df = df.withColumns({
        "__m": F.max("__t").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "client_prior_event_count_log1p": F.log1p((F.row_number().over(order) - 1).cast("double")),
        "has_previous_event": last.isNotNull().cast("int"),
        "seconds_since_previous_log1p": F.log1p(F.greatest(F.coalesce(F.col("__t") - last, F.lit(0)), F.lit(0)).cast("double")),
        "timestamp_reversal_flag": F.coalesce(F.col("__t") < last, F.lit(False)).cast("int"),
        "same_port_as_previous": F.coalesce(port == prev, F.lit(False)).cast("int"),
        "source_port_seen_before": F.col("__seen").cast("int"),
        "prior_unique_ports_log1p": F.log1p(F.coalesce(F.sum((~F.col("__seen")).cast("long")).over(before), F.lit(0)).cast("double")),
    })
    for tau in taus:
        w = 512 * tau
        b = F.floor(F.col("__m") / w)
        df = df.withColumn("__b", b).withColumn("__e", F.exp((F.col("__m") - b * w) / tau))
        here = Window.partitionBy(client, "__b").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
        there = by.orderBy("__b").rangeBetween(-1, -1)
        past = F.col("__m") - F.col("__b") * w
        df = df.withColumn(f"activity_decay_{tau}s", F.coalesce(F.sum("__e").over(here), F.lit(0.0)) * F.exp(-past / tau) + F.coalesce(F.sum("__e").over(there), F.lit(0.0)) * F.exp(-(past + w) / tau))
    return df.drop("__t", "__seen", "__m", "__b", "__e")


def statistics(df: DataFrame, names: list[str]) -> DataFrame:
    """feature, minimum, maximum, mean, non_zero, constant: one pass, then unpivoted."""
    aggs = []
    for n in names:
        c = F.col(n).cast("double")
        aggs += [F.struct(F.lit(n).alias("feature"), F.min(c).alias("minimum"), F.max(c).alias("maximum"), F.avg(c).alias("mean"), F.count_if(c != 0).alias("non_zero")).alias(n)]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.col(n) for n in names])).alias("s")).select("s.*").withColumn("constant", F.col("minimum") == F.col("maximum"))

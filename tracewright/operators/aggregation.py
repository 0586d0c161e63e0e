"""Aggregate views, regimes and reconciliation.

All views are partial and final hash aggregates over one shuffle by their grain;
distinct counts are exact.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Raw columns that no analysis view may show.
FORBIDDEN = ("client_ip", "client_ip_canonical", "user_agent", "metadata")
LABELS, SPLITS = ("attack", "benign", "uncertain"), ("train", "validation", "test")
#: Quantiles of active hours that a burst threshold is chosen from.
LADDER = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.995, 1.0)


def flag(c: Column) -> Column:
    """true/1 and false/0 in any case; anything else fails the query."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "1"), F.lit(True)).when(t.isin("false", "0"), F.lit(False)).otherwise(F.raise_error(F.lit("not a binary value")).cast("boolean"))


def aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side without the same (event_id, record_hash) in the other."""
    key = ["event_id", "record_hash"]
    l, r = left.groupBy(*key).agg(F.count(F.lit(1)).alias("n_left")), right.groupBy(*key).agg(F.count(F.lit(1)).alias("n_right"))
    return l.join(r, key, "full").where(F.coalesce("n_left", F.lit(0)) != F.coalesce("n_right", F.lit(0)))


def combined(*sidecars: DataFrame) -> DataFrame:
    """Sidecars joined on (event_id, record_hash); one shuffle each at most."""
    out = sidecars[0]
    for s in sidecars[1:]:
        out = out.join(s, ["event_id", "record_hash"])
    return out


def filled(per: DataFrame, at: str, step: str) -> DataFrame:
    """``per`` with a row for every ``step`` between its first and last ``at``; the
    other columns of those that were not there are null. One row a step."""
    span = per.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo is not null")
    return span.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias(at)).join(per, at, "left")


def view_violations(view: DataFrame) -> DataFrame:
    """violation, n: one row for each rule of analysis views that ``view`` could
    break, and one for each forbidden column it has. One pass of aggregates."""
    c, count = F.col, lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    rules = {
        "missing": count(reduce(or_, [F.col(f"`{x}`").isNull() for x in view.columns])),
        "port_out_of_range": count(~c("source_port_normalized").between(0, 65535)),
        "confidence_out_of_range": count(~c("label_confidence").between(0, 1)),
        "unexpected_label": count(~F.trim("weak_label").isin(*LABELS)),
        "unexpected_split": count(~F.trim("data_split").isin(*SPLITS)),
    } | {f"forbidden_column:{x}": F.count(F.lit(1)) for x in FORBIDDEN if x in view.columns}
    one = view.agg(F.array(*[F.struct(F.lit(k).alias("violation"), v.alias("n")) for k, v in rules.items()]).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.*")


def checked_view(view: DataFrame) -> DataFrame:
    """``view`` itself; fails if it shows forbidden columns or breaks a rule."""
    bad = {r.violation: r.n for r in view_violations(view).collect() if r.n or r.violation.startswith("forbidden")}
    if bad:
        raise ValueError(f"not an analysis view: {bad}")
    return view


def ordered(view: DataFrame, *grain: str) -> DataFrame:
    """A view in the order of its grain, for a sink; rows of one grain by all columns."""
    return view.orderBy(*grain, *[c for c in view.columns if c not in grain])


def _metrics(client: str) -> list[Column]:
    n, label = F.count(F.lit(1)), F.col("weak_label")
    share = lambda c: F.count_if(c) * 100.0 / n
    out = [n.alias("event_count"), F.countDistinct(client).alias("unique_client_count")]
    for v in ("attack", "benign", "uncertain"):
        out += [F.count_if(label == v).alias(f"{v}_count"), share(label == v).alias(f"{v}_percent")]
    return out + [F.count_if("label_conflict").alias("conflict_count"), share(F.col("label_conflict")).alias("conflict_percent"), F.avg("label_confidence").alias("mean_label_confidence"), F.sum(F.col("timestamp_reversal_flag").cast("long")).alias("timestamp_reversal_count")]


def time_view(df: DataFrame, grain: str = "hour", client: str = "client_key") -> DataFrame:
    """One row per hour_start (or day) and data_split."""
    name = "hour_start" if grain == "hour" else "day"
    return df.groupBy(F.date_trunc(grain, "timestamp_normalized").alias(name), "data_split").agg(*_metrics(client))


def client_view(df: DataFrame, daily: bool = False, client: str = "client_key", decays=()) -> DataFrame:
    """One row per client (and day) and data_split."""
    keys = [F.col(client)] + ([F.date_trunc("day", "timestamp_normalized").alias("day")] if daily else []) + [F.col("data_split")]
    ts = F.col("timestamp_normalized")
    span = F.unix_timestamp(F.max(ts).cast("timestamp")) - F.unix_timestamp(F.min(ts).cast("timestamp"))
    more = [F.min(ts).alias("first_timestamp"), F.max(ts).alias("last_timestamp"), span.alias("active_span_seconds"), F.countDistinct("source_port_normalized").alias("unique_port_count")]
    return df.groupBy(*keys).agg(*[m for m in _metrics(client) if "unique_client_count" not in str(m)], *more, *[F.avg(d).alias(f"mean_{d}") for d in decays])


def reconcile(view: DataFrame, events: int, grain: list[str]) -> None:
    """Fails unless the view has all events, labels add up and grains are unique."""
    got = view.agg(F.sum("event_count").alias("n"), F.count_if(F.col("attack_count") + F.col("benign_count") + F.col("uncertain_count") != F.col("event_count")).alias("bad"), F.count(F.lit(1)).alias("rows"), F.countDistinct(F.struct(*grain)).alias("grains")).first()
    if (got.n or 0) != events or got.bad or got.rows != got.grains:
        raise ValueError(f"the view does not reconcile: {got} for {events} events")


def client_profile(df: DataFrame, client: str = "client_ip") -> DataFrame:
    """Evidence profile of each client from event-level masks."""
    n = F.count(F.lit(1))
    s, p, b = (F.count_if(c) for c in ("declared_scanner", "payload_attack_pattern", "browser_style"))
    hours = (F.unix_timestamp(F.max("timestamp_normalized").cast("timestamp")) - F.unix_timestamp(F.min("timestamp_normalized").cast("timestamp"))) / 3600
    return df.groupBy(client).agg(
        n.alias("event_count"), s.alias("scanner_events"), p.alias("payload_events"), b.alias("browser_events"), hours.alias("span_hours"),
        (s / n).alias("scanner_ratio"), (p / n).alias("payload_ratio"), (b / n).alias("browser_ratio"), (s > 0).alias("any_scanner"), (p > 0).alias("any_payload"), (b > 0).alias("any_browser"))


def burst_threshold(hourly: DataFrame, q: float = 0.99) -> DataFrame:
    """One row: the linearly interpolated quantile of train hours, and its ceiling."""
    v = F.percentile("event_count", F.lit(q))
    return hourly.where("data_split = 'train'").agg(v.alias("threshold_training_quantile"), F.ceil(v).alias("burst_threshold_event_count"))


def regimes(hourly: DataFrame, threshold: DataFrame) -> DataFrame:
    """burst, post_burst (the hour right after a burst) or ordinary. The window is
    over all hours: about 10^4 rows a year whatever the events."""
    order = Window.orderBy("hour_start", "data_split")
    out = hourly.crossJoin(F.broadcast(threshold)).withColumn("__burst", F.col("event_count") >= F.col("burst_threshold_event_count"))
    after = F.lag("__burst").over(order) & (F.lag("hour_start").over(order) + F.expr("INTERVAL 1 HOUR") == F.col("hour_start"))
    return out.withColumn("volume_regime", F.when(F.col("__burst"), "burst").when(F.coalesce(after, F.lit(False)), "post_burst").otherwise("ordinary")).drop("__burst").withColumn("regime_version", F.lit("volume-regime-v1"))


def regime_distribution(view: DataFrame) -> DataFrame:
    per = view.groupBy("data_split", "volume_regime").agg(F.count(F.lit(1)).alias("hours"), F.sum("event_count").alias("events"))
    w = Window.partitionBy("data_split")
    return per.withColumns({"hour_percent": F.col("hours") * 100.0 / F.sum("hours").over(w), "event_percent": F.col("events") * 100.0 / F.sum("events").over(w)})


def missing_days(daily: DataFrame) -> DataFrame:
    have = daily.select(F.col("day").cast("date").alias("day")).distinct()
    return have.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day")).join(have, "day", "left_anti")


def daily_summary(daily: DataFrame) -> DataFrame:
    c = F.col("event_count")
    per = daily.groupBy("data_split").agg(F.count(F.lit(1)).alias("days"), F.sum(c).alias("events"), F.avg(c).alias("mean"), F.percentile(c, F.lit(0.5)).alias("median"), F.percentile(c, F.lit(0.95)).alias("p95"), F.max(c).alias("largest"), F.max_by(F.col("day"), F.struct(c, F.col("day"))).alias("peak_day"))
    return per.withColumns({"largest_to_median": F.col("largest") / F.col("median"), "share": F.col("events") / F.sum("events").over(Window.partitionBy(F.lit(1)))})

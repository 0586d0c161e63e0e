"""Profiles of tables: missing values, frequencies, shapes, concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _unpivot(df: DataFrame, aggs: dict[str, list]) -> DataFrame:
    """One pass of aggregates a column, then one row a column."""
    one = df.agg(*[F.struct(F.lit(c).alias("field"), *xs).alias(f"c{k}") for k, (c, xs) in enumerate(aggs.items())])
    return one.select(F.explode(F.array(*[F.col(f"c{k}") for k in range(len(aggs))])).alias("s")).select("s.*")


def missing_profile(df: DataFrame, names: list[str]) -> DataFrame:
    """field, missing (null or white space), missing_percent."""
    blank = {c: F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")) for c in names}
    n = F.count(F.lit(1))
    return _unpivot(df, {c: [b.alias("missing"), (b * 100.0 / n).alias("missing_percent")] for c, b in blank.items()})


def null_empty_whitespace(df: DataFrame, names: list[str]) -> DataFrame:
    out = {}
    for c in names:
        s = F.col(c).cast("string")
        out[c] = [F.count_if(s.isNull()).alias("nulls"), F.count_if(s == "").alias("empty"), F.count_if((s != "") & s.rlike(r"^\s+$")).alias("whitespace_only")]
    return _unpivot(df, out)


def value_ranges(df: DataFrame, ts: str = "timestamp", port: str = "source_port") -> DataFrame:
    """One row: earliest, latest, invalid_timestamps (missing ones too) and
    invalid_ports (given, but no whole number from 1 to 65535)."""
    t = F.col(ts).try_cast("timestamp_ntz")
    text = F.trim(F.col(port).cast("string"))
    valid = text.rlike(r"^[+-]?\d+$") & text.try_cast("decimal(38,0)").between(1, 65535)
    return df.agg(F.min(t).alias("earliest"), F.max(t).alias("latest"), F.count_if(t.isNull()).alias("invalid_timestamps"), F.count_if((text != "") & ~F.coalesce(valid, F.lit(False))).alias("invalid_ports"))


def frequency(df: DataFrame, name: str) -> DataFrame:
    """value, n: the pre-aggregated counts that the reports below start from."""
    return df.groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, name: str, k: int = 10) -> DataFrame:
    """The k most frequent non-missing values with shares and running coverage.
    The totals come from one aggregate; the window sees k rows."""
    counts = frequency(df, name)
    there = F.col("value").isNotNull() & (F.trim(F.col("value").cast("string")) != "")
    totals = counts.agg(F.sum("n").alias("all"), F.sum(F.when(there, F.col("n"))).alias("present"))
    top = counts.where(there).orderBy(F.desc("n"), "value").limit(k)
    w = Window.orderBy(F.desc("n"), "value")
    out = top.crossJoin(F.broadcast(totals)).withColumns({"rank": F.row_number().over(w), "share_of_all": F.col("n") / F.col("all"), "share_of_present": F.col("n") / F.col("present"), "coverage": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.col("present")})
    return out.drop("all", "present")


def concentration(df: DataFrame, name: str) -> DataFrame:
    """distinct values and the share of the 1, 5 and 10 most frequent ones."""
    counts = frequency(df, name).where("value is not null")
    total = counts.agg(F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("total"))
    top = counts.orderBy(F.desc("n"), "value").limit(10).withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "value")))
    cover = top.agg(*[F.sum(F.when(F.col("r") <= k, F.col("n"))).alias(f"t{k}") for k in (1, 5, 10)])
    return total.crossJoin(F.broadcast(cover)).select("distinct_values", *[(F.col(f"t{k}") / F.col("total")).alias(f"top_{k}_coverage") for k in (1, 5, 10)])


def reservoir(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """A uniform sample of k rows by a seeded hash of a unique key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(k)


def line_counts(parsed: DataFrame) -> DataFrame:
    """lines, blank_lines, concatenated_lines (more than one value) and values of
    parsed arrays; a line's second value marks it, so nothing is grouped by line."""
    at, n = F.col("array_position"), F.count_if
    return parsed.agg(n(at.isNull() | (at == 1)).alias("lines"), n(F.col("parse_status") == "blank").alias("blank_lines"), n(at == 2).alias("concatenated_lines"), n(at.isNotNull()).alias("values"))


def timestamp_shapes(df: DataFrame, name: str) -> DataFrame:
    """shape (digits as D), zone (utc, offset, none), n."""
    s = F.col(name).cast("string")
    zone = F.when(s.rlike("(?i)(z|utc|gmt)$"), "utc").when(s.rlike(r"[+-]\d{2}:?\d{2}$"), "offset").otherwise("none")
    return df.groupBy(F.regexp_replace(s, r"\d", "D").alias("shape"), zone.alias("zone")).agg(F.count(F.lit(1)).alias("n"))


def repeated_content(df: DataFrame, key: str) -> DataFrame:
    """rows, distinct_contents, repeated_rows, repeated_percent."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_contents")).withColumns({"repeated_rows": F.col("rows") - F.col("distinct_contents"), "repeated_percent": (F.col("rows") - F.col("distinct_contents")) * 100.0 / F.col("rows")})


def evidence_inventory(df: DataFrame, masks: dict) -> DataFrame:
    n = F.count(F.lit(1))
    return _unpivot(df, {k: [F.count_if(m).alias("events"), (F.count_if(m) * 100.0 / n).alias("percent")] for k, m in masks.items()})


def reversal_audit(df: DataFrame, ts: str, ordinal: str) -> DataFrame:
    """Backward jumps of time in arrival order, over ranges of the ordinal: each
    range compares its rows in one task, and its first with the last of the range
    before, so no task sorts the table."""
    lim = df.agg(F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi"))
    cells = df.crossJoin(F.broadcast(lim)).select(F.col(ordinal).alias("o"), F.unix_timestamp(F.col(ts).cast("timestamp")).alias("t"), F.floor((F.col(ordinal) - F.col("lo")) * 4096 / (F.col("hi") - F.col("lo") + 1)).alias("cell"))
    ends = cells.groupBy("cell").agg(F.max_by("t", "o").alias("t_last"))  # at most 4,096 rows
    prior = ends.select("cell", F.lag("t_last").over(Window.orderBy("cell")).alias("t_before"))
    jump = F.coalesce(F.lag("t").over(Window.partitionBy("cell").orderBy("o")), F.col("t_before")) - F.col("t")
    back = cells.join(F.broadcast(prior), "cell").withColumn("jump", jump).where("jump > 0")
    qs = F.percentile("jump", F.array(*map(F.lit, (0.5, 0.9, 0.95, 0.99))))
    return back.agg(F.count(F.lit(1)).alias("reversals"), F.max("jump").alias("largest"), *[qs.getItem(k).alias(f"p{p}") for k, p in enumerate((50, 90, 95, 99))], F.count_if(F.col("jump") > 60).alias("over_minute"), F.count_if(F.col("jump") > 3600).alias("over_hour"), F.count_if(F.col("jump") > 86400).alias("over_day"))

"""From raw lines to canonical events, alerts and a manifest.

One lazy plan: read, detect, parse, map, enrich, classify, validate. Only the
alerts shuffle, by entity. Events are stored once as Parquet; sinks, alerts and
counts read that.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crypto, enrichment, mapping, parsers
from ..operators import correlation
from ..sources import logs, provenance, sinks

XML_FORMATS = ("windows_event_xml", "xml_generic")
GENERIC = ("csv", "json", "xml")
#: Time patterns of parsers' raw times, tried in order.
TIME_PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy-HH:mm:ss[.SSSSSS]", "MMM d yyyy HH:mm:ss", "MMM dd yyyy HH:mm:ss"]


def event_time(raw: Column, year: int = 2024) -> Column:
    """A raw time as a timestamp in UTC, or null; ``year`` completes times without one."""
    t = F.trim(raw)
    full = F.when(t.rlike(r"^[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:"), F.regexp_replace(t, r"^([A-Z][a-z]{2})\s+(\d{1,2})\s+", f"$1 $2 {year} ")).when(t.rlike(r"^\d{2}/\d{2}-"), F.regexp_replace(t, r"^(\d{2}/\d{2})-", f"$1/{year}-")).otherwise(F.regexp_replace(t, r"\s+", " "))
    return F.coalesce(*[F.try_to_timestamp(full, F.lit(p)) for p in TIME_PATTERNS])


def detect_file(lines: DataFrame, sample: int = 10) -> str | None:
    """The format of most of the first non-blank lines. Specific formats beat csv,
    json and xml; ties go by the order of detection. One small aggregate."""
    tests = parsers.recognisers(F.col("line"))
    some = lines.orderBy("ordinal").limit(sample)
    hits = some.agg(*[F.count_if(t).alias(k) for k, t in tests.items()]).first().asDict()
    found = {k: n for k, n in hits.items() if n}
    specific = {k: n for k, n in found.items() if k not in GENERIC} or found
    return max(specific, key=specific.get) if specific else None


def parsed(lines: DataFrame, format_name: str | None = None) -> DataFrame:
    """Lines with format_name, success, fields, extra and error.

    With a given format one parser runs. Without, each line is recognised on its
    own; XML lines, which need Python, take a branch of their own, so that the
    others stay in the JVM. Lines that nothing recognises fail.
    """
    parsers.last_wins(lines.sparkSession)
    line = F.col("line")

    def unpack(df: DataFrame, p: Column) -> DataFrame:
        # a generator, since a filter on success would be pushed below a projection and parse again
        return df.select("*", F.inline(F.array(p)))

    if format_name == "csv":
        first = lines.groupBy("source_file").agg(F.min_by("line", "ordinal").alias("__head"), F.min("ordinal").alias("__first"))
        cells, head = parsers.csv_fields(F.trim(line)), parsers.csv_fields(F.trim(F.col("__head")))
        ok = (F.size(cells) == F.size(head)) & (F.col("ordinal") != F.col("__first"))
        entries = F.zip_with(head, cells, lambda k, v: F.struct(F.trim(k).alias("key"), F.nullif(F.trim(v), F.lit("")).alias("value")))
        message = F.when(F.col("ordinal") == F.col("__first"), "header line").otherwise("column count mismatch")
        none = F.create_map().cast(parsers.MAP)
        p = F.struct(ok.alias("success"), F.when(ok, parsers.compact(entries)).otherwise(none).alias("fields"), none.alias("extra"), F.when(~ok, message).alias("error"))
        return unpack(lines.join(first, "source_file").withColumn("format_name", F.lit("csv")), p).drop("__head", "__first")
    if format_name:
        return unpack(lines.withColumn("format_name", F.lit(format_name)), parsers.parse(line, format_name))
    known = lines.withColumn("format_name", F.coalesce(parsers.detect(line), F.lit("unknown")))
    plain = parsers.result(F.lit(False), F.create_map().cast(parsers.MAP), None, "no parser recognises the line")
    for name in reversed([n for n in parsers.PARSERS if n not in XML_FORMATS]):
        plain = F.when(F.col("format_name") == name, parsers.parse(line, name)).otherwise(plain)
    out = unpack(known.where(~F.col("format_name").isin(*XML_FORMATS)), plain)
    for name in XML_FORMATS:
        out = out.unionByName(unpack(known.where(F.col("format_name") == name), parsers.parse(line, name)))
    return out


def events(parsed_lines: DataFrame, source_id: str, field_map: dict | None = None, defaults: dict | None = None, alias_action: bool = False, processing_time: bool = False) -> DataFrame:
    """Canonical events of parsed lines. Identity columns are the engine's own:
    event_uid is derived from source, ordinal and line, so that a rerun repeats it.
    ``alias_action`` maps a parser's ``action`` to event_action; by default it stays
    an extra field. ``processing_time`` leaves timestamp_utc empty."""
    fmap = dict(field_map or {}) | ({"action": "event_action"} if alias_action else {})
    ok = parsed_lines.where("success")
    uid = F.sha2(F.concat_ws("|", F.lit(source_id), F.col("ordinal").cast("string"), "line"), 256)
    df = ok.withColumns({"event_uid": F.regexp_replace(F.substring(uid, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), "record_hash": crypto.record_hash(F.col("line")), "raw_log": F.col("line"), "source_id": F.lit(source_id), "ingest_timestamp": F.current_timestamp()})
    df = mapping.map_fields(df.drop("line", "success", "error"), fmap, defaults)
    return df if processing_time else df.withColumn("timestamp_utc", F.coalesce("timestamp_utc", event_time(F.col("timestamp_raw"))))


def validated(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", mapping.validation_errors())


def is_ready(line, any_object: bool = False):
    """Whether a line is a JSON event already: an object with an event_uid or a
    raw_log, or any object."""
    keys = F.json_object_keys(line)
    named = F.lit(True) if any_object else F.array_contains(keys, "event_uid") | F.array_contains(keys, "raw_log")
    return F.coalesce(keys.isNotNull() & named, F.lit(False))


def ready_events(lines: DataFrame, source_id: str) -> DataFrame:
    """Events of lines that are JSON events: their own identity where they state
    one, canonical columns by name, all else in the extra fields. Not enriched."""
    parsers.last_wins(lines.sparkSession)
    f = F.from_json("line", "map<string,string>")
    own = lambda k: F.try_element_at("__f", F.lit(k))
    uid = F.sha2(F.concat_ws("|", F.lit(source_id), F.col("ordinal").cast("string"), "line"), 256)
    df = lines.withColumn("__f", f).withColumns({
        "event_uid": F.coalesce(own("event_uid"), F.regexp_replace(F.substring(uid, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")),
        "raw_log": F.coalesce(own("raw_log"), F.col("line")), "format_name": own("format_name"), "source_id": F.coalesce(own("source_id"), F.lit(source_id)),
        "ingest_timestamp": F.coalesce(own("ingest_timestamp").try_cast("timestamp"), F.current_timestamp()), "fields": F.map_filter("__f", lambda k, v: ~k.isin(*mapping.IDENTITY)), "extra": F.create_map().cast(parsers.MAP),
    })
    df = df.withColumn("record_hash", F.coalesce(own("record_hash"), crypto.record_hash(F.col("raw_log"))))
    return mapping.map_fields(df.drop("line", "__f"))


def direct_events(lines: DataFrame, source_id: str, any_object: bool = False, enrich: bool = True) -> DataFrame:
    """Events of lines of which some are JSON events already and the rest raw logs;
    lines that no parser takes are left out. Batch or stream."""
    ready = is_ready(F.col("line"), any_object)
    raw = events(parsed(lines.where(~ready)), source_id)
    raw = enrichment.enrich(raw) if enrich else raw
    return raw.unionByName(ready_events(lines.where(ready), source_id), allowMissingColumns=True)


def process(spark: SparkSession, lines: list[str], format_name: str | None = None, enrich: bool = True) -> DataFrame:
    """A few lines given directly: canonical events with ``is_threat``."""
    df = spark.createDataFrame([(k, x.strip()) for k, x in enumerate(lines) if x.strip()], "ordinal long, line string").withColumn("source_file", F.lit("direct"))
    out = events(parsed(df, format_name), "api_process")
    return (enrichment.enrich(out) if enrich else out).withColumn("is_threat", mapping.is_threat())


def run_pipeline(spark: SparkSession, source: str, target: str, output_format: str = "json-lines", format_name: str | None = None, source_id: str | None = None, field_map: dict | None = None, max_events: int | None = None, enrich: bool = True, classify=None, correlate: bool = True, alerts_path: str | None = None, manifest_path: str | None = None) -> dict:
    """Reads ``source``, writes valid events to ``target``, alerts and a manifest
    beside it, and returns the counts. ``classify`` is a fitted model of
    :mod:`operators.ml` or None."""
    began = time.time()
    lines = logs.read_lines(spark, source, max_events)
    format_name = format_name or detect_file(lines)
    df = events(parsed(lines, format_name), source_id or source.rstrip("/").rpartition("/")[2], field_map)
    if enrich:
        df = enrichment.enrich(df)
    if classify is not None:
        df = classify.annotate(df)
    held = f"{target.rstrip('/')}.events"
    validated(df).write.mode("overwrite").parquet(held)
    rows = spark.read.parquet(held)
    stored = rows.where("errors = ''").drop("errors")
    sinks.writer(output_format)(stored, target)
    total, got = lines.count(), rows.agg(F.count(F.lit(1)).alias("parsed"), F.count_if(F.col("errors") == "").alias("valid")).first()
    summary = {"format_name": format_name or "unknown", "output_format": output_format, "total_lines": total, "parsed_ok": got.valid, "parse_errors": total - got.parsed, "schema_errors": got.parsed - got.valid, "alerts_generated": 0}
    if correlate:
        alerts_path = alerts_path or f"{target.rstrip('/')}.alerts"
        found = correlation.alerts(stored)
        sinks.write_json_lines(found, alerts_path)
        summary["alerts_generated"] = spark.read.text(alerts_path).count()
    took = max(time.time() - began, 1e-9)
    summary |= {"elapsed_seconds": took, "events_per_second": summary["parsed_ok"] / took}
    if manifest_path:
        stages = {"detection": {"format_name": summary["format_name"]}, "normalization": {k: summary[k] for k in ("total_lines", "parsed_ok", "parse_errors", "schema_errors")}, "contextual_enrichment": {"enabled": enrich}, "machine_learning": {"enabled": classify is not None}, "correlation_engine": {"enabled": correlate, "sliding_window_sec": correlation.MAX_WINDOW}}
        provenance.write_manifest(spark, manifest_path, source, target, alerts_path if correlate else None, summary, stages)
    return summary


def summary(df: DataFrame) -> DataFrame:
    """events, attack share, threat share and dominant format of canonical events."""
    per = df.groupBy("format_name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("weak_label") == "attack").alias("attacks"))
    return per.agg(F.sum("n").alias("events"), F.sum("attacks").alias("attacks"), F.max_by("format_name", F.struct("n", "format_name")).alias("dominant_format"))

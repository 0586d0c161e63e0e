"""Sinks: JSON lines, CSV, CEF, alerts, quarantine; several at once; exports that
can be repeated. All write directories of part files through Spark's committer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import CEF_SEVERITY
from ..functions.parsers import pick

CSV_COLUMNS = (
    "event_uid record_hash ingest_timestamp timestamp_utc format_name source_id vendor device_type src_ip dst_ip src_port dst_port protocol event_category event_action severity "
    "threat_name threat_signature_id username user_agent http_method http_url http_status weak_label label_confidence evidence_codes label_conflict raw_log"
).split()


def json_line(df: DataFrame) -> Column:
    """All columns as a JSON object with its nulls; times in ISO 8601."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def pruned_json_line(df: DataFrame) -> Column:
    """Without nulls, empty texts and empty maps, as the dashboard shows events."""
    cols = []
    for c, t in df.dtypes:
        x = F.col(f"`{c}`")
        cols.append(F.when(x != "", x).alias(c) if t == "string" else F.when(F.size(x) > 0, x).alias(c) if t.startswith("map") else x)
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def _header(value: Column) -> Column:
    return F.replace(F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def _extension(key: str, value: Column) -> Column:
    v = value.cast("string")
    for a, b in (("\\", "\\\\"), ("=", "\\="), ("\n", "\\n"), ("\r", "\\r")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return F.concat(F.lit(f"{key}="), v)


def cef_line(vendor: str = "Tracewright", product: str = "LogEngine", version: str = "1.0") -> Column:
    """A canonical event as one CEF line; absent fields are left out and the
    message is the first 512 characters of the raw line."""
    c = F.col
    full = lambda x: F.nullif(x, F.lit(""))
    sig = F.coalesce(full(c("threat_signature_id")), F.substring("event_uid", 1, 8))
    name = F.coalesce(full(c("threat_name")), c("event_category"))
    head = F.concat_ws("|", F.lit("CEF:0"), F.lit(vendor), F.lit(product), F.lit(version), _header(sig), _header(name), pick(c("severity"), CEF_SEVERITY, 0).cast("string"))
    labels = ("record_hash", "weak_label", "evidence_codes", "format_name", "source_id")
    parts = [
        ("eventId", c("event_uid")), ("cs1", c("record_hash")), ("cs1Label", F.lit(labels[0])), ("rt", F.unix_millis(c("timestamp_utc"))),
        ("src", c("src_ip")), ("spt", c("src_port")), ("dst", c("dst_ip")), ("dpt", c("dst_port")), ("proto", c("protocol")), ("act", c("event_action")),
        ("requestMethod", c("http_method")), ("request", c("http_url")), ("requestClientApplication", c("user_agent")), ("suser", c("username")), ("dvchost", c("device_hostname")), ("dvc", c("device_ip")),
        ("cs2", c("weak_label")), ("cs2Label", F.lit(labels[1])), ("cn1", c("label_confidence")), ("cn1Label", F.lit("label_confidence")), ("cs3", c("evidence_codes")), ("cs3Label", F.lit(labels[2])),
        ("cs4", c("format_name")), ("cs4Label", F.lit(labels[3])), ("cs5", c("source_id")), ("cs5Label", F.lit(labels[4])), ("msg", F.substring(full(c("raw_log")), 1, 512)),
    ]
    return F.concat_ws("|", head, F.concat_ws(" ", *[_extension(k, v) for k, v in parts]))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(json_line(df).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", columns: list[str] | None = None) -> None:
    """The 28 fixed columns; what else an event has is ignored."""
    df.select(*[c if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns or CSV_COLUMNS]).write.mode(mode).csv(path, header=True, escape='"')


def write_cef(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(cef_line().alias("value")).write.mode(mode).text(path)


WRITERS = {"cef": write_cef, "json-lines": write_json_lines, "jsonl": write_json_lines, "ndjson": write_json_lines, "csv": write_csv}


def writer(kind: str):
    try:
        return WRITERS[kind.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown output format {kind!r}; known: {', '.join(WRITERS)}") from None


def write_all(df: DataFrame, targets: list[tuple[str, str]], mode: str = "overwrite") -> None:
    """The same events to several (kind, path); they are computed once and held
    on disk meanwhile (a lost part is computed anew)."""
    from pyspark import StorageLevel

    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        for kind, path in targets:
            writer(kind)(held, path, mode)
    finally:
        held.unpersist()


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Alerts as JSON lines, appended to what is there."""
    write_json_lines(alerts, path, "append")


def write_quarantine(parsed: DataFrame, path: str) -> None:
    """What :func:`logs.parse_arrays` could not use, but blank lines."""
    parsed.where("parse_status not in ('valid', 'blank')").select("source_line", "array_position", "parse_status", "error", "record").write.mode("overwrite").csv(path, header=True, escape='"')


def newest(df: DataFrame, by: str, limit: int, offset: int = 0) -> DataFrame:
    """A page of events, newest first."""
    return df.orderBy(F.desc(by), F.desc("event_uid")).offset(offset).limit(limit)

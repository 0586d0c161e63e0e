"""Sources: text logs, arrays of values, tables of texts, configurations."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FIELDS = ["category_type", "sub_key", "timestamp", "client_ip", "source_port", "user_agent", "language", "metadata"]
SENTINEL = r"\N"


def read_lines(spark: SparkSession, path: str, max_events: int | None = None) -> DataFrame:
    """source_file, ordinal and line of every non-blank line of text files.

    The ordinal orders lines within the input as Spark's file splits do; it is
    unique and rises along a file, though not without gaps. Bytes that are no
    UTF-8 become the replacement character.
    """
    raw = spark.read.format("text").load(path)
    df = raw.select(F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("ordinal"), F.regexp_replace("value", r"[\r\n]+$", "").alias("line")).where(F.trim("line") != "")
    return df.orderBy("ordinal").limit(max_events) if max_events else df


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """source_line (1, 2, …) and line, blank lines too: exact numbers need the
    sizes of the partitions before, one row a partition, counted in a scan of its own."""
    raw = spark.read.text(path).select(F.col("value").alias("line"), F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = raw.groupBy("__p").agg(F.count(F.lit(1)).alias("__c")).select("__p", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__start"))
    return raw.join(starts, "__p").select((F.col("__start") + F.col("__n") + 1).alias("source_line"), "line")


def decoded_values(text: str):
    """(position, value, error) of the JSON values that stand on one line; the
    first one that does not parse ends it."""
    decoder, at, n = json.JSONDecoder(), 0, 0
    while True:
        while at < len(text) and text[at].isspace():
            at += 1
        if at >= len(text):
            return
        n += 1
        try:
            value, at = decoder.raw_decode(text, at)
        except json.JSONDecodeError as e:
            yield n, None, str(e)
            return
        yield n, value, None


def compact_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def parse_arrays(lines: DataFrame, width: int = len(FIELDS)) -> DataFrame:
    """Rows (source_line, line) to one row per value on a line: source_line,
    array_position, parse_status, values, record, record_hash, error.

    Status is valid, blank, invalid_json, not_an_array or invalid_field_count.
    Several values may stand on a line. Null lines are blank. Arrow batches; no
    shuffle.
    """
    import hashlib

    schema = "source_line long, array_position int, parse_status string, values array<string>, record string, record_hash string, error string"
    types = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string()]

    def text_of(v):
        return v if v is None or isinstance(v, str) else compact_json(v)

    def run(batches):
        for b in batches:
            rows = []
            for k, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = (line or "").strip()
                if not text:
                    rows.append((k, None, "blank", None, None, None, None))
                for at, value, error in decoded_values(text):
                    if error:
                        rows.append((k, at, "invalid_json", None, None, None, error))
                        continue
                    record = compact_json(value)
                    if not isinstance(value, list):
                        rows.append((k, at, "not_an_array", None, record, None, "the value is no array"))
                    elif len(value) != width:
                        rows.append((k, at, "invalid_field_count", None, record, None, f"{len(value)} fields instead of {width}"))
                    else:
                        rows.append((k, at, "valid", [text_of(v) for v in value], record, hashlib.sha256(record.encode("utf-8", "surrogatepass")).hexdigest()[:32], None))
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["source_line", "array_position", "parse_status", "values", "record", "record_hash", "error"])

    return lines.select("source_line", "line").mapInArrow(run, schema)


def structure(parsed: DataFrame, dataset: str) -> DataFrame:
    """Valid rows of :func:`parse_arrays` as named fields with event_id
    (dataset:line:position) and record_hash. Values equal to the sentinel that
    stands for null in exports fail the query."""
    ok = parsed.where("parse_status = 'valid'")
    named = {n: F.when(F.get("values", F.lit(k)) == SENTINEL, F.raise_error(F.lit(f"{n} holds the null sentinel")).cast("string")).otherwise(F.get("values", F.lit(k))).alias(n) for k, n in enumerate(FIELDS)}
    return ok.select(F.concat_ws(":", F.lit(dataset[:12]), "source_line", "array_position").alias("event_id"), "record_hash", "source_line", "array_position", *named.values())


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV export: header, nulls as the sentinel, so that null differs from empty."""
    return spark.read.schema(schema).csv(path, header=True, nullValue=SENTINEL, emptyValue="", escape='"', multiLine=False)


def read_config(path: str, required: tuple[str, ...] = ("source_id", "log_path")) -> dict:
    """A source's YAML file; missing keys fail."""
    import yaml

    with open(path, encoding="utf-8") as f:
        config = yaml.safe_load(f) or {}
    missing = [k for k in required if not config.get(k)]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return config


def read_blocklist(spark: SparkSession, path: str, feed: str, score: float = 0.9) -> DataFrame:
    """A text file of addresses and networks as (ip, source, score); comments and
    blank lines go. Networks keep their slash."""
    entry = F.trim("value")
    return spark.read.text(path).where((entry != "") & ~entry.startswith("#")).select(entry.alias("ip"), F.lit(feed).alias("source"), F.lit(float(score)).alias("score"))


def synthetic_events(spark: SparkSession, n: int, seed: int = 42, parts: int | None = None) -> DataFrame:
    """Seeded labelled events in nine formats, half of them attacks: ordinal, y,
    format_name and the columns that the classifier's features come from."""
    h = lambda salt, m: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(m))
    formats = ["cisco_asa", "paloalto_traffic", "paloalto_threat", "windows_event_xml", "aws_cloudtrail", "cef", "leef", "snort_alert", "syslog"]

    def one_of(salt: int, values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (h(salt, len(values)) + 1).cast("int"))

    attack = F.col("id") % 2 == 0
    df = spark.range(0, n, 1, parts) if parts else spark.range(n)
    return df.select(
        F.col("id").alias("ordinal"), attack.cast("int").alias("y"), one_of(1, formats).alias("format_name"),
        (h(2, 64512) + 1024).cast("int").alias("src_port"),
        F.when(attack, one_of(3, [22, 23, 445, 3389, 8080, 80])).otherwise(one_of(4, [80, 443, 53, 8443, 123])).alias("dst_port"),
        one_of(5, ["tcp", "tcp", "udp", "icmp"]).alias("protocol"),
        F.when(attack, one_of(6, [4, 6, 8, 10])).otherwise(one_of(7, [0, 1, 2, 4])).alias("severity"),
        F.when(attack, one_of(8, ["deny", "drop", "block", "alert", "allow"])).otherwise(one_of(9, ["allow", "allow", "allow", "deny", "unknown"])).alias("event_action"),
        F.timestamp_seconds(F.lit(1704067200) + h(10, 31 * 86400)).alias("timestamp_utc"),
        (~attack & (h(11, 3) > 0)).alias("is_src_private"),
        F.when(attack & (h(12, 2) == 0), h(13, 40) / 100.0 + 0.6).alias("threat_intel_score"),
        F.when(attack & (h(14, 3) > 0), one_of(15, ["T1190", "T1110", "T1046", "T1059"])).alias("mitre_technique_id"),
        F.when(h(16, 2) == 0, F.when(attack, one_of(17, ["sqlmap/1.7", "nikto/2.1", "masscan/1.3"])).otherwise(F.lit("Mozilla/5.0 (X11; Linux x86_64)"))).alias("user_agent"),
    )


def campaigns(spark: SparkSession, attacks: int = 14, per: int = 60, benign: int = 2520, seed: int = 7) -> tuple[DataFrame, list[dict]]:
    """A log with known attack campaigns between benign and malformed lines, and
    their ground truth (id, type, source, target, event_count)."""
    kinds = ["port_scan", "brute_force", "c2_beacon", "sql_injection", "path_traversal", "exfiltration", "privilege_escalation"]
    truth = [{"campaign_id": f"campaign-{k:02d}", "type": kinds[k % len(kinds)], "source": f"203.0.113.{k + 1}", "target": f"10.0.1.{k + 1}", "event_count": per} for k in range(attacks)]
    n = spark.range(attacks * per).select((F.col("id") % attacks).cast("int").alias("c"), F.expr(f"id div {attacks}").alias("i"))
    at = F.date_format(F.timestamp_seconds(1704067200 + F.col("i") + F.col("c") * 900), "MMM dd HH:mm:ss")
    line = F.format_string("<134>%s fw01 kernel: deny src=203.0.113.%d dst=10.0.1.%d spt=%d dpt=%d proto=TCP action=deny", at, F.col("c") + 1, F.col("c") + 1, (40000 + F.col("i")).cast("int"), (20 + F.col("i")).cast("int"))
    bad = n.select(F.concat(F.lit("a"), F.col("c").cast("string"), F.lit("-"), F.col("i").cast("string")).alias("k"), line.alias("line"))
    h = F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(250)).cast("int")
    ok = spark.range(benign).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("k"), F.when(F.col("id") % 50 == 0, F.concat(F.lit("???malformed "), F.col("id").cast("string"))).otherwise(
        F.format_string("<134>%s fw01 kernel: allow src=10.0.0.%d dst=8.8.8.8 spt=%d dpt=443 proto=TCP action=allow", F.date_format(F.timestamp_seconds(1704067200 + F.col("id") * 5), "MMM dd HH:mm:ss"), h, (50000 + h).cast("int"))).alias("line"))
    return bad.unionByName(ok), truth

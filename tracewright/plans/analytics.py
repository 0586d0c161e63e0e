"""Queries of the batch analytics over ``events``, each with its DuckDB SQL.

Doubles are rounded to six decimals on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import crypto, labels, network
from ..operators import aggregation as agg
from ..operators import batch, correlation, features, profiling
from .adapter import CANONICAL_SQL, SQL, TEST_FROM, VALIDATION_FROM, addressed, canonical, structured

KEY = b"tracewright"


def r6(df: DataFrame) -> DataFrame:
    """Doubles and decimals rounded, NTZ timestamps kept, counts as long."""
    out = {}
    for c, t in df.dtypes:
        if t in ("double", "float") or t.startswith("decimal"):
            x = F.round(F.col(c).cast("double"), 6)
            out[c] = F.when(x == 0, F.lit(0.0)).otherwise(x)
        elif t in ("int", "tinyint", "smallint"):
            out[c] = F.col(c).cast("bigint")
    return df.withColumns(out) if out else df


def labelled(spark, d):
    s = structured(spark, d).withColumns(labels.label_columns())
    return s.withColumn("data_split", batch.calendar_split(F.col("timestamp_normalized"), VALIDATION_FROM, TEST_FROM))


def viewed(spark, d):
    """Labelled events with pseudonym and the reversal flag of the client's past."""
    order = Window.partitionBy("client_ip").orderBy("ordinal")
    t = F.col("timestamp_normalized")
    return labelled(spark, d).withColumns({"client_key": crypto.client_key(F.col("client_ip"), KEY), "timestamp_reversal_flag": F.coalesce(t < F.lag(t).over(order), F.lit(False)).cast("int")})


PAY = {k: "(?i)" + p.replace("'", "''") for k, p in labels.PAYLOADS.items()}
MASKS = "m AS (SELECT *, coalesce(regexp_matches(lower(user_agent), '" + "|".join(labels.SCANNERS) + "'), false) AS declared_scanner, coalesce(regexp_matches(user_agent, '^(Mozilla|Opera)/'), false) AS browser_style, coalesce(user_agent, '') = '' AS missing_user_agent, " + ", ".join(f"regexp_matches(concat(category_type, ' ', sub_key, ' ', coalesce(language, ''), ' ', metadata), '{p}') AS {k}" for k, p in PAY.items()) + " FROM s), "
LABELS = MASKS + f"""p AS (SELECT *, payload_shell OR payload_traversal OR payload_sqli OR payload_xss AS payload_attack_pattern FROM m),
l AS (SELECT *, CASE WHEN declared_scanner OR payload_attack_pattern THEN 'attack' WHEN browser_style THEN 'benign' ELSE 'uncertain' END AS weak_label,
 CASE WHEN declared_scanner AND payload_attack_pattern THEN 0.99 WHEN payload_attack_pattern THEN 0.95 WHEN declared_scanner THEN 0.85 WHEN browser_style THEN 0.55 ELSE 0.0 END::DOUBLE AS label_confidence,
 browser_style AND (declared_scanner OR payload_attack_pattern) AS label_conflict,
 coalesce(nullif(concat_ws('|', {', '.join(f"CASE WHEN {m} THEN '{c}' END" for m, c in labels.CODES)}), ''), '{labels.NO_EVIDENCE}') AS evidence_codes,
 {' + '.join(f"{m}::INT" for m, _ in labels.CODES)} AS evidence_count,
 CASE WHEN timestamp_normalized < TIMESTAMP '{VALIDATION_FROM}' THEN 'train' WHEN timestamp_normalized < TIMESTAMP '{TEST_FROM}' THEN 'validation' ELSE 'test' END AS data_split FROM p)"""
VIEWED = "v AS (SELECT *, concat('client_', client_ip) AS client_key, coalesce(timestamp_normalized < lag(timestamp_normalized) OVER (PARTITION BY client_ip ORDER BY ordinal), false)::INT AS timestamp_reversal_flag FROM l)"
WITH_L, WITH_V = f"WITH {SQL}, {LABELS}", f"WITH {SQL}, {LABELS}, {VIEWED}"
METRICS = """count(*) AS event_count, count(DISTINCT client_key) AS unique_client_count,
 """ + ", ".join(f"count(*) FILTER (weak_label = '{x}') AS {x}_count, round(count(*) FILTER (weak_label = '{x}') * 100.0 / count(*), 6)::DOUBLE AS {x}_percent" for x in ("attack", "benign", "uncertain")) + """,
 count(*) FILTER (label_conflict) AS conflict_count, round(count(*) FILTER (label_conflict) * 100.0 / count(*), 6)::DOUBLE AS conflict_percent,
 round(avg(label_confidence), 6) AS mean_label_confidence, sum(timestamp_reversal_flag)::BIGINT AS timestamp_reversal_count"""
NO_UNIQUE = METRICS.replace("count(DISTINCT client_key) AS unique_client_count,", "")
SPAN = "min(timestamp_normalized) AS first_timestamp, max(timestamp_normalized) AS last_timestamp, CAST(epoch(max(timestamp_normalized)) - epoch(min(timestamp_normalized)) AS BIGINT) AS active_span_seconds, count(DISTINCT source_port_normalized) AS unique_port_count"
HOURLY = f"h AS (SELECT date_trunc('hour', timestamp_normalized) AS hour_start, data_split, {METRICS} FROM v GROUP BY ALL), t AS (SELECT quantile_cont(event_count, 0.99) AS q FROM h WHERE data_split = 'train')"
DAILY = f"dd AS (SELECT date_trunc('day', timestamp_normalized) AS day, data_split, {METRICS} FROM v GROUP BY ALL)"
REGIMES = """g AS (SELECT h.*, q, event_count >= ceil(q) AS b FROM h, t), gg AS (SELECT *, CASE WHEN b THEN 'burst' WHEN coalesce(lag(b) OVER w AND lag(hour_start) OVER w + INTERVAL 1 HOUR = hour_start, false) THEN 'post_burst' ELSE 'ordinary' END AS volume_regime FROM g WINDOW w AS (ORDER BY hour_start, data_split))"""

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d, f=f: r6(f(spark, d))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"{WITH_V}, {HOURLY} SELECT * FROM h")
def hourly_summary(spark, d):
    return agg.time_view(viewed(spark, d))


@query(f"{WITH_V}, {DAILY} SELECT * REPLACE (day::TIMESTAMP AS day) FROM dd")
def daily_summary(spark, d):
    return agg.time_view(viewed(spark, d), "day")


@query(f"{WITH_V} SELECT client_ip AS client_key, data_split, {NO_UNIQUE}, {SPAN} FROM v GROUP BY ALL")
def client_split_summary(spark, d):
    return agg.client_view(viewed(spark, d).withColumn("client_key", F.col("client_ip")))


@query(f"{WITH_V} SELECT client_ip AS client_key, date_trunc('day', timestamp_normalized)::TIMESTAMP AS day, data_split, {NO_UNIQUE}, {SPAN} FROM v GROUP BY ALL")
def client_daily_summary(spark, d):
    return agg.client_view(viewed(spark, d).withColumn("client_key", F.col("client_ip")), daily=True)


@query(f"{WITH_L} SELECT event_id, record_hash, weak_label, label_confidence, evidence_codes, evidence_count::BIGINT AS evidence_count, label_conflict, 'weak-label-v1' AS label_version FROM l")
def weak_labels(spark, d):
    return labelled(spark, d).select("event_id", "record_hash", "weak_label", "label_confidence", "evidence_codes", "evidence_count", "label_conflict", "label_version")


INVENTORY = [*PAY, "declared_scanner", "browser_style", "missing_user_agent", "payload_attack_pattern"]


@query(f"{WITH_L} " + " UNION ALL ".join(f"SELECT '{m}' AS field, count(*) FILTER ({m}) AS events, round(count(*) FILTER ({m}) * 100.0 / count(*), 6)::DOUBLE AS percent FROM l" for m in INVENTORY))
def evidence_inventory(spark, d):
    return profiling.evidence_inventory(structured(spark, d), labels.evidence())


@query(f"{WITH_L} SELECT weak_label, label_confidence, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS percent FROM l GROUP BY ALL")
def label_distribution(spark, d):
    per = labelled(spark, d).groupBy("weak_label", "label_confidence").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))))


GROUP = "CASE WHEN declared_scanner THEN 'scanner' WHEN browser_style THEN 'browser' WHEN missing_user_agent THEN 'missing' ELSE 'other' END"


@query(f"{WITH_L} SELECT {GROUP} AS ua_group, count(*) FILTER (NOT payload_attack_pattern) AS without_payload, count(*) FILTER (payload_attack_pattern) AS with_payload, count(*) AS total, round(count(*) FILTER (payload_attack_pattern) / count(*), 6) AS payload_rate FROM l GROUP BY ALL")
def ua_payload_crosstab(spark, d):
    m = structured(spark, d).withColumns(labels.evidence()).withColumn("ua_group", F.expr(GROUP))
    p = m.groupBy("ua_group").pivot("payload_attack_pattern", [False, True]).agg(F.count(F.lit(1)))
    a, b = F.coalesce("false", F.lit(0)), F.coalesce("true", F.lit(0))
    return p.select("ua_group", a.alias("without_payload"), b.alias("with_payload"), (a + b).alias("total"), (b / (a + b)).alias("payload_rate"))


@query(f"""{WITH_L} SELECT client_ip, count(*) AS event_count, count(*) FILTER (declared_scanner) AS scanner_events, count(*) FILTER (payload_attack_pattern) AS payload_events, count(*) FILTER (browser_style) AS browser_events,
 round((epoch(max(timestamp_normalized)) - epoch(min(timestamp_normalized))) / 3600, 6) AS span_hours, round(count(*) FILTER (declared_scanner) / count(*), 6) AS scanner_ratio, round(count(*) FILTER (payload_attack_pattern) / count(*), 6) AS payload_ratio,
 round(count(*) FILTER (browser_style) / count(*), 6) AS browser_ratio, bool_or(declared_scanner) AS any_scanner, bool_or(payload_attack_pattern) AS any_payload, bool_or(browser_style) AS any_browser FROM l GROUP BY client_ip""")
def client_evidence_profile(spark, d):
    return agg.client_profile(structured(spark, d).withColumns(labels.evidence()))


@query(f"""{WITH_L}, c AS (SELECT client_ip, bool_or(declared_scanner) AS any_scanner, bool_or(payload_attack_pattern) AS any_payload, bool_or(browser_style) AS any_browser, count(*) AS n FROM l GROUP BY 1)
SELECT any_scanner, any_payload, any_browser, count(*) AS clients, sum(n)::BIGINT AS events FROM c GROUP BY ALL""")
def evidence_combinations(spark, d):
    p = agg.client_profile(structured(spark, d).withColumns(labels.evidence()))
    return p.groupBy("any_scanner", "any_payload", "any_browser").agg(F.count(F.lit(1)).alias("clients"), F.sum("event_count").alias("events"))


HF = "(hour(timestamp_normalized) + minute(timestamp_normalized) / 60.0 + second(timestamp_normalized) / 3600.0)::DOUBLE"


def rz(x, name):
    return f"CASE WHEN round({x}, 6) = 0 THEN 0.0 ELSE round({x}, 6) END::DOUBLE AS {name}"


@query(f"""WITH {SQL}, x AS (SELECT *, {HF} AS hf, isodow(timestamp_normalized) - 1 AS wd FROM s) SELECT event_id, {rz('sin(hf * (2 * pi() / 24))', 'hour_sin')}, {rz('cos(hf * (2 * pi() / 24))', 'hour_cos')},
 {rz('sin((wd + hf / 24) * (2 * pi() / 7))', 'weekday_sin')}, {rz('cos((wd + hf / 24) * (2 * pi() / 7))', 'weekday_cos')}, (wd >= 5)::BIGINT AS is_weekend, source_port_normalized AS source_port_value,
 (source_port_normalized <= 1023)::BIGINT AS is_privileged_port, (source_port_normalized BETWEEN 1024 AND 49151)::BIGINT AS is_registered_port, (source_port_normalized >= 49152)::BIGINT AS is_dynamic_port,
 (language IS NOT NULL)::BIGINT AS language_present, coalesce(length(language), 0)::BIGINT AS language_length FROM x""")
def event_local_features(spark, d):
    f = features.event_local(structured(spark, d))
    return f.select("event_id", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "is_weekend", "source_port_value", "is_privileged_port", "is_registered_port", "is_dynamic_port", "language_present", "language_length")


def _past(spark, d, taus=()):
    return features.past_only(structured(spark, d), client="client_ip", taus=taus)


PAST = """f AS (SELECT *, row_number() OVER (PARTITION BY client_ip, source_port_normalized ORDER BY ordinal) > 1 AS seen, lag(epoch(timestamp_normalized)) OVER w AS lt, lag(source_port_normalized) OVER w AS lp, row_number() OVER w - 1 AS prior FROM s WINDOW w AS (PARTITION BY client_ip ORDER BY ordinal))"""


@query(f"""WITH {SQL}, {PAST} SELECT event_id, round(ln(1 + prior), 6) AS client_prior_event_count_log1p, (lt IS NOT NULL)::BIGINT AS has_previous_event, round(ln(1 + greatest(coalesce(epoch(timestamp_normalized) - lt, 0), 0)), 6) AS seconds_since_previous_log1p,
 coalesce(epoch(timestamp_normalized) < lt, false)::BIGINT AS timestamp_reversal_flag, coalesce(source_port_normalized = lp, false)::BIGINT AS same_port_as_previous, seen::BIGINT AS source_port_seen_before,
 round(ln(1 + coalesce(sum((NOT seen)::INT) OVER (PARTITION BY client_ip ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), 6)::DOUBLE AS prior_unique_ports_log1p FROM f""")
def past_only_features(spark, d):
    return _past(spark, d).select("event_id", "client_prior_event_count_log1p", "has_previous_event", "seconds_since_previous_log1p", "timestamp_reversal_flag", "same_port_as_previous", "source_port_seen_before", "prior_unique_ports_log1p")


@query(f"""WITH {SQL}, mm AS (SELECT event_id, client_ip, ordinal, max(epoch(timestamp_normalized)) OVER (PARTITION BY client_ip ORDER BY ordinal) AS m FROM s)
SELECT a.event_id, {', '.join(f"round(coalesce(sum(exp(-(a.m - b.m) / {t}.0)), 0), 6)::DOUBLE AS activity_decay_{t}s" for t in features.TAUS)} FROM mm a LEFT JOIN mm b ON a.client_ip = b.client_ip AND b.ordinal < a.ordinal GROUP BY a.event_id""")
def activity_decay(spark, d):
    return _past(spark, d, features.TAUS).select("event_id", *[f"activity_decay_{t}s" for t in features.TAUS])


@query(f"WITH {SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS feature, round(min({x})::DOUBLE, 6) AS minimum, round(max({x})::DOUBLE, 6) AS maximum, round(avg({x}), 6) AS mean, count(*) FILTER ({x} <> 0) AS non_zero, min({x}) = max({x}) AS constant FROM s" for n, x in (("source_port_value", "source_port_normalized"), ("language_length", "coalesce(length(language), 0)"), ("is_privileged_port", "(source_port_normalized <= 1023)::INT"))))
def feature_statistics(spark, d):
    return features.statistics(features.event_local(structured(spark, d)), ["source_port_value", "language_length", "is_privileged_port"])


@query(f"{WITH_L} SELECT event_id, data_split FROM l")
def calendar_split(spark, d):
    return labelled(spark, d).select("event_id", "data_split")


@query(f"WITH {SQL}, z AS (SELECT event_id, row_number() OVER (ORDER BY ordinal) - 1 AS r, count(*) OVER () AS n FROM s) SELECT event_id, CASE WHEN r < floor(n * 0.7) THEN 'train' WHEN r < floor(n * 0.85) THEN 'validation' ELSE 'test' END AS data_split FROM z")
def positional_split(spark, d):
    return batch.positional_split(structured(spark, d).select("event_id", "ordinal")).select("event_id", "data_split")


CW = "cw AS (SELECT weak_label, count(*) AS n, (sum(count(*)) OVER ()) / (count(*) OVER () * count(*)) AS class_weight, avg(label_confidence) AS mean_confidence FROM l WHERE data_split = 'train' AND weak_label <> 'uncertain' GROUP BY 1)"


@query(f"{WITH_L}, {CW} SELECT weak_label, n, round(class_weight, 6)::DOUBLE AS class_weight, round(mean_confidence, 6) AS mean_confidence FROM cw")
def class_weights(spark, d):
    return batch.class_weights(labelled(spark, d).where("data_split = 'train'"))


SW = "sw AS (SELECT l.*, (l.weak_label <> 'uncertain')::BIGINT AS supervised_eligible, (l.weak_label <> 'uncertain' AND data_split = 'train')::BIGINT AS training_eligible, CASE WHEN l.weak_label <> 'uncertain' AND data_split = 'train' THEN class_weight * label_confidence / mean_confidence ELSE 0 END::DOUBLE AS w FROM l LEFT JOIN cw USING (weak_label))"


@query(f"{WITH_L}, {CW}, {SW} SELECT event_id, record_hash, data_split, supervised_eligible, training_eligible, round(w, 6) AS training_sample_weight FROM sw")
def sample_weights(spark, d):
    return batch.sample_weights(labelled(spark, d)).select("event_id", "record_hash", "data_split", "supervised_eligible", "training_eligible", "training_sample_weight")


@query(f"{WITH_L}, {CW}, {SW} SELECT count(*) AS n, round(sum(w) * sum(w) / sum(w * w), 4) AS ess FROM sw WHERE w > 0")
def effective_sample_size(spark, d):
    return batch.effective_sample_size(batch.sample_weights(labelled(spark, d))).withColumn("ess", F.round("ess", 4))


@query(f"{WITH_L} SELECT client_ip FROM l WHERE data_split = 'train' INTERSECT SELECT client_ip FROM l WHERE data_split = 'test'")
def split_client_overlap(spark, d):
    x = labelled(spark, d).select("client_ip", "data_split")
    return x.where("data_split = 'train'").select("client_ip").intersect(x.where("data_split = 'test'").select("client_ip"))


@query(f"""{WITH_L}, counted AS (SELECT data_split, weak_label, min(timestamp_normalized) AS a, max(timestamp_normalized) AS b, count(*) AS c FROM l GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY data_split ORDER BY c DESC, weak_label) AS most, row_number() OVER (PARTITION BY data_split ORDER BY c, weak_label) AS least FROM counted)
SELECT data_split, min(a) AS first_timestamp, max(b) AS last_timestamp, sum(c)::BIGINT AS n, max(weak_label) FILTER (most = 1) AS majority, max(weak_label) FILTER (least = 1) AS minority, round(max(c)::DOUBLE / min(c), 6) AS imbalance_ratio FROM ranked GROUP BY 1""")
def split_bounds(spark, d):
    per = labelled(spark, d).groupBy("data_split", "weak_label").agg(F.min("timestamp_normalized").alias("a"), F.max("timestamp_normalized").alias("b"), F.count(F.lit(1)).alias("c"))
    most, least = F.struct(-F.col("c"), "weak_label"), F.struct("c", "weak_label")
    return per.groupBy("data_split").agg(F.min("a").alias("first_timestamp"), F.max("b").alias("last_timestamp"), F.sum("c").alias("n"), F.min_by("weak_label", most).alias("majority"), F.min_by("weak_label", least).alias("minority"), (F.max("c") / F.min("c")).alias("imbalance_ratio"))


@query(f"{WITH_L} SELECT data_split, weak_label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY data_split), 6)::DOUBLE AS percent FROM l GROUP BY data_split, weak_label")
def split_labels(spark, d):
    per = labelled(spark, d).groupBy("data_split", "weak_label").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("data_split")))


@query(f"{WITH_L} SELECT date_trunc('day', timestamp_normalized)::TIMESTAMP AS day, count(*) FILTER (weak_label = 'attack') AS attack, count(*) FILTER (weak_label = 'benign') AS benign, count(*) FILTER (weak_label = 'uncertain') AS uncertain FROM l GROUP BY 1")
def day_label_pivot(spark, d):
    p = labelled(spark, d).groupBy(F.date_trunc("day", "timestamp_normalized").alias("day")).pivot("weak_label", ["attack", "benign", "uncertain"]).agg(F.count(F.lit(1)))
    return p.fillna(0)


@query(f"{WITH_V}, {HOURLY} SELECT round(q, 6) AS threshold_training_quantile, ceil(q)::BIGINT AS burst_threshold_event_count FROM t")
def burst_threshold(spark, d):
    return agg.burst_threshold(agg.time_view(viewed(spark, d)))


def _regimes(spark, d):
    h = agg.time_view(viewed(spark, d))
    return agg.regimes(h, agg.burst_threshold(h))


@query(f"{WITH_V}, {HOURLY}, {REGIMES} SELECT hour_start, data_split, event_count, ceil(q)::BIGINT AS burst_threshold_event_count, volume_regime FROM gg")
def hourly_regimes(spark, d):
    return _regimes(spark, d).select("hour_start", "data_split", "event_count", "burst_threshold_event_count", "volume_regime")


@query(f"{WITH_V}, {HOURLY}, {REGIMES} SELECT data_split, volume_regime, count(*) AS hours, sum(event_count)::BIGINT AS events, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY data_split), 6)::DOUBLE AS hour_percent, round(sum(event_count) * 100.0 / sum(sum(event_count)) OVER (PARTITION BY data_split), 6)::DOUBLE AS event_percent FROM gg GROUP BY data_split, volume_regime")
def regime_distribution(spark, d):
    return agg.regime_distribution(_regimes(spark, d))


@query(f"WITH {SQL}, days AS (SELECT DISTINCT timestamp_normalized::DATE AS day FROM s) SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM days EXCEPT SELECT day FROM days")
def missing_days(spark, d):
    return agg.missing_days(structured(spark, d).select(F.col("timestamp_normalized").alias("day")))


@query(f"""{WITH_V}, {DAILY} SELECT data_split, count(*) AS days, sum(event_count)::BIGINT AS events, round(avg(event_count), 6) AS mean, round(quantile_cont(event_count, 0.5), 6)::DOUBLE AS median, round(quantile_cont(event_count, 0.95), 6)::DOUBLE AS p95, max(event_count) AS largest,
 (list(day ORDER BY event_count DESC, day DESC))[1]::TIMESTAMP AS peak_day, round(max(event_count) / quantile_cont(event_count, 0.5), 6)::DOUBLE AS largest_to_median, round(sum(event_count) / sum(sum(event_count)) OVER (), 6)::DOUBLE AS share FROM dd GROUP BY 1""")
def daily_volume_summary(spark, d):
    return agg.daily_summary(agg.time_view(viewed(spark, d), "day"))


@query(f"""WITH {SQL}, j AS (SELECT lag(t) OVER (ORDER BY ordinal) - t AS jump FROM (SELECT ordinal, CAST(epoch(timestamp_normalized) AS BIGINT) - 3 * (k % 97 = 0)::INT * k AS t FROM s)), b AS (SELECT jump FROM j WHERE jump > 0)
SELECT count(*) AS reversals, max(jump) AS largest, {', '.join(f"round(quantile_cont(jump, 0.{p}), 6)::DOUBLE AS p{p}" for p in (50, 90, 95, 99))}, count(*) FILTER (jump > 60) AS over_minute, count(*) FILTER (jump > 3600) AS over_hour, count(*) FILTER (jump > 86400) AS over_day FROM b""")
def timestamp_reversals(spark, d):
    s = structured(spark, d).withColumn("t", F.timestamp_seconds(F.unix_timestamp(F.col("timestamp_normalized").cast("timestamp")) - F.expr("3 * if(k % 97 = 0, k, 0)")))
    return profiling.reversal_audit(s, "t", "ordinal")


FIELDS = ["user_agent", "language", "metadata", "client_ip"]


@query(f"WITH {SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS missing, round(count(*) FILTER ({c} IS NULL OR trim({c}) = '') * 100.0 / count(*), 6)::DOUBLE AS missing_percent FROM s" for c in FIELDS))
def missing_profile(spark, d):
    return profiling.missing_profile(structured(spark, d), FIELDS)


@query("WITH x AS (SELECT CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE lang END AS a, source AS b FROM documents) " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS nulls, count(*) FILTER ({c} = '') AS empty, count(*) FILTER (regexp_full_match({c}, '\\s+')) AS whitespace_only FROM x" for c in ("a", "b")))
def null_empty_whitespace(spark, d):
    x = spark.read.parquet(f"{d}/documents.parquet").select(F.expr("CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE lang END").alias("a"), F.col("source").alias("b"))
    return profiling.null_empty_whitespace(x, ["a", "b"])


@query(f"""WITH {SQL}, c AS (SELECT user_agent AS value, count(*) AS n FROM s GROUP BY 1), q AS (SELECT *, sum(n) OVER () AS al, sum(n) FILTER (value IS NOT NULL) OVER () AS pr FROM c) SELECT value, n, rank() OVER w AS rank, round(n / al, 6) AS share_of_all, round(n / pr, 6) AS share_of_present, round(sum(n) OVER (w ROWS UNBOUNDED PRECEDING) / pr, 6) AS coverage FROM q WHERE value IS NOT NULL WINDOW w AS (ORDER BY n DESC, value) ORDER BY n DESC, value LIMIT 10""")
def top_user_agents(spark, d):
    return profiling.top_values(structured(spark, d), "user_agent")


@query(f"""WITH {SQL}, c AS (SELECT client_ip AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, client_ip) AS r FROM s GROUP BY 1) SELECT count(*) AS distinct_values, {', '.join(f"round(sum(n) FILTER (r <= {k}) / sum(n), 6)::DOUBLE AS top_{k}_coverage" for k in (1, 5, 10))} FROM c""")
def concentration(spark, d):
    return profiling.concentration(structured(spark, d), "client_ip")


@query(f"WITH {SQL} SELECT regexp_replace(strftime(timestamp_normalized, '%Y-%m-%d %H:%M:%S'), '\\d', 'D', 'g') AS shape, 'none' AS zone, count(*) AS n FROM s GROUP BY ALL")
def timestamp_shapes(spark, d):
    return profiling.timestamp_shapes(structured(spark, d).withColumn("t", F.date_format("timestamp_normalized", "yyyy-MM-dd HH:mm:ss")), "t")


@query("WITH c AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1) SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_contents, (sum(n) - count(*))::BIGINT AS repeated_rows, round((sum(n) - count(*)) * 100.0 / sum(n), 6)::DOUBLE AS repeated_percent FROM c")
def repeated_content(spark, d):
    return profiling.repeated_content(spark.read.parquet(f"{d}/documents.parquet").select(F.sha2("text", 256).alias("h")), "h")


ANY_IP = "CASE k % 6 WHEN 0 THEN concat('127.0.0.', k) WHEN 1 THEN concat('8.8.4.', k) WHEN 2 THEN concat('224.0.0.', k) WHEN 3 THEN concat('999.1.1.', k) WHEN 4 THEN concat('172.31.9.', k) ELSE client_ip END"


@query(f"WITH {SQL} SELECT CASE kind WHEN 0 THEN 'loopback' WHEN 1 THEN 'public' WHEN 2 THEN 'other' WHEN 3 THEN 'invalid' ELSE 'private' END AS ip_class, count(DISTINCT ip) AS n FROM (SELECT {ANY_IP} AS ip, k % 6 AS kind FROM s) GROUP BY 1")
def ip_classes(spark, d):
    ips = addressed(spark, d).select(F.expr(ANY_IP).alias("ip")).distinct()
    return ips.groupBy(network.ip_class(F.col("ip")).alias("ip_class")).agg(F.count(F.lit(1)).alias("n"))


TS_TEXT = "CASE WHEN k % 11 = 0 THEN 'yesterday' WHEN k % 13 = 0 THEN ' ' ELSE {iso} END"
PORT_TEXT = "CASE WHEN k % 17 = 0 THEN '0' WHEN k % 19 = 0 THEN '80x' WHEN k % 23 = 0 THEN '' WHEN k % 29 = 0 THEN '65536' ELSE cast(source_port_normalized AS {text}) END"


@query(f"WITH {SQL} SELECT min(timestamp_normalized) FILTER (k % 11 <> 0 AND k % 13 <> 0) AS earliest, max(timestamp_normalized) FILTER (k % 11 <> 0 AND k % 13 <> 0) AS latest, count(*) FILTER (k % 11 = 0 OR k % 13 = 0) AS invalid_timestamps, count(*) FILTER (k % 17 = 0 OR k % 19 = 0 OR (k % 23 <> 0 AND k % 29 = 0)) AS invalid_ports FROM s")
def value_ranges(spark, d):
    s = structured(spark, d).select(F.expr(TS_TEXT.format(iso="date_format(timestamp_normalized, 'yyyy-MM-dd HH:mm:ss')")).alias("timestamp"), F.expr(PORT_TEXT.format(text="STRING")).alias("source_port"))
    return profiling.value_ranges(s)


BAD_VIEW = {
    "weak_label": "CASE WHEN k % 7 = 0 THEN 'other' WHEN k % 5 = 0 THEN NULL ELSE 'attack' END", "data_split": "CASE WHEN k % 11 = 0 THEN 'later' ELSE 'train' END",
    "label_confidence": "CASE WHEN k % 13 = 0 THEN 1.5 ELSE 0.5 END", "source_port_normalized": "CASE WHEN k % 3 = 0 THEN 70000 ELSE source_port_normalized END",
}


@query(f"""WITH {SQL}, v AS (SELECT k, {', '.join(f'{e} AS {n}' for n, e in BAD_VIEW.items())} FROM s) SELECT 'forbidden_column:metadata' AS violation, count(*) AS n FROM v UNION ALL SELECT 'missing', count(*) FILTER (weak_label IS NULL) FROM v UNION ALL SELECT 'port_out_of_range', count(*) FILTER (k % 3 = 0) FROM v
 UNION ALL SELECT 'confidence_out_of_range', count(*) FILTER (k % 13 = 0) FROM v UNION ALL SELECT 'unexpected_label', count(*) FILTER (weak_label = 'other') FROM v UNION ALL SELECT 'unexpected_split', count(*) FILTER (k % 11 = 0) FROM v""")
def analysis_view_violations(spark, d):
    v = structured(spark, d).select("event_id", "record_hash", "timestamp_normalized", "metadata", *[F.expr(e).alias(n) for n, e in BAD_VIEW.items()])
    return agg.view_violations(v)


_I, _O = bytes(b ^ 0x36 for b in KEY.ljust(64, b"\0")), bytes(b ^ 0x5C for b in KEY.ljust(64, b"\0"))


@query(f"WITH {SQL} SELECT DISTINCT client_ip, concat('client_', substr(sha256(unhex('{_O.hex()}') || unhex(sha256(unhex('{_I.hex()}') || client_ip::BLOB))), 1, 24)) AS client_key FROM s")
def pseudonymize_clients(spark, d):
    return structured(spark, d).select("client_ip").distinct().withColumn("client_key", crypto.client_key(F.col("client_ip"), KEY))


@query(f"WITH {SQL} SELECT event_id, substr(sha256(metadata), 1, 32) AS hash, concat('IP-', substr(sha256(client_ip), 1, 12)) AS display FROM s")
def record_hash(spark, d):
    return structured(spark, d).select("event_id", crypto.record_hash(F.col("metadata")).alias("hash"), crypto.display_ip(F.col("client_ip")).alias("display"))


# correlation -------------------------------------------------------------
NB = "lower(coalesce(raw_log, ''))"
FAILED_SQL = f"(event_action IN ('deny','drop','block','alert') OR coalesce(http_status IN (401, 403), false) OR (event_category = 'authentication' AND weak_label = 'attack') OR contains({NB}, 'failed') OR contains({NB}, 'failure') OR contains({NB}, 'invalid user'))"
BAD_SQL = "(is_malicious OR threat_intel_score >= 0.70)"
SEVERE_SQL = "(severity >= 6 OR lower(severity_label) IN ('high','critical','emergency'))"
#: rule → which events of a window it counts as its own, which as aimed at a target.
HITS = {"PORT_SCAN_SWEEP": ("dst_port > 0", "true"), "BRUTE_FORCE_CAMPAIGN": (FAILED_SQL, FAILED_SQL), "CROSS_DEVICE_CAMPAIGN": ("true", "true"), "MALICIOUS_C2_BEACON": (BAD_SQL, BAD_SQL), "HIGH_SEVERITY_MULTI_VECTOR": ("true", "true")}
RULE_SQL = {
    "PORT_SCAN_SWEEP": ("port_scan_alerts", "len(list_distinct(list(CASE WHEN dst_port > 0 THEN dst_port END) OVER w))", "measure >= 5", "true"),
    "BRUTE_FORCE_CAMPAIGN": ("brute_force_alerts", f"sum(CASE WHEN event_action IN ('deny','drop','block','alert') OR http_status IN (401, 403) OR (event_category = 'authentication' AND weak_label = 'attack') OR contains({NB}, 'failed') OR contains({NB}, 'failure') OR contains({NB}, 'invalid user') THEN 1 ELSE 0 END) OVER w", "measure >= 5", "true"),
    "CROSS_DEVICE_CAMPAIGN": ("cross_device_alerts", "len(list_distinct(list(coalesce(device_type, CASE WHEN contains(format_name, 'windows') THEN 'endpoint' ELSE format_name END)) OVER w))", "measure >= 2 AND extra", "bool_or(event_action IN ('deny','drop','block','alert') OR weak_label = 'attack' OR is_malicious OR threat_name IS NOT NULL) OVER w"),
    "MALICIOUS_C2_BEACON": ("c2_beacon_alerts", "sum(CASE WHEN is_malicious OR threat_intel_score >= 0.70 THEN 1 ELSE 0 END) OVER w", "measure >= 2", "true"),
    "HIGH_SEVERITY_MULTI_VECTOR": ("multi_vector_alerts", "count(*) OVER w", "measure >= 2 AND extra", "bool_or(severity >= 6 OR lower(severity_label) IN ('high','critical','emergency')) OVER w"),
}


def _rule(name):
    rule, (query_name, measure, holds, extra), (hit, aim) = correlation.RULES[name], RULE_SQL[name], HITS[name]
    technique, threat = f"'{rule.technique}'", f"'{rule.technique_name}'"
    if name == "HIGH_SEVERITY_MULTI_VECTOR":  # of the first severe event
        technique, threat = (f"(list(coalesce({c}, {default})) FILTER ({SEVERE_SQL}) OVER w)[1]" for c, default in (("mitre_technique_id", technique), ("threat_name", threat)))
    sql = f"""WITH RECURSIVE {SQL}, {CANONICAL_SQL}, u AS (SELECT *, CAST(epoch(timestamp_utc) AS BIGINT) AS t, (CAST(epoch(timestamp_utc) AS BIGINT) - 1577836800) * 4096000000 + row_number() OVER (PARTITION BY src_ip, timestamp_utc ORDER BY ordinal) - 1 AS kk FROM c),
    x AS (SELECT src_ip, t, ordinal, {measure} AS measure, {extra} AS extra, count(*) FILTER ({hit}) OVER w AS event_count, min(dst_ip) FILTER ({aim}) OVER w AS target_ip, len(list_distinct(list(dst_ip) FILTER ({aim}) OVER w)) AS n_targets, {technique} AS technique, {threat} AS threat
      FROM u WINDOW w AS (PARTITION BY src_ip ORDER BY kk RANGE BETWEEN {int(rule.window) * 4096000000 + 4095} PRECEDING AND CURRENT ROW)),
    tr AS (SELECT * FROM x WHERE {holds}),
    al AS (SELECT src_ip, t, ordinal, measure FROM (SELECT *, row_number() OVER (PARTITION BY src_ip ORDER BY t, ordinal) AS r FROM tr) WHERE r = 1
      UNION ALL SELECT src_ip, t, ordinal, measure FROM (SELECT tr.*, row_number() OVER (PARTITION BY tr.src_ip ORDER BY tr.t, tr.ordinal) AS r FROM al JOIN tr ON tr.src_ip = al.src_ip AND tr.t >= al.t + {int(rule.cooldown)}) WHERE r = 1)
    SELECT '{name}' AS rule_name, x.src_ip AS primary_ip, x.t AS at_second, x.measure::BIGINT AS measure, x.event_count, x.target_ip, x.n_targets::BIGINT AS n_targets, x.technique AS mitre_technique_id, x.threat AS mitre_technique_name FROM al JOIN x ON x.ordinal = al.ordinal"""

    def run(spark, d):
        a = correlation.alerts(canonical(spark, d), [name])
        targets = F.from_json("context", "target_ips array<string>")["target_ips"]
        return a.select("rule_name", "primary_ip", F.unix_timestamp("timestamp_utc").alias("at_second"), "measure", "event_count", "target_ip", F.size(targets).cast("long").alias("n_targets"), "mitre_technique_id", "mitre_technique_name")

    run.__name__ = query_name
    query(sql)(run)


for _name in RULE_SQL:
    _rule(_name)


@query(f"WITH {SQL}, {CANONICAL_SQL}, p AS (SELECT CAST(epoch(timestamp_utc) AS BIGINT) AS t, count(*) AS n FROM c GROUP BY 1) SELECT g.t AS at_second, coalesce(n, 0) AS events FROM (SELECT unnest(generate_series(min(t), max(t))) AS t FROM p) g LEFT JOIN p ON p.t = g.t")
def eps_series(spark, d):
    return correlation.eps(canonical(spark, d)).select(F.unix_timestamp("second").alias("at_second"), "events")


COUNTERS = ["format_name", "severity", "event_action", "weak_label"]


@query(f"WITH {SQL}, {CANONICAL_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c}::VARCHAR AS value, count(*) AS n FROM c GROUP BY 2" for c in COUNTERS))
def dashboard_counters(spark, d):
    e = canonical(spark, d).select(F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in COUNTERS])).alias("x"))
    return e.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SQL}, {CANONICAL_SQL} SELECT src_ip, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, src_ip LIMIT 10")
def top_source_ips(spark, d):
    return canonical(spark, d).groupBy("src_ip").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "src_ip").limit(10)

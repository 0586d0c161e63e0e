"""Queries of normalisation, enrichment, cleaning and evaluation over ``events``,
each with its DuckDB SQL. Log lines are rendered from the table's columns; the SQL
states the fields that a parser must find in them without parsing anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enrichment, fixed_values, labels, mapping, network, parsers
from ..operators import aggregation, batch, ml, profiling
from ..sources import logs, sinks
from . import pipeline
from .adapter import CANONICAL_SQL, SQL, addressed, canonical, structured
from .analytics import CW, HOURLY, SW, WITH_L, WITH_V, labelled, query, viewed

WITH_C = f"WITH {SQL}, {CANONICAL_SQL}"
K = "(dst_port - 20)"

# parsers: (format, line in Spark SQL, {field: DuckDB expression over c}) ------
IPS = "src_ip, dst_ip, src_port, dst_port"
LINES = {
    "cef": (
        f"format_string('CEF:0|Acme|Box|1.0|%d|Deny, rule %d|%d|src=%s dst=%s spt=%d dpt=%d proto=%s outcome=%s msg=two words %d rest=v%d', {K}, {K}, severity, {IPS}, protocol, event_action, {K}, {K})",
        {"vendor": "'Acme'", "threat_signature_id": f"{K}::VARCHAR", "threat_name": f"'Deny, rule ' || {K}", "severity": "severity::VARCHAR", "src_ip": "src_ip", "dst_port": "dst_port::VARCHAR", "protocol": "protocol", "event_action": "event_action", "message": f"'two words ' || {K}"},
    ),
    "leef": (
        f"concat('LEEF:2.0|IBM|QRadar|7.5|', {K}, '|delimiter=^|', concat_ws('^', concat('src=', src_ip), concat('dst=', dst_ip), concat('spt=', src_port), concat('dpt=', dst_port), concat('sev=', severity), 'usrName=u=1'))",
        {"vendor": "'IBM'", "threat_signature_id": f"{K}::VARCHAR", "src_ip": "src_ip", "dst_ip": "dst_ip", "src_port": "src_port::VARCHAR", "severity": "severity::VARCHAR", "username": "'u=1'"},
    ),
    "snort_alert": (
        f"format_string('01/08-12:34:56.123456  [Drop] [**] [1:%d:7] ET SCAN number %d [**] [Classification: Misc activity] [Priority: %d] {{TCP}} %s:%d -> %s:%d', {K}, {K}, {K} % 5, src_ip, src_port, dst_ip, dst_port)",
        {"threat_signature_id": f"concat('1:', {K}, ':7')", "threat_name": f"'ET SCAN number ' || {K}", "severity": f"CASE {K} % 5 WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'low' WHEN 4 THEN 'informational' ELSE 'unknown' END", "protocol": "'tcp'", "src_ip": "src_ip", "src_port": "src_port::VARCHAR", "dst_ip": "dst_ip", "dst_port": "dst_port::VARCHAR", "action": "'drop'"},
    ),
    "syslog": (
        f"format_string('<%d>1 2024-01-08T12:34:56.000Z fw%d app - ID - src=%s dst=%s spt=%d dpt=%d proto=%s action=%s', {K} % 192, {K}, src_ip, dst_ip, src_port, dst_port, protocol, if({K} % 2 = 0, 'deny', 'allow'))",
        {"facility": f"({K} % 192 // 8)::VARCHAR", "severity": f"CASE {K} % 8 WHEN 0 THEN '10' WHEN 1 THEN '9' WHEN 2 THEN '8' WHEN 3 THEN '7' WHEN 4 THEN '6' WHEN 5 THEN '5' WHEN 6 THEN '4' ELSE '2' END", "timestamp_raw": "'2024-01-08T12:34:56.000Z'", "device_hostname": f"'fw' || {K}", "src_ip": "src_ip", "dst_ip": "dst_ip", "src_port": "src_port::VARCHAR", "dst_port": "dst_port::VARCHAR", "event_action": f"CASE WHEN {K} % 2 = 0 THEN 'deny' ELSE 'allow' END"},
    ),
    "cisco_asa": (
        f"format_string('%%ASA-%d-%d: %s tcp src outside:%s/%d dst inside:%s/%d by access-group \"x\"', {K} % 8, if({K} % 2 = 0, 106023, 999999), if({K} % 3 = 0, 'Deny', 'Built'), src_ip, src_port, dst_ip, dst_port)",
        {"threat_signature_id": f"CASE WHEN {K} % 2 = 0 THEN '106023' ELSE '999999' END", "threat_name": f"CASE WHEN {K} % 2 = 0 THEN 'ACL Deny' ELSE 'ASA Message 999999' END", "severity": f"CASE {K} % 8 WHEN 0 THEN 'emergency' WHEN 1 THEN 'alert' WHEN 2 THEN 'critical' WHEN 3 THEN 'error' WHEN 4 THEN 'warning' WHEN 5 THEN 'notice' WHEN 6 THEN 'informational' ELSE 'debug' END", "event_action": f"CASE WHEN {K} % 3 = 0 THEN 'deny' ELSE 'allow' END", "protocol": "'tcp'", "src_ip": "src_ip", "src_port": "src_port::VARCHAR", "dst_ip": "dst_ip", "dst_port": "dst_port::VARCHAR"},
    ),
    "paloalto_traffic": (
        f"concat('1,2024/01/08 10:00:00,SER,TRAFFIC,end,2049,x,', src_ip, ',', dst_ip, ',0.0.0.0,0.0.0.0,\"rule, a\",user', {K}, ',,web,vsys1,trust,untrust,e1,e2,fwd,t,1,1,', src_port, ',', dst_port, ',0,0,0x0,tcp,', if({K} % 4 = 0, 'reset-both', 'allow'), ',100,200')",
        {"timestamp_raw": "'2024/01/08 10:00:00'", "src_ip": "src_ip", "dst_ip": "dst_ip", "src_port": "src_port::VARCHAR", "dst_port": "dst_port::VARCHAR", "protocol": "'tcp'", "username": f"'user' || {K}", "event_action": f"CASE WHEN {K} % 4 = 0 THEN 'reset' ELSE 'allow' END"},
    ),
    "aws_cloudtrail": (
        f"concat('{{\"Records\":[{{\"eventName\":\"', if({K} % 2 = 0, 'DeleteBucket', 'ListBuckets'), '\",\"eventSource\":\"s3.amazonaws.com\",\"eventTime\":\"2024-01-08T12:00:00Z\",\"sourceIPAddress\":\"', src_ip, '\",\"userIdentity\":{{\"arn\":\"arn:aws:iam::1:user/bob', {K}, '\"}}', if({K} % 5 = 0, ',\"errorCode\":\"AccessDenied\"', ''), '}}]}}')",
        {"src_ip": "src_ip", "threat_name": f"CASE WHEN {K} % 2 = 0 THEN 'AWS:DeleteBucket' ELSE 'AWS:ListBuckets' END", "username": f"'bob' || {K}", "event_action": f"CASE WHEN {K} % 5 = 0 THEN 'deny' ELSE 'allow' END", "severity": f"CASE WHEN {K} % 5 = 0 OR {K} % 2 = 0 THEN 'high' ELSE 'informational' END", "event_category": f"CASE WHEN {K} % 5 = 0 THEN 'threat' ELSE 'network' END"},
    ),
    "windows_event_xml": (
        f"concat('<Event xmlns=\"http://schemas.microsoft.com/win/2004/08/events/event\"><System><EventID>', if({K} % 2 = 0, '4625', '4688'), '</EventID><Computer>host', {K}, '</Computer></System><EventData><Data Name=\"TargetUserName\">u', {K}, '</Data><Data Name=\"IpAddress\">', src_ip, '</Data><Data Name=\"IpPort\">-</Data></EventData></Event>')",
        {"threat_signature_id": f"CASE WHEN {K} % 2 = 0 THEN '4625' ELSE '4688' END", "threat_name": f"CASE WHEN {K} % 2 = 0 THEN 'Failed Logon' ELSE 'Process Created' END", "event_action": f"CASE WHEN {K} % 2 = 0 THEN 'deny' ELSE 'unknown' END", "severity": f"CASE WHEN {K} % 2 = 0 THEN 'medium' ELSE 'low' END", "device_hostname": f"'host' || {K}", "username": f"'u' || {K}", "src_ip": "src_ip", "src_port": "NULL::VARCHAR"},
    ),
    "json": (
        f"concat('{{\"src_ip\":\"', src_ip, '\",\"dst_port\":', dst_port, ',\"note\":\"a \\\\\"b\\\\\"\",\"none\":null,\"nested\":{{\"x\":', {K}, '}}}}')",
        {"src_ip": "src_ip", "dst_port": "dst_port::VARCHAR", "note": "'a \"b\"'", "none": "NULL::VARCHAR"},
    ),
    "cj_json_array": (
        f"concat('[\"cat\",\"sub\",\"2024-01-01 00:00:00\",\"', src_ip, '\",', src_port, ',null,\"en\",\"m', {K}, '\"]')",
        {"event_category": "'cat'", "src_ip": "src_ip", "src_port": "src_port::VARCHAR", "user_agent": "NULL::VARCHAR", "metadata": f"'m' || {K}"},
    ),
    "xml_generic": (
        f"concat('<log level=\"high\"><source-ip>', src_ip, '</source-ip><user>u', {K}, '</user><other>x</other></log>')",
        {"severity": "'high'", "device_type": "'generic'"},
    ),
}
LINES["paloalto_threat"] = (
    f"concat('1,2024/01/08 10:00:00,SER,THREAT,vulnerability,2049,x,', src_ip, ',', dst_ip, ',0.0.0.0,0.0.0.0,rule,any,,web,vsys1,trust,untrust,e1,e2,fwd,t,1,1,', src_port, ',', dst_port, ',0,0,0x0,tcp,', if({K} % 4 = 0, 'sinkhole', 'odd'), repeat(',', 28), 'SIG', {K}, ',Name ', {K}, ',', if({K} % 3 = 0, 'critical', 'info'))",
    {"src_ip": "src_ip", "dst_port": "dst_port::VARCHAR", "username": "NULL::VARCHAR", "event_action": f"CASE WHEN {K} % 4 = 0 THEN 'block' ELSE 'alert' END", "threat_signature_id": f"'SIG' || {K}", "threat_name": f"'Name ' || {K}", "severity": f"CASE WHEN {K} % 3 = 0 THEN 'critical' ELSE 'informational' END"},
)


def rendered(spark: SparkSession, d: str, name: str) -> DataFrame:
    parsers.last_wins(spark)
    return canonical(spark, d).withColumn("line", F.expr(LINES[name][0]))


def _parser(name: str, wanted: dict[str, str]) -> None:
    def run(spark, d):
        p = rendered(spark, d, name).select("ordinal", parsers.parse(F.col("line"), name).alias("p"))
        return p.select("ordinal", F.col("p.success").alias("success"), *[F.try_element_at("p.fields", F.lit(f)).alias(f) for f in wanted])

    run.__name__ = f"parse_{name}"
    query(f"{WITH_C} SELECT ordinal, true AS success, {', '.join(f'{e} AS {f}' for f, e in wanted.items())} FROM c")(run)


for _name, (_line, _wanted) in LINES.items():
    _parser(_name, _wanted)

ORDER = list(LINES)


@query(f"{WITH_C} SELECT format_name, count(*) AS n FROM (SELECT CASE ordinal % {len(ORDER) + 2} " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(ORDER)) + f" WHEN {len(ORDER)} THEN 'csv' END AS format_name FROM c) GROUP BY 1")
def detect_format(spark, d):
    parsers.last_wins(spark)
    pick = F.pmod(F.col("ordinal"), F.lit(len(ORDER) + 2))
    line = F.when(pick == len(ORDER), F.expr("concat_ws(',', src_ip, src_port, dst_ip, dst_port)")).otherwise("plain words")
    for k, n in enumerate(ORDER):
        line = F.when(pick == k, F.expr(LINES[n][0])).otherwise(line)
    return canonical(spark, d).select(parsers.detect(line).alias("format_name")).groupBy("format_name").agg(F.count(F.lit(1)).alias("n"))


@query(f"{WITH_C} SELECT ordinal, src_ip AS src, dst_port::VARCHAR AS port FROM c WHERE ordinal % 3 <> 0 OR ordinal % 2 = 0")
def parse_csv(spark, d):
    lines = canonical(spark, d).select("ordinal", F.expr("if(ordinal % 3 <> 0 OR ordinal % 2 = 0, concat('\"', src_ip, '\",', dst_port, ',\"a, b\"'), src_ip)").alias("line"))
    p = lines.select("ordinal", parsers.csv_row(F.col("line"), ["src", "port", "note"]).alias("p")).where("p.success")
    return p.select("ordinal", F.try_element_at("p.fields", F.lit("src")).alias("src"), F.try_element_at("p.fields", F.lit("port")).alias("port"))


# mapping ---------------------------------------------------------------------
WORD = "CASE k % 9 WHEN 0 THEN 'Emerg' WHEN 1 THEN ' critical ' WHEN 2 THEN 'ERROR' WHEN 3 THEN 'warn' WHEN 4 THEN 'notice' WHEN 5 THEN 'info' WHEN 6 THEN '10' WHEN 7 THEN 'odd' END"
ACT = "CASE k % 7 WHEN 0 THEN 'Permitted' WHEN 1 THEN 'denied' WHEN 2 THEN 'BLOCKED' WHEN 3 THEN 'teardown' WHEN 4 THEN 'alert' WHEN 5 THEN 'reset' ELSE 'quux' END"
PORT = "CASE k % 5 WHEN 0 THEN '443' WHEN 1 THEN ' 80.9 ' WHEN 2 THEN 'x' WHEN 3 THEN '' ELSE '-7' END"


@query(f"""WITH {SQL} SELECT event_id, CASE k % 9 WHEN 0 THEN 10 WHEN 1 THEN 8 WHEN 2 THEN 6 WHEN 3 THEN 4 WHEN 4 THEN 2 WHEN 5 THEN 1 WHEN 6 THEN 10 WHEN 7 THEN 0 END::BIGINT AS severity,
 CASE k % 7 WHEN 0 THEN 'allow' WHEN 1 THEN 'deny' WHEN 2 THEN 'block' WHEN 3 THEN 'drop' WHEN 4 THEN 'alert' WHEN 5 THEN 'reset' ELSE 'unknown' END AS event_action, CASE k % 5 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 4 THEN -7 END::BIGINT AS dst_port,
 CASE WHEN k % 2 = 0 THEN 'threat' ELSE 'unknown' END AS event_category, least(1.0, k / 50.0)::DOUBLE AS label_confidence FROM s""")
def coerce_fields(spark, d):
    s = structured(spark, d)
    c = lambda n, e: mapping.coerce(n, F.expr(e)).alias(n)
    return s.select("event_id", c("severity", WORD), c("event_action", ACT), c("dst_port", PORT), c("event_category", "if(k % 2 = 0, 'IDS', 'zzz')"), c("label_confidence", "cast(k / 50.0D as string)"))


@query(f"{WITH_C} SELECT ordinal, '{{src_ip}}' AS src_ip, 4::BIGINT AS severity, 'unknown' AS event_action, 'x' AS threat_name, 'kept' AS other, NULL::VARCHAR AS raw_log FROM c".replace("'{src_ip}'", "src_ip"))
def map_fields(spark, d):
    parsers.last_wins(spark)
    m = canonical(spark, d).select("ordinal", F.expr("map('srcaddr', src_ip, 'sev', 'warning', 'sig', 'x', 'else', 'kept', 'raw_log', cast(null as string))").alias("fields"), F.lit(None).cast("map<string,string>").alias("extra"))
    out = mapping.map_fields(m, {"srcaddr": "src_ip", "sev": "severity", "sig": "threat_name", "else": "other"})
    return out.select("ordinal", "src_ip", "severity", "event_action", "threat_name", F.try_element_at("extra_fields", F.lit("other")).alias("other"), F.try_element_at("extra_fields", F.lit("raw_log")).alias("raw_log"))


@query(f"""{WITH_C} SELECT ordinal, concat_ws('; ', CASE WHEN k % 10 = 0 THEN 'source_id is required' END, CASE WHEN k % 7 = 0 THEN 'record_hash is not 32 hexadecimal digits' END, CASE WHEN k % 3 = 0 THEN 'dst_port is out of range' END, CASE WHEN k % 5 = 0 THEN 'label_confidence is not in [0, 1]' END, CASE WHEN k % 4 = 0 THEN 'event_action is unknown' END) AS errors
 FROM (SELECT *, {K} AS k FROM c)""")
def validation_errors(spark, d):
    c = canonical(spark, d).withColumn("k", F.expr(K)).withColumns({
        "record_hash": F.expr("if(k % 7 = 0, 'zz', md5(event_uid))"), "source_id": F.expr("if(k % 10 = 0, '', 'src')"), "dst_port": F.expr("if(k % 3 = 0, 70000, dst_port)"), "label_confidence": F.expr("if(k % 5 = 0, 1.5D, 0.5D)"), "event_action": F.expr("if(k % 4 = 0, 'quux', event_action)")})
    return c.select("ordinal", mapping.validation_errors().alias("errors"))


# enrichment -------------------------------------------------------------------
ADDRESS = "concat(event_id * 37 % 256, '.', event_id * 91 % 256, '.', k, '.', user_id % 256, CASE WHEN event_id % 11 = 0 THEN ':80' ELSE '' END)"


def _bounds(cidr: str) -> str:
    lo, hi = network.bounds(cidr)
    return f"{lo}, {hi}"


NETS_SQL = "nets(no, lo, hi, country, city, asn) AS (VALUES " + ", ".join(f"({k}, {_bounds(c)}, '{a}', '{b}', '{o}')" for k, (c, a, b, o) in enumerate(fixed_values.NETWORKS)) + ")"
INNER_SQL = "inside(lo, hi) AS (VALUES " + ", ".join(f"({_bounds(c)})" for c in network.INTERNAL) + ")"
REGION_SQL = "regions(octet, country, city, asn) AS (VALUES " + ", ".join(f"({o}, '{a}', '{b}', '{x}')" for a, b, x, os in fixed_values.REGIONS for o in os) + ")"


@query(f"""WITH {SQL}, {NETS_SQL}, {INNER_SQL}, {REGION_SQL}, a AS (SELECT event_id, (event_id::BIGINT * 37 % 256) AS o1, (event_id::BIGINT * 37 % 256) * 16777216 + (event_id::BIGINT * 91 % 256) * 65536 + k * 256 + user_id % 256 AS n FROM s),
h AS (SELECT event_id, min(no) AS no FROM a JOIN nets ON n BETWEEN lo AND hi GROUP BY 1), i AS (SELECT DISTINCT event_id FROM a JOIN inside ON n BETWEEN lo AND hi)
SELECT a.event_id, CASE WHEN h.no IS NOT NULL THEN nets.country WHEN i.event_id IS NOT NULL THEN 'INTERNAL' ELSE coalesce(r.country, 'GLOBAL') END AS country, CASE WHEN h.no IS NOT NULL THEN nets.city WHEN i.event_id IS NOT NULL THEN 'Private Network' ELSE coalesce(r.city, 'Public WAN') END AS city, (h.no IS NULL AND i.event_id IS NOT NULL) AS is_private
FROM a LEFT JOIN h USING (event_id) LEFT JOIN nets USING (no) LEFT JOIN i ON i.event_id = a.event_id LEFT JOIN regions r ON r.octet = a.o1""")
def geo_lookup(spark, d):
    g = structured(spark, d).select("event_id", network.geo(F.expr(ADDRESS)).alias("g"))
    return g.select("event_id", "g.country", "g.city", "g.is_private")


T_IP = "concat(CASE WHEN event_id % 2 = 0 THEN '198.51.100.' ELSE '203.0.113.' END, event_id % 256)"


@query(f"""WITH {SQL}, t(ip, source, score) AS (VALUES {', '.join(f"('{a}', '{n}', {v})" for a, (n, v) in fixed_values.THREATS.items())}), a AS (SELECT event_id, {T_IP} AS ip, event_id::BIGINT % 256 AS low, event_id::BIGINT % 2 AS odd FROM s)
SELECT event_id, coalesce(t.score, CASE WHEN odd = 0 AND low BETWEEN 64 AND 79 THEN 0.88 WHEN odd = 1 AND low BETWEEN 80 AND 95 THEN 0.95 ELSE 0 END)::DOUBLE AS score, coalesce(t.source, CASE WHEN odd = 0 AND low BETWEEN 64 AND 79 THEN 'emerging_threats_bruteforce' WHEN odd = 1 AND low BETWEEN 80 AND 95 THEN 'darklist_c2_pool' END) AS source FROM a LEFT JOIN t USING (ip)""".replace("event_id % ", "event_id::BIGINT % "))
def threat_lookup(spark, d):
    t = structured(spark, d).select("event_id", network.threat(F.expr(T_IP)).alias("t"))
    return t.select("event_id", "t.score", "t.source")


TEXT = "CASE k % 12 WHEN 0 THEN 'SQL  Injection' WHEN 1 THEN 'Brute force' WHEN 2 THEN 'nmap port scan' WHEN 3 THEN 'PowerShell -enc' WHEN 4 THEN 'mirai botnet' WHEN 5 THEN 'SYN flood' WHEN 6 THEN 'AccessDenied' WHEN 7 THEN 'a scanner' WHEN 8 THEN '' ELSE 'plain' END"
TECH_SQL = "CASE WHEN trim(x) = '' THEN NULL " + " ".join(f"WHEN regexp_matches(x, '(?i){p}') THEN '{t}'" for p, _, t, _ in fixed_values.TECHNIQUES) + " WHEN a = 'deny' THEN 'T1190' END"


@query(f"WITH {SQL} SELECT event_id, {TECH_SQL} AS technique_id FROM (SELECT event_id, {TEXT} AS x, CASE WHEN event_type = 'error' THEN 'deny' ELSE 'allow' END AS a FROM s)")
def technique_mapping(spark, d):
    none = F.lit(None).cast("string")
    return structured(spark, d).select("event_id", mapping.technique(F.expr(TEXT), none, none, none, F.expr("if(event_type = 'error', 'deny', 'allow')"))["technique_id"].alias("technique_id"))


@query(f"""{WITH_C} SELECT ordinal, CASE WHEN bad THEN 0.95 END::DOUBLE AS threat_intel_score, CASE WHEN bad AND k % 2 = 0 THEN 'attack' WHEN k % 2 = 0 THEN 'uncertain' ELSE 'benign' END AS weak_label, CASE WHEN bad THEN greatest(k / 100.0, 0.85) ELSE k / 100.0 END::DOUBLE AS label_confidence,
 CASE WHEN bad THEN 'DE' ELSE 'INTERNAL' END AS src_country, NOT bad AS is_src_private, 'US' AS dst_country FROM (SELECT *, {K} AS k, {K} % 3 = 0 AS bad FROM c)""")
def enrich_events(spark, d):
    null = lambda t: F.lit(None).cast(t)
    c = canonical(spark, d, addressed(spark, d)).withColumn("k", F.expr(K)).withColumns({"src_ip": F.expr("if(k % 3 = 0, '185.220.101.5', src_ip)")})
    c = c.withColumns({n: null(t) for n, t in mapping.CANONICAL.items() if n not in c.columns}).withColumns({"threat_intel_score": null("double"), "is_malicious": null("boolean"), "weak_label": F.expr("if(k % 2 = 0, 'uncertain', 'benign')"), "label_confidence": F.expr("k / 100.0D")})
    e = enrichment.enrich(c)
    return e.select("ordinal", "threat_intel_score", "weak_label", "label_confidence", "src_country", "is_src_private", "dst_country")


@query(f"""{WITH_C} SELECT ordinal, lower(severity_label) = 'critical' OR severity BETWEEN 1 AND 4 OR event_action IN ('deny', 'alert') OR weak_label = 'attack' OR is_malicious OR mitre_technique_id IS NOT NULL OR threat_intel_score >= 0.5 OR threat_name IS NOT NULL AS is_threat FROM c""")
def is_threat(spark, d):
    return canonical(spark, d).select("ordinal", mapping.is_threat().alias("is_threat"))


@query(f"{WITH_C} SELECT ordinal, concat('10.0.', user_id // 256, '.', user_id % 256) AS src_ip, {K} % 5 * 2 AS severity_code, 'deny' AS event_action, 'INTERNAL' AS src_country, '' AS errors FROM c JOIN (SELECT ordinal, user_id FROM s) USING (ordinal)".replace(f"{K} % 5 * 2 AS severity_code", f"CASE {K} % 5 * 2 WHEN 0 THEN 1 WHEN 2 THEN 4 WHEN 4 THEN 4 WHEN 6 THEN 6 ELSE 8 END::BIGINT AS severity"))
def normalise_events(spark, d):
    """Lines through the whole plan: parse, map, enrich, validate."""
    lines = canonical(spark, d).select("ordinal", F.lit("mem").alias("source_file"), F.expr(f"format_string('CEF:0|Acme|Box|1.0|%d|Rule|%d|src=%s dst=%s outcome=Denied', {K}, {K} % 5 * 2, src_ip, dst_ip)").alias("line"))
    e = pipeline.validated(enrichment.enrich(pipeline.events(pipeline.parsed(lines, "cef"), "bench")))
    return e.select("ordinal", "src_ip", "severity", "event_action", "src_country", "errors")


# sinks -------------------------------------------------------------------------
@query(f"""{WITH_C} SELECT ordinal, concat('CEF:0|Tracewright|LogEngine|1.0|', coalesce(NULL, substr(event_uid, 1, 8)), '|', coalesce(replace(threat_name, '|', '\\|'), event_category), '|', CASE severity WHEN 6 THEN 7 WHEN 4 THEN 5 ELSE 1 END, '|eventId=', event_uid, ' cs1=h cs1Label=record_hash rt=', epoch_ms(timestamp_utc), ' src=', src_ip, ' spt=', src_port, ' dst=', dst_ip, ' dpt=', dst_port, ' proto=', protocol, ' act=', event_action, CASE WHEN user_agent IS NOT NULL THEN ' requestClientApplication=' || user_agent ELSE '' END,
 ' cs2=', weak_label, ' cs2Label=weak_label cn1Label=label_confidence cs3Label=evidence_codes cs4=', format_name, ' cs4Label=format_name cs5=bench cs5Label=source_id msg=', raw_log) AS line FROM c""")
def cef_lines(spark, d):
    null = F.lit(None).cast("string")
    c = canonical(spark, d).withColumns({"record_hash": F.lit("h"), "source_id": F.lit("bench"), **{n: null for n in ("threat_signature_id", "http_method", "http_url", "username", "device_hostname", "device_ip", "label_confidence", "evidence_codes")}})
    return c.select("ordinal", sinks.cef_line().alias("line"))


# arrays of values, structuring, cleaning ----------------------------------------
def array_lines(spark, d):
    one = "concat('[\"c\",\"s\",\"2024-01-01 00:00:00\",\"', client_ip, '\",80,null,\"en\",\"m\"]')"
    return structured(spark, d).select(F.col("ordinal").cast("long").alias("source_line"), F.expr(f"CASE ordinal % 6 WHEN 0 THEN '  ' WHEN 1 THEN '[1,' WHEN 2 THEN '{{\"a\":1}}' WHEN 3 THEN '[1,2]' WHEN 4 THEN {one} ELSE concat({one}, ' ', {one}) END").alias("line"))


@query(f"WITH {SQL} SELECT CASE event_id::BIGINT % 6 WHEN 0 THEN 'blank' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'not_an_array' WHEN 3 THEN 'invalid_field_count' ELSE 'valid' END AS parse_status, (count(*) + count(*) FILTER (event_id::BIGINT % 6 = 5))::BIGINT AS n FROM s GROUP BY 1")
def parse_status_counts(spark, d):
    return logs.parse_arrays(array_lines(spark, d)).groupBy("parse_status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SQL} SELECT count(*) AS lines, count(*) FILTER (event_id::BIGINT % 6 = 0) AS blank_lines, count(*) FILTER (event_id::BIGINT % 6 = 5) AS concatenated_lines, (count(*) FILTER (event_id::BIGINT % 6 <> 0) + count(*) FILTER (event_id::BIGINT % 6 = 5))::BIGINT AS \"values\" FROM s")
def line_counts(spark, d):
    return profiling.line_counts(logs.parse_arrays(array_lines(spark, d)))


@query(f"""WITH {SQL} SELECT concat('dataset12345:', event_id, ':1') AS event_id, substr(sha256(concat('["c","s","2024-01-01 00:00:00","', client_ip, '",80,null,"en","m"]')), 1, 32) AS record_hash, client_ip, '80' AS source_port, NULL::VARCHAR AS user_agent FROM s""")
def structure_events(spark, d):
    lines = structured(spark, d).select(F.col("ordinal").cast("long").alias("source_line"), F.expr("concat('[\"c\", \"s\", \"2024-01-01 00:00:00\", \"', client_ip, '\", 80, null, \"en\", \"m\"]')").alias("line"))
    return logs.structure(logs.parse_arrays(lines), "dataset12345678").select("event_id", "record_hash", "client_ip", "source_port", "user_agent")


@query(f"WITH {SQL} SELECT event_id, timestamp_normalized, client_ip AS client_ip_canonical, 4::BIGINT AS ip_version, source_port_normalized FROM s")
def clean_events(spark, d):
    s = structured(spark, d).select("event_id", F.date_format("timestamp_normalized", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "client_ip", F.concat(F.col("source_port_normalized").cast("string"), F.lit(".0")).alias("source_port"))
    return batch.clean(batch.clean(s)).select("event_id", *batch.DERIVED)


@query(f"{WITH_L}, {CW}, {SW} SELECT event_id, weak_label, round(w, 6) AS training_sample_weight FROM sw")
def joined_sidecars(spark, d):
    x = labelled(spark, d)
    return aggregation.combined(x.select("event_id", "record_hash", "weak_label"), batch.sample_weights(x).select("event_id", "record_hash", "training_sample_weight")).select("event_id", "weak_label", "training_sample_weight")


@query(f"WITH {SQL} SELECT event_id, record_hash, 1::BIGINT AS n_left FROM s WHERE k % 7 = 0")
def misaligned_identities(spark, d):
    s = structured(spark, d).select("event_id", "record_hash", "k")
    return aggregation.aligned(s, s.where("k % 7 <> 0")).select("event_id", "record_hash", "n_left")


@query(f"WITH {SQL}, z AS (SELECT CASE k % 4 WHEN 0 THEN 'attack' WHEN 1 THEN 'uncertain' WHEN 2 THEN 'other' END AS weak_label, CASE WHEN k % 3 = 0 THEN 0.5 ELSE 0.0 END AS c, event_id FROM s) SELECT event_id FROM z WHERE weak_label IS NULL OR weak_label = 'other' OR (weak_label = 'uncertain' AND c <> 0) OR (weak_label = 'attack' AND c <= 0)")
def invalid_labels(spark, d):
    z = structured(spark, d).select("event_id", F.expr("CASE k % 4 WHEN 0 THEN 'attack' WHEN 1 THEN 'uncertain' WHEN 2 THEN 'other' END").alias("weak_label"), F.expr("if(k % 3 = 0, 0.5D, 0.0D)").alias("label_confidence"))
    return batch.invalid_labels(z).select("event_id")


@query(f"{WITH_V}, {HOURLY} SELECT count(*) AS active_hours, (epoch(max(hour_start)) - epoch(min(hour_start)))::BIGINT // 3600 + 1 AS possible_hours, " + ", ".join(f"round(quantile_cont(event_count, {q}), 6)::DOUBLE AS q{round(q * 1000)}" for q in aggregation.LADDER) + " FROM h WHERE data_split = 'train'")
def training_quantiles(spark, d):
    h = aggregation.time_view(viewed(spark, d)).where("data_split = 'train'")
    span = (F.unix_timestamp(F.max("hour_start").cast("timestamp")) - F.unix_timestamp(F.min("hour_start").cast("timestamp"))) / 3600 + 1
    return h.agg(F.count(F.lit(1)).alias("active_hours"), span.cast("long").alias("possible_hours"), *[F.percentile("event_count", F.lit(q)).alias(f"q{round(q * 1000)}") for q in aggregation.LADDER])


@query(f"WITH {SQL} SELECT ip_version, count(*) AS n FROM (SELECT CASE k % 3 WHEN 0 THEN 4 WHEN 1 THEN 6 END::BIGINT AS ip_version FROM s) GROUP BY 1")
def ip_versions(spark, d):
    ips = addressed(spark, d).select(F.expr("CASE k % 3 WHEN 0 THEN client_ip WHEN 1 THEN concat('2001:db8::', k) ELSE '300.1.1.1' END").alias("ip"))
    return ips.groupBy(network.ip_version(F.col("ip")).alias("ip_version")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SQL} SELECT count(*) AS n, round(avg(value), 6) AS mean, min(value) AS minimum, max(value) AS maximum, " + ", ".join(f"round(quantile_cont(value, 0.{q}), 6) AS p{q}" for q in (25, 50, 75)) + " FROM s")
def describe_values(spark, d):
    v = F.col("value")
    return structured(spark, d).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("minimum"), F.max(v).alias("maximum"), *[F.percentile(v, F.lit(q / 100)).alias(f"p{q}") for q in (25, 50, 75)])


@query(f"{WITH_L} SELECT count(*) FILTER (evidence_count <> CASE WHEN evidence_codes = '{labels.NO_EVIDENCE}' THEN 0 ELSE length(evidence_codes) - length(replace(evidence_codes, '|', '')) + 1 END) AS inconsistent, count(*) AS n FROM l")
def evidence_count_consistency(spark, d):
    want = F.when(F.col("evidence_codes") == labels.NO_EVIDENCE, 0).otherwise(F.regexp_count("evidence_codes", F.lit(r"\|")) + 1)
    return labelled(spark, d).agg(F.count_if(F.col("evidence_count") != want).alias("inconsistent"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SQL}, months AS (SELECT date_trunc('month', timestamp_normalized)::TIMESTAMP AS month, count(*) AS events, round(count(*) FILTER (event_type = 'error') * 100.0 / count(*), 6)::DOUBLE AS error_percent FROM s GROUP BY 1)
SELECT month, coalesce(events, 0) AS events, error_percent FROM (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM months) LEFT JOIN months USING (month)""")
def monthly_summary(spark, d):
    per = structured(spark, d).groupBy(F.date_trunc("month", "timestamp_normalized").alias("month")).agg(F.count(F.lit(1)).alias("events"), (F.count_if(F.col("event_type") == "error") * 100.0 / F.count(F.lit(1))).alias("error_percent"))
    return aggregation.filled(per, "month", "1 MONTH").withColumn("events", F.coalesce("events", F.lit(0)))


@query(f"WITH {SQL} SELECT event_id FROM s ORDER BY md5(concat('42:', event_id)), event_id LIMIT 100")
def reservoir_sample(spark, d):
    return profiling.reservoir(structured(spark, d), "event_id", 100).select("event_id")


# features and evaluation ----------------------------------------------------------
HFC = "(hour(timestamp_utc) + minute(timestamp_utc) / 60.0 + second(timestamp_utc) / 3600.0)::DOUBLE"
ML_SQL = {
    "src_port_norm": "src_port / 65535.0", "src_port_registered": "(src_port BETWEEN 1024 AND 49151)::INT", "src_port_dynamic": "(src_port >= 49152)::INT", "dst_port_norm": "dst_port / 65535.0", "dst_port_privileged": "(dst_port <= 1023)::INT", "dst_port_web": "(dst_port IN (80, 443))::INT", "dst_port_admin": "(dst_port IN (22, 23))::INT",
    "proto_tcp": "(protocol = 'TCP')::INT", "proto_udp": "(protocol = 'udp')::INT", "proto_icmp": "(protocol = 'icmp')::INT", "proto_other": "(protocol = 'gre')::INT", "severity_norm": "severity / 10.0", "action_denied": "(event_action = 'deny')::INT", "action_allowed": "(event_action = 'allow')::INT",
    "hour_sin": f"sin({HFC} * (2 * pi() / 24))", "is_weekend": "(isodow(timestamp_utc) >= 6)::INT", "threat_intel_score": "threat_intel_score", "has_mitre_tag": "(mitre_technique_id IS NOT NULL)::INT", "user_agent_len_log1p": "CASE WHEN user_agent IS NULL THEN 0 ELSE ln(1 + length(user_agent)) END",
}


@query(f"{WITH_C} SELECT ordinal, " + ", ".join(f"round(({e})::DOUBLE, 6) + 0.0 AS {n}" for n, e in ML_SQL.items()) + " FROM c")
def classifier_features(spark, d):
    c = canonical(spark, d)
    cols = ml.feature_columns(set(c.columns))
    return c.select("ordinal", *[cols[n].alias(n) for n in ML_SQL])


P = "(k / 100.0)"


@query(f"""WITH {SQL}, e AS (SELECT (event_type = 'error' OR k % 10 < 4)::INT AS y, round(k / 100.0, 4) AS p FROM s), z AS (SELECT *, (p >= 0.5)::INT AS d, greatest(p, 1 - p) < 0.6 AS u FROM e),
 o AS (SELECT count(*) FILTER (y = 1 AND d = 1)::DOUBLE AS tp, count(*) FILTER (y = 0 AND d = 1)::DOUBLE AS fp, count(*) FILTER (y = 0 AND d = 0)::DOUBLE AS tn, count(*) FILTER (y = 1 AND d = 0)::DOUBLE AS fn, avg((p - y) * (p - y)) AS brier, avg(u::INT) AS ab FROM z),
 a AS (SELECT sum(CASE WHEN x.p > w.p THEN 1.0 WHEN x.p = w.p THEN 0.5 ELSE 0 END * x.n * w.n) / (sum(x.n * w.n)) AS auc FROM (SELECT p, count(*) AS n FROM e WHERE y = 1 GROUP BY 1) x, (SELECT p, count(*) AS n FROM e WHERE y = 0 GROUP BY 1) w)
 SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, tn::BIGINT AS tn, fn::BIGINT AS fn, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
 round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc, round(auc, 6)::DOUBLE AS roc_auc, round(brier, 6)::DOUBLE AS brier_score, round(ab, 6) AS abstention_rate FROM o, a""")
def classifier_metrics(spark, d):
    e = structured(spark, d).select(F.expr("cast(event_type = 'error' OR k % 10 < 4 as int)").alias("y"), F.expr("round(k / 100.0D, 4)").alias("p_attack"))
    return ml.metrics(e.withColumns(ml.decision(F.col("p_attack"))))


@query(f"{WITH_C} SELECT threat_intel_score > 0.5 OR severity >= 4 AS attack, count(*) AS n FROM c GROUP BY 1")
def static_rule_baseline(spark, d):
    return canonical(spark, d).groupBy(ml.static_rule().alias("attack")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{WITH_C} SELECT count(*) AS events, count(*) FILTER (weak_label = 'attack')::BIGINT AS attacks, (SELECT arg_max(format_name, n) FROM (SELECT format_name, count(*) AS n FROM c GROUP BY 1)) AS dominant_format FROM c")
def ingest_summary(spark, d):
    return pipeline.summary(canonical(spark, d))


def classify_synthetic(spark: SparkSession, d: str) -> DataFrame:
    """A calibrated classifier trained on synthetic events, applied to ``events``."""
    clf, _ = ml.train(logs.synthetic_events(spark, 3000))
    out = clf.predict(canonical(spark, d))
    return out.select("ordinal", "label", "confidence")


query()(classify_synthetic)

"""Known answers of labels, features, splits, weights, regimes and correlation."""

import hashlib
import hmac
import json
import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tracewright.functions import crypto, labels, mapping, network, parsers
from tracewright.operators import aggregation, batch, correlation, features


def test_weak_labels(spark):
    rows = [("gobuster/3.1", "x"), ("Mozilla/5.0", "x"), ("Mozilla/5.0", "wget http://x;sh"), (None, "x"), ("okhttp", "x"), ("sqlmap", "../../etc/passwd")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "i int, user_agent string, metadata string").withColumns({c: F.lit("") for c in ("category_type", "sub_key", "language")})
    got = batch.weak_labels(df).orderBy("i").collect()
    assert [(r.weak_label, r.label_confidence, r.label_conflict) for r in got] == [("attack", 0.85, False), ("benign", 0.55, False), ("attack", 0.95, True), ("uncertain", 0.0, False), ("uncertain", 0.0, False), ("attack", 0.99, False)]
    assert got[4].evidence_codes == labels.NO_EVIDENCE and got[5].evidence_count == 2


def test_past_only_features(spark):
    rows = [(0, "A", 0, 80), (1, "A", 60, 80), (2, "B", 15, 443), (3, "A", 30, 80), (4, "A", 120, 443)]
    df = spark.createDataFrame(rows, "ordinal long, c string, s long, source_port_normalized long").withColumn("timestamp_normalized", F.timestamp_seconds(F.col("s") + 1704067200).cast("timestamp_ntz"))
    got = {r.ordinal: r for r in features.past_only(df, "c").collect()}
    col = lambda n: [got[k][n] for k in range(5)]
    assert col("has_previous_event") == [0, 1, 0, 1, 1] and col("timestamp_reversal_flag") == [0, 0, 0, 1, 0]
    assert col("same_port_as_previous") == [0, 1, 0, 1, 0] and col("source_port_seen_before") == [0, 1, 0, 1, 0]
    assert got[1].activity_decay_60s == pytest.approx(math.exp(-1))


def test_split_and_weights(spark):
    ts = spark.sql("SELECT * FROM VALUES (0, timestamp_ntz'2023-12-31 23:59:59'), (1, timestamp_ntz'2024-01-01 00:00:00'), (2, timestamp_ntz'2024-01-31 23:59:59'), (3, timestamp_ntz'2024-02-01 00:00:00') AS t(i, ts)")
    assert [r.s for r in ts.orderBy("i").select(batch.calendar_split(F.col("ts")).alias("s")).collect()] == ["train", "validation", "validation", "test"]
    rows = [("attack", 0.85), ("attack", 0.95), ("attack", 0.99), ("benign", 0.55), ("uncertain", 0.0)]
    df = spark.createDataFrame(rows, "weak_label string, label_confidence double").withColumn("data_split", F.lit("train"))
    w = {r.weak_label: r.class_weight for r in batch.class_weights(df).collect()}
    assert w == {"attack": pytest.approx(4 / 6), "benign": pytest.approx(2.0)}
    got = batch.sample_weights(df).groupBy("weak_label").agg(F.sum("training_sample_weight").alias("s")).collect()
    assert {r.weak_label: r.s for r in got} == {"attack": pytest.approx(2.0), "benign": pytest.approx(2.0), "uncertain": 0.0}


def test_regimes(spark):
    rows = [(h, n) for h, n in zip((0, 1, 2, 4, 5, 6, 7), (10, 200, 20, 10, 200, 200, 10))]
    h = spark.createDataFrame(rows, "h long, event_count long").select(F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz").alias("hour_start"), F.lit("train").alias("data_split"), "event_count")
    t = spark.createDataFrame([(159.2, 160)], "threshold_training_quantile double, burst_threshold_event_count long")
    assert [r.volume_regime for r in aggregation.regimes(h, t).orderBy("hour_start").collect()] == ["ordinary", "burst", "post_burst", "ordinary", "burst", "burst", "post_burst"]


CANON = "ordinal long, t long, src_ip string, dst_port int"


def canon(spark, rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], CANON)
    cols = {c: F.lit(None).cast(t) for c, t in mapping.CANONICAL.items() if c not in ("src_ip", "dst_port")}
    return df.withColumns(cols | {"event_uid": F.concat(F.lit("e"), F.col("ordinal").cast("string")), "dst_ip": F.lit("10.0.0.9"), "raw_log": F.lit("x"), "format_name": F.lit("cef"), "timestamp_utc": F.timestamp_seconds(F.col("t") + 1704067200), "ingest_timestamp": F.current_timestamp()})


def test_port_scan(spark):
    scan = [(k, "1.1.1.1", p) for k, p in enumerate((21, 22, 23, 80, 443, 25, 110))]
    late = [(k * 1, "2.2.2.2", p) for k, p in enumerate((21, 22, 23, 80))] + [(60, "2.2.2.2", 443)]
    got = correlation.alerts(canon(spark, scan + late), ["PORT_SCAN_SWEEP"]).collect()
    assert [(r.primary_ip, r.event_count, r.measure, r.severity, r.mitre_technique_id) for r in got] == [("1.1.1.1", 5, 5, "medium", "T1046")]


def test_scalar_functions(spark):
    key = b"k" * 80
    df = spark.createDataFrame([("8.8.8.8:53",), ("10.1.1.1",), ("203.0.113.88",), ("bad",), (None,), ("2001:DB8::1",)], "ip string")
    got = df.select("ip", network.geo(F.col("ip")).alias("g"), network.threat(F.col("ip")).alias("t"), network.canonical_ip(F.col("ip")).alias("c"), crypto.hmac_sha256(F.col("ip"), key).alias("h")).collect()
    assert [r.g.country for r in got] == ["US", "INTERNAL", "US", None, None, None]
    assert got[2].t.is_malicious and got[2].t.source == "darklist_c2" and got[5].c == "2001:db8::1"
    assert got[1].h == hmac.new(key, b"10.1.1.1", hashlib.sha256).hexdigest()


def test_invalid_values_fail(spark):
    ok = spark.createDataFrame([("2024-01-01 00:00:00", "1.1.1.1", "80.0")], "timestamp string, client_ip string, source_port string")
    assert batch.clean(ok).first().source_port_normalized == 80
    for c, v in (("timestamp", "2024-13-01"), ("client_ip", "1.1.1"), ("source_port", "80.5"), ("source_port", None)):
        with pytest.raises(Exception):
            batch.clean(ok.withColumn(c, F.lit(v).cast("string"))).collect()
    with pytest.raises(ValueError):
        batch.clean(ok.drop("client_ip"))


def test_lines(spark):
    parsers.last_wins(spark)
    lines = [
        "<134>1 2024-01-08T12:00:00Z router01 firewall - - - src=172.16.0.5 dst=192.0.2.1 spt=1234 dpt=8080 proto=TCP action=DENY",
        "LEEF:1.0|Cisco|ASA|9.14|106023|src=192.168.1.5\tspt=44231\tdst=10.0.0.1\tdpt=443\tproto=TCP\taction=deny\tsev=7", "# a comment",
        "%ASA-2-106001: Inbound TCP connection denied from 198.51.100.25/12345 to 10.0.0.1/22 flags SYN on interface outside", '[1,2,3,4,5,6,7,null]', '{"a": 1', "<a><b>",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r.f for r in df.select(parsers.detect(F.col("line")).alias("f")).collect()] == ["syslog", "leef", None, "cisco_asa", "cj_json_array", None, "xml_generic"]
    f = df.select(parsers.parse(F.col("line"), "syslog").alias("s"), parsers.parse(F.col("line"), "cisco_asa").alias("a"), parsers.parse(F.col("line"), "xml_generic").alias("x"), parsers.parse(F.col("line"), "none").alias("n")).collect()
    assert f[0].s.fields["dst_port"] == "8080" and f[0].s.fields["device_hostname"] == "router01"
    assert f[3].a.success and "src_ip" not in f[3].a.fields and not f[6].x.success and not f[0].n.success


def test_gaps_are_found_and_filled(spark):
    days = spark.createDataFrame([("2024-02-27",), ("2024-03-02",), ("2024-02-27",)], "day string").selectExpr("cast(day as date) day")
    assert [str(r.day) for r in aggregation.missing_days(days).orderBy("day").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    e = spark.createDataFrame([("2024-01-01 23:59:58",), ("2024-01-03 00:00:01",), ("2024-01-03 00:00:01",)], "timestamp_utc string").selectExpr("cast(timestamp_utc as timestamp) timestamp_utc")
    got = correlation.eps(e).orderBy("second").collect()
    assert len(got) == 86404 and sum(r.events for r in got) == 3 and (got[0].events, got[1].events, got[-1].events) == (1, 0, 2)


def test_analysis_views_are_checked(spark):
    good = spark.createDataFrame([(80, 0.5, "attack", "train")], "source_port_normalized int, label_confidence double, weak_label string, data_split string")
    assert aggregation.checked_view(good).count() == 1
    with pytest.raises(ValueError, match="forbidden_column:metadata"):
        aggregation.checked_view(good.selectExpr("*", "'x' metadata"))
    for broken in ("70000 source_port_normalized", "2.0D label_confidence", "'odd' weak_label", "'late' data_split", "cast(null as string) weak_label"):
        name = broken.split()[-1]
        with pytest.raises(ValueError):
            aggregation.checked_view(good.drop(name).selectExpr("*", broken))
    v = spark.createDataFrame([(2, "b"), (1, "z"), (2, "a")], "g int, x string")
    assert [tuple(r) for r in aggregation.ordered(v, "g").collect()] == [(1, "z"), (2, "a"), (2, "b")]


def test_many_events_of_one_microsecond_give_no_more_alerts(spark):
    """5,000 events of an entity at one time, more than the ordering key has places for."""
    e = spark.range(5000).selectExpr("id ordinal", "concat('u', id) event_uid", "'10.0.0.1' src_ip", "cast(null as string) device_ip", "concat('192.0.2.', id % 9) dst_ip", "cast(20 + id % 50 as int) dst_port", "timestamp_seconds(1704067200) timestamp_utc", "timestamp_seconds(1704067200) ingest_timestamp",
        "'deny' event_action", "cast(null as int) http_status", "'network' event_category", "cast(null as string) weak_label", "'' raw_log")
    got = correlation.alerts(e, ["PORT_SCAN_SWEEP", "BRUTE_FORCE_CAMPAIGN"]).collect()
    assert {r.rule_name: (r.measure, r.event_count) for r in got} == {"PORT_SCAN_SWEEP": (5, 5), "BRUTE_FORCE_CAMPAIGN": (5, 5)} and len(got) == 2
    scan = json.loads(next(r.context for r in got if r.rule_name == "PORT_SCAN_SWEEP"))
    assert scan["scanned_ports"] == [20, 21, 22, 23, 24] and scan["port_count"] == 5 and len(scan["target_ips"]) == 5


def test_cooldown_against_brute_force(spark):
    r = random.Random(5)
    times = {"steady": [k * 1_000_000 for k in range(70_000)], "none": [], "one": [7]}
    for k in range(20):
        at, times[f"e{k}"] = 0, []
        for _ in range(r.randrange(1, 300)):
            at += r.choice((0, 0, 1, 30_000_000, 59_999_999, 60_000_000, 60_000_001, 900_000_000))
            times[f"e{k}"].append(at)
    rows = [(e, t, t * 4096 + n, n) for e, ts in times.items() for n, t in enumerate(ts)]
    found = spark.createDataFrame(rows, "entity string, __us long, __k long, ordinal long")
    for cooldown in (0, 20, 60):
        rule, want = replace(correlation.RULES["PORT_SCAN_SWEEP"], cooldown=cooldown), set()
        for e, ts in times.items():
            last = None
            for n, t in enumerate(ts):
                if last is None or t - last >= cooldown * 1_000_000:
                    last = t
                    want.add((e, n))
        got = [(x.entity, x.ordinal) for x in correlation.thinned(found, rule).select("entity", "ordinal").collect()]
        assert len(got) == len(want) and set(got) == want


#: Most often that a line's expensive functions may stand in its parser's expression.
ONCE = [("paloalto_threat", "regexp_extract_all", 1), ("paloalto_traffic", "regexp_extract_all", 1), ("syslog", "regexp_extract", 50), ("snort_alert", "regexp_extract", 13), ("aws_cloudtrail", "get_json_object", 3)]


@pytest.mark.parametrize("name, function, most", ONCE)
def test_a_line_is_searched_once(spark, name, function, most):
    assert 1 <= str(parsers.parse(F.col("line"), name)).count(f"{function}(") <= most


@pytest.mark.parametrize("line", ["<13>1 2024 h a - - - src=1.2.3.4 x", "<13>1 2024 h a - - - \x1fsrc=1.2.3.4 \x1f x", "no match"])
def test_groups_of_one_run(spark, line):
    """Also for texts that hold the mark between groups."""
    import re

    for regex, n in ((parsers.V.SYSLOG_5424, 8), (parsers.NET, 5)):
        got = spark.createDataFrame([(line,)], "line string").select(parsers.groups(F.col("line"), regex, n).alias("g")).first().g
        m = re.search(regex, line)
        assert got == (m and [x or "" for x in m.groups()])


@pytest.mark.parametrize("name", ["enrich_events", "ip_classes", "ip_versions"])
def test_user_ids_beyond_two_octets_equal_sql(spark, tmp_path, name):
    """Ids that the fixed text of client_ip does not hold as an address."""
    import duckdb

    from tracewright.plans import oracles, registry

    db, path = duckdb.connect(), f"{tmp_path}/events.parquet"
    db.sql("CREATE TABLE events AS SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * i AS ts, i * 40009 AS user_id, 'view' AS event_type, 1.5::DOUBLE AS value, '{\"k\": ' || i % 100 || '}' AS props FROM range(400) t(i)")
    db.sql(f"COPY events TO '{path}' (FORMAT parquet)")
    got = [tuple(r) for r in registry.QUERIES[name](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, db.sql(oracles.ORACLES[name]).fetchall())) and got

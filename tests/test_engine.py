"""Sources, sinks, the pipeline, manifests, the classifier, streams, entry points."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from tracewright.functions import parsers
from tracewright.operators import aggregation, correlation, ml
from tracewright.plans import pipeline, simulation
from tracewright.sources import logs, provenance, sinks
from tracewright.streaming import jobs, sources

from .test_contracts import canon

CEF = "CEF:0|Acme|Box|1|{k}|Brute force|8|src=203.0.113.88 dst=10.0.0.{k} spt=4000 dpt={p} outcome=Denied"


def test_arrays_and_quarantine(spark, tmp_path):
    good = json.dumps(["c", "s", "2024-01-01 00:00:00", "1.1.1.1", 80, None, "en", "m"])
    (tmp_path / "in.log").write_text(f"{good} {good}\n\n[1]\n{{}}\n{good} [bad\n")
    parsed = logs.parse_arrays(logs.read_numbered_lines(spark, str(tmp_path / "in.log")))
    assert [(r.source_line, r.array_position, r.parse_status) for r in parsed.orderBy("source_line", "array_position").collect()] == [(1, 1, "valid"), (1, 2, "valid"), (2, None, "blank"), (3, 1, "invalid_field_count"), (4, 1, "not_an_array"), (5, 1, "valid"), (5, 2, "invalid_json")]
    s = logs.structure(parsed, "abc").orderBy("event_id").collect()
    assert [r.event_id for r in s] == ["abc:1:1", "abc:1:2", "abc:5:1"] and s[0].user_agent is None and len({r.record_hash for r in s}) == 1
    sinks.write_quarantine(parsed, str(tmp_path / "q"))
    assert spark.read.csv(str(tmp_path / "q"), header=True).count() == 3


def test_pipeline_and_manifest(spark, tmp_path):
    (tmp_path / "in.log").write_text("\n".join(CEF.format(k=k, p=20 + k) for k in range(8)) + "\nnoise\n\n")
    got = pipeline.run_pipeline(spark, str(tmp_path / "in.log"), str(tmp_path / "out"), manifest_path=str(tmp_path / "m/manifest.json"))
    assert (got["format_name"], got["total_lines"], got["parsed_ok"], got["parse_errors"]) == ("cef", 9, 8, 1) and got["alerts_generated"] >= 2
    event = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert event["is_malicious"] is True and event["mitre_technique_id"] == "T1110" and event["event_action"] == "deny" and event["username"] is None
    assert provenance.verify_manifest(spark, str(tmp_path / "m/manifest.json")) == (True, [])
    part = glob.glob(f"{tmp_path}/out/part-*")[0]
    with open(part, "a") as f:
        f.write("tampered\n")
    ok, errors = provenance.verify_manifest(spark, str(tmp_path / "m/manifest.json"))
    assert not ok and "changed" in errors[0] and not provenance.verify_manifest(spark, str(tmp_path / "none.json"))[0]
    with pytest.raises(ValueError):
        sinks.writer("odd")


def test_export_once(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "e")
    assert provenance.export_once(df, path, "s", "v1") is True and provenance.export_once(df, path, "s", "v1") is False
    with pytest.raises(ValueError):
        provenance.export_once(df, path, "s", "v2")


def test_process_mixed_lines(spark):
    got = pipeline.process(spark, [CEF.format(k=1, p=1), '{"src_ip": "10.0.0.1", "severity": "low"}', "<log><user>u</user></log>", "??"]).orderBy("ordinal").collect()
    assert [r.format_name for r in got] == ["cef", "json", "xml_generic"] and got[0].is_threat and got[1].severity == 2


def test_classifier(spark):
    clf, scores = ml.train(logs.synthetic_events(spark, 600, parts=2), kind="lr")
    assert scores["accuracy"] > 0.9 and scores["roc_auc"] > 0.9
    labels = {r.label for r in clf.predict(logs.synthetic_events(spark, 50, seed=9, parts=2)).select("label").collect()}
    assert labels <= {"attack", "benign", "uncertain"}


def test_stream_alerts_equal_batch(spark, tmp_path):
    events = canon(spark, [(k * 3, f"1.1.1.{k % 2}", 20 + k) for k in range(60)]).withColumns({"event_action": F.lit("deny"), "severity": F.lit(6), "is_malicious": F.lit(True)})
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = jobs.alerts(stream).writeStream.format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    streamed = {(r.rule_name, r.primary_ip, r.at_us // 10**6, r.measure) for r in spark.table("found").collect()}
    batch = {(r.rule_name, r.primary_ip, int(r.timestamp_utc.timestamp()), r.measure) for r in correlation.alerts(events).collect()}
    assert {x[:2] + x[3:] for x in streamed} == {x[:2] + x[3:] for x in batch} and len(streamed) == len(batch) > 5


def test_stream_files_to_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.log").write_text("\n".join(CEF.format(k=k, p=k) for k in range(4)))
    e = jobs.normalised(sources.tailed(spark, str(tmp_path / "in")), "cef", "tail", enrich=False)
    jobs.to_sinks(e, [("jsonl", str(tmp_path / "j")), ("csv", str(tmp_path / "c"))], str(tmp_path / "cp"), once=True).awaitTermination(120)
    assert spark.read.text(str(tmp_path / "j")).count() == 4 and spark.read.csv(str(tmp_path / "c"), header=True).count() == 4


def test_registry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and "hourly_summary" in names


def test_ready_and_raw_lines(spark, tmp_path):
    ready = json.dumps({"event_uid": "u1", "raw_log": "x", "src_ip": "1.1.1.1", "severity": 8, "threat_intel_score": "odd", "more": {"a": 1}})
    rows = [ready, '{"src_ip": "2.2.2.2"}', CEF.format(k=1, p=1), "?? no format"]
    lines = spark.createDataFrame(list(enumerate(rows)), "ordinal long, line string").withColumn("source_file", F.lit("f"))
    got = {r.src_ip: r for r in pipeline.direct_events(lines, "api").collect()}
    assert set(got) == {"1.1.1.1", "2.2.2.2", "203.0.113.88"}
    one = got["1.1.1.1"]
    assert (one.event_uid, one.raw_log, one.severity, one.threat_intel_score, one.extra_fields) == ("u1", "x", 8, None, {"more": '{"a":1}'})
    assert got["2.2.2.2"].format_name == "json" and got["203.0.113.88"].is_malicious
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(rows))
    q = jobs.json_events(sources.tailed(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("tail_json").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.src_ip, r.format_name) for r in spark.table("tail_json").collect()} == {("1.1.1.1", None), ("2.2.2.2", None), ("203.0.113.88", "cef")}


def test_simulations(spark):
    rules = {"port_scan": "PORT_SCAN_SWEEP", "brute_force": "BRUTE_FORCE_CAMPAIGN", "cross_device": "CROSS_DEVICE_CAMPAIGN", "c2_beacon": "MALICIOUS_C2_BEACON", "exploit_followup": "HIGH_SEVERITY_MULTI_VECTOR"}
    for name, rule in rules.items():
        events, found = simulation.simulate(spark, name)
        assert events.count() == len(simulation.scripted(name))
        assert rule in {r.rule_name for r in correlation.history(found).collect()}
    with pytest.raises(ValueError):
        simulation.scripted("odd")


def test_history_is_newest_first(spark):
    a = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2), ("d", 3)], "alert_id string, s long").select("alert_id", F.timestamp_seconds("s").alias("timestamp_utc"))
    assert [r.alert_id for r in correlation.history(a, 3).collect()] == ["b", "d", "c"]


def test_empty_months_and_line_numbers(spark, tmp_path):
    per = spark.createDataFrame([("2024-01-01", 2), ("2024-04-01", 1)], "month string, events long").withColumn("month", F.col("month").cast("timestamp"))
    got = aggregation.filled(per, "month", "1 MONTH").orderBy("month").collect()
    assert [(r.month.month, r.events) for r in got] == [(1, 2), (2, None), (3, None), (4, 1)] and aggregation.filled(per.limit(0), "month", "1 MONTH").count() == 0
    text = [f"line {k}" if k % 7 else "" for k in range(1, 3001)]
    (tmp_path / "big.log").write_text("\n".join(text) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = logs.read_numbered_lines(spark, str(tmp_path / "big.log")).orderBy("source_line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.source_line for r in rows] == list(range(1, 3001)) and [r.line for r in rows] == text


def test_datagrams(spark, tmp_path):
    import socket
    import time

    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
        s.bind(("127.0.0.1", 0))
        port = s.getsockname()[1]
    q = sources.udp_lines(spark, port).writeStream.format("memory").queryName("udp").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        out, end = socket.socket(socket.AF_INET, socket.SOCK_DGRAM), time.time() + 60
        while time.time() < end and spark.table("udp").count() == 0:
            out.sendto(b"<134>hello\n", ("127.0.0.1", port))
            time.sleep(0.5)
        assert {(r.line, r.source_file) for r in spark.table("udp").collect()} == {("<134>hello", f"udp:127.0.0.1:{port}")}
    finally:
        q.stop()
        out.close()


# Lines of shapes that the rendered queries do not have: (line, format, expected fields)
SHAPES = [
    ("LEEF:1.0|Acme|Box|2|77|src=1.2.3.4\tdst=5.6.7.8\tsev=3", "leef", {"leef_version": "1.0", "src_ip": "1.2.3.4", "dst_ip": "5.6.7.8", "severity": "3"}),
    ("LEEF:2.0|Acme|Box|2|77|delimiter=0x7C|src=1.2.3.4|dst=5.6.7.8", "leef", {"src_ip": "1.2.3.4", "dst_ip": "5.6.7.8"}),
    ("<34>Jan  8 12:00:01 gate sshd: denied src=1.2.3.4", "syslog", {"timestamp_raw": "Jan  8 12:00:01", "device_hostname": "gate", "tag": "sshd", "src_ip": "1.2.3.4"}),
    ("<34>Jan 8 2024 12:00:01 gate sshd: from 1.2.3.4", "syslog", {"timestamp_raw": "Jan 8 2024 12:00:01", "device_hostname": "gate", "src_ip": "1.2.3.4"}),
    ("Jan 18 10:00:00 gate %ASA-3-305006: no ports here", "cisco_asa", {"threat_signature_id": "305006", "src_ip": None, "dst_port": None}),
    ("[**] [1:2:3] only a marker [**] and no more", "snort_alert", {"threat_signature_id": "1:2:3", "threat_name": "only a marker", "src_ip": None}),
    ('{"eventName": "ListUsers", "eventSource": "iam.amazonaws.com", "sourceIPAddress": "1.2.3.4"}', "aws_cloudtrail", {"threat_name": "AWS:ListUsers", "src_ip": "1.2.3.4"}),
    ('[{"eventName": "ListUsers", "eventSource": "iam.amazonaws.com", "sourceIPAddress": "1.2.3.4"}]', "aws_cloudtrail", {"threat_name": "AWS:ListUsers", "src_ip": "1.2.3.4"}),
    ("# a comment", "cef", None),
]


@pytest.mark.parametrize("line, name, wanted", SHAPES)
def test_shapes_of_lines(spark, line, name, wanted):
    parsers.last_wins(spark)
    p = spark.createDataFrame([(line,)], "line string").select(parsers.parse(F.col("line"), name).alias("p")).first().p
    assert p.success == (wanted is not None)
    assert wanted is None or {k: p.fields.get(k) for k in wanted} == wanted

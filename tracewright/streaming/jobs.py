"""Streams: normalisation, counters, events a second, stateful alerts, sinks."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import enrichment
from ..operators import correlation
from ..plans import pipeline
from ..sources import sinks

LATE = "10 minutes"


def normalised(lines: DataFrame, format_name: str, source_id: str, field_map: dict | None = None, enrich: bool = True) -> DataFrame:
    """Canonical events of a stream of lines of one format: the columns of batch."""
    df = lines.withColumn("ordinal", F.xxhash64("source_file", "line", "arrived"))
    out = pipeline.events(pipeline.parsed(df, format_name), source_id, field_map)
    return enrichment.enrich(out) if enrich else out


def json_events(lines: DataFrame, source_id: str = "file_tailer", enrich: bool = True) -> DataFrame:
    """Canonical events of a stream of JSON-lines, in which raw logs may stand too."""
    df = lines.withColumn("ordinal", F.xxhash64("source_file", "line", "arrived"))
    return pipeline.direct_events(df, source_id, any_object=True, enrich=enrich)


def per_second(events: DataFrame, ts: str = "timestamp_utc", late: str = LATE) -> DataFrame:
    """Events of each second; final once the watermark has passed. The watermark
    is an addition: events later than that are not counted."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 second").alias("w")).agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("second"), "events")


def counters(events: DataFrame, dimensions=("format_name", "severity", "event_action", "weak_label")) -> DataFrame:
    """Running counts by dimension and value (complete or update mode)."""
    e = events.select(F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in dimensions])).alias("x"))
    return e.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))


NEEDED = ["event_uid", "dst_ip", "dst_port", "__us", "ordinal", "__failed", "__family", "__suspicious", "__bad", "__severe", "threat_name", "mitre_technique_id"]
ALERT = "rule_name string, primary_ip string, at_us long, measure long, event_count long, target_ip string, mitre_technique_id string"


def judged(window: list[dict], now: dict, rule: correlation.Rule):
    """(measure, uids, technique) of a rule over the events in its window, or None."""
    start = now["__us"] - int(min(rule.window, correlation.MAX_WINDOW) * 1e6)
    seen = [e for e in window if e["__us"] >= start]
    name = rule.name
    if name == "PORT_SCAN_SWEEP":
        hit = [e for e in seen if (e["dst_port"] or 0) > 0]
        measure = len({e["dst_port"] for e in hit})
    elif name == "BRUTE_FORCE_CAMPAIGN":
        hit = [e for e in seen if e["__failed"]]
        measure = len(hit)
    elif name == "CROSS_DEVICE_CAMPAIGN":
        hit = seen
        measure = len({e["__family"] for e in seen if e["__family"] is not None}) if any(e["__suspicious"] for e in seen) else 0
    elif name == "MALICIOUS_C2_BEACON":
        hit = [e for e in seen if e["__bad"]]
        measure = len(hit)
    else:
        hit, measure = seen, len(seen) if any(e["__severe"] for e in seen) else 0
    if measure < rule.least:
        return None
    technique = rule.technique
    if name == "HIGH_SEVERITY_MULTI_VECTOR":
        technique = next(e for e in seen if e["__severe"])["mitre_technique_id"] or technique
    targets = sorted({e["dst_ip"] for e in seen if e["dst_ip"]})
    return measure, len(hit), targets[0] if targets else None, technique


def alerts(events: DataFrame, rules: dict | None = None, late: str = LATE) -> DataFrame:
    """Alerts of a stream, with a state per entity: the events of the last five
    minutes and each rule's last alert. Idle entities leave the state when the
    watermark has passed their window and cooldown. Events of one micro-batch are
    taken in time order; an event that comes late sees the later ones, too."""
    rules = rules or correlation.RULES
    keep_us = int(correlation.MAX_WINDOW * 1e6)
    wait_ms = int(1000 * (correlation.MAX_WINDOW + max(r.cooldown for r in rules.values())))

    def step(key, batches, state: GroupState):
        window, last = json.loads(state.get[0]) if state.exists and not state.hasTimedOut else [[], {}]
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["__us", "ordinal"])
        out = []
        for e in rows.astype(object).where(rows.notna(), None).to_dict("records"):
            e = {k: (v.item() if hasattr(v, "item") else v) for k, v in e.items() if k in NEEDED}
            window.append(e)
            while window and window[0]["__us"] < e["__us"] - keep_us:
                window.pop(0)
            for name, rule in rules.items():
                if not rule.enabled or e["__us"] - last.get(name, -(1 << 62)) < rule.cooldown * 1e6:
                    continue
                got = judged(window, e, rule)
                if got:
                    last[name] = e["__us"]
                    out.append((name, key[0], e["__us"] + 1577836800000000, got[0], got[1], got[2], got[3]))
        state.update((json.dumps([window, last]),))
        mark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(mark, int(rows["__us"].max() // 1000 + 1577836800000)) + wait_ms)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ALERT.split(", ")])

    no = F.lit(False)
    df = events.withColumn("entity", F.coalesce("src_ip", "device_ip")).where("entity is not null").withColumn("__ts", F.coalesce("timestamp_utc", "ingest_timestamp"))
    df = df.withWatermark("__ts", late).withColumns({"__us": F.unix_micros("__ts") - F.lit(1577836800000000), "__failed": correlation.failed(), "__family": correlation.device_family(), "__suspicious": correlation.suspicious(), "__bad": F.coalesce("is_malicious", no) | F.coalesce(F.col("threat_intel_score") >= 0.70, no), "__severe": correlation.severe()})
    return df.select("entity", "__ts", *NEEDED).groupBy("entity").applyInPandasWithState(step, ALERT, "state string", "append", GroupStateTimeout.EventTimeTimeout)


def to_sinks(events: DataFrame, targets: list[tuple[str, str]], checkpoint: str, once: bool = False):
    """Starts a query that writes each micro-batch to several (kind, path)."""

    def write(batch: DataFrame, number: int) -> None:
        # a repeated batch replaces its own folder, so nothing is written twice
        sinks.write_all(batch, [(kind, f"{path}/batch={number}") for kind, path in targets])

    w = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()

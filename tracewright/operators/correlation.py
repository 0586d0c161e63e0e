"""Correlation rules over sliding windows of each entity, in batch.

An entity is src_ip, else device_ip. Windows look back from an event, its own time
and the bound included. Range frames need an order: the key is microseconds times
4096 plus the rank among the entity's events of that time, so a frame holds no
later events of the same time. From the 4096th event of a microsecond on, events
share the last rank and see each other. Cooldown is a fold over each run of
an entity's triggers of a rule: a trigger counts if at least the cooldown has passed
since the last that counted. One shuffle by entity.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_WINDOW = 300
#: Counted triggers in one list of a cooldown's fold.
COUNTED = 1000
BAD_ACTIONS = ("deny", "drop", "block", "alert")


@dataclass(frozen=True)
class Rule:
    name: str
    incident: str
    window: float
    cooldown: float
    least: int
    severity: str
    tactic: str
    technique: str
    technique_name: str
    enabled: bool = True


RULES = {
    r.name: r
    for r in (
        Rule("PORT_SCAN_SWEEP", "port_scan", 30, 60, 5, "medium", "Discovery", "T1046", "Network Service Discovery"),
        Rule("BRUTE_FORCE_CAMPAIGN", "brute_force", 60, 60, 5, "high", "Credential Access", "T1110", "Brute Force"),
        Rule("CROSS_DEVICE_CAMPAIGN", "cross_device", 120, 90, 2, "high", "Initial Access", "T1190", "Exploit Public-Facing Application"),
        Rule("MALICIOUS_C2_BEACON", "c2_beacon", 180, 120, 2, "critical", "Command and Control", "T1071", "Application Layer Protocol"),
        Rule("HIGH_SEVERITY_MULTI_VECTOR", "multi_vector_exploit", 60, 60, 2, "critical", "Execution", "T1190", "Exploit Attempt"),
    )
}


def configured(overrides: dict[str, dict]) -> dict[str, Rule]:
    """Rules with parameters of a configuration; unknown names fail."""
    unknown = set(overrides) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    return {n: replace(r, **overrides.get(n, {})) for n, r in RULES.items()}


def failed(c=F.col) -> Column:
    raw = F.lower(F.coalesce(c("raw_log"), F.lit("")))
    return (
        F.coalesce(c("event_action").isin(*BAD_ACTIONS), F.lit(False))
        | F.coalesce(c("http_status").isin(401, 403), F.lit(False))
        | F.coalesce((c("event_category") == "authentication") & (c("weak_label") == "attack"), F.lit(False))
        | raw.contains("failed") | raw.contains("failure") | raw.contains("invalid user")
    )


def device_family() -> Column:
    f = F.col("format_name")
    by_format = F.when(f.contains("cisco") | f.contains("paloalto"), "firewall").when(f.contains("snort") | f.contains("suricata") | f.contains("ids"), "ids_ips").when(f.contains("cloudtrail"), "cloud").when(f.contains("windows"), "endpoint").otherwise(f)
    return F.lower(F.coalesce("device_type", by_format))


def suspicious() -> Column:
    no = F.lit(False)
    return F.coalesce(F.col("event_action").isin(*BAD_ACTIONS), no) | F.coalesce(F.col("weak_label") == "attack", no) | F.coalesce("is_malicious", no) | F.col("threat_name").isNotNull()


def severe() -> Column:
    return F.coalesce(F.col("severity") >= 6, F.lit(False)) | F.coalesce(F.lower("severity_label").isin("high", "critical", "emergency"), F.lit(False))


def prepared(events: DataFrame) -> DataFrame:
    """Adds entity, event time and the ordering key; events without entity go."""
    df = events.withColumn("entity", F.coalesce("src_ip", "device_ip")).where("entity is not null")
    df = df.withColumn("__us", F.unix_micros(F.coalesce("timestamp_utc", "ingest_timestamp")) - F.lit(1577836800000000))
    tie = F.row_number().over(Window.partitionBy("entity", "__us").orderBy("ordinal")) - 1
    tie = F.least(tie, F.lit(4095))
    return df.withColumn("__k", F.col("__us") * 4096 + tie)


def look_back(rule: Rule):
    us = int(min(rule.window, MAX_WINDOW) * 1e6)
    return Window.partitionBy("entity").orderBy("__k").rangeBetween(-(us * 4096 + 4095), 0)


def triggers(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows of ``prepared`` at which a rule's condition holds, with what the alert
    needs: uids, target_ip, measure, and (rule dependent) technique."""
    w = look_back(rule)
    tech, tech_name = F.lit(rule.technique), F.lit(rule.technique_name)
    uid = F.col("event_uid")
    all_uids = F.collect_list(uid).over(w)
    given = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    distinct = lambda c: F.array_sort(F.collect_set(c).over(w))
    aim = F.col("dst_ip")
    if rule.name == "PORT_SCAN_SWEEP":
        port = F.when(F.col("dst_port") > 0, F.col("dst_port"))
        measure = F.size(F.collect_set(port).over(w))
        holds, uids = measure >= rule.least, F.collect_list(F.when(port.isNotNull(), uid)).over(w)
        more = {"scanned_ports": distinct(port), "port_count": measure}
    elif rule.name == "BRUTE_FORCE_CAMPAIGN":
        measure = F.sum(failed().cast("int")).over(w)
        holds, uids = measure >= rule.least, F.collect_list(F.when(failed(), uid)).over(w)
        aim, more = F.when(failed(), aim), {"failed_count": measure, "usernames": distinct(F.when(failed(), given("username")))}
    elif rule.name == "CROSS_DEVICE_CAMPAIGN":
        measure = F.size(F.collect_set(device_family()).over(w))
        holds, uids = (measure >= rule.least) & F.max(suspicious()).over(w), all_uids
        more = {"device_types": distinct(device_family()), "event_count": F.count(F.lit(1)).over(w)}
    elif rule.name == "MALICIOUS_C2_BEACON":
        bad = F.coalesce("is_malicious", F.lit(False)) | F.coalesce(F.col("threat_intel_score") >= 0.70, F.lit(False))
        measure = F.sum(bad.cast("int")).over(w)
        holds, uids = measure >= rule.least, F.collect_list(F.when(bad, uid)).over(w)
        score = F.max(F.when(bad, F.coalesce("threat_intel_score", F.lit(0.0)))).over(w)
        aim, more = F.when(bad, aim), {"threat_intel_score": score, "threat_intel_sources": distinct(F.when(bad, given("threat_intel_source"))), "connection_count": measure}
    else:
        measure = F.count(F.lit(1)).over(w)
        holds, uids = F.max(severe()).over(w) & (measure >= rule.least), all_uids
        first = F.first(F.when(severe(), F.struct("threat_name", "mitre_technique_id")), ignorenulls=True).over(w)
        tech, tech_name = F.coalesce(first["mitre_technique_id"], tech), F.coalesce(first["threat_name"], tech_name)
        more = {"threat_name": tech_name, "mitre_technique": tech, "correlated_count": measure}
    cols = {"__holds": holds, "__measure": measure.cast("long"), "__uids": uids, "__targets": distinct(aim), "__more": F.struct(*[v.alias(k) for k, v in more.items()]), "__tech": tech, "__tech_name": tech_name}
    return df.withColumns(cols).where("__holds")


def thinned(found: DataFrame, rule: Rule) -> DataFrame:
    """Triggers that no earlier counted one within the cooldown suppresses.

    A trigger that comes at least the cooldown after the one before it always
    counts, so an entity's triggers fall into runs that are folded apart. A fold
    gets times and places (24 bytes each), of one microsecond only the first; what
    it counts is held in lists of ``COUNTED``, so that its work stays linear.
    """
    us = int(rule.cooldown * 1e6)
    line = Window.partitionBy("entity").orderBy("__us", "__k", "__o")
    gap = F.col("__us") - F.lag("__us").over(line)
    runs = found.select("entity", "__us", "__k", F.col("ordinal").cast("bigint").alias("__o")).withColumn("__gap", gap)
    opens = F.coalesce(F.col("__gap") >= us, F.lit(True)).cast("int")
    runs = runs.withColumn("__run", F.sum(opens).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.where(F.col("__gap").isNull() | (F.col("__gap") > 0) | F.lit(us == 0))

    def step(acc, x):
        one = F.array(F.struct(x["__k"].alias("k"), x["__o"].alias("o")))
        full = F.size(acc["ks"]) >= COUNTED
        counted = F.struct(
            x["__us"].alias("last"), F.when(full, one).otherwise(F.concat(acc["ks"], one)).alias("ks"),
            F.when(full, F.concat(acc["done"], F.array(acc["ks"]))).otherwise(acc["done"]).alias("done"))
        return F.when(acc["last"].isNull() | (x["__us"] - acc["last"] >= us), counted).otherwise(acc)

    place = "array<struct<k:bigint,o:bigint>>"
    start = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast(place).alias("ks"), F.array().cast(f"array<{place}>").alias("done"))
    keep = F.aggregate(F.array_sort(F.collect_list(F.struct("__us", "__k", "__o"))), start, step, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["ks"]))))
    keys = runs.groupBy("entity", "__run").agg(keep.alias("ks")).select("entity", F.explode("ks").alias("__at")).select("entity", F.col("__at.k").alias("__k"), F.col("__at.o").alias("__o"))
    return found.withColumn("__o", F.col("ordinal").cast("bigint")).join(keys, ["entity", "__k", "__o"]).drop("__o")


def alerts(events: DataFrame, names=None, rules: dict[str, Rule] | None = None) -> DataFrame:
    """Alerts of the named rules (all by default). Ids are made of rule, entity and
    key, so a rerun gives the same."""
    df, rules, out = prepared(events), rules or RULES, None
    for name in names or RULES:
        rule = rules[name]
        if not rule.enabled:
            continue
        a = thinned(triggers(df, rule), rule).select(
            F.concat(F.lit("alert-"), F.substring(F.sha2(F.concat_ws("|", F.lit(name), "entity", F.col("__k").cast("string")), 256), 1, 12)).alias("alert_id"),
            F.lit(name).alias("rule_name"), F.lit(rule.incident).alias("incident_type"), F.lit(rule.severity).alias("severity"), F.col("entity").alias("primary_ip"),
            F.get("__targets", F.lit(0)).alias("target_ip"), F.coalesce("timestamp_utc", "ingest_timestamp").alias("timestamp_utc"),
            F.size("__uids").cast("long").alias("event_count"), F.col("__uids").alias("correlated_event_uids"), F.col("__measure").alias("measure"), F.lit(rule.tactic).alias("mitre_tactic"), F.col("__tech").alias("mitre_technique_id"), F.col("__tech_name").alias("mitre_technique_name"),
            F.to_json(F.struct(F.lit(rule.window).alias("window_seconds"), F.col("__targets").alias("target_ips"), F.col("__more.*"))).alias("context"))
        out = a if out is None else out.unionByName(a)
    return out


def history(found: DataFrame, most: int = 500) -> DataFrame:
    """The newest alerts, newest first; ties by id. The ring's size is the feature."""
    return found.orderBy(F.desc("timestamp_utc"), "alert_id").limit(most)


def eps(events: DataFrame, ts: str = "timestamp_utc") -> DataFrame:
    """Events per second, seconds without any filled with 0."""
    per = events.groupBy(F.date_trunc("second", ts).alias("second")).agg(F.count(F.lit(1)).alias("n"))
    # one row a day first, so that the seconds are made in as many tasks
    days = per.agg(F.min("second").alias("lo"), F.max("second").alias("hi")).select("lo", "hi", F.explode(F.sequence(F.date_trunc("day", "lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias("day")).repartition("day")
    last = F.least(F.col("day") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 SECOND"), F.col("hi"))
    span = days.select(F.explode(F.sequence(F.greatest("day", "lo"), last, F.expr("INTERVAL 1 SECOND"))).alias("second"))
    return span.join(per, "second", "left").select("second", F.coalesce("n", F.lit(0)).alias("events"))

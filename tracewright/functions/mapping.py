"""Vendor terms to canonical ones, coercion, validation, technique mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import ACTION, CATEGORY, DEVICE, NO_THREAT_NAMES, SEVERITY, TECHNIQUES, THREAT_ACTIONS, THREAT_LABELS, THREAT_WORDS
from .network import let


CATEGORIES = sorted({*CATEGORY.values(), "unknown"})
ACTIONS = sorted({*ACTION.values(), "unknown"})

IDENTITY = ["event_uid", "record_hash", "raw_log", "format_name", "source_id", "ingest_timestamp"]
TYPES = {
    "string": "timestamp_raw vendor device_type device_hostname device_ip observer_name src_ip dst_ip protocol http_method http_url user_agent username event_category event_action severity_label threat_name threat_signature_id threat_signature_name weak_label evidence_codes src_country src_city src_asn dst_country threat_intel_source mitre_tactic mitre_technique_id mitre_technique_name".split(),
    "int": "src_port dst_port http_status severity".split(),
    "double": "label_confidence threat_intel_score".split(),
    "boolean": "label_conflict is_src_private is_malicious".split(),
    "timestamp": ["timestamp_utc"],
}
CANONICAL = {c: t for t, cs in TYPES.items() for c in cs}


def lookup(value: Column, terms: dict, default) -> Column:
    """A constant map's value of the trimmed, lower-cased text; null stays null."""
    m = F.create_map(*[F.lit(x) for kv in terms.items() for x in kv])
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(m, F.lower(F.trim(value))), F.lit(default)))


def device_type(value: Column) -> Column:
    """A vendor's term for a device to the canonical one; unknown ones are generic."""
    return lookup(value.cast("string"), DEVICE, "generic")


def coerce(name: str, value: Column) -> Column:
    """A text to the type and vocabulary of a canonical field; null stays null."""
    t = F.trim(value.cast("string"))
    if name in ("src_port", "dst_port", "http_status"):
        return t.try_cast("double").try_cast("int")
    if name == "severity":
        return lookup(value.cast("string"), SEVERITY, 0)
    if name == "event_action":
        return lookup(value.cast("string"), ACTION, "unknown")
    if name == "event_category":
        return lookup(value.cast("string"), CATEGORY, "unknown")
    if name == "label_confidence":
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t.try_cast("double")))
    if name == "label_conflict":
        return F.lower(t).isin("true", "1", "yes")
    return F.nullif(t, F.lit(""))


def map_fields(df: DataFrame, field_map: dict[str, str] | None = None, defaults: dict | None = None) -> DataFrame:
    """``fields`` (map of texts) to canonical columns and ``extra_fields``.

    A mapped name goes to its canonical field or, if that is none, to the extra
    fields; canonical names map to themselves; the rest is extra. Identity
    columns always win over fields of their names. Defaults fill what no field
    gave; a field that was there but empty stays null.
    """
    field_map, defaults = field_map or {}, {"event_category": "unknown", "event_action": "unknown", "severity": 0} | (defaults or {})
    got, extra = F.col("fields"), F.coalesce("extra", F.create_map().cast("map<string,string>"))
    sources: dict[str, list[str]] = {}
    for raw, name in field_map.items():
        sources.setdefault(name, []).append(raw)
    cols = {}
    for name, kind in CANONICAL.items():
        own = [r for r in sources.get(name, [])] + ([name] if name not in field_map else [])
        there = F.lit(False)
        value = F.lit(None).cast("string")
        for r in own:
            value = F.coalesce(value, F.try_element_at(got, F.lit(r)))
            there = there | F.map_contains_key(got, r)
        c = coerce(name, value).try_cast(kind)
        if name in defaults:
            c = F.when(there, c).otherwise(F.lit(defaults[name]).cast(kind))
        cols[name] = c
    used = [*field_map, *[c for c in CANONICAL if c not in field_map]]
    renamed = [(r, n) for r, n in field_map.items() if n not in CANONICAL]
    rest = F.map_filter(got, lambda k, v: ~k.isin(*used))
    over = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(n), F.try_element_at(got, F.lit(r))) for r, n in renamed]), lambda e: e["col2"].isNotNull())) if renamed else F.create_map().cast("map<string,string>")
    cols["extra_fields"] = F.map_from_entries(F.map_entries(F.map_concat(rest, over, F.map_filter(extra, lambda k, v: ~F.map_contains_key(rest, k)))))
    return df.withColumns(cols).drop("fields", "extra")


def validation_errors() -> Column:
    """Errors of a canonical event joined by '; '; empty for a valid one."""
    c = F.col
    missing = [F.when(c(n).isNull() | (c(n).cast("string") == ""), f"{n} is required") for n in IDENTITY]
    ports = [F.when(~c(n).between(0, 65535), f"{n} is out of range") for n in ("src_port", "dst_port")]
    shares = [F.when(~c(n).between(0, 1), f"{n} is not in [0, 1]") for n in ("label_confidence", "threat_intel_score")]
    words = [F.when(~c("event_category").isin(*CATEGORIES), "event_category is unknown"), F.when(~c("event_action").isin(*ACTIONS), "event_action is unknown"), F.when(~c("severity").isin(0, 1, 2, 4, 6, 8, 10), "severity is unknown")]
    return F.concat_ws("; ", *missing, F.when(~c("record_hash").rlike("^[0-9a-f]{32}$"), "record_hash is not 32 hexadecimal digits"), *ports, *shares, *words)


def technique(threat_name: Column, event_name: Column, url: Column, raw: Column, action: Column) -> Column:
    """struct(tactic, technique_id, technique_name) or null."""
    empty = F.lit("")
    text = F.concat_ws(" ", *(F.coalesce(x, empty) for x in (threat_name, event_name, url, raw)))

    def s(tactic, tid, name):
        return F.struct(F.lit(tactic).alias("tactic"), F.lit(tid).alias("technique_id"), F.lit(name).alias("technique_name"))

    def of(x: Column) -> Column:
        out = F.when(F.trim(x["text"]) == "", F.lit(None))
        for regex, tactic, tid, name in TECHNIQUES:
            out = out.when(x["text"].rlike("(?i)" + regex), s(tactic, tid, name))
        return out.when(F.lower(F.coalesce(x["action"], empty)).rlike("deny|block|drop"), s(*TECHNIQUES[0][1:]))

    return let(F.struct(text.alias("text"), action.alias("action")), of)


def is_threat() -> Column:
    """The dashboard's threat predicate; severities 1 to 4 count, as it has always been."""
    no, c = F.lit(False), F.col
    tests = [
        F.lower("severity_label").isin(*THREAT_LABELS),
        (c("severity") > 0) & (c("severity") <= 4),
        F.lower("event_action").isin(*THREAT_ACTIONS),
        F.lower("weak_label").isin(*THREAT_WORDS),
        c("is_malicious"), c("mitre_technique_id").isNotNull(), c("threat_intel_score") >= 0.5,
        c("threat_name").isNotNull() & ~F.trim("threat_name").isin(*NO_THREAT_NAMES),
    ]
    out = no
    for t in tests:
        out = out | F.coalesce(t, no)
    return out

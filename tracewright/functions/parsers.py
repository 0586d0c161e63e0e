"""Log formats as Column expressions: recognition and extraction.

Each parser returns struct(success, fields, extra, error) from a line. Fields and
extra are maps of texts without nulls. Python is used for XML alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, StringType, StructField, StructType

from . import fixed_values as V
from .network import let

MAP = "map<string,string>"
XML = StructType([StructField("ok", BooleanType()), StructField("root", StringType()), StructField("flat", MapType(StringType(), StringType())), StructField("data", ArrayType(StructType([StructField("name", StringType()), StructField("value", StringType())])))])


def part(line: Column, regex: str, k: int) -> Column:
    """A group of the first match; null where it is absent or empty."""
    return let(F.regexp_extract(line, regex, k), full)


def full(value: Column) -> Column:
    return F.when(value != "", value)


#: Stands between the groups of a match; a text that holds it is matched group by group.
MARK = "\x1f"


def groups(text: Column, regex: str, n: int) -> Column:
    """The n > 1 groups of the first match, "" for absent ones, by one run of the
    regex; null where nothing matches. A regex that begins with ^ has no
    alternatives without it."""
    before = "" if regex.removeprefix("(?i)").removeprefix("(?s)").startswith("^") else r"^[\s\S]*?"
    whole = rf"{before}(?:{regex})[\s\S]*$"

    def of(t: Column) -> Column:
        once = let(F.split(F.regexp_replace(t, whole, MARK.join(f"${k}" for k in range(1, n + 1))), MARK, -1), lambda a: F.when(F.size(a) == n, a))
        each = F.when(t.rlike(regex), F.array(*[F.regexp_extract(t, regex, k) for k in range(1, n + 1)]))
        return F.when(t.contains(MARK), each).otherwise(once)

    return let(text, of)


def group(found: Column, k: int) -> Column:
    """Group k of :func:`groups`; null where it is absent or empty."""
    return full(F.get(found, F.lit(k - 1)))


def pairs(**cols) -> Column:
    return compact(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in cols.items()]))


def compact(entries: Column) -> Column:
    """Map of (key, value) entries without nulls; of equal keys the last counts,
    by the session's mapKeyDedupPolicy (see :func:`last_wins`)."""
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull() & e["key"].isNotNull()))


def merged(*maps: Column) -> Column:
    return F.map_concat(*maps)


def last_wins(spark) -> None:
    """What all parsers need of the session: later values of a key replace earlier ones."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def const(**kv) -> Column:
    return pairs(**{k: F.lit(v) for k, v in kv.items()})


def pick(value: Column, table: dict, default=None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, value), default if isinstance(default, Column) else F.lit(default))


def result(ok: Column, fields: Column, extra: Column | None, error: str) -> Column:
    none = F.create_map().cast(MAP)
    extra = none if extra is None else extra
    return F.struct(ok.alias("success"), F.when(ok, fields).otherwise(none).alias("fields"), F.when(ok, extra).otherwise(none).alias("extra"), F.when(~ok, F.lit(error)).alias("error"))


def routed(entries: Column, names: dict[str, str]) -> tuple[Column, Column]:
    """Entries with known keys renamed, and the others."""
    keys = F.array(*map(F.lit, names))
    known = F.transform(F.filter(entries, lambda e: F.array_contains(keys, e["key"])), lambda e: F.struct(pick(e["key"], names).alias("key"), e["value"].alias("value")))
    return compact(known), compact(F.filter(entries, lambda e: ~F.array_contains(keys, e["key"])))


# Cisco ASA ---------------------------------------------------------------
ASA = r"(?is)%ASA-(\d+)-(\d+):\s*(.*)"
ASA_LEVEL = {str(k): level for k, level in enumerate(V.SYSLOG_LEVELS)}
ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"


def cisco_asa(line: Column) -> Column:
    at = lambda a, k: F.get(a, F.lit(k))

    def of(x: Column) -> Column:
        level, msg, body, found, ports, bare = (x[n] for n in ("level", "msg", "body", "full", "ports", "bare"))
        none = F.size(found) == 0
        action = F.when(body.rlike("(?i)" + V.ASA_DENY), "deny").when(body.rlike("(?i)" + V.ASA_ALLOW), "allow").otherwise("unknown")
        fields = merged(
            const(vendor="cisco", device_type="firewall", event_category="network"),
            pairs(threat_signature_id=msg, threat_name=pick(F.substring(msg, 1, 3), V.ASA_NAMES, F.concat(F.lit("ASA Message "), msg)), severity=pick(level, ASA_LEVEL, "unknown"), severity_label=level, event_action=action,
                  protocol=F.lower(part(body, r"(?i)\b(tcp|udp|icmp|gre|esp|ah)\b", 1)), src_ip=F.when(none, at(bare, 0)).otherwise(at(found, 0)), src_port=at(ports, 0), dst_ip=F.when(none, at(bare, 1)).otherwise(at(found, 1)), dst_port=at(ports, 1)))
        return result(x["ok"], fields, pairs(asa_body=body, asa_msg_id=msg), "no %ASA marker")

    def parts(y: Column) -> Column:
        g, body, all_ = y["g"], y["body"], lambda regex: F.regexp_extract_all(y["body"], F.lit(regex), F.lit(1))
        return let(F.struct(y["ok"].alias("ok"), group(g, 1).alias("level"), group(g, 2).alias("msg"), body.alias("body"), all_(rf"\w+:({ADDRESS})/\d+").alias("full"), all_(rf"\w+:{ADDRESS}/(\d+)").alias("ports"), all_(rf"\w+:({ADDRESS})").alias("bare")), of)

    s = F.trim(line)
    return let(groups(s, ASA, 3), lambda g: let(F.struct(F.when(line.isNotNull(), g.isNotNull()).alias("ok"), g.alias("g"), F.trim(F.get(g, F.lit(2))).alias("body")), parts))


# Palo Alto ---------------------------------------------------------------
def csv_fields(line: Column) -> Column:
    """Comma-separated values of a line, quoted ones unquoted."""
    cells = F.regexp_extract_all(line, F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda x: F.when(x.rlike('^".*"$'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))


def _pan(f: Column, kind: str, nulls: list[str]):
    def get(k):
        v = F.trim(F.get(f, F.lit(k)))
        return F.when((v != "") & ~v.isin(*nulls), v)

    return get, (F.size(f) >= 30) & (F.upper(F.trim(F.get(f, F.lit(3)))) == kind)


def paloalto_traffic(line: Column) -> Column:
    return let(csv_fields(F.trim(line)), _traffic)


def paloalto_threat(line: Column) -> Column:
    return let(csv_fields(F.trim(line)), _threat)


def _traffic(f: Column) -> Column:
    get, ok = _pan(f, "TRAFFIC", ["0.0.0.0", "0"])
    sub = F.lower(F.trim(F.get(f, F.lit(4))))
    action = F.coalesce(pick(F.lower(get(30)), V.PAN_ACTION), pick(sub, V.PAN_SUBTYPE, "unknown"))
    fields = merged(const(vendor="palo_alto", device_type="firewall", event_category="network", severity="informational"), pairs(timestamp_raw=get(1), src_ip=get(7), dst_ip=get(8), src_port=get(24), dst_port=get(25), protocol=F.lower(get(29)), event_action=action, username=get(12)))
    extra = pairs(serial=get(2), log_type=F.lit("TRAFFIC"), subtype=sub, rule_name=get(11), application=get(14), src_zone=get(16), dst_zone=get(17), bytes_sent=get(38), bytes_received=get(39), packets=get(40))
    return result(ok, fields, extra, "no TRAFFIC line of 30 fields")


def _threat(f: Column) -> Column:
    get, ok = _pan(f, "THREAT", ["0.0.0.0", "0", "any", "unknown"])
    sev = F.lower(F.coalesce(get(60), F.lit("")))
    level = pick(sev, V.PAN_SEVERITY, "medium")
    fields = merged(const(vendor="palo_alto", device_type="ids_ips", event_category="threat"), pairs(timestamp_raw=get(1), src_ip=get(7), dst_ip=get(8), src_port=get(24), dst_port=get(25), protocol=F.lower(get(29)), event_action=pick(F.lower(get(30)), V.PAN_ACTION, "alert"), username=get(12), threat_signature_id=get(58), threat_name=get(59), severity=level, severity_label=sev))
    return result(ok, fields, pairs(serial=get(2), log_type=F.lit("THREAT"), rule_name=get(11), application=get(14), src_zone=get(16), dst_zone=get(17)), "no THREAT line of 30 fields")


# CEF and LEEF ------------------------------------------------------------


def cef(line: Column) -> Column:
    def of(g: Column) -> Column:
        at = lambda k: F.get(g, F.lit(k - 1))
        head = pairs(cef_version=at(1), vendor=at(2), device_product=at(3), device_version=at(4), threat_signature_id=at(5), threat_name=at(6), severity=F.trim(at(7)), severity_label=F.trim(at(7)))

        def entries(ext: Column) -> Column:
            keys, values = F.regexp_extract_all(ext, F.lit(V.CEF_PAIR), F.lit(1)), F.regexp_extract_all(ext, F.lit(V.CEF_PAIR), F.lit(2))
            return F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), F.trim(v).alias("value")))

        def body(e: Column) -> Column:
            known, other = routed(e, V.CEF_KEYS)
            return result(F.when(line.isNotNull(), g.isNotNull()), merged(head, known), other, "no CEF header")

        return let(let(at(8), entries), body)

    return let(groups(F.trim(line), V.CEF_LINE, 8), of)


def leef(line: Column) -> Column:
    def of(g: Column) -> Column:
        at = lambda k: F.get(g, F.lit(k - 1))
        raw = F.trim(at(6))
        hexa = F.conv(F.regexp_extract(raw, r"^0[xX]([0-9A-Fa-f]+)$", 1), 16, 10).try_cast("int")
        mark = let(hexa, lambda n: F.when(raw == "", "\t").when(n.isNotNull(), F.char(n)).when(raw.rlike("^0[xX]"), "\t").otherwise(pick(raw, {"\\t": "\t", "\\n": "\n", "\\r": "\r", "\\|": "|"}, raw)))
        attrs = F.filter(F.split(at(7), F.concat(F.lit("\\Q"), mark, F.lit("\\E")), -1), lambda x: x.contains("="))
        entries = F.transform(attrs, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("key"), F.trim(F.substring(x, F.instr(x, F.lit("=")) + 1, F.length(x))).alias("value")))
        head = pairs(leef_version=at(1), vendor=at(2), device_product=at(3), device_version=at(4), threat_signature_id=at(5))

        def body(e: Column) -> Column:
            known, other = routed(e, V.LEEF_KEYS)
            return result(F.when(line.isNotNull(), g.isNotNull()), merged(head, known), other, "no LEEF header")

        return let(entries, body)

    return let(groups(F.trim(line), V.LEEF_LINE, 7), of)


# Snort -------------------------------------------------------------------


def snort_alert(line: Column) -> Column:
    """A line with the marker alone still succeeds, with what can be found."""

    def of(x: Column) -> Column:
        s, g = x["s"], lambda k: group(x["g"], k)
        base = const(event_category="threat", vendor="snort_suricata", device_type="ids_ips")
        whole = merged(base, pairs(timestamp_raw=g(1), action=F.lower(F.trim(F.coalesce(g(2), F.lit("alert")))), threat_signature_id=g(3), threat_name=F.trim(g(4)), classification=g(5), priority=F.coalesce(g(6), F.lit("")), severity=pick(g(6), V.SNORT_PRIORITY, "unknown"), severity_label=F.concat(F.lit("Priority "), g(6)), protocol=F.lower(g(7)), src_ip=g(8), src_port=g(9), dst_ip=g(10), dst_port=g(11)))
        some = merged(base, pairs(raw_message=s, threat_signature_id=part(s, r"\[(\d+:\d+:\d+)\]", 1), threat_name=F.trim(part(s, r"\[\*\*\]\s+(?:\[\d+:\d+:\d+\]\s+)?([^\[]+?)\s+\[\*\*\]", 1))))
        return result(s.contains("[**]"), F.when(x["g"].isNotNull(), whole).otherwise(some), None, "no alert marker")

    return let(F.trim(line), lambda s: let(F.struct(s.alias("s"), groups(s, V.SNORT_LINE, 11).alias("g")), of))


# syslog ------------------------------------------------------------------
NET = rf"(?i)(?:src|source|from)[=:\s]+([\d.]+)(?:[:/](\d+))?|(?:dst|dest|destination|to)[=:\s]+([\d.]+)(?:[:/](\d+))?|((?<!\d){ADDRESS}(?!\d))"


def _network(text: Column) -> Column:
    def of(each: Column) -> Column:
        some = lambda k: F.filter(F.transform(each, lambda g: group(g, k)), lambda v: v.isNotNull())
        last = lambda k: F.try_element_at(some(k), F.lit(-1))
        return let(some(5), lambda lone: pairs(src_ip=F.coalesce(last(1), F.get(lone, F.lit(0))), src_port=last(2), dst_ip=F.coalesce(last(3), F.get(lone, F.lit(1))), dst_port=last(4)))

    return let(F.transform(F.regexp_extract_all(text, F.lit(NET), F.lit(0)), lambda m: groups(m, NET, 5)), of)


def _key_values(text: Column) -> Column:
    def entry(m: Column) -> Column:
        word, value = F.lower(F.substring_index(m, "=", 1)), F.substring(m, F.instr(m, F.lit("=")) + 1, F.length(m))
        bare = lambda v: F.when(F.substring(v, 1, 1).isin("'", '"'), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)
        return F.struct(let(word, lambda w: pick(w, V.SYSLOG_KEYS, w)).alias("key"), let(value, bare).alias("value"))

    return compact(F.transform(F.regexp_extract_all(text, F.lit(V.SYSLOG_PAIR), F.lit(0)), entry))


def syslog(line: Column) -> Column:
    """Later sources of a field win: header, key=value, addresses, action word."""

    def of(x: Column) -> Column:
        s, pri, g5, g3, gy = (x[n] for n in ("s", "pri", "g5", "g3", "gy"))
        is5, is3, is3y = g5.isNotNull(), g3.isNotNull(), gy.isNotNull()
        code = pri.bitwiseAND(7)
        level, score = F.get(F.array(*map(F.lit, V.SYSLOG_LEVELS)), code), F.get(F.array(*map(F.lit, V.SYSLOG_SCORES)), code)
        head = pairs(priority=pri, facility=F.shiftright(pri, 3), syslog_severity=level, severity=score, severity_label=level)

        def old(g):
            tag, msg = F.coalesce(group(g, 4), F.lit("")), F.trim(F.get(g, F.lit(4)))
            both = F.concat(tag, F.lit(": "), msg)
            return pairs(timestamp_raw=group(g, 2), device_hostname=group(g, 3), tag=tag, message=F.regexp_replace(both, "^[: ]+|[: ]+$", "")), F.concat_ws(" ", tag, msg)

        m5 = F.trim(F.get(g5, F.lit(7)))
        f5 = pairs(timestamp_raw=group(g5, 3), device_hostname=group(g5, 4), app_name=group(g5, 5), message=m5)
        (f3, t3), (fy, ty) = old(g3), old(gy)
        own = F.when(is5, f5).when(is3, f3).when(is3y, fy).otherwise(pairs(message=s))
        text = F.when(is5, m5).when(is3, t3).when(is3y, ty).otherwise(s)
        found = let(text, lambda t: merged(_key_values(t), _network(t), pairs(event_action=F.lower(part(t, "(?i)" + V.SYSLOG_ACTIONS, 1)))))
        return result(s.startswith("<"), merged(head, own, found), None, "no syslog line")

    return let(F.trim(line), lambda s: let(F.struct(s.alias("s"), part(s, r"^<(\d{1,3})>", 1).try_cast("int").alias("pri"), groups(s, V.SYSLOG_5424, 8).alias("g5"), groups(s, V.SYSLOG_3164, 5).alias("g3"), groups(s, V.SYSLOG_3164_YEAR, 5).alias("gy")), of))


# JSON --------------------------------------------------------------------
def json_object(line: Column) -> Column:
    def of(x: Column) -> Column:
        s, all_ = x["s"], x["all"]
        nested = lambda k, v: v.startswith("{")
        ok = s.startswith("{") & s.endswith("}") & all_.isNotNull() & F.try_parse_json(s).isNotNull()
        some = F.map_filter(all_, lambda k, v: v.isNotNull())
        return result(ok, F.map_filter(some, lambda k, v: ~nested(k, v)), F.map_filter(some, nested), "no JSON object")

    return let(F.trim(line), lambda s: let(F.struct(s.alias("s"), F.from_json(s, MAP).alias("all")), of))


CJ = "event_category sub_key timestamp src_ip src_port user_agent language metadata".split()


def cj_json_array(line: Column) -> Column:
    def of(x: Column) -> Column:
        s, a = x["s"], x["a"]
        ok = s.startswith("[") & F.try_parse_json(s).isNotNull() & (F.size(a) == len(CJ))
        return result(F.coalesce(ok, F.lit(False)), pairs(**{n: F.get(a, F.lit(k)) for k, n in enumerate(CJ)}), None, "no array of 8 values")

    return let(F.trim(line), lambda s: let(F.struct(s.alias("s"), F.from_json(s, "array<string>").alias("a")), of))


TRAIL = "struct<eventName string, eventSource string, eventTime string, eventID string, eventType string, awsRegion string, sourceIPAddress string, userAgent string, errorCode string, errorMessage string, requestParameters string, userIdentity struct<userName string, principalId string, arn string, accountId string, type string>>"


def aws_cloudtrail(line: Column) -> Column:
    """The first record of a line: of a wrapper, an array, or an object itself."""

    def of(x: Column) -> Column:
        r, who_ = x["r"], x["r"]["userIdentity"]
        name, source, err = F.coalesce(r["eventName"], F.lit("")), F.coalesce(r["eventSource"], F.lit("")), full(r["errorCode"])
        who = F.coalesce(full(who_["userName"]), full(who_["principalId"]), full(F.substring_index(who_["arn"], "/", -1)))
        ip = full(r["sourceIPAddress"])
        level = F.when(err.isin(*V.TRAIL_HIGH_ERRORS) | name.rlike(f"^(?:{'|'.join(V.TRAIL_HIGH)})"), "high").when(name.rlike(f"^(?:{'|'.join(V.TRAIL_MEDIUM)})"), "medium").otherwise("informational")
        category = F.when(source.rlike("iam|sts|cognito"), "authentication").when(err.isin(*V.TRAIL_THREAT_ERRORS), "threat").otherwise("network")
        fields = merged(const(vendor="amazon_aws", device_type="generic"), pairs(timestamp_raw=r["eventTime"], src_ip=F.when(~ip.startswith("AWS"), ip), user_agent=full(r["userAgent"]), username=who, threat_signature_id=name, threat_name=F.concat(F.lit("AWS:"), name), event_action=F.when(err.isNull(), "allow").otherwise(pick(err, V.TRAIL_ERRORS, "alert")), event_category=category, severity=level, severity_label=F.coalesce(err, F.lit("success"))))
        extra = pairs(event_id_cloudtrail=r["eventID"], event_source=source, aws_region=r["awsRegion"], account_id=who_["accountId"], identity_type=who_["type"], event_type=r["eventType"], error_code=err, error_message=full(r["errorMessage"]), request_parameters=r["requestParameters"])
        return result(x["ok"], fields, extra, "no CloudTrail record")

    def record(y: Column) -> Column:
        ok = F.try_parse_json(y["s"]).isNotNull() & F.coalesce(y["rec"].startswith("{"), F.lit(False))
        return let(F.struct(ok.alias("ok"), F.from_json(y["rec"], TRAIL).alias("r")), of)

    # "$" writes an object as the paths do, so that nested texts are the same for all three
    first = lambda s: F.coalesce(F.get_json_object(s, "$.Records[0]"), F.when(s.startswith("["), F.get_json_object(s, "$[0]")), F.when(~s.rlike(r'"Records"\s*:'), F.get_json_object(s, "$")))
    return let(F.trim(line), lambda s: let(F.struct(s.alias("s"), first(s).alias("rec")), record))


def csv_row(line: Column, header: list[str]) -> Column:
    """A data line under the header of its file; widths must agree."""
    return let(csv_fields(F.trim(line)), lambda f: result(F.size(f) == len(header), pairs(**{h.strip(): F.nullif(F.trim(F.get(f, F.lit(k))), F.lit("")) for k, h in enumerate(header)}), None, "column count mismatch"))


# XML ---------------------------------------------------------------------
@F.pandas_udf(XML)
def parse_xml(lines):
    """Tag paths and attributes to texts, and named Data elements; Arrow batches."""
    import xml.etree.ElementTree as ET

    import pandas as pd

    def bare(tag):
        return tag.rpartition("}")[2]

    def walk(e, prefix, out):
        for k, v in e.attrib.items():
            out[(prefix + bare(k)).lower()] = v.strip()
        if e.text and e.text.strip():
            # the root's text goes by its tag, others by path and tag
            out[(prefix + bare(e.tag)).lower()] = e.text.strip()
        for c in e:
            walk(c, f"{prefix}{bare(c.tag)}_", out)
        return out

    rows = []
    for line in lines:
        try:
            root = ET.fromstring(line.strip())
        except (ET.ParseError, AttributeError):
            rows.append((False, None, {}, []))
            continue
        data = [{"name": d.get("Name") or d.get("name") or "", "value": (d.text or "").strip()} for d in root.iter() if bare(d.tag) == "Data"]
        rows.append((True, bare(root.tag), walk(root, "", {}), data))
    return pd.DataFrame(rows, columns=["ok", "root", "flat", "data"])


def xml_generic(line: Column) -> Column:
    x = parse_xml(line)
    entries = F.transform(F.map_entries(x["flat"]), lambda e: F.struct(F.regexp_replace(e["key"], "[- ]", "_").alias("key"), e["value"].alias("value")))
    known, other = routed(entries, V.XML_KEYS)
    base = const(event_category="unknown", event_action="unknown", severity="informational", device_type="generic")
    return result(F.coalesce(x["ok"], F.lit(False)), merged(base, known), merged(other, pairs(xml_root_tag=x["root"])), "XML does not parse")


def windows_event_xml(line: Column) -> Column:
    x = parse_xml(line)
    g = lambda k: F.nullif(F.try_element_at(x["flat"], F.lit(k)), F.lit(""))
    eid = F.coalesce(g("system_eventid_eventid"), g("system_eventid"), g("system_eventid_eventid"))
    data = F.filter(x["data"], lambda d: ~d["value"].isin("", "-"))
    last = lambda names, drop=(): F.try_element_at(F.transform(F.filter(data, lambda d: F.lower(d["name"]).isin(*names) & ~d["value"].isin("-", *drop)), lambda d: d["value"]), F.lit(-1))
    named = ("targetusername", "subjectusername", "accountname", "ipaddress", "sourceaddress", "workstationname", "ipport", "sourceport")
    extra = compact(F.transform(F.filter(data, lambda d: ~F.lower(d["name"]).isin(*named)), lambda d: F.struct(d["name"].alias("key"), d["value"].alias("value"))))
    fields = merged(const(device_type="endpoint", event_category="authentication"), pairs(
        threat_signature_id=eid, threat_name=pick(eid, V.WINDOWS_NAMES, F.concat(F.lit("EventID "), F.coalesce(eid, F.lit("None")))), event_action=pick(eid, V.WINDOWS_ACTION, "unknown"), severity=pick(eid, V.WINDOWS_SEVERITY, "informational"),
        timestamp_raw=g("system_timecreated_systemtime"), device_hostname=g("system_computer_computer"), log_channel=g("system_channel_channel"), event_level=g("system_level_level"), vendor=g("system_provider_name"),
        username=last(named[:3]), src_ip=last(named[3:6], ("::1", "127.0.0.1")), src_port=last(named[6:]), process_name=last(("newprocessname",)), command_line=last(("commandline",))))
    has = F.exists(F.map_keys(x["flat"]), lambda k: k.startswith("system_"))
    return result(F.coalesce(x["ok"] & has, F.lit(False)), fields, extra, "no Windows event")


# detection ---------------------------------------------------------------
def _json_like(s):
    return F.try_parse_json(s).isNotNull()


def recognisers(line: Column) -> dict[str, Column]:
    """Format → whether a line looks like it, in the order of detection."""
    s = F.trim(line)
    pan = lambda kind: F.upper(F.trim(F.get(F.split(s, ",", 6), F.lit(3)))) == kind
    pri = part(s, r"^<(\d{1,4})>", 1).try_cast("int")
    marked = s.startswith("<") | s.contains("CEF:") | s.startswith("LEEF:") | s.startswith("{") | s.startswith("[") | s.contains("[**]")
    commas, tabs = F.length(s) - F.length(F.replace(s, F.lit(","))), F.length(s) - F.length(F.replace(s, F.lit("\t")))
    trail = (s.startswith("{") & (s.rlike(r'"Records"\s*:') | (F.get_json_object(s, "$.eventName").isNotNull() & F.get_json_object(s, "$.eventSource").isNotNull()))) | (s.startswith("[") & F.get_json_object(s, "$[0].eventName").isNotNull())
    out = {
        "cisco_asa": s.rlike(r"(?i)%ASA-\d+-\d+:"),
        "paloalto_traffic": pan("TRAFFIC"),
        "paloalto_threat": pan("THREAT"),
        "windows_event_xml": s.rlike(r'(?i)<Event\b|xmlns="http://schemas\.microsoft\.com/win/2004/08/events'),
        "aws_cloudtrail": trail & _json_like(s),
        "cef": s.contains("CEF:"),
        "leef": s.startswith("LEEF:"),
        "snort_alert": s.contains("[**]"),
        "syslog": pri.between(0, 191),
        "cj_json_array": s.startswith("[") & _json_like(s) & (F.size(F.from_json(s, "array<string>")) == 8),
        "json": s.startswith("{") & s.endswith("}"),
        "csv": ~marked & ((commas >= 3) | (tabs >= 3)),
        "xml_generic": s.startswith("<") & s.rlike(r"(?s)^<\??[A-Za-z].*>$"),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}


def detect(line: Column) -> Column:
    """The first format that recognises a line; null if none does."""
    out = None
    for name, test in recognisers(line).items():
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


PARSERS = {"cisco_asa": cisco_asa, "paloalto_traffic": paloalto_traffic, "paloalto_threat": paloalto_threat, "windows_event_xml": windows_event_xml, "aws_cloudtrail": aws_cloudtrail, "cef": cef, "leef": leef, "snort_alert": snort_alert, "syslog": syslog, "cj_json_array": cj_json_array, "json": json_object, "xml_generic": xml_generic}


def register(name: str, parser, replace: bool = False) -> None:
    """Adds a parser of one's own: a function from a line to ``result(...)``."""
    if name in PARSERS and not replace:
        raise ValueError(f"{name} is registered")
    PARSERS[name] = parser


def parse(line: Column, name: str) -> Column:
    """An unknown format gives a failed result, as a line that does not match does."""
    if name not in PARSERS:
        return result(F.lit(False), F.create_map().cast(MAP), None, f"unknown format {name}")
    return PARSERS[name](line)

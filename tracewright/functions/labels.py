"""Weak-label evidence and decisions as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import BROWSERS, PAYLOADS, SCANNERS

LABEL_VERSION = "weak-label-v1"
CODES = [
    ("declared_scanner", "UA_DECLARED_SCANNER"),
    ("browser_style", "UA_BROWSER_STYLE"),
    ("missing_user_agent", "UA_MISSING"),
    ("payload_shell", "PAYLOAD_SHELL"),
    ("payload_traversal", "PAYLOAD_PATH_TRAVERSAL"),
    ("payload_sqli", "PAYLOAD_SQLI"),
    ("payload_xss", "PAYLOAD_XSS"),
]
NO_EVIDENCE = "NO_MATCHING_EVIDENCE"


def payload_text() -> Column:
    return F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("category_type", "sub_key", "language", "metadata")))


def evidence() -> dict[str, Column]:
    """Mask name → Column over user_agent, category_type, sub_key, language, metadata."""
    ua, text = F.coalesce("user_agent", F.lit("")), payload_text()
    low = F.lower(ua)

    def either(cols):
        out = F.lit(False)
        for c in cols:
            out = out | c
        return out

    masks = {
        "declared_scanner": either([low.contains(s) for s in SCANNERS]),
        "browser_style": either([ua.startswith(b) for b in BROWSERS]),
        "missing_user_agent": ua == "",
    } | {k: text.rlike("(?i)" + p) for k, p in PAYLOADS.items()}
    return masks | {"payload_attack_pattern": either([masks[k] for k in PAYLOADS])}


def codes(masks: dict[str, Column]) -> Column:
    joined = F.concat_ws("|", *(F.when(masks[m], F.lit(code)) for m, code in CODES))
    return F.when(joined == "", F.lit(NO_EVIDENCE)).otherwise(joined)


def label_columns() -> dict[str, Column]:
    """weak_label, label_confidence, evidence_codes, evidence_count, label_conflict, label_version."""
    m = evidence()
    scan, pay, browse = m["declared_scanner"], m["payload_attack_pattern"], m["browser_style"]
    attack = scan | pay
    count = F.lit(0)
    for name, _ in CODES:
        count = count + m[name].cast("int")
    return {
        "weak_label": F.when(attack, "attack").when(browse, "benign").otherwise("uncertain"),
        "label_confidence": F.when(scan & pay, 0.99).when(pay, 0.95).when(scan, 0.85).when(browse, 0.55).otherwise(0.0),
        "evidence_codes": codes(m),
        "evidence_count": count.cast("tinyint"),
        "label_conflict": browse & attack,
        "label_version": F.lit(LABEL_VERSION),
    }

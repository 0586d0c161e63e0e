"""IPv4 arithmetic, address classes, geography and threat lists as Columns."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .fixed_values import NETWORKS, REGIONS, THREAT_NETS, THREATS

OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = "^" + r"\.".join([OCTET] * 4) + "$"
IPV6 = r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*$"

#: Not globally reachable, as Python's ipaddress has it; 192.0.0.9 and .10 are.
INTERNAL = "0.0.0.0/8 10.0.0.0/8 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.0.0/24 192.0.0.170/31 192.0.2.0/24 192.168.0.0/16 198.18.0.0/15 198.51.100.0/24 203.0.113.0/24 240.0.0.0/4".split()
MALICIOUS = 0.65


def bounds(cidr: str) -> tuple[int, int]:
    net = ipaddress.ip_network(cidr, strict=False)
    return int(net.network_address), int(net.broadcast_address)


def bare(ip: Column) -> Column:
    """Trimmed, without the port of an ``ip:port``."""
    ip = F.trim(ip)
    return F.when(ip.rlike(r"^[^:\[]*:\d+$"), F.split_part(ip, F.lit(":"), F.lit(1))).otherwise(ip)


def ipv4(ip: Column) -> Column:
    """The address as a number; null if it is no IPv4 address."""
    parts = F.split(ip, r"\.")
    n = F.lit(0).cast("long")
    for k in range(4):
        n = n * 256 + parts.getItem(k).try_cast("long")
    return F.when(ip.rlike(IPV4), n)


def ip_version(ip: Column) -> Column:
    ip = F.trim(ip)
    return F.when(ip.rlike(IPV4), 4).when(canonical_ipv6(ip).isNotNull(), 6)


@F.udf(StringType())
def _ipv6(ip):
    try:
        return str(ipaddress.IPv6Address(ip))
    except ValueError:
        return None


def canonical_ipv6(ip: Column) -> Column:
    """RFC 5952 form by Python, only for what looks like IPv6."""
    return F.when(ip.rlike(IPV6), _ipv6(F.when(ip.rlike(IPV6), ip)))


def canonical_ip(ip: Column) -> Column:
    ip = F.trim(ip)
    return F.when(ip.rlike(IPV4), ip).otherwise(canonical_ipv6(ip))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; long bodies stay out of the
    generated code, which has a size limit."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def within(n: Column, cidr: str) -> Column:
    lo, hi = bounds(cidr)
    return n.between(lo, hi)


def internal(n: Column) -> Column:
    out = F.lit(False)
    for c in INTERNAL:
        out = out | within(n, c)
    return out & ~n.isin(bounds("192.0.0.9/32")[0], bounds("192.0.0.10/32")[0])


def geo(ip: Column) -> Column:
    """struct(country, city, asn, is_private): networks in their order, internal
    ranges, regions by first octet, else global; invalid addresses give nulls."""

    def place(country, city, asn, private):
        return F.struct(F.lit(country).alias("country"), F.lit(city).alias("city"), F.lit(asn).alias("asn"), F.lit(private).alias("is_private"))

    def of(n: Column) -> Column:
        nothing = F.struct(*(F.lit(None).cast("string").alias(x) for x in ("country", "city", "asn")), F.lit(False).alias("is_private"))
        out = F.when(n.isNull(), nothing)
        for cidr, country, city, asn in NETWORKS:
            out = out.when(within(n, cidr), place(country, city, asn, False))
        out = out.when(internal(n), place("INTERNAL", "Private Network", "RFC1918 Private", True))
        first = F.shiftright(n, 24)
        for country, city, asn, octets in REGIONS:
            out = out.when(first.isin(*octets), place(country, city, asn, False))
        return out.otherwise(place("GLOBAL", "Public WAN", "AS-Public Internet", False))

    return let(ipv4(bare(ip)), of)


def threat(ip: Column, ips: dict = THREATS, nets: list = THREAT_NETS, threshold: float = MALICIOUS) -> Column:
    """struct(score, source, is_malicious); exact addresses before networks."""

    def hit(score, source):
        return F.struct(F.lit(float(score)).alias("score"), F.lit(source).cast("string").alias("source"), F.lit(score >= threshold).alias("is_malicious"))

    def of(x: Column) -> Column:
        out = F.when(x["plain"].isNull(), hit(0.0, None))
        for address, (source, score) in ips.items():
            out = out.when(x["plain"] == address, hit(score, source))
        for cidr, source, score in nets:
            out = out.when(within(x["n"], cidr), hit(score, source))
        return out.otherwise(hit(0.0, None))

    return let(F.struct(bare(ip).alias("plain"), ipv4(bare(ip)).alias("n")), of)


def read_blocklist(path: str, feed: str, score: float = 0.9) -> tuple[dict, list, int]:
    """A text file of addresses and networks: (ips, nets, count)."""
    ips, nets = {}, []
    for line in open(path, encoding="utf-8", errors="replace"):
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        if "/" in line:
            try:
                bounds(line)
            except ValueError:
                continue
            nets.append((line, feed, score))
        else:
            ips[line] = (feed, score)
    return ips, nets, len(ips) + len(nets)


def ip_class(ip: Column) -> Column:
    def of(n: Column) -> Column:
        return F.when(n.isNull(), "invalid").when(within(n, "127.0.0.0/8"), "loopback").when(internal(n), "private").when(within(n, "224.0.0.0/4"), "other").otherwise("public")

    return let(ipv4(F.trim(ip)), of)

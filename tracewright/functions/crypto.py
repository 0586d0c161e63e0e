"""Hashes and keyed pseudonyms without Python on the executors."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hmac_sha256(value: Column, key: bytes) -> Column:
    """HMAC-SHA-256 in hexadecimal; the pads are literals."""
    import hashlib

    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner = F.sha2(F.concat(F.lit(bytes(b ^ 0x36 for b in key)), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(bytes(b ^ 0x5C for b in key)), F.unhex(inner)), 256)


def client_key(ip: Column, key: bytes) -> Column:
    return F.concat(F.lit("client_"), F.substring(hmac_sha256(ip, key), 1, 24))


def record_hash(raw: Column) -> Column:
    return F.substring(F.sha2(F.encode(raw, "UTF-8"), 256), 1, 32)


def display_ip(ip: Column) -> Column:
    return F.concat(F.lit("IP-"), F.substring(F.sha2(F.encode(ip, "UTF-8"), 256), 1, 12))

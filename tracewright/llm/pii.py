"""Personal data to surrogates, with DataFrame functions only.

Detected: e-mail addresses, phone numbers, payment cards, social security
numbers, IBANs, IPv4 and IPv6 addresses, access keys, secrets after a name
("token = …", "AWS_SECRET_ACCESS_KEY=…", '"Password": "…"', in any case and
within any identifier) and persons after a title. Each is replaced by a surrogate
of its kind, made from SHA-256 of a secret key, the kind and the entity's normal
form (so any spelling of a number gets the same digits: coreference), that keeps
its format: digits for digits, letters for letters in their case, hexadecimal for
hexadecimal, separators where they were; cards keep their issuer's digit and the
validity of their check digit, IBANs their country and the validity of theirs,
access keys their prefix, phones their country code; private addresses stay
private and public ones public.

A secret whose value is an access key, a card or the like is that entity, with a
name before it or without. A secret has 8 characters or more; marks like . ! @ #
$ belong to it only if it has a digit too.

Names are replaced token by token: the last token after a title is a surname,
those before are given names of the title's gender (after a neutral title, one
that ends in "a" counts as female), in the script of the original. So "Mr Smith"
keeps the surname that "Mr John Smith" got, everywhere. Where a text has a title
before a name of several tokens, that name is replaced in the rest of the text
without a title too.

Distinct entities must stay distinct. Before anything is replaced, the distinct
normal forms of the corpus (for names: of each token) are gathered and their
surrogates compared with each other and with the real ones; those that collide
are drawn anew with a nonce until none does. Only the nonces that are not 0 are
kept; where there are some, they come back by a join of texts' hashes, whose
smaller side Spark broadcasts only below its threshold.

The secret key is the session's ``spark.tracewright.pii.key``; where that is
unset a fixed one, known to all, is used, which only tests should do.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import renamed, staged, table

KEY_SETTING, KNOWN_KEY = "spark.tracewright.pii.key", "tracewright-surrogates-1"
MAX_NONCE = 64

MALE = r"(?:Mr|Mister|Sir|Lord|Herr|Señor|Sr|Don|Monsieur|M(?=\.)|г-н|господин)"
FEMALE = r"(?:Mrs|Ms|Miss|Madam|Lady|Dame|Mme|Mlle|Frau|Señora|Sra|Señorita|Doña|Madame|Mademoiselle|г-жа|госпожа)"
NEUTRAL = r"(?:Dr|Doctor|Doktor|Prof|Professor|Professeur|Profesora?|Docteur|Doctora?|Rev|Reverend|доктор|профессор)"
NAME = r"\p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+){0,2}"
SECRET = r"(?i:token|passwd|password|passphrase|pwd|secret(?:[_-]?key)?|api[_-]?key|access[_-]?key|private[_-]?key|auth)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
MARKS = r"[A-Za-z0-9+/_.~!@#$%^*=:-]"
IPV4 = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)"
HEX = r"[0-9A-Fa-f]{1,4}"
#: All eight groups or "::", the last two perhaps as IPv4; a digit or four letters tell it from code.
IPV6 = (
    r"(?<!:)(?=[0-9A-Fa-f:.]*(?:\d|[0-9A-Fa-f]{4}))(?:"
    rf"(?:(?:{HEX}:){{6}}|(?:{HEX}(?::{HEX}){{0,4}})?::(?:{HEX}:){{0,5}}){IPV4}(?![\d.]*\d)|"
    rf"(?:(?:{HEX}:){{7}}{HEX}|{HEX}(?::{HEX}){{0,6}}::(?:{HEX}(?::{HEX}){{0,5}})?|::{HEX}(?::{HEX}){{0,6}})(?![\p{{L}}\p{{N}}_]|:[0-9A-Fa-f]))"
)
#: kind → Java regex; the first that matches at a place wins.
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": SECRET + rf"(?:(?={MARKS}*\d){MARKS}{{8,}}(?<![.!:])|[A-Za-z0-9+/_-]{{8,}})",
    "access_key": r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": IPV6,
    "ip": IPV4 + r"(?![\d.]*\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\d)|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?!\d)",
    "phone": r"\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "person_m": MALE + r"\.? " + NAME,
    "person_f": FEMALE + r"\.? " + NAME,
    "person_n": rf"(?:(?:{NEUTRAL}\.? )+(?:{MALE}\.? |{FEMALE}\.? )?)" + NAME,
}
TITLES = rf"^(?:(?:{MALE}|{FEMALE}|{NEUTRAL})\.? )+"
#: A secret's name may be the end of an identifier; all others start a word.
ALL = r"(?:(?<![\p{L}\p{N}_])(?:" + "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "secret") + f")|{PATTERNS['secret']})"
ALL = ALL.replace(r"([ -]?)", r"(?<sep>[ -]?)").replace(r"\1", r"\k<sep>")

#: Country calling codes of one and two digits; all others have three.
CODES = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"

SYLLABLES = ["bar", "bel", "cor", "dan", "del", "fen", "gar", "hal", "jor", "kel", "lan", "mar", "nor", "per", "quin", "ros", "sal", "tor", "val", "win", "yar", "zel", "bri", "cas", "dor", "els", "far", "gil", "hol", "ker", "lor", "mel"]
MALE_ENDS, FEMALE_ENDS = ["an", "en", "ic", "or", "us", "el", "ard", "to"], ["a", "ia", "ina", "ela", "essa", "ila", "ana", "eta"]
CYRILLIC = ["бар", "бел", "вор", "дан", "дел", "жар", "зим", "кал", "кор", "лав", "мар", "нов", "пол", "рад", "сав", "тар"]
CYRILLIC_MALE, CYRILLIC_FEMALE = ["ан", "ий", "ил", "ор", "ей", "ем", "ир", "ат"], ["а", "ия", "ина", "ела", "ила", "ана", "ета", "ая"]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed, and stands in the plan, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_of(e: Column, kinds=tuple(PATTERNS), default: str = "phone") -> Column:
    """The kind of a match; patterns are tried in their order."""
    out = F.lit(default)
    for kind in reversed(kinds):
        out = F.when(e.rlike("^(?:" + PATTERNS[kind] + ")$"), F.lit(kind)).otherwise(out)
    return out


def of_value(match: Column, kind: Column) -> Column:
    """(kind, value): the part of a match that is replaced, without a secret's
    name or a title, and what kind of entity it is in any context."""
    secret = let(F.regexp_replace(match, "^.*?" + SECRET, ""), lambda v: F.struct(kind_of(v, [k for k in PATTERNS if k != "secret" and not k.startswith("person")], "secret").alias("kind"), v.alias("value")))
    female = (kind == "person_f") | (kind == "person_n") & (match.rlike(FEMALE + r"\.? ") | ~match.rlike(rf"(?<![\p{{L}}-]){MALE}\.? ") & match.rlike(r"[aая][ -]\p{Lu}\p{Ll}+$"))
    person = F.struct(F.when(female, "person_f").otherwise("person_m").alias("kind"), F.regexp_replace(match, TITLES, "").alias("value"))
    return F.when(kind == "secret", secret).when(kind.startswith("person"), person).otherwise(F.struct(kind.alias("kind"), match.alias("value")))


def full_ipv6(v: Column) -> Column:
    """The eight groups of an IPv6 address in hexadecimal without leading zeros."""
    octet = lambda x, k: F.lpad(F.conv(F.get(x, F.lit(k)), 10, 16), 2, "0")
    groups = lambda x: F.filter(F.split(x, ":"), lambda g: g != "")
    hexa = let(F.split(F.substring_index(v, ":", -1), "\\."), lambda x: F.when(F.size(x) == 4, F.concat(octet(x, 0), octet(x, 1), F.lit(":"), octet(x, 2), octet(x, 3))).otherwise(F.get(x, F.lit(0))))
    low = F.lower(F.concat(F.regexp_extract(v, "^(.*:)", 1), hexa))
    halves = let(low, lambda x: F.array(groups(F.substring_index(x, "::", 1)), F.when(x.contains("::"), groups(F.substring_index(x, "::", -1))).otherwise(F.array().cast("array<string>"))))
    full = let(halves, lambda x: F.concat(F.get(x, F.lit(0)), F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(F.flatten(x)))), F.get(x, F.lit(1))))
    return F.array_join(F.transform(full, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def normal(v: Column, kind: Column) -> Column:
    """What makes two spellings the same entity, but for IPv6: see ``full_ipv6``;
    surrogates of that kind are in full already."""
    digits = F.regexp_replace(v, "[^0-9A-Za-z]", "")
    abroad = (kind == "phone") & (v.startswith("+") | (F.length(digits) > 10))
    return F.when(abroad, F.concat(F.lit("+"), digits)).when(kind.isin("phone", "card", "ssn", "iban"), digits).when(kind == "email", F.lower(v)).otherwise(v)


def _bits(kind: Column, norm: Column, nonce: Column, key: str) -> Column:
    h = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, nonce.cast("string")), 256)
    return F.concat(h, F.sha2(h, 256))


def _byte(bits: Column, k: Column | int) -> Column:
    """The k-th number 0 to 65535 of the hash, which repeats after 63."""
    at = F.pmod(k if isinstance(k, Column) else F.lit(k), F.lit(63)) * 2 + 1
    return F.conv(F.substring(bits, at, F.lit(4)), 16, 10).cast("int")


def _pick(bits: Column, k: int, values: list[str]) -> Column:
    return F.element_at(F.split(F.lit(" ".join(values)), " "), F.pmod(_byte(bits, k), F.lit(len(values))) + 1)


def _charwise(v: Column, bits: Column, start: Column, stop: Column, hexa: Column) -> Column:
    """Letters and digits from ``start`` on and before ``stop`` replaced in kind,
    by their number among letters and digits."""
    alnum = "[^\\p{L}\\p{N}]"

    def one(c: Column, i: Column) -> Column:
        n = _byte(bits, F.length(F.regexp_replace(F.substring(v, F.lit(1), i + 1), alnum, "")))
        at = lambda letters, size: F.substring(F.lit(letters), F.pmod(n, F.lit(size)) + 1, F.lit(1))
        new = (
            F.when((i < start) | (i >= stop), c)
            .when(hexa & c.rlike("[0-9a-f]"), at("0123456789abcdef", 16))
            .when(c.rlike("[0-9]"), at("0123456789", 10))
            .when(c.rlike("\\p{IsCyrillic}") & c.rlike("\\p{Lu}"), at("АБВГДЕЖЗИКЛМНОПРСТ", 18))
            .when(c.rlike("\\p{IsCyrillic}"), at("абвгдежзиклмнопрст", 18))
            .when(c.rlike("\\p{Lu}"), at("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26))
            .when(c.rlike("\\p{L}"), at("abcdefghijklmnopqrstuvwxyz", 26))
            .otherwise(c)
        )
        return new

    return F.array_join(F.transform(F.split(v, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits; doubling starts at the last but one."""
    ds = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.floor(c.cast("int") * 2 / 10).cast("int") + (c.cast("int") * 2) % 10))
    return F.aggregate(ds, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _mod97(compact: Column) -> Column:
    """The remainder of an IBAN's letters and digits, letters as 10 to 35."""
    step = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + F.coalesce(F.ascii(c), F.lit(55)) - 55) % 97
    return F.aggregate(F.split(compact, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c)).cast("int"))


def _iban(v: Column, plain: Column) -> Column:
    """Check digits that are right if they were, else wrong."""
    compact = lambda x: F.regexp_replace(x, "[^A-Z0-9]", "")
    valid = _mod97(F.concat(F.substring(compact(v), 5, 99), F.substring(v, 1, 4))) == 1
    right = 98 - _mod97(F.concat(F.substring(compact(plain), 5, 99), F.substring(v, 1, 2), F.lit("00")))
    check = let(right, lambda r: F.when(valid, r).otherwise(F.when(r == 98, 2).otherwise(r + 1)))
    return F.concat(F.substring(v, 1, 2), F.lpad(check.cast("string"), 2, "0"), F.substring(plain, 5, 99))


def _name(v: Column, kind: Column, bits: Column, nonce: Column) -> Column:
    """A given name or surname; more syllables where many have collided."""
    def made(parts: list[str], male: list[str], female: list[str], surname: Column) -> Column:
        more = F.when((nonce > 3) | (kind == "surname"), _pick(bits, 5, parts)).otherwise("")
        end = F.when(kind == "given_m", _pick(bits, 6, male)).when(kind == "given_f", _pick(bits, 6, female)).otherwise(surname)
        return F.initcap(F.concat(*[_pick(bits, k, parts) for k in (2, 3, 4)], more, end))

    cyrillic = made(CYRILLIC, CYRILLIC_MALE, CYRILLIC_FEMALE, F.when(v.rlike("[ая]$"), "ова").otherwise("ов"))
    return F.when(v.rlike("\\p{IsCyrillic}"), cyrillic).otherwise(made(SYLLABLES, MALE_ENDS, FEMALE_ENDS, F.lit("")))


def _ip(v: Column, bits: Column, nonce: Column) -> Column:
    """Private ranges stay what they are; if their addresses run out, 10/8."""
    byte = lambda k, n=256: F.pmod(_byte(bits, k), F.lit(n)).cast("string")
    host = (F.pmod(_byte(bits, 3), F.lit(254)) + 1).cast("string")
    dots = lambda *parts: F.concat_ws(".", *[F.lit(x) if isinstance(x, str) else x for x in parts], host)
    return (
        F.when(v.startswith("127."), dots("127", byte(1), byte(2)))
        .when(v.startswith("169.254."), dots("169", "254", byte(2)))
        .when(v.startswith("192.168.") & (nonce < 8), dots("192", "168", byte(2)))
        .when(v.rlike(r"^172\.(1[6-9]|2\d|3[01])\.") & (nonce < 8), dots("172", (F.pmod(_byte(bits, 1), F.lit(16)) + 16).cast("string"), byte(2)))
        .when(v.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)"), dots("10", byte(1), byte(2)))
        .otherwise(dots((F.pmod(_byte(bits, 0), F.lit(88)) + 11).cast("string"), byte(1), byte(2)))
    )


def surrogate(v: Column, kind: Column, norm: Column, nonce: Column, key: str = KNOWN_KEY) -> Column:
    """Of one entity, or of one token of a name (given_m, given_f, surname)."""
    n, zero = F.length(v), F.lit(0)
    stop = F.when(kind == "email", n - F.length(F.regexp_extract(v, r"(\.[A-Za-z]+)$", 1))).otherwise(n)
    # a phone's country code is told by its normal form, so all spellings keep the same digits
    code = F.length(F.regexp_extract(norm, rf"^\+({CODES})", 1))
    country = F.when(code == 1, F.length(F.regexp_extract(v, r"^(\D*\d)", 1))).when(code == 2, F.length(F.regexp_extract(v, r"^(\D*\d\D*\d)", 1))).otherwise(F.length(F.regexp_extract(v, r"^(\D*\d\D*\d\D*\d)", 1)))
    start = F.when(kind.isin("access_key", "iban"), F.lit(4)).when(kind == "card", F.when(v.rlike("^3[47]"), 2).otherwise(1)).when((kind == "phone") & norm.startswith("+"), country).otherwise(zero)
    digits = lambda x: F.regexp_replace(x, "[^0-9]", "")

    def card(plain: Column) -> Column:
        """The last digit again makes the check sum right where it was right."""
        body = F.substring(plain, F.lit(1), n - 1)
        check = F.pmod(-_luhn_sum(F.concat(digits(body), F.lit("0"))), F.lit(10)).cast("string")
        return F.when(_luhn_sum(digits(v)) % 10 == 0, F.concat(body, check)).otherwise(plain)

    def ipv6(bits: Column) -> Column:
        first = F.lpad(F.lower(F.hex(F.pmod(_byte(bits, 0), F.lit(4096)))), 3, "0")
        first = F.when(norm.rlike("^(f[cd]|fe[89ab]|0:0:0:0:0:0:0:1$)"), F.concat(F.lit("fd"), F.substring(first, 2, 2))).otherwise(F.concat(F.lit("2"), first))
        return F.concat_ws(":", first, *[F.lower(F.hex(_byte(bits, k))) for k in range(1, 8)])

    def charwise(bits: Column) -> Column:
        plain = _charwise(v, bits, start, stop, (kind == "secret") & v.rlike("^[0-9a-f]+$"))
        return let(plain, lambda x: F.when(kind == "card", card(x)).when(kind == "iban", _iban(v, x)).otherwise(x))

    names = kind.isin("given_m", "given_f", "surname")
    return let(_bits(kind, norm, nonce, key), lambda bits: F.when(names, _name(v, kind, bits, nonce)).when(kind == "ip", _ip(v, bits, nonce)).when(kind == "ipv6", ipv6(bits)).otherwise(charwise(bits)))


def tokens(value: Column, kind: Column) -> Column:
    """Array of (kind, text) of a name: its tokens, and what parts them (kind null)."""
    parts = F.regexp_extract_all(value, F.lit("[^ -]+|[ -]"), F.lit(0))
    given = F.concat(F.lit("given_"), F.substring(kind, 8, 1))
    return let(parts, lambda p: F.transform(p, lambda c, i: F.struct(F.when(c.isin(" ", "-"), None).when(i == F.size(p) - 1, "surname").otherwise(given).alias("kind"), c.alias("text"))))


def named(value: Column, kind: Column, nonce, key: str) -> Column:
    """The surrogate of a whole name; ``nonce(kind, norm)``."""
    return F.array_join(F.transform(tokens(value, kind), lambda t: F.when(t["kind"].isNull(), t["text"]).otherwise(surrogate(t["text"], t["kind"], t["text"], nonce(t["kind"], t["text"]), key))), "")


def found(text: Column) -> Column:
    """Array of (kind, match, value, norm) of a text, in order."""
    pieces = F.regexp_extract_all(text, F.lit(ALL), F.lit(0))

    # one step each: what a lambda names is computed once
    kinds = F.transform(pieces, lambda e: F.struct(kind_of(e).alias("kind"), e.alias("match")))
    values = F.transform(kinds, lambda x: F.struct(x["match"].alias("match"), of_value(x["match"], x["kind"]).alias("of")))
    norm = lambda v, k: F.when(k == "ipv6", full_ipv6(v)).otherwise(normal(v, k))
    return F.transform(values, lambda x: F.struct(x["of"]["kind"].alias("kind"), x["match"].alias("match"), x["of"]["value"].alias("value"), norm(x["of"]["value"], x["of"]["kind"]).alias("norm")))


def entities(each: Column) -> Column:
    """Array of (kind, norm, value) that surrogates are drawn for."""
    some = F.filter(each, lambda x: ~x["kind"].startswith("person"))
    names = F.filter(F.flatten(F.transform(F.filter(each, lambda x: x["kind"].startswith("person")), lambda x: tokens(x["value"], x["kind"]))), lambda t: t["kind"].isNotNull())
    return F.concat(F.transform(some, lambda x: F.struct(x["kind"].alias("kind"), x["norm"].alias("norm"), x["value"].alias("value"))), F.transform(names, lambda t: F.struct(t["kind"].alias("kind"), t["text"].alias("norm"), t["text"].alias("value"))))


def nonces(docs: DataFrame, key: str = KNOWN_KEY) -> DataFrame:
    """(kind, norm, nonce) of entities whose first surrogate collides with
    another entity or its surrogate; usually few rows. Each spelling's own
    surrogate is compared, as it will be put into the text."""
    spark, text = docs.sparkSession, F.col("text").cast("string")
    each = docs.select(F.explode(let(found(text), entities)).alias("f")).select("f.kind", "f.norm", "f.value").distinct()
    known = staged(each.withColumns({"nonce": F.lit(0), "s": F.lit(None).cast("string")}), "pii-entities")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(MAX_NONCE):
        # drawing costs far more than reading, so it is spread by number, not by size
        draw = let(surrogate(F.col("value"), F.col("kind"), F.col("norm"), F.col("nonce"), key), lambda s: normal(s, F.col("kind")))
        drawn = staged(known.repartition(tasks, "kind", "norm", "value").withColumn("s", F.coalesce("s", draw)), "pii-drawn")
        # the entity that holds a surrogate: real ones before drawn ones
        claims = drawn.select("kind", F.col("s").alias("form"), F.struct(F.lit(1).alias("drawn"), "nonce", "norm").alias("by")).union(
            known.select("kind", F.col("norm").alias("form"), F.struct(F.lit(0).alias("drawn"), F.lit(0).alias("nonce"), "norm").alias("by"))).distinct()
        held = claims.groupBy("kind", "form").agg(F.min("by").alias("by"), F.count(F.lit(1)).alias("n")).where("n > 1")
        clash = staged(drawn.join(held.select("kind", F.col("form").alias("s"), "by"), ["kind", "s"]).where((F.col("by.norm") != F.col("norm")) | (F.col("by.drawn") == 0)).select("kind", "norm", F.lit(1).alias("again")).distinct(), "pii-clash")
        if not clash.limit(1).count():
            return known.where("nonce > 0").select("kind", "norm", "nonce").distinct()
        # only those that clash are drawn anew
        known = staged(drawn.join(clash, ["kind", "norm"], "left").select("kind", "norm", "value", (F.col("nonce") + F.coalesce("again", F.lit(0))).alias("nonce"), F.when(F.col("again").isNull(), F.col("s")).alias("s")), "pii-entities")
    raise RuntimeError("surrogates still collide; the space of a kind is too small")


def rewritten(text: Column, each: Column, nonce, key: str) -> Column:
    """``text`` with the surrogates of what was ``found`` in it; ``nonce(kind, norm)``."""
    one = lambda x: F.when(x["kind"].startswith("person"), named(x["value"], x["kind"], nonce, key)).otherwise(surrogate(x["value"], x["kind"], x["norm"], nonce(x["kind"], x["norm"]), key))
    new = F.transform(each, lambda x: F.concat(F.substring(x["match"], F.lit(1), F.length(x["match"]) - F.length(x["value"])), one(x)))
    # names of several tokens, the longest first, where they stand without a title
    names = F.array_distinct(F.transform(F.filter(each, lambda x: x["kind"].startswith("person") & x["value"].contains(" ")), lambda x: F.struct((-F.length(x["value"])).alias("n"), x["kind"].alias("kind"), x["value"].alias("value"))))
    swaps = F.transform(F.array_sort(names), lambda x: F.struct(F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), x["value"], F.lit(r"(?![\p{L}\p{N}_])")).alias("name"), named(x["value"], x["kind"], nonce, key).alias("new")))
    between = let(swaps, lambda w: F.transform(F.split(text, ALL, -1), lambda b: F.aggregate(w, b, lambda t, x: F.regexp_replace(t, x["name"], x["new"]))))
    return F.array_join(F.transform(F.arrays_zip(between.alias("b"), new.alias("s")), lambda z: F.concat(z["b"], F.coalesce(z["s"], F.lit("")))), "")


def replace(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``, and columns ``n_entities`` and
    ``kinds`` (names it already has are replaced).

    Null texts stay null with no entities; empty texts stay empty. Repeated
    rows and null ids get what their text gets; an empty table stays empty;
    very long texts are rewritten whole. All other columns pass. ``key`` is the
    secret key (see the module's docstring).
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, KNOWN_KEY)
    names = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    docs = renamed(docs.drop("n_entities", "kinds"), "text")
    keep = [c for c in docs.columns if c != "text"]
    some = staged(nonces(docs, key), "pii-nonces")
    inner = docs.select(F.struct(*[docs[c] for c in keep]).alias("__row") if keep else F.struct(F.lit(0).alias("__none")).alias("__row"), docs["text"].cast("string").alias("__text")).withColumn("__found", found(F.col("__text")))
    if some.limit(1).count():
        h = F.when(F.size("__found") > 0, F.sha2("__text", 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("__row").cast("string")))
        inner = inner.withColumn("__h", h)
        hits = inner.where(F.size("__found") > 0).select("__h", F.explode(let(F.col("__found"), entities)).alias("f")).select("__h", "f.kind", "f.norm").distinct().join(some, ["kind", "norm"])
        by = staged(hits.groupBy("__h").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "norm"), "nonce"))).alias("__n")), "pii-by-text")
        inner = inner.join(by, "__h", "left")
        nonce = lambda kind, norm: F.coalesce(F.element_at("__n", F.concat_ws("\x1f", kind, norm)), F.lit(0))
    else:
        nonce = lambda kind, norm: F.lit(0)
    text = F.when(F.coalesce(F.size("__found"), F.lit(0)) <= 0, F.col("__text")).otherwise(rewritten(F.col("__text"), F.col("__found"), nonce, key))
    out = inner.select("__row", text.alias("text"), F.greatest(F.coalesce(F.size("__found"), F.lit(0)), F.lit(0)).alias("n_entities"), F.array_sort(F.array_distinct(F.transform("__found", lambda x: x["kind"]))).alias("kinds"))
    order = [F.col(f"__row.`{c}`").alias(c) if c in keep else F.col("text") for c in docs.columns if c in keep or c == "text"]
    return out.select(*order, "n_entities", "kinds").toDF(*names, "n_entities", "kinds")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities", "kinds")


QUERIES = {"op5_pii": op5_pii}
ORACLES: dict[str, str] = {}

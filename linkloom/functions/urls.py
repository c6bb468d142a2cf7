"""URL and index-key functions as native column expressions.

A key is `revDomain>revSubdomain>(o|s)[port]>path`: it sorts by domain, and two
addresses of one page have one key. Keys and parsed addresses are structs and
strings built by Catalyst expressions only, the registrable domain by a hashed
set of public suffixes inside the expression (`domain_sql`).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemes, image endings, shortest address.
IMAGES = ("jpeg", "jpg", "png", "gif", "bmp")
SHORTEST = 8
_LABEL = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_-]{0,61}[\p{L}\p{N}_])?"
_LAST = r"(?!\p{N})" + _LABEL
HOST = rf"^(?:{_LABEL}\.)+{_LAST}\.?$"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def reverse_host(host: Column) -> Column:
    """Labels in reverse order; a trailing dot stays at the end."""
    plain = F.regexp_replace(host, r"\.$", "")
    turned = F.array_join(F.reverse(F.split(plain, r"\.")), ".")
    return F.when(host.endswith("."), F.concat(turned, F.lit("."))).otherwise(turned)


def is_ip(host: Column) -> Column:
    return host.rlike(IPV4)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def split_url(raw: Column) -> Column:
    """STRUCT<host, path, port, secure, ip_host>, null where the address is malformed. The domain is not checked yet."""

    def parts(text: Column) -> Column:
        rest = F.regexp_extract(text, r"(?is)^https?://(.*)$", 1)
        return F.struct(F.length(text).alias("n"), text.rlike(r"^(?i)https?://").alias("known"), text.rlike(r"^(?i)https://").alias("secure"), F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("authority"), F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1).alias("path"))

    def place(p: Column) -> Column:
        has_port = p["authority"].contains(":")
        port_text = F.regexp_extract(p["authority"], r"(?s)^[^:]*:(.*)$", 1)
        port = F.when(~has_port, F.when(p["secure"], 443).otherwise(80)).when(port_text.rlike(r"^[+-]?\d+$"), port_text.try_cast("int"))
        host = F.substring_index(p["authority"], ":", 1)
        return F.struct(host.alias("host"), F.when(p["path"] == "", "/").otherwise(p["path"]).alias("path"), port.alias("port"), p["secure"].alias("secure"), is_ip(host).alias("ip_host"), (p["known"] & (p["n"] >= SHORTEST)).alias("ok"))

    def checked(u: Column) -> Column:
        ok = u["ok"] & (u["host"] != "") & u["port"].isNotNull() & (u["ip_host"] | (u["host"].rlike(HOST) & (F.length(u["host"]) <= 254)))
        return F.when(ok, F.struct(*[u[c].alias(c) for c in ("host", "path", "port", "secure", "ip_host")]))

    text = F.regexp_replace(raw, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return F.when(~raw.contains(">"), bound(text, lambda t: bound(parts(t), lambda p: bound(place(p), checked))))


def key_of(url: Column, domain: Column) -> Column:
    """Index key of a split address with its registrable domain."""
    turned = F.when(url["ip_host"], url["host"]).otherwise(reverse_host(url["host"]))
    rev = F.when(url["ip_host"], domain).otherwise(reverse_host(domain))
    sub = F.substring(turned, F.length(rev) + 1, F.length(turned))
    usual = url["port"] == F.when(url["secure"], 443).otherwise(80)
    return F.concat(rev, F.lit(">"), sub, F.lit(">"), F.when(url["secure"], "s").otherwise("o"), F.when(usual, "").otherwise(url["port"].cast("string")), F.lit(">"), url["path"])


def address_of(url: Column) -> Column:
    """Canonical address; the scheme's own port is left out."""
    usual = url["port"] == F.when(url["secure"], 443).otherwise(80)
    return F.concat(F.when(url["secure"], "https://").otherwise("http://"), url["host"], F.when(usual, "").otherwise(F.concat(F.lit(":"), url["port"].cast("string"))), url["path"])


def from_key(key: Column) -> Column:
    """STRUCT<domain, host, path, port, secure, ip_host> of a key, null unless it has four parts and a valid third."""
    p = F.split(key, ">")
    rev, sub, mark, path = p[0], p[1], p[2], p[3]
    ip = is_ip(rev) & (sub == "")
    host = F.when(ip, rev).otherwise(reverse_host(F.concat(rev, sub)))
    port = F.when(F.length(mark) == 1, F.when(mark == "s", 443).otherwise(80)).otherwise(F.substring(mark, 2, 12).try_cast("int"))
    ok = (F.size(p) == 4) & mark.rlike(r"^[os]") & port.isNotNull()
    return F.when(ok, F.struct(F.when(ip, rev).otherwise(reverse_host(rev)).alias("domain"), host.alias("host"), path.alias("path"), port.alias("port"), mark.startswith("s").alias("secure"), ip.alias("ip_host")))


def domain_of_key(key: Column) -> Column:
    """Reversed domain of a key: all up to the first separator."""
    return F.substring_index(key, ">", 1)


def is_image(path: Column) -> Column:
    return ~path.contains(" ") & F.lower(path).rlike(r"\.(?:" + "|".join(IMAGES) + ")$")


def rev_encode(n: Column) -> Column:
    """Hex text that sorts a non-negative count in descending order.

    Big-endian bytes without leading zeros, headed by their number; 00 and 01 are
    escaped as 0101 and 0102; every byte is complemented; FF ends the text.
    """
    digits = F.when(n == 0, "").otherwise(F.hex(n))
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    raw = F.concat(F.lpad(F.hex((F.length(even) / 2).cast("bigint")), 2, "0"), even)
    bytes_ = F.split(F.regexp_replace(raw, "(..)(?=.)", "$1 "), " ")
    turned = F.transform(bytes_, lambda b: F.when(b == "00", "fefe").when(b == "01", "fefd").otherwise(F.lower(F.lpad(F.hex(F.lit(255) - F.conv(b, 16, 10).cast("int")), 2, "0"))))
    return F.concat(F.array_join(turned, ""), F.lit("ff"))


def json_escaped(json: Column) -> Column:
    """Characters that mean something in HTML as \\u escapes."""
    for c, code in (("<", "003c"), (">", "003e"), ("&", "0026"), ("=", "003d"), ("'", "0027")):
        json = F.replace(json, F.lit(c), F.lit("\\u" + code))
    return json


def byte_escaped(text: Column) -> Column:
    """Text for dumps: bytes outside 32 to 126, and the backslash, as \\xNN."""
    pairs = F.filter(F.split(F.regexp_replace(F.hex(F.encode(text, "UTF-8")), "(..)", "$1 "), " "), lambda b: b != "")
    code = lambda b: F.conv(b, 16, 10).cast("int")
    return F.array_join(F.transform(pairs, lambda b: F.when(code(b).between(32, 126) & (code(b) != 92), F.char(code(b))).otherwise(F.concat(F.lit("\\x"), F.lower(b)))), "")


@functools.lru_cache(maxsize=1)
def _rules() -> tuple[tuple[str, str], ...]:
    jvm = SparkSession.active()._jvm
    table = jvm.com.google.thirdparty.publicsuffix.PublicSuffixPatterns
    out = []
    for kind, m in (("exact", table.EXACT), ("under", table.UNDER), ("excluded", table.EXCLUDED)):
        out += [(kind, s) for s in str(jvm.com.google.common.base.Joiner.on(" ").join(m.keySet())).split()]
    return tuple(out)


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in sorted(words)) or "NULL"


def domain_sql(host: str, suffixes: DataFrame | None = None) -> str:
    """SQL of the registrable domain of a host expression, null where it has none.

    Every tail of the host is looked up in the public suffix list that Spark's own
    libraries carry; the longest hit decides. The list is a hashed set inside the
    expression (about ten thousand words, whatever the data), so a lookup is narrow:
    no join, no shuffle by host, and it works on hosts inside arrays.
    suffixes: own rules as (kind, suffix), kind being exact, under or excluded.
    """
    rules = _rules() if suffixes is None else [tuple(r) for r in suffixes.select("kind", "suffix").collect()]
    exact, under, excluded = (_quoted({s for k, s in rules if k == kind}) for kind in ("exact", "under", "excluded"))
    tail = lambda i: f"array_join(slice(ls, {i}, greatest(size(ls) - ({i}) + 1, 0)), '.')"
    hit = f"transform(transform(sequence(1, size(ls)), i -> struct(i, {tail('i')} AS t, {tail('i + 1')} AS p)), x -> CASE WHEN x.t IN ({exact}) THEN x.i - 1 WHEN x.t IN ({excluded}) THEN x.i WHEN x.p IN ({under}) THEN x.i - 1 END)"
    whole = f"transform(array(get(array_compact({hit}), 0)), at -> CASE WHEN at > 0 THEN {tail('at')} END)[0]"
    return f"transform(array(split(regexp_replace({host}, '[.]$', ''), '[.]')), ls -> {whole})[0]"


def with_domains(df: DataFrame, url: str = "u", suffixes: DataFrame | None = None) -> DataFrame:
    """Adds `domain`; the split address becomes null where its host has none."""
    u = F.col(url)
    out = df.withColumn("domain", F.when(u["ip_host"], u["host"]).otherwise(F.expr(domain_sql(f"{url}.host", suffixes))))
    return out.withColumn(url, F.when(F.col("domain").isNotNull(), u))


def keyed(df: DataFrame, raw: str, out: str = "uri", suffixes: DataFrame | None = None) -> DataFrame:
    """Adds the index key of an address column, null where it is no valid page address."""
    return with_domains(df.withColumn("_u", split_url(F.col(raw))), "_u", suffixes).withColumn(out, key_of(F.col("_u"), F.col("domain"))).drop("_u", "domain")

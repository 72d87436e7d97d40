"""The 26 lexical features: of plain URLs from one Arrow function, of others as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from . import chars, hosts, plain, urls
from .numbers import exact_round


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters; 0 for an empty string.

    Sorting the characters turns equal ones into runs. A run of one adds nothing
    to sum(c * log2 c), so only repeated characters are visited.
    """
    size = F.length(text)
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1+"), F.lit(0))
    mass = F.aggregate(runs, F.lit(0.0), lambda acc, r: acc + F.length(r) * F.log2(F.length(r)))
    return F.when(size == 0, 0.0).otherwise(F.log2(size) - mass / size)


def _non_ascii(text: Column) -> Column:
    return F.length(text) != F.octet_length(text)


def digit_count(text: Column) -> Column:
    """Characters that are digits in the Unicode sense; ASCII text takes the short way."""
    wide = F.length(F.regexp_replace(text, "[^" + chars.digit_class() + "]", ""))
    return F.when(_non_ascii(text), wide).otherwise(urls.count_any(text, "0123456789"))


def special_char_count(text: Column) -> Column:
    """Neither alphanumeric nor one of . / : -"""
    wide = F.length(F.regexp_replace(text, r"[\p{L}\p{N}./:\-]+", ""))
    return F.when(_non_ascii(text), wide).otherwise(
        F.length(F.regexp_replace(text, r"[A-Za-z0-9./:\-]+", "")))


def _with_counts(df: DataFrame, text: str) -> DataFrame:
    """Add `_bits`, the entropy of a text column, `_digits` and `_special`. Texts beyond ASCII go by the expressions."""
    t, counted = F.col(text), F.col("_counted")
    short = counted["mass"].isNotNull() & t.isNotNull()
    size = F.when(counted["plain"] == 1, counted["url_length"]).when(short, F.length(t))
    bits = F.when(size == 0, 0.0).otherwise(F.log2(size) - counted["mass"] / size)
    return df.withColumns({
        "_bits": F.when(size.isNotNull(), bits).when(t.isNotNull(), entropy(t)),
        "_digits": F.when(short, counted["digit_count"]).when(t.isNotNull(), digit_count(t)),
        "_special": F.when(short, counted["special_char_count"]).when(t.isNotNull(), special_char_count(t)),
    })


def lookalike_ratio(host: Column) -> Column:
    bare = urls.without(host, ".")
    return F.when(F.length(bare) == 0, 0.0).otherwise(urls.count_any(bare, K.LOOKALIKE_CHARS) / F.length(bare))


def _brand_text(host: Column, path: Column, domain: Column) -> Column:
    before = F.substring(host, F.lit(1), F.length(host) - F.length(domain))
    return F.lower(F.concat(before, F.lit(" "), path))


def _brand(text: Column, domain: Column) -> Column:
    named = F.lit(False)
    for token in K.BRAND_TOKENS:
        named = named | F.contains(text, F.lit(token))
    return named & ~F.substring_index(domain, ".", 1).isin(K.BRAND_TOKENS)


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def from_parts(url: Column, prefix: str = "_") -> dict[str, Column]:
    """Feature expressions over a trimmed URL, the columns of `urls.with_parts` and those that `with_features` adds."""
    host, path, query = (F.col(prefix + n) for n in ("host", "path", "query"))
    domain, ip = F.col(prefix + "domain"), F.col(prefix + "is_ip")
    digits, suffix = F.col(prefix + "digits"), F.col(prefix + "tld")
    later = F.when(F.contains(url, F.lit("://")), urls.after(url, "://")).otherwise(url)
    return {
        "url_length": F.length(url),
        "hostname_length": F.length(host),
        "path_length": F.length(path),
        "query_length": F.length(query),
        "digit_count": digits,
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "special_char_count": F.col(prefix + "special"),
        "hyphen_count": urls.count_char(url, "-"),
        "dot_count": urls.count_char(url, "."),
        "slash_count": urls.count_char(url, "/"),
        "entropy": exact_round(F.col(prefix + "bits"), 4),
        "has_ip_address": _flag(ip),
        "subdomain_count": F.when(ip, 0).when(
            ~ip, F.greatest(urls.count_char(host, ".") - 1, F.lit(0))),
        "hostname_hyphen_count": urls.count_char(host, "-"),
        "hostname_digit_count": digit_count(host),
        "is_known_shortener": _flag(domain.isin(K.SHORTENER_DOMAINS)),
        "has_punycode": _flag(F.contains(host, F.lit("xn--"))),
        "homoglyph_char_ratio": lookalike_ratio(host),
        "percent_encoded_count": urls.count_char(url, "%"),
        "brand_token_in_subdomain_or_path": _flag(_brand(F.col(prefix + "named"), domain)),
        "tld_length": F.length(suffix),
        "is_suspicious_tld": _flag(suffix.isin(K.SUSPICIOUS_TLDS)),
        "uses_https": _flag(F.col(prefix + "scheme") == "https"),
        "has_at_symbol": _flag(F.contains(url, F.lit("@"))),
        "has_port": _flag(F.col(prefix + "port_text") != ""),
        "has_double_slash_redirect": _flag(F.contains(later, F.lit("//"))),
    }


def with_features(df: DataFrame, url: str = "url", keep_parts: bool = False, parts: str | None = None) -> DataFrame:
    """Add the 26 features of a raw URL column, and, when `keep_parts`, `host` and `spelled`, the name of a host that has
    letters outside ASCII.

    A URL whose authority cannot be used has NULL features; `urls.reject_reason`
    says why. With `parts`, the URL is trimmed, and its parts are there under that prefix already.
    """
    own = df.columns
    if keep_parts:
        df = hosts.with_foreign(df, url, "_foreign")
    df = df.withColumn("_counted", plain.measured(df, url, "_foreign" if keep_parts else None))
    # Expressions see a null in place of a plain URL, so that they cost it next to nothing.
    odd = F.col("_counted.plain") == 0
    if parts:
        work = df.withColumns({"_u": F.col(url), **{
            "_" + n: F.col(parts + n) for n in ("scheme", "netloc", "path", "query", "host", "port_text")}})
    else:
        trimmed = urls.strip(F.when(odd, F.col(url)))
        work = df.withColumn("_u", trimmed)
        clean = urls.without(urls.without(urls.without(F.col("_u"), "\t"), "\r"), "\n")
        work = urls.with_parts(work.withColumn("_clean", clean), "_clean")
    # One null test here makes every feature of an unusable URL NULL further down.
    usable = odd & (F.col("_host") != "") & ~urls.bad_authority()
    work = work.withColumn("_usable", usable)
    names = ["_u", "_scheme", "_path", "_query", "_host", "_port_text"]
    work = work.withColumns({n: F.when(F.col("_usable"), F.col(n)) for n in names})
    work = work.withColumns({
        "_domain": hosts.registrable(F.col("_host")),
        "_tld": hosts.tld(F.col("_host")),
        "_is_ip": hosts.is_ip(F.col("_host")),
    })
    work = _with_counts(work.withColumn("_named", _brand_text(F.col("_host"), F.col("_path"), F.col("_domain"))), "_u")
    columns, counted = from_parts(F.col("_u")), F.col("_counted")
    # No filter passes an expression that isn't deterministic. On its way down one would copy a feature's expressions into each other.
    here = F.spark_partition_id() >= 0
    chosen = [(F.when(here, columns[n]) if n == "entropy" else F.when((counted["plain"] == 1) & here, counted[n])
               .otherwise(columns[n])).alias(n) for n in K.FEATURES]
    extra = [F.when(counted["plain"] == 1, counted["host"]).otherwise(F.col("_host")).alias("host"),
             counted["spelled"].alias("spelled")] if keep_parts else []
    return work.select(*own, *extra, *chosen)


def url_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Public batch call: the input columns plus the 26 features."""
    return with_features(df, url)


def finite(names=K.FEATURES) -> Column:
    """True when every named feature is present and finite."""
    ok = F.lit(True)
    for name in names:
        ok = ok & F.col(name).isNotNull()
        if name in K.DOUBLE_FEATURES:
            ok = ok & ~F.isnan(name) & (F.abs(F.col(name)) != float("inf"))
    return ok

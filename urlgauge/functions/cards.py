"""Scores, statuses, indicator cards and highlighted URL segments, inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from . import urls
from .numbers import exact_round, fixed_text

CARD_TYPE = "array<struct<title:string,flagged:boolean,detail:string>>"


def sigmoid(log_odds: Column) -> Column:
    """Stable on both tails."""
    grown = F.exp(-F.abs(log_odds))
    return F.when(log_odds >= 0, 1 / (1 + grown)).otherwise(grown / (1 + grown))


def trust_score(probability: Column) -> Column:
    return exact_round((1 - probability) * 100, 1)


def risk_percent(probability: Column) -> Column:
    return exact_round(probability * 100, 1)


def prediction(probability: Column) -> Column:
    return (probability >= K.THRESHOLD).cast("int")


def confidence(probability: Column) -> Column:
    return F.greatest(probability, 1 - probability) * 100


def status(probability: Column) -> Column:
    """Two-way status of the additive model."""
    return F.when(probability >= K.THRESHOLD, "Potential phishing").otherwise("Lower predicted risk")


def status_style(probability: Column) -> Column:
    return F.when(probability >= K.THRESHOLD, "dangerous").otherwise("safe")


def status3(trust: Column) -> Column:
    """Three-way status of the older score."""
    return F.when(trust >= 70, "Safe").when(trust >= 40, "Risky").otherwise("Dangerous")


def display_status(label: Column, trust: Column) -> Column:
    """Either vocabulary of labels on one scale; unknown labels fall back on the score."""
    text = F.lower(F.coalesce(label, F.lit("")))
    return (F.when(text.isin("lower predicted risk", "safe"), "Safe")
            .when(text.isin("potential phishing", "dangerous"), "Dangerous")
            .when(text == "risky", "Risky")
            .otherwise(status3(F.coalesce(trust, F.lit(0.0)))))


def _card(title, flagged, detail) -> Column:
    return F.struct(F.lit(title).alias("title"), flagged.alias("flagged"), detail.alias("detail"))


def _c(name: str) -> Column:
    return F.col(name)


def indicators() -> Column:
    """The six observation cards; expects the feature columns."""
    length, depth, ratio = _c("url_length"), _c("subdomain_count"), _c("homoglyph_char_ratio")
    ip, watch, puny = (_c(n) == 1 for n in ("has_ip_address", "is_suspicious_tld", "has_punycode"))
    return F.array(
        _card("IP address host", ip, F.when(ip, "Detected").otherwise("Not detected")),
        _card("URL length", length > K.THRESHOLDS["url_length"],
              F.concat(length.cast("string"), F.lit(" characters; indicator cutoff is over 60"))),
        _card("TLD watchlist", watch, F.when(watch, "In the illustrative watchlist")
              .otherwise("Not in the watchlist")),
        _card("Subdomain count heuristic", depth >= K.THRESHOLDS["subdomain_count"],
              F.concat(depth.cast("string"), F.lit("; indicator cutoff is 3 or more"))),
        _card("Punycode hostname", puny, F.when(puny, "Encoded hostname detected")
              .otherwise("Not detected")),
        _card("Look-alike character heuristic", ratio > K.THRESHOLDS["homoglyph_char_ratio"],
              F.concat(fixed_text(ratio * 100, 1),
                       F.lit("% of hostname characters; cutoff is over 35%"))),
    )


def signal_cards() -> Column:
    """The four older cards; expects the feature columns."""
    length, depth = _c("url_length"), _c("subdomain_count")
    long, deep = length > K.THRESHOLDS["url_length"], depth >= K.THRESHOLDS["subdomain_count"]
    ip, watch = _c("has_ip_address") == 1, _c("is_suspicious_tld") == 1

    def found(flag):
        return F.when(flag, "Detected").otherwise("Not Detected")

    return F.array(
        _card("IP Address", ip, found(ip)),
        _card("URL Length", long, F.concat(
            F.when(long, "Long").otherwise("Normal"), F.lit(" ("), length.cast("string"),
            F.lit(" characters)"))),
        _card("Suspicious TLD", watch, found(watch)),
        _card("Subdomain Count", deep, F.concat(
            F.when(deep, "High").when(depth <= 1, "Low").otherwise("Moderate"),
            F.lit(" ("), depth.cast("string"), F.lit(")"))),
    )


def display_value(feature: str) -> Column:
    value = _c(feature)
    if feature in K.FLAG_FEATURES:
        return F.when(value != 0, "Yes").otherwise("No")
    if feature in K.DOUBLE_FEATURES:
        return fixed_text(value, 4)
    return value.cast("string")


def reasons(importances: dict[str, float], top_n: int = 5) -> Column:
    """Older explanation: active signals weighted by global importance, worded top ones.

    The wording filter comes after the cut, so a strong signal without a sentence
    still takes a place.
    """
    found = []
    for index, name in enumerate(K.FEATURES):
        weight = F.lit(float(importances.get(name, 0.0)))
        if name.startswith(("has_", "is_")):
            active, strength = _c(name) == 1, weight
        elif name in K.THRESHOLDS:
            active, strength = _c(name) > K.THRESHOLDS[name], weight * _c(name)
        else:
            continue
        found.append(F.when(active, F.struct(
            (-strength.cast("double")).alias("order"), F.lit(index).alias("position"),
            F.lit(name).alias("feature"), F.lit(K.REASON_TEXT.get(name)).alias("text"))))
    ranked = F.slice(F.sort_array(F.filter(F.array(*found), lambda r: r.isNotNull())), 1, top_n)
    return F.transform(F.filter(ranked, lambda r: r["text"].isNotNull()), lambda r: r["text"])


_SPANS = "array<struct<l:int,r:int,label:string>>"


def with_highlight(df: DataFrame, url: str = "url", name: str = "url_parts") -> DataFrame:
    """Add the non-overlapping parts of a trimmed URL with the labels that cover them.

    Expects the feature columns. Positions are 0-based and half-open: indicators
    become spans, span ends become boundaries, and each gap between boundaries
    collects the labels of the spans containing it. Each step is its own
    projection because a lambda re-evaluates everything it captures.
    """
    own, u = df.columns, F.col(url)
    hostport = F.substring_index(urls.part(u, "netloc"), "@", -1)
    before = F.length(F.regexp_extract(u, urls.LEAD + "[^/?#]*", 0)) - F.length(hostport)
    df = df.withColumns({"_hp": hostport, "_l": before})
    df = df.withColumn("_h", F.when(
        F.startswith("_hp", F.lit("[")), F.regexp_extract("_hp", r"^[^\]]*\]", 0)).otherwise(
        F.substring_index("_hp", ":", 1)))
    df = df.withColumns({"_r": F.col("_l") + F.length("_h"), "_labels": F.split("_h", r"\."),
                         "_letters": F.split("_h", "")})
    host, start, stop = F.col("_h"), F.col("_l"), F.col("_r")

    def span(left, right, label):
        return F.struct(left.cast("int").alias("l"), right.cast("int").alias("r"),
                        F.lit(label).alias("label"))

    def when(condition, spans):
        return F.when(condition, spans).otherwise(F.array().cast(_SPANS))

    label_starts = F.transform("_labels", lambda text, i: start + F.length(
        F.array_join(F.slice("_labels", F.lit(1), i), ".")) + F.when(i > 0, 1).otherwise(0))
    coded = F.zip_with("_labels", label_starts, lambda text, at: F.when(
        F.contains(F.lower(text), F.lit("xn--")), span(at, at + F.length(text), "Punycode hostname")))
    alike = F.transform("_letters", lambda ch, i: F.when(
        F.lower(ch).isin(list(K.LOOKALIKE_CHARS)),
        span(start + i, start + i + 1, "Look-alike character heuristic")))
    shown = F.length(F.substring_index(host, ".", -2)) + 1
    cutoff = K.THRESHOLDS["url_length"]
    df = df.withColumn("_spans", F.array_compact(F.flatten(F.array(
        when(_c("has_ip_address") == 1, F.array(span(start, stop, "IP address host"))),
        when((_c("is_suspicious_tld") == 1) & F.contains(host, F.lit(".")), F.array(
            span(stop - F.length(F.substring_index(host, ".", -1)), stop, "TLD watchlist"))),
        when(_c("subdomain_count") >= K.THRESHOLDS["subdomain_count"], F.array(
            span(start, F.greatest(start, stop - shown), "Subdomain count heuristic"))),
        when(_c("has_punycode") == 1, coded),
        when(_c("homoglyph_char_ratio") > K.THRESHOLDS["homoglyph_char_ratio"], alike),
        when(_c("url_length") > cutoff, F.array(
            span(F.lit(cutoff), F.length(u), "URL extends beyond 60 characters")))))))
    df = df.withColumn("_points", F.sort_array(F.array_distinct(F.flatten(F.array(
        F.array(F.lit(0), F.length(u)),
        F.transform("_spans", lambda s: s["l"]), F.transform("_spans", lambda s: s["r"]))))))
    gaps = F.size("_points") - 1
    df = df.withColumn("_gaps", F.arrays_zip(
        F.slice("_points", F.lit(1), gaps).alias("l"), F.slice("_points", F.lit(2), gaps).alias("r")))
    df = df.withColumn("_covered", F.transform("_gaps", lambda g: F.struct(
        g["l"].alias("l"), g["r"].alias("r"), F.array_distinct(F.transform(
            F.filter("_spans", lambda s: (s["l"] <= g["l"]) & (g["r"] <= s["r"])),
            lambda s: s["label"])).alias("labels"))))
    parts = F.transform("_covered", lambda c: F.struct(
        F.substring(u, c["l"] + 1, c["r"] - c["l"]).alias("text"),
        (F.size(c["labels"]) > 0).alias("highlighted"),
        F.array_join(c["labels"], "; ").alias("label")))
    return df.select(*own, parts.alias(name))


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "MMM - dd - yyyy")


def iso_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def value_entry(name: str) -> Column:
    """A feature's entry in a JSON cell, as a floating number; what JSON has no number for is quoted."""
    value = _c(name).cast("double")
    text = value.cast("string")
    if name in K.DOUBLE_FEATURES:
        odd = F.isnan(value) | (F.abs(value) == float("inf"))
        text = F.when(odd, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)
    else:  # below ten millions a whole floating number's text is the number's own and one more digit
        whole = _c(name).cast("long")
        text = F.when((whole == value) & (F.abs(whole) < 10_000_000), F.concat(whole.cast("string"), F.lit(".0"))).otherwise(text)
    return F.concat(F.lit(f'"{name}":'), F.coalesce(text, F.lit("null")))


def value_cell(names: list[str], prefix: str | None = None) -> Column:
    """JSON cell {feature: value} of a term's features. With `prefix`, the entries are there as columns."""
    entries = [_c(prefix + n) if prefix else value_entry(n) for n in names]
    return F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}"))

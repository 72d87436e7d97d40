"""Features and URL parts against unit rows, published rows and the standard library."""

import ipaddress
import math
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from urlgauge import constants as K
from urlgauge.catalog import learning_queries
from urlgauge.functions import chars, features, hosts, plain, urls
from urlgauge.operators import explain, split


def compute(spark, addresses):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, url string")
    return [r.asDict() for r in features.with_features(df).orderBy("i").collect()]


# Published example addresses and the feature values known for them.
UNIT = [
    ("http://192.168.1.1/paypal/login.php", {"has_ip_address": 1, "subdomain_count": 0}),
    ("https://www.google.com/search?q=test", {"has_ip_address": 0}),
    ("http://secure-paypal-login-verify.xyz/account", {"is_suspicious_tld": 1}),
    ("https://www.wikipedia.org/wiki/Phishing", {"is_suspicious_tld": 0}),
    ("https://xn--pple-43d.com/signin", {"has_punycode": 1}),
    ("https://example.com", {"uses_https": 1}),
    ("http://example.com", {"uses_https": 0}),
    ("HTTPS://example.com", {"uses_https": 1}),
    ("https://www.example.com/a/b/c?x=1", {"url_length": 33}),
    ("http://bit.ly/3xample", {"is_known_shortener": 1}),
    ("http://example.com@evil.com/login", {"has_at_symbol": 1, "hostname_length": 8}),
    ("http://payp0l1d.com/login", {"homoglyph_char_ratio": 4 / 11}),
    ("not a real url at all", {"url_length": 21}),
    ("http://a.com:/", {"has_port": 0}),
    ("http://a.com:80/", {"has_port": 1}),
    ("http://real.com//evil.com", {"has_double_slash_redirect": 1}),
    ("first.com/first", {"brand_token_in_subdomain_or_path": 1}),  # 'irs' inside 'first'
    ("http://[::1]:8080/x", {"has_ip_address": 1, "has_port": 1, "hostname_length": 3}),
]

# Published example rows: 26 values in model order, domain group, split for seed 42.
PUBLISHED = [
    ("members.tripod.com/wodgotham1/", "domain:tripod.com", "train",
     [30, 18, 12, 0, 1, 0.0333333, 0, 0, 2, 2, 3.9736, 0, 1, 0, 0, 0, 0, 0.125, 0, 0, 3, 0, 0, 0, 0, 0]),
    ("http://92.222.70.178/SBIDIOT/arm6", "ip:92.222.70.178", "train",
     [33, 13, 13, 0, 11, 0.333333, 0, 0, 3, 4, 4.2336, 1, 0, 0, 10, 0, 0, 0.2, 0, 0, 3, 0, 0, 0, 0, 0]),
    ("https://premium57.web-hosting.com:2096/cpsess3669307974/horde/imp/dynamic.php?page=mailbox#",
     "domain:web-hosting.com", "train",
     [91, 25, 39, 12, 16, 0.175824, 3, 1, 3, 6, 4.8508, 0, 1, 1, 2, 0, 0, 0.0869565, 0, 0, 3, 0, 1, 0, 1, 0]),
    ("ohio.hometownlocator.com/counties/", "domain:hometownlocator.com", "test",
     [34, 24, 10, 0, 0, 0, 0, 0, 2, 2, 3.6901, 0, 1, 0, 0, 0, 0, 0.363636, 0, 0, 3, 0, 0, 0, 0, 0]),
    ("https://www.achauthorization.pages.dev", "domain:achauthorization.pages.dev", "test",
     [38, 30, 0, 0, 0, 0, 0, 0, 3, 2, 4.1357, 0, 2, 0, 0, 0, 0, 0.0740741, 0, 0, 3, 0, 1, 0, 0, 0]),
    ("https://www.mfaet.gov.sb", "domain:mfaet.gov.sb", "test",
     [24, 16, 0, 0, 0, 0, 0, 0, 3, 2, 3.8239, 0, 2, 0, 0, 0, 0, 0.0769231, 0, 0, 2, 0, 1, 0, 0, 0]),
]


def test_unit_rows(spark):
    for (address, wanted), row in zip(UNIT, compute(spark, [u for u, _ in UNIT])):
        for name, value in wanted.items():
            assert row[name] == pytest.approx(value), (address, name)


def test_parts_are_searched_not_matched(spark):
    """A pattern per part was a third of the time of the features, sorted arrays of characters a quarter."""
    df = spark.createDataFrame([("http://a.com/",)], "url string")
    assert "regexp_extract" not in urls.with_parts(df)._jdf.queryExecution().analyzed().toString()
    assert "_counted" in features.with_features(df)._jdf.queryExecution().analyzed().toString()


def test_characters_of_many_lengths(spark):
    """Counted in pieces of a batch: long texts, short ones, none, and others that go by the expressions."""
    texts = ["http://a.com/" + "ab%1" * 300_000, *[f"http://a{i}.com/{'x-_' * (i % 50)}" for i in range(5000)],
             "http://a.com/\u0660\u00e9~", "", "http://[", "http://b.com/" + "z9" * 700_000]
    for url, row in zip(texts, compute(spark, texts)):
        if url in ("", "http://["):
            assert row["entropy"] is None and row["digit_count"] is None
            continue
        counts = Counter(url).values()
        assert row["entropy"] == pytest.approx(-sum(c / len(url) * math.log2(c / len(url)) for c in counts), abs=6e-5)
        assert row["digit_count"] == sum(c.isdigit() for c in url)
        assert row["special_char_count"] == sum(not c.isalnum() and c not in "./:-" for c in url)


def test_published_rows(spark):
    df = spark.createDataFrame([(u,) for u, *_ in PUBLISHED], "url string")
    rows = hosts.url_group(features.with_features(df), rules=RULES).withColumn(
        "split", hosts.choose_split(F.col("domain_group")))
    found = {r["url"]: r for r in rows.collect()}
    for address, group, part, values in PUBLISHED:
        row = found[address]
        assert (row["domain_group"], row["split"]) == (group, part)
        for name, value in zip(K.FEATURES, values):
            assert row[name] == pytest.approx(value, abs=1e-5), (address, name)


def test_unusable_urls_have_no_features(spark):
    for row in compute(spark, ["", "http:///path", "http://[::1/", "http://a:99999/"]):
        assert all(row[n] is None for n in K.FEATURES)


text = st.text(st.sampled_from("abcXYZ019.-/:?#@%=&_ ~éß中٣²"), max_size=40)
addresses = st.builds(lambda a, b, c: a + b + c,
                      st.sampled_from(["", "http://", "HTTPS://", "ftp://", "1x://", "//"]),
                      st.sampled_from(["", "a.b.co.uk", "Shop.Example.COM:8080", "u:p@x.org", "10.0.0.1",
                                       "o0l1.xyz:", "[2001:db8::1]:443", "[::1]", "a.com:x"]), text)


def brute(address):
    """The same quantities from the standard library, or None when it cannot be parsed."""
    u = address.strip()
    head, mark, _ = u.partition("://")
    scheme_ok = mark and head[:1].isascii() and head[:1].isalpha() and all(
        c.isascii() and (c.isalnum() or c in "+.-") for c in head)
    try:
        got = urlsplit(u if scheme_ok else "http://" + u)
        host, port = (got.hostname or "").lower(), got.port
    except ValueError:
        return None
    if not host:
        return None
    sizes = Counter(u).values()
    try:
        ipaddress.ip_address(host)
        ip = 1
    except ValueError:
        ip = 0
    bare = host.replace(".", "")
    tail = host.split(".")[-1] if "." in host else ""
    return {
        "url_length": len(u), "hostname_length": len(host), "path_length": len(got.path),
        "query_length": len(got.query), "digit_count": sum(map(str.isdigit, u)),
        "special_char_count": len([c for c in u if not (c.isalnum() or c in "./:-")]),
        "entropy": sum(-n / len(u) * math.log2(n / len(u)) for n in sizes),
        "has_ip_address": ip, "hostname_digit_count": sum(map(str.isdigit, host)),
        "homoglyph_char_ratio": sum(bare.count(c) for c in "0o1l") / len(bare) if bare else 0.0,
        "tld_length": len(tail), "has_port": int(port is not None),
        "uses_https": int(got.scheme == "https"),
        "has_double_slash_redirect": int("//" in (u.split("://", 1)[1] if mark else u)),
    }


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(addresses, min_size=40, max_size=120))
def test_against_standard_library(spark, batch):
    for address, row in zip(batch, compute(spark, batch)):
        wanted = brute(address)
        if wanted is None:
            assert row["url_length"] is None, address
            continue
        for name, value in wanted.items():
            assert row[name] == pytest.approx(value, abs=6e-5), (address, name)


def test_reject_reasons_and_keys(spark):
    cases = {
        "": "empty_url", "http://a.com/\x01x": "literal_control_character",
        "http://a.com:99999/": "url_or_port_parse_error", "http://a.com:x/": "url_or_port_parse_error",
        "http://[::1/": "url_or_port_parse_error", "http:///path": "empty_hostname",
        "http://a b.com/": "whitespace_in_hostname", "http://a.com:/": "",
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r["url"]: r["reason"] for r in urls.inspect(df).collect()} == cases
    same = [("http://User@A.com/", "http://User@a.COM/"), ("HTTP://a.com", "http://a.com"),
            ("http://a.com/", "http://a.com/?"), ("http://a.com/", "http://a.com/#")]
    differ = [("http://User@a.com/", "http://user@a.com/"), ("a.com", "http://a.com"),
              ("http://a.com", "http://a.com/"), ("http://a.com/A", "http://a.com/a")]
    df = spark.createDataFrame([(u,) for u in {x for p in same + differ for x in p}], "url string")
    keys = {r["url"]: r["url_key"] for r in urls.inspect(df).collect()}
    assert all(keys[a] == keys[b] for a, b in same)
    assert all(keys[a] != keys[b] for a, b in differ)


def test_ip_literals(spark):
    names = ["::1", "1::", "::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "fe80::1%eth0", "1::2::3",
             "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.256", "12345::", "1.2.3.4", "01.2.3.4",
             "1.2.3", "256.1.1.1", "1:2:3:4:5:6:7::", "v1.a:b"]

    def known(host):
        try:
            return bool(ipaddress.ip_address(host))
        except ValueError:
            return False

    df = spark.createDataFrame([(n,) for n in names], "host string")
    for row in df.select("host", hosts.is_ip(F.col("host")).alias("ip")).collect():
        assert row["ip"] == known(row["host"]), row["host"]


# Enough rules for the published rows and the cases below.
RULES = ["com", "net", "org", "de", "dev", "se", "uk", "co.uk", "gov.sb", "eu.com", "pages.dev", "cprapid.com", "cloudns.nz", "nz",
         "*.ck", "!www.ck", "cn", "com.cn", "*.compute.amazonaws.com.cn"]


def test_host_groups(spark):
    wanted = {
        "a.b.co.uk": "domain:b.co.uk", "co.uk": "domain:co.uk", "y.x.ck": "domain:y.x.ck", "x.ck": "domain:x.ck",
        "a.www.ck": "domain:www.ck", "b.a.pages.dev": "domain:a.pages.dev", "pages.dev": "domain:pages.dev",
        "localhost": "domain:localhost", "a.b.c.unknown": "domain:c.unknown", "1.2.3.4": "ip:1.2.3.4",
        "FE80::0:1": "ip:fe80::1", "x%2Ecom": "domain:x.com", "b\u00fccher.de": "domain:xn--bcher-kva.de",
        "compute.amazonaws.com.cn": "domain:amazonaws.com.cn", "100%.a+b.com": "domain:a+b.com",
        "a.b.compute.amazonaws.com.cn": "domain:a.b.compute.amazonaws.com.cn", "1.2.3.04": "domain:3.04",
    }
    df = spark.createDataFrame([(h,) for h in wanted], "host string")
    assert {r["host"]: r["domain_group"] for r in hosts.host_group(df, "host", RULES).collect()} == wanted
    rules = spark.createDataFrame([(r,) for r in RULES + [f"r{i}.com" for i in range(3000)]], "rule string")
    assert {r["host"]: r["domain_group"] for r in hosts.host_group(df, "host", rules).collect()} == wanted
    with pytest.raises(ValueError):
        hosts.host_group(df, "host", None)


def test_short_ipv6(spark):
    names = ["::", "::1", "1::", "0:0:1:0:0:0:2:0", "1:0:0:2:3:0:0:4", "0001:00a0::0f", "1:2:3:4:5:6:7:8", "::1.2.3.4",
             "::ffff:1.2.3.4", "fe80::1%eth0", "1:0:3:4:5:6:7:8", "64:ff9b::192.0.2.33", "0:0:0:0:0:0:0:0", "1:0:0:0:0:0:0:0"]
    df = spark.createDataFrame([(n,) for n in names], "host string")
    for r in df.select("host", hosts.short_ipv6(F.col("host")).alias("short")).collect():
        assert r["short"] == ipaddress.ip_address(r["host"]).compressed, r["host"]


def test_no_host_is_an_error(spark):
    for address in ("http:///x", None):
        with pytest.raises(Exception, match="without a host"):
            hosts.url_group(spark.createDataFrame([(address,)], "url string"), rules=RULES).collect()
    with pytest.raises(Exception, match="no split"):
        spark.range(1).select(hosts.choose_split(F.lit(None).cast("string"))).collect()


def test_groups_scan_once(spark, sf_dir):
    df = hosts.url_group(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules=RULES)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_older_record_searches_for_parts(spark):
    """Three patterns per URL told whether it is usable before; the searches must tell the same of odd URLs."""
    rng = np.random.default_rng(5)
    bits = ["http", "://", ":", "/", "?", "#", "@", "[", "]", "a.com", "1.2.3.4", ":80", ":99999", "::1", " ", "\t", "\n", "é", "%41", "x", "０", "／", "", " "]
    odd = ["".join(rng.choice(bits, rng.integers(0, 9))) for _ in range(3000)] + [None, "", "http://a.com:8\n0/", "http://[::1/"]
    df = urls.with_parts(spark.createDataFrame([(u,) for u in odd], "url string").withColumn("u", urls.strip(F.col("url"))), "u", "_v_")
    searched = (F.col("_v_host") != "") & ~urls.bad_authority("_v_")
    trimmed = F.btrim("url", F.lit(chars.whitespace()))
    assert df.where(~F.col("u").eqNullSafe(trimmed) | ~searched.eqNullSafe(urls.usable(trimmed))).count() == 0
    plan = explain.score_urls_older(df.select("url"), learning_queries.fixed_fit(spark, "full"))._jdf.queryExecution().analyzed().toString()
    assert urls.PART_PATTERNS["host"] not in plan


def test_urls_are_parsed_once_for_checks_features_and_groups(spark):
    """A score record parsed its URL twice, and a group parsed what features had; odd URLs still have the same groups."""
    rng = np.random.default_rng(7)
    bits = ["http", "://", ":", "/", "?", "@", "[", "]", "a.com", "1.2.3.4", ":80", ":x", "::1", "\t", "\n", "b.co.uk", "%41", "０", "."]
    odd = ["http://a" + "".join(rng.choice(bits, rng.integers(0, 7))) for _ in range(1500)] + ["http://a\t.com/", "b.example.com:99999/"]
    df = spark.createDataFrame([(u,) for u in odd], "url string")
    hosted = urls.host_of(urls.hostport(urls.strip(F.col("url"))))
    found = df.withColumn("h", hosted).toPandas()
    df = spark.createDataFrame([(u,) for u in found.url[found.h != ""]], "url string")
    rows = features.with_features(df, keep_parts=True)
    both = [split.assign(rows, rules=["com", "co.uk"], host=h).select("url", "domain_group", "split").toPandas() for h in ("host", None)]
    assert both[0].equals(both[1]) and len(both[0]) > 1000
    plan = explain.score_urls(df, learning_queries.FIXED)._jdf.queryExecution().analyzed().toString()
    assert plan.count(" AS _v_hostport#") == 1 and " AS _hostport#" not in plan


def test_filters_on_scores_do_not_copy_them(spark):
    """A filter on validity took the score function and all features along, once per term, and the plan outgrew the memory."""
    df = spark.createDataFrame([("http://a.com/",), ("",)], "url string")
    kept = explain.score_urls(df, learning_queries.FIXED).where("valid").select("url", "trust_score")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("look(") == 1 and kept.count() == 1


def test_plain_urls_are_found_at_once(spark, monkeypatch):
    """Every URL went through all expressions, most of them for nothing; now they see a null in place of a plain one."""
    rng = np.random.default_rng(11)
    bits = ["http", "HTTPS", "://", ":", "/", "//", "?", "#", "@", "[", "]", ".", "-", "a.com", "paypal", "APPLE", "1.2.3.4", "01.2.3.4",
            ":80", ":99999", "::1", " ", "\t", "\x1f", "é", "%41", "xn--", "XN--", "0o1l", "OL", "bit.ly", ".xyz", "\x7f"]
    odd = ["http://" * (i % 2) + "".join(rng.choice(bits, rng.integers(0, 9))) for i in range(4000)] + [None, "", " http://a.com/ "]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(odd)], "i int, url string")
    found = features.with_features(df, keep_parts=True).drop("spelled").orderBy("i").toPandas()
    plain_ones = df.select(plain.measured(df, "url")["plain"]).toPandas().iloc[:, 0].sum()
    # Without plain URLs every one goes by the expressions.
    counted = plain.measured(df, "url")
    none = F.struct(F.lit(0).alias("plain"), F.lit("").alias("host"), F.lit("").alias("spelled"), *[counted[n].alias(n) for n in plain.NAMES[1:]])
    monkeypatch.setattr(plain, "measured", lambda *_: none)
    assert found.equals(features.with_features(df, keep_parts=True).drop("spelled").orderBy("i").toPandas()) and plain_ones > 500


def test_names_are_spelled_with_the_features(spark):
    """Groups sent all rows through a second function, for the few names that go beyond ASCII."""
    df = spark.createDataFrame([(u,) for u in ("http://bücher.example/", "http://b%C3%BCcher.example/%41", "http://a.com/é", "http://Ａ.com/")], "url string")
    rows = features.with_features(df, keep_parts=True)
    own = split.assign(rows, rules=["com", "example"], host="host", spelling="spelled").drop("host", "spelled")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_with_hosts(") == 1 and "spelled(" not in plan
    assert sorted(own.toPandas().domain_group) == sorted(hosts.url_group(df, rules=["com", "example"]).toPandas().domain_group)


def test_split_by_digits(spark):
    """A number, a decimal and a double were made of every hash; its digits compare in the same order."""
    for share in (K.TRAIN_BELOW, K.VALIDATION_BELOW):
        first = int(hosts._first_from(share), 16)
        assert first / 2.0 ** 64 >= share > (first - 1) / 2.0 ** 64


def test_filters_on_features_do_not_copy_them(spark):
    """A filter on all features took their expressions down with it, each copied into the next, until the memory ran out."""
    rows = features.with_features(spark.createDataFrame([("http://a.com/",), ("",)], "url string"))
    kept = rows.withColumn("ok", features.finite()).where("ok")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("_alone(") == 1 and kept.count() == 1

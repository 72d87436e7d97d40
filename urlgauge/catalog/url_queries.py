"""Sources, URL functions and features (inventory groups A, B and C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import cards, features, hosts, urls
from ..operators import prepare, split
from ..sources import publish, registry, tables
from . import inputs as I, sql as S
from .registry import query

LARGER = registry.SOURCES["larger"]


def parsed(spark, sf_dir, sql=I.ALL_URLS):
    df = I.view(spark, sf_dir, sql) if isinstance(sql, str) else sql
    return urls.with_parts(df.withColumn("u", urls.strip(F.col("url"))), "u")


def featured(spark, sf_dir):
    return features.with_features(I.all_urls(spark, sf_dir))


def rounded(df, names=K.FEATURES):
    return [F.round(n, 6).alias(n) if n in K.DOUBLE_FEATURES else F.col(n) for n in names]


EDGE_URLS = f"select distinct url from ({I.EDGE_V}) e"


# --- A. sources ---------------------------------------------------------------

@query("a01_raw_scan", f"select url, original_label from ({I.URLS_V}) v")
def a01(spark, sf_dir):
    return I.view(spark, sf_dir, I.URLS_V).select(
        F.coalesce("url", F.lit("")).alias("url"), F.coalesce("original_label", F.lit("")).alias("original_label"))


@query("a02_source_row", S.with_(S.raw(I.URLS_V), "select source_row, url, original_label from src"))
def a02(spark, sf_dir):
    return I.raw(spark, sf_dir).select("source_row", "url", "original_label")


@query("a03_contract", S.with_(S.prepared(), "kept as (select url, label from routes where route = 'kept')",
                               S.featured("kept", "2"), f"""
 select count(*) as rows, count_if(label is null or label not in (0, 1))::bigint as bad_label,
 0::bigint as not_finite, count_if(least({', '.join(K.COUNT_FEATURES)}) < 0)::bigint as negative,
 count_if(label = 0)::bigint as label_0_rows, count_if(label = 1)::bigint as label_1_rows from feats2"""))
def a03(spark, sf_dir):
    from ..plans import scratch
    path = scratch.folder(spark, "a03")
    kept = prepare.routed(I.raw(spark, sf_dir), LARGER).where("route = 'kept'")
    features.with_features(kept.select("url", "label")).write.parquet(path)
    return tables.contract(tables.read_features(spark, path, check=False))


@query("a04_partition_read", S.with_(S.PAGES, S.parse(), S.grouped(), """
 select id, url, domain_group from grouped where split = 'validation'"""))
def a04(spark, sf_dir):
    from ..plans import scratch
    path = scratch.folder(spark, "a04")
    split.assign(I.pages(spark, sf_dir), rules=I.RULES).write.partitionBy("split").parquet(path)
    return tables.read_split(spark, path, "validation").select("id", "url", "domain_group")


@query("a05_csv_round_trip", """select page_id as id, url, '"' || url || '",' || chr(10) || ' x' as quoted from pages""")
def a05(spark, sf_dir):
    """A publication's CSV output, with quotes, commas and line feeds in its cells, read back."""
    from ..plans import scratch
    out = publish.Publication(spark, scratch.folder(spark, "a05"))
    quoted = F.concat(F.lit('"'), "url", F.lit('",\n x'))
    out.csv("pages", I.pages(spark, sf_dir).withColumn("quoted", quoted))
    return spark.read.schema("id long, url string, quoted string").csv(
        out.publish() + "/pages", header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False)


@query("a06_publish_once", "select page_id as id, url, true as second_run_refused from pages")
def a06(spark, sf_dir):
    from ..plans import scratch
    folder = scratch.folder(spark, "a06")
    first = publish.Publication(spark, folder)
    first.table("rows", I.pages(spark, sf_dir))
    first.publish()
    try:
        publish.Publication(spark, folder)
        refused = False
    except FileExistsError:
        refused = True
    return spark.read.parquet(f"{folder}/rows").withColumn("second_run_refused", F.lit(refused))


@query("a07_manifest", "select count(*) as rows, true as unchanged from pages")
def a07(spark, sf_dir):
    from ..plans import scratch
    folder = scratch.folder(spark, "a07")
    rows = I.pages(spark, sf_dir)
    publish.write_manifest(spark, folder, {"table": publish.fingerprint(rows)})
    recorded = publish.read_manifest(spark, folder)["table"]
    same = publish.check_fingerprint(rows, recorded, "pages")
    return same.agg(F.count("*").alias("rows")).withColumn("unchanged", F.lit(True))


@query("a08_fingerprint", """
select count(*) as rows, sum(('0x' || substr(sha256(concat_ws(chr(31), cast(page_id as varchar),
 coalesce(url, '\\N'))), 1, 15))::UBIGINT::HUGEINT)::varchar as digest_sum from pages""")
def a08(spark, sf_dir):
    return tables.table_fingerprint(I.pages(spark, sf_dir))


@query("a08_file_fingerprint")
def a08f(spark, sf_dir):
    return tables.file_fingerprints(spark, f"{sf_dir}/pages.parquet")


@query("a08_file_trees")
def a08t(spark, sf_dir):
    """Blocks of 1 MB, so that the larger tables have several levels."""
    return tables.file_trees(spark, f"{sf_dir}/lineitem.parquet", block=1 << 20, fan=4)


@query("a10_history_read", S.with_(S.HISTORY, """
 select id, url, trust_score, risk_percent, status, strftime(ts, '%b - %d - %Y') as checked_at from history"""))
def a10(spark, sf_dir):
    from ..plans import scratch
    path = scratch.folder(spark, "a10")
    entries = I.history(spark, sf_dir)
    entries.withColumns({
        "reasons": F.lit(None).cast(cards.CARD_TYPE), "checked_at": cards.day_label(F.col("ts"))}
    ).write.mode("append").parquet(path)
    return tables.read_history(spark, path).select(
        "id", "url", "trust_score", "risk_percent", "status", "checked_at")


@query("a11_request_source", "select cast(page_id as varchar) as request_id, url from pages")
def a11(spark, sf_dir):
    from ..plans import scratch
    path = scratch.folder(spark, "a11")
    I.pages(spark, sf_dir).select(
        F.col("id").cast("string").alias("request_id"), "url", F.lit(None).cast("timestamp").alias("ts")
    ).write.json(path)
    return tables.read_requests(spark, path).select("request_id", "url")


# --- B. URL functions ---------------------------------------------------------

@query("b01_trim", S.with_(S.ALL, S.parse(), "select url, u as trimmed, url <> u as changed from parsed"))
def b01(spark, sf_dir):
    u = F.col("url")
    return I.all_urls(spark, sf_dir).select("url", urls.strip(u).alias("trimmed"),
                                            urls.was_trimmed(u).alias("changed"))


@query("b01_trimmed_rows", S.with_(S.src(I.URLS_V), S.parse(),
                                   "select count(*) as rows, count_if(url <> u)::bigint as trimmed_rows from parsed"))
def b01_rows(spark, sf_dir):
    return I.view(spark, sf_dir, I.URLS_V).agg(
        F.count("*").alias("rows"), F.count_if(urls.was_trimmed(F.col("url"))).alias("trimmed_rows"))


@query("b02_scheme", S.with_(S.ALL, S.parse(), "select url, has_scheme, work from parsed"))
def b02(spark, sf_dir):
    u = urls.strip(F.col("url"))
    return I.all_urls(spark, sf_dir).select(
        "url", urls.has_scheme(u).alias("has_scheme"), urls.working_url(u).alias("work"))


@query("b03_url_parts", S.with_(S.BOTH, S.parse(), """
 select url, scheme, netloc, path, query, fragment, host, port_text from parsed"""))
def b03(spark, sf_dir):
    rows = parsed(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e")
    return rows.select(
        "url", *[F.col("_" + n).alias(n) for n in
                 ("scheme", "netloc", "path", "query", "fragment", "host", "port_text")])


@query("b04_host_port", S.with_(S.BOTH, S.parse(), """
 select url, length(netloc) - length(hostport) as user_length, lower(hostport) as host_port from parsed"""))
def b04(spark, sf_dir):
    rows = parsed(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e")
    return rows.select("url", (F.length("_netloc") - F.length("_hostport")).alias("user_length"),
                       F.lower("_hostport").alias("host_port"))


@query("b05_reject_reason", S.with_(S.prepared(I.EDGE_V), "select source_row, url, reason from routes"))
def b05(spark, sf_dir):
    return prepare.inspected(I.raw_edges(spark, sf_dir), LARGER).select("source_row", "url", "reason")


@query("b06_url_key", S.with_(S.BOTH, S.parse(), f"""
 select url, case when {S.REASON} = '' then {S.KEY} else '' end as url_key from parsed"""))
def b06(spark, sf_dir):
    both = I.view(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e")
    rows = urls.inspect(both.withColumn("u", urls.strip(F.col("url"))), "u")
    return rows.select("url", "url_key")


@query("b07_metadata_hostname", S.with_(S.ALL, S.parse(), "select url, rtrim(host, '.') as hostname from parsed"))
def b07(spark, sf_dir):
    return parsed(spark, sf_dir).select("url", urls.metadata_hostname().alias("hostname"))


@query("b08_label_map", S.with_(S.prepared(I.EDGE_V), """
 select source_row, original_label, original_category, label from routes"""))
def b08(spark, sf_dir):
    return prepare.labelled(I.raw_edges(spark, sf_dir), LARGER).select(
        "source_row", "original_label", "original_category", "label")


@query("b09_registrable", S.with_(S.ALL, S.parse(), f"select url, {S._REG} as registrable from parsed"))
def b09(spark, sf_dir):
    return parsed(spark, sf_dir).select("url", hosts.registrable(F.col("_host")).alias("registrable"))


@query("b10_tld", S.with_(S.ALL, S.parse(), f"select url, {S._TLD} as tld from parsed"))
def b10(spark, sf_dir):
    return parsed(spark, sf_dir).select("url", hosts.tld(F.col("_host")).alias("tld"))


@query("b11_entropy", S.with_(S.ALL, S.parse(), """
 select url, round(coalesce(list_aggregate(string_split(u, ''), 'entropy'), 0), 6) as bits from parsed"""))
def b11(spark, sf_dir):
    return I.all_urls(spark, sf_dir).select(
        "url", F.round(features.entropy(urls.strip(F.col("url"))), 6).alias("bits"))


@query("b12_ip_host", S.with_(S.BOTH, S.parse(), f"""
 select url, {S._IP} or (contains(host, ':') and regexp_matches(host, '^2001:db8::[0-9]$')) as is_ip
 from parsed where host <> '' and not {S._PARSE_ERROR}"""))
def b12(spark, sf_dir):
    rows = parsed(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e")
    return rows.where((F.col("_host") != "") & ~urls.bad_authority()).select(
        "url", hosts.is_ip(F.col("_host")).alias("is_ip"))


@query("b13_host_group", S.with_(S.ALL, S.parse(), S.grouped(), """
 select distinct host, domain_group from grouped"""))
def b13(spark, sf_dir):
    names = parsed(spark, sf_dir).select(F.col("_host").alias("host")).distinct()
    return hosts.host_group(names, "host", I.RULES)


@query("b13_host_group_rule_table", S.with_(S.ALL, S.parse(), S.grouped(), """
 select distinct host, domain_group from grouped"""))
def b13_rules(spark, sf_dir):
    names = parsed(spark, sf_dir).select(F.col("_host").alias("host")).distinct()
    rules = spark.createDataFrame([(r,) for r in I.RULES], "rule string")
    return hosts.host_group(names, "host", rules)


# Wildcards, an exception, hosts that are a suffix or a wildcard's base, escapes, addresses, foreign letters.
ODD_RULES = ["com", "cn", "com.cn", "*.ck", "!www.ck", "*.compute.amazonaws.com.cn", "co.uk", "de"]


@query("b13_odd_hosts", """
with s as (select distinct s_suppkey % 11 as kind, cast(s_suppkey as varchar) as n, s_suppkey % 256 as b, s_suppkey % 65536 as w from supplier)
select distinct case kind when 0 then 'a.b' || n || '.ck' when 1 then 'x.www.ck' when 2 then 'b' || n || '.ck'
  when 3 then 'compute.amazonaws.com.cn' when 4 then 'h' || n || '.r.compute.amazonaws.com.cn' when 5 then 'com.cn'
  when 6 then 'A' || n || '%2EShop.com.' when 7 then '2001:0db8::' || printf('%04x', w) when 8 then '10.0.0.' || b
  when 9 then 'www.b' || chr(252) || 'cher.de' else 'a.b' || n || '.zz' end as host,
 case kind when 0 then 'domain:a.b' || n || '.ck' when 1 then 'domain:www.ck' when 2 then 'domain:b' || n || '.ck'
  when 3 then 'domain:amazonaws.com.cn' when 4 then 'domain:h' || n || '.r.compute.amazonaws.com.cn' when 5 then 'domain:com.cn'
  when 6 then 'domain:shop.com' when 7 then case when w = 0 then 'ip:2001:db8::' else 'ip:2001:db8::' || printf('%x', w) end
  when 8 then 'ip:10.0.0.' || b when 9 then 'domain:xn--bcher-kva.de' else 'domain:b' || n || '.zz' end as domain_group
from s""")
def b13_odd(spark, sf_dir):
    number = F.col("s_suppkey")
    text = number.cast("string")
    kind = number % 11
    host = (F.when(kind == 0, F.concat(F.lit("a.b"), text, F.lit(".ck"))).when(kind == 1, "x.www.ck")
            .when(kind == 2, F.concat(F.lit("b"), text, F.lit(".ck"))).when(kind == 3, "compute.amazonaws.com.cn")
            .when(kind == 4, F.concat(F.lit("h"), text, F.lit(".r.compute.amazonaws.com.cn"))).when(kind == 5, "com.cn")
            .when(kind == 6, F.concat(F.lit("A"), text, F.lit("%2EShop.com.")))
            .when(kind == 7, F.concat(F.lit("2001:0db8::"), F.lpad(F.lower(F.hex(number % 65536)), 4, "0")))
            .when(kind == 8, F.concat(F.lit("10.0.0."), (number % 256).cast("string")))
            .when(kind == 9, "www.b\u00fccher.de").otherwise(F.concat(F.lit("a.b"), text, F.lit(".zz"))))
    names = I.table(spark, sf_dir, "supplier").select(host.alias("host")).distinct()
    return hosts.host_group(names, "host", ODD_RULES)


@query("b14_url_group", S.with_(S.ALL, S.parse(), S.grouped(), "select url, domain_group from grouped"))
def b14(spark, sf_dir):
    return hosts.url_group(I.all_urls(spark, sf_dir), rules=I.RULES)


@query("b15_choose_split", S.with_(S.ALL, S.parse(), S.grouped(), "select url, domain_group, split from grouped"))
def b15(spark, sf_dir):
    return split.assign(I.all_urls(spark, sf_dir), rules=I.RULES).select("url", "domain_group", "split")


_STRICT = f"""case when u = '' then 'EMPTY' when length(u) > 8192 then 'TOO_LONG'
 when regexp_matches(u, '[\\x00-\\x20\\x7f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]') then 'WHITESPACE'
 when scheme not in ('http', 'https') or host = '' or {S._PARSE_ERROR} then 'INVALID' end"""


def _message(messages):
    return "case code " + " ".join(f"when '{k}' then '{v}'" for k, v in messages.items()) + " end"


@query("b16_validate", S.with_(S.BOTH, S.parse(), f"coded as (select url, {_STRICT} as code from parsed)", f"""
 select url, code is null as valid, code as error_code, {_message(K.MESSAGES)} as error_message from coded"""))
def b16(spark, sf_dir):
    return urls.validate(I.view(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e"))


_FORM = f"""case when u = '' then 'EMPTY' when length(url) > 2048 then 'TOO_LONG'
 when regexp_matches(url, '[\\x00-\\x1f\\x7f]') then 'CONTROL'
 when regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.\\-]*:') and not regexp_matches(u, '^(?i:https?):') then 'SCHEME'
 when not has_scheme or {S._PARSE_ERROR} or host = '' or regexp_matches(host, '[\\s<>^|%\\\\]') then 'INVALID'
 when not contains(host, '.') and host <> 'localhost' then 'HOST'
 when substr(netloc, 1, length(netloc) - length(hostport)) not in ('', '@', ':@') then 'USERINFO' end"""


@query("b16_validate_form", S.with_(S.BOTH, S.parse(), f"coded as (select url, {_FORM} as code from parsed)", f"""
 select url, code is null as valid, code as error_code, {_message(K.FORM_MESSAGES)} as error_message from coded"""))
def b16_form(spark, sf_dir):
    return urls.validate_form(I.view(spark, sf_dir, f"{I.ALL_URLS} union select url from ({I.EDGE_V}) e"))


_P = "round(value / 100, 4)"


@query("b17_sigmoid", """
select event_id, round(1 / (1 + exp(-(value - 50) / 10)), 9) as probability from events""")
def b17(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select(
        "event_id", F.round(cards.sigmoid((F.col("value") - 50) / 10), 9).alias("probability"))


@query("b18_scores", S.with_(S.src(f"select event_id, least(greatest(value / 100, 0), 1) as p from events"), """
 select event_id, printf('%.1f', (1 - p) * 100)::double as trust_score, printf('%.1f', p * 100)::double as risk_percent,
 cast(p >= 0.5 as int) as prediction, round(greatest(p, 1 - p) * 100, 6) as confidence from src"""))
def b18(spark, sf_dir):
    p = F.col("p")
    rows = I.table(spark, sf_dir, "events").select("event_id", F.least(
        F.greatest(F.col("value") / 100, F.lit(0.0)), F.lit(1.0)).alias("p"))
    return rows.select("event_id", cards.trust_score(p).alias("trust_score"),
                       cards.risk_percent(p).alias("risk_percent"), cards.prediction(p).alias("prediction"),
                       F.round(cards.confidence(p), 6).alias("confidence"))


@query("b19_status", S.with_(S.HISTORY, f"""
 select id, case when risk_percent >= 50 then 'Potential phishing' else 'Lower predicted risk' end as two_way,
 case when trust_score >= 70 then 'Safe' when trust_score >= 40 then 'Risky' else 'Dangerous' end as three_way,
 {S.SHOWN} as shown from history"""))
def b19(spark, sf_dir):
    return I.history(spark, sf_dir).select(
        "id", cards.status(F.col("risk_percent") / 100).alias("two_way"),
        cards.status3(F.col("trust_score")).alias("three_way"),
        cards.display_status(F.col("status"), F.col("trust_score")).alias("shown"))


def exploded(df, column, *keep):
    return df.select(*keep, F.posexplode_outer(column).alias("position", "card")).select(
        *keep, "position", "card.title", "card.flagged", "card.detail")


def _cards_sql(cards_):
    union = " union all ".join(
        f"select url, {i} as position, '{t}' as title, {f} as flagged, {d} as detail from feats"
        for i, (t, f, d) in enumerate(cards_))
    return S.with_(S.ALL, S.featured(), union)


@query("b20_indicators", _cards_sql([
    ("IP address host", "has_ip_address = 1", "case when has_ip_address = 1 then 'Detected' else 'Not detected' end"),
    ("URL length", "url_length > 60", "concat(url_length, ' characters; indicator cutoff is over 60')"),
    ("TLD watchlist", "is_suspicious_tld = 1",
     "case when is_suspicious_tld = 1 then 'In the illustrative watchlist' else 'Not in the watchlist' end"),
    ("Subdomain count heuristic", "subdomain_count >= 3", "concat(subdomain_count, '; indicator cutoff is 3 or more')"),
    ("Punycode hostname", "has_punycode = 1",
     "case when has_punycode = 1 then 'Encoded hostname detected' else 'Not detected' end"),
    ("Look-alike character heuristic", "homoglyph_char_ratio > 0.35",
     "concat(printf('%.1f', homoglyph_char_ratio * 100), '% of hostname characters; cutoff is over 35%')"),
]))
def b20(spark, sf_dir):
    return exploded(featured(spark, sf_dir).select("url", cards.indicators().alias("c")), "c", "url")


@query("b21_signal_cards", _cards_sql([
    ("IP Address", "has_ip_address = 1", "case when has_ip_address = 1 then 'Detected' else 'Not Detected' end"),
    ("URL Length", "url_length > 60",
     "concat(case when url_length > 60 then 'Long' else 'Normal' end, ' (', url_length, ' characters)')"),
    ("Suspicious TLD", "is_suspicious_tld = 1",
     "case when is_suspicious_tld = 1 then 'Detected' else 'Not Detected' end"),
    ("Subdomain Count", "subdomain_count >= 3",
     "concat(case when subdomain_count >= 3 then 'High' when subdomain_count <= 1 then 'Low' else 'Moderate' end,"
     " ' (', subdomain_count, ')')"),
]))
def b21(spark, sf_dir):
    return exploded(featured(spark, sf_dir).select("url", cards.signal_cards().alias("c")), "c", "url")


def _shown(name):
    if name in K.FLAG_FEATURES:
        return f"case when {name} <> 0 then 'Yes' else 'No' end"
    return f"printf('%.4f', {name})" if name in K.DOUBLE_FEATURES else f"cast({name} as varchar)"


@query("b22_display_value", S.with_(S.ALL, S.featured(), "select url, " + ", ".join(
    f"{_shown(n)} as {n}" for n in K.FEATURES) + " from feats"))
def b22(spark, sf_dir):
    return featured(spark, sf_dir).select("url", *[cards.display_value(n).alias(n) for n in K.FEATURES])


# Positions one by one: every character gets the labels covering it, equal neighbours between
# span ends are glued back together.
_HIGHLIGHT = f"""
placed as (select *, length(regexp_extract(u, '{S._SCHEME}', 0)) + length(netloc) - length(hostport) as s0,
  case when starts_with(hostport, '[') then regexp_extract(hostport, '^[^\\]]*\\]', 0)
       else regexp_extract(hostport, '^[^:]*', 0) end as rawhost from feats),
spans as (
  select url, 0 as o, s0 as l, s0 + length(rawhost) as r, 'IP address host' as label from placed where has_ip_address = 1
  union all select url, 1, s0 + length(rawhost) - length(regexp_extract(rawhost, '[^.]*$', 0)), s0 + length(rawhost),
   'TLD watchlist' from placed where is_suspicious_tld = 1 and contains(rawhost, '.')
  union all select url, 2, s0, s0 + length(regexp_extract(rawhost, '^(.*)[.][^.]*[.][^.]*$', 1)),
   'Subdomain count heuristic' from placed where subdomain_count >= 3
  union all select url, 3, s0 + a, s0 + a + length(part), 'Punycode hostname' from (
    select url, s0, part, coalesce(sum(length(part) + 1) over (partition by url order by i rows between unbounded preceding and 1 preceding), 0)::bigint as a
    from (select url, s0, unnest(string_split(rawhost, '.')) as part, generate_subscripts(string_split(rawhost, '.'), 1) as i
      from placed where has_punycode = 1)) where contains(lower(part), 'xn--')
  union all select url, 4, s0 + i - 1, s0 + i, 'Look-alike character heuristic' from (
    select url, s0, unnest(string_split(rawhost, '')) as ch, generate_subscripts(string_split(rawhost, ''), 1) as i
    from placed where homoglyph_char_ratio > 0.35) where lower(ch) in ('0', 'o', '1', 'l')
  union all select url, 5, 60, length(u), 'URL extends beyond 60 characters' from placed where url_length > 60),
ends as (select url, 0 as pos from placed union select url, length(u) from placed
  union select url, l from spans union select url, r from spans),
gaps as (select url, pos as l, lead(pos) over (partition by url order by pos) as r from ends),
parts as (select g.url, g.l, g.r, (select string_agg(label, '; ' order by o) from
   (select distinct o, label from spans s where s.url = g.url and s.l <= g.l and g.r <= s.r)) as label
  from gaps g where g.r is not null)"""


@query("b23_highlight", S.with_(S.ALL, S.featured(), _HIGHLIGHT, """
 select parts.url, l as position, substr(u, l + 1, r - l) as text, label is not null as highlighted, coalesce(label, '') as label
 from parts join placed on parts.url = placed.url"""))
def b23(spark, sf_dir):
    rows = featured(spark, sf_dir).withColumn("u", urls.strip(F.col("url")))
    parts = cards.with_highlight(rows, "u", "parts").select("url", "parts").select(
        "url", F.transform("parts", lambda p: F.length(p["text"])).alias("sizes"),
        F.posexplode_outer("parts").alias("n", "p"))
    start = F.aggregate(F.slice("sizes", F.lit(1), F.col("n")), F.lit(0), lambda a, x: a + x)
    return parts.select("url", start.alias("position"), "p.text", "p.highlighted", "p.label")


@query("b25_date_labels", """
select event_id, strftime(ts, '%b - %d - %Y') as day_label, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso_stamp from events""")
def b25(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select(
        "event_id", cards.day_label(F.col("ts")).alias("day_label"), cards.iso_stamp(F.col("ts")).alias("iso_stamp"))


@query("b26_value_cell", S.with_(S.ALL, S.featured(), """
 select url, concat('{"url_length":', url_length, '.0,"dot_count":', dot_count, '.0}') as cell from feats"""))
def b26(spark, sf_dir):
    return featured(spark, sf_dir).select("url", cards.value_cell(["url_length", "dot_count"]).alias("cell"))


# --- C. features --------------------------------------------------------------

@query("c00_all_features", S.with_(S.ALL, S.parse(), f"select url, {S.feature_list()} from parsed"))
def c00(spark, sf_dir):
    df = featured(spark, sf_dir)
    return df.select("url", *rounded(df))


def _one(number, name):
    @query(f"c{number:02d}_{name}", S.with_(S.ALL, S.parse(), f"select url, {S.ROUNDED[name]} as {name} from parsed"))
    def one(spark, sf_dir):
        df = featured(spark, sf_dir)
        return df.select("url", *rounded(df, [name]))


for _number, _name in enumerate(K.FEATURES, start=1):
    _one(_number, _name)


@query("c27_feature_validity", S.with_(S.EDGES, S.parse(), f"""
 select url, not (host = '' or {S._PARSE_ERROR}) as usable from parsed"""))
def c27(spark, sf_dir):
    rows = features.with_features(I.view(spark, sf_dir, EDGE_URLS))
    return rows.select("url", features.finite().alias("usable"))

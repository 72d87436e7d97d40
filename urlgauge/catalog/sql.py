"""The same operators as SQL text over the given tables, written on its own terms."""

from __future__ import annotations

from .. import constants as K
from . import inputs

_WS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
_URL = r"(?s)^([a-zA-Z][a-zA-Z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def with_(*parts: str) -> str:
    """Join CTE texts and a final select."""
    return "with " + ", ".join(parts[:-1]) + " " + parts[-1]


def src(sql: str, name: str = "src") -> str:
    return f"{name} as ({sql})"


PAGES = src("select page_id as id, url from pages")
ALL = src(inputs.ALL_URLS)
EDGES = src(f"select distinct url from ({inputs.EDGE_V}) e")
BOTH = src(f"{inputs.ALL_URLS} union select url from ({inputs.EDGE_V}) e")


def parse(source: str = "src", tag: str = "") -> str:
    """CTEs up to `parsed`: u, has_scheme, scheme, netloc, path, query, fragment, host, port_text."""
    return f"""
trimmed{tag} as (select *, regexp_replace(regexp_replace(url, '^{_WS}+', ''), '{_WS}+$', '') as u from {source}),
worked{tag} as (select *, regexp_matches(u, '{_SCHEME}') as has_scheme,
  case when regexp_matches(u, '{_SCHEME}') then u else concat('http://', u) end as work from trimmed{tag}),
pieces{tag} as (select *, lower(regexp_extract(work, '{_URL}', 1)) as scheme,
  regexp_extract(work, '{_URL}', 2) as netloc, regexp_extract(work, '{_URL}', 3) as path,
  regexp_extract(work, '{_URL}', 4) as query, regexp_extract(work, '{_URL}', 5) as fragment from worked{tag}),
authority{tag} as (select *, regexp_extract(netloc, '(?s)^(?:.*@)?(.*)$', 1) as hostport from pieces{tag}),
parsed{tag} as (select *,
  lower(case when contains(hostport, '[') then regexp_extract(hostport, '\\[([^\\]]*)', 1)
        else regexp_extract(hostport, '^([^:]*)', 1) end) as host,
  case when contains(hostport, '[') then regexp_extract(hostport, '\\][^:]*:(.*)$', 1)
        else regexp_extract(hostport, '^[^:]*:(.*)$', 1) end as port_text from authority{tag})"""


_PARSE_ERROR = ("(contains(netloc, '[') <> contains(netloc, ']') or (port_text <> '' and "
                "(not regexp_matches(port_text, '^[0-9]+$') or try_cast(port_text as bigint) > 65535)))")
REASON = f"""case when u = '' then 'empty_url'
  when regexp_matches(u, '[\\x00-\\x1f\\x7f-\\x{{9f}}]') then 'literal_control_character'
  when {_PARSE_ERROR} then 'url_or_port_parse_error'
  when host = '' then 'empty_hostname'
  when regexp_matches(host, '{_WS}') then 'whitespace_in_hostname' else '' end"""
_NET = ("concat(substr(netloc, 1, length(netloc) - length(hostport)), lower(hostport))")


def _quoted(x: str) -> str:
    return f"""concat('"', replace(replace({x}, '\\', '\\\\'), '"', '\\"'), '"')"""


KEY = ("sha256(concat('[', " + ", ',', ".join(map(_quoted, [
    "case when has_scheme then scheme else 'missing' end", _NET, "path", "query", "fragment"])) + ", ']'))")


def _cnt(text: str, char: str) -> str:
    return f"length({text}) - length(replace({text}, '{char}', ''))"


_REG = "regexp_extract(host, '([^.]*[.])?[^.]*$', 0)"
_TLD = "case when contains(host, '.') then regexp_extract(host, '[^.]*$', 0) else '' end"
#: The IPv6 hosts of the given rows are plain groups, with one gap at most.
_IP = (f"(regexp_matches(host, '{IPV4}') or regexp_matches(host, '^[0-9a-f]{{0,4}}(:[0-9a-f]{{0,4}}){{2,7}}$'))")
_BARE = "replace(host, '.', '')"
_BEFORE = f"substr(host, 1, length(host) - length({_REG}))"
_LATER = "case when contains(u, '://') then substr(u, strpos(u, '://') + 3) else u end"
FEATURE = {
    "url_length": "length(u)", "hostname_length": "length(host)", "path_length": "length(path)",
    "query_length": "length(query)", "digit_count": r"length(regexp_replace(u, '[^\p{Nd}]', '', 'g'))",
    "digit_ratio": r"length(regexp_replace(u, '[^\p{Nd}]', '', 'g')) / greatest(length(u), 1)",
    "special_char_count": r"length(regexp_replace(u, '[\p{L}\p{N}./:\-]', '', 'g'))",
    "hyphen_count": _cnt("u", "-"), "dot_count": _cnt("u", "."), "slash_count": _cnt("u", "/"),
    "entropy": "round_even(coalesce(list_aggregate(string_split(u, ''), 'entropy'), 0), 4)",
    "has_ip_address": f"cast({_IP} as int)",
    "subdomain_count": f"case when {_IP} then 0 else greatest({_cnt('host', '.')} - 1, 0) end",
    "hostname_hyphen_count": _cnt("host", "-"),
    "hostname_digit_count": r"length(regexp_replace(host, '[^\p{Nd}]', '', 'g'))",
    "is_known_shortener": f"cast({_REG} in ({q(K.SHORTENER_DOMAINS)}) as int)",
    "has_punycode": "cast(contains(host, 'xn--') as int)",
    "homoglyph_char_ratio": f"case when {_BARE} = '' then 0.0 else "
                            f"length(regexp_replace({_BARE}, '[^0o1l]', '', 'g')) / length({_BARE}) end",
    "percent_encoded_count": _cnt("u", "%"),
    "brand_token_in_subdomain_or_path":
        f"cast(regexp_matches(lower(concat({_BEFORE}, ' ', path)), '{'|'.join(K.BRAND_TOKENS)}') and "
        f"regexp_extract({_REG}, '^[^.]*', 0) not in ({q(K.BRAND_TOKENS)}) as int)",
    "tld_length": f"length({_TLD})",
    "is_suspicious_tld": f"cast(({_TLD}) in ({q(K.SUSPICIOUS_TLDS)}) as int)",
    "uses_https": "cast(scheme = 'https' as int)", "has_at_symbol": "cast(contains(u, '@') as int)",
    "has_port": "cast(port_text <> '' as int)",
    "has_double_slash_redirect": f"cast(contains({_LATER}, '//') as int)",
}
ROUNDED = {n: f"round({e}, 6)" if n in K.DOUBLE_FEATURES else e for n, e in FEATURE.items()}


def feature_list(names=K.FEATURES, rounded: bool = True) -> str:
    table = ROUNDED if rounded else FEATURE
    return ", ".join(f"{table[n]} as {n}" for n in names)


def featured(source: str = "src", tag: str = "") -> str:
    """CTEs up to `feats`: everything in `parsed` plus the 26 features, unrounded."""
    made = feature_list(rounded=False)
    return parse(source, tag) + f", feats{tag} as (select *, {made} from parsed{tag})"


def grouped(source: str = "parsed") -> str:
    """CTEs up to `grouped`: `source` with domain_group and split."""
    rules = ", ".join(f"('{r}')" for r in inputs.RULES)
    return f"""
rules(rule) as (values {rules}),
names as (select host, string_split(host, '.') as parts from (
  select distinct rtrim(host, '.') as host from {source})),
tails as (select host, n, array_to_string(parts[len(parts) - n + 1:], '.') as tail
  from (select host, parts, unnest(range(1, len(parts) + 1)) as n from names)),
longest as (select host, max(n) as n from tails join rules on tail = rule group by host),
domains as (select names.host as bare, case when regexp_matches(names.host, '{IPV4}') then concat('ip:', names.host)
  else concat('domain:', case when n < len(parts) then array_to_string(parts[len(parts) - n:], '.')
    else array_to_string(parts[greatest(len(parts) - 1, 1):], '.') end) end as domain_group
  from names left join longest on names.host = longest.host),
shares as (select *, ('0x' || substr(sha256(concat('42|', domain_group)), 1, 16))::UBIGINT::DOUBLE
  / 18446744073709551616::DOUBLE as share from domains),
grouped as (select s.*, d.domain_group, case when share < 0.7 then 'train' when share < 0.85 then 'validation'
  else 'test' end as split from {source} s join shares d on rtrim(s.host, '.') = d.bare)"""


def raw(view: str) -> str:
    """CTE `src`: a URL list with its source rows."""
    order = ", ".join(inputs.ROW_KEY)
    return f"src as (select *, row_number() over (order by {order}) as source_row from ({view}) v)"


def prepared(view: str = inputs.URLS_V) -> str:
    """CTEs up to `routes`: every raw row with url_key, reason, route and its key's aggregates."""
    return raw(view) + "," + parse() + f""",
inspected as (select source_row, u as url, original_label, u <> url as trimmed,
  lower(trim(original_label)) as cat, {REASON} as why, {KEY} as k, rtrim(host, '.') as hostname from parsed),
reasoned as materialized (select source_row, url, original_label, trimmed, nullif(cat, '') as original_category, hostname,
  case when cat = '' then null when cat = 'benign' then 0 else 1 end as label,
  case when cat = '' then 'missing_label' else why end as reason,
  case when why = '' then k else '' end as url_key from inspected),
keys as materialized (select url_key, count(distinct label) as labels, min(source_row) as first_row, count(*) as records,
  string_agg(distinct original_category, ';' order by original_category) as categories
  from reasoned where reason = '' group by url_key),
routes as materialized (select r.*, labels, coalesce(first_row, source_row) as first_row, coalesce(records, 1) as records,
  coalesce(categories, original_category) as categories,
  case when reason <> '' then 'invalid' when labels > 1 then 'conflict'
   when first_row <> source_row then 'duplicate' else 'kept' end as route
  from reasoned r left join keys on r.reason = '' and r.url_key = keys.url_key)"""


SCORED = src(inputs.SCORED_V, "scored")
CONFUSION = """sum(case when label = 0 and probability < 0.5 then 1 else 0 end)::bigint as tn,
 sum(case when label = 0 and probability >= 0.5 then 1 else 0 end)::bigint as fp,
 sum(case when label = 1 and probability < 0.5 then 1 else 0 end)::bigint as fn,
 sum(case when label = 1 and probability >= 0.5 then 1 else 0 end)::bigint as tp"""
RANKED = """
points as (select model, probability as p, sum(label) as pos, sum(1 - label) as neg from scored group by model, p),
cums as (select *, sum(pos) over w as cum_tp, sum(neg) over w as cum_fp,
  sum(pos) over (partition by model) as np, sum(neg) over (partition by model) as nn
  from points window w as (partition by model order by p desc))"""
HISTORY = src(inputs.HISTORY_V, "history")
SHOWN = """case when lower(status) in ('lower predicted risk', 'safe') then 'Safe'
 when lower(status) in ('potential phishing', 'dangerous') then 'Dangerous'
 when lower(status) = 'risky' then 'Risky' when trust_score >= 70 then 'Safe'
 when trust_score >= 40 then 'Risky' else 'Dangerous' end"""
CLUSTERED = src("""select vec_id, label as cluster, unnest(embedding) as v,
 generate_subscripts(embedding, 1) as f from embeddings""", "tall")

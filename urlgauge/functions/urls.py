"""Native column expressions that take a URL apart, check it and key it.

A single part is one anchored pattern over the URL itself, so an expression stays
small when Catalyst moves a predicate on it down to the scan. All parts together
come from searches for their delimiters, each from the part before. Nothing is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import constants as K
from . import chars

SCHEME_PATTERN = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
LEAD = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?"
_USER = r"(?:[^/?#]*@)?"
PART_PATTERNS = {
    "netloc": LEAD + r"([^/?#]*)",
    "hostport": LEAD + _USER + r"([^/?#]*)",
    # After an opening bracket the host runs to the closing one, else to the colon.
    "host": LEAD + _USER + r"(?:[^/?#\[]*\[)?((?<=\[)[^/?#\]]*|[^/?#:]*)",
    "port_text": LEAD + _USER + r"(?:[^/?#\[]*\[[^/?#\]]*\]?|)[^/?#:]*:?([^/?#]*)",
    "path": LEAD + r"[^/?#]*([^?#]*)",
    "query": r"^[^?#]*\?([^#]*)",
    "fragment": r"(?s)^[^#]*#(.*)$",
}
# 0 to 65535 with any number of leading zeros.
PORT_PATTERN = ("^0*(?:[0-9]{1,4}|[1-5][0-9]{4}|6[0-4][0-9]{3}|65[0-4][0-9]{2}"
                "|655[0-2][0-9]|6553[0-5])$")
EXOTIC_AUTHORITY = LEAD + r"[^/?#]*[%\[\x{80}-\x{10ffff}]"


# HotSpot compiles no method of more bytes than this; Spark's own limit is eight times as large.
COMPILED_BYTES = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled(spark: SparkSession) -> None:
    """Let stages whose fused code would only be interpreted run operator by operator, in short methods.

    URL work is many expressions in one stage, so Spark's default runs it several times slower. A limit set
    by the user stays.
    """
    if int(spark.conf.get(_METHOD_LIMIT)) == 65535:
        spark.conf.set(_METHOD_LIMIT, COMPILED_BYTES)


def strip(url: Column) -> Column:
    """Trim Unicode white space on both sides."""
    return F.btrim(url, F.lit(chars.whitespace()))


def was_trimmed(url: Column) -> Column:
    return url != strip(url)


def has_scheme(url: Column) -> Column:
    return url.rlike(SCHEME_PATTERN)


def working_url(url: Column) -> Column:
    return F.when(has_scheme(url), url).otherwise(F.concat(F.lit("http://"), url))


def without(text: Column, char: str) -> Column:
    return F.replace(text, F.lit(char), F.lit(""))


def count_any(text: Column, marks: str) -> Column:
    """Characters of `text` that are one of `marks`."""
    left = text
    for char in marks:
        left = without(left, char)
    return F.length(text) - F.length(left)


def count_char(text: Column, char: str) -> Column:
    return count_any(text, char)


def after(text: Column, mark: str) -> Column:
    """Text behind the first `mark`, or '' when there is none."""
    return F.substr(text, F.length(F.substring_index(text, mark, 1)) + len(mark) + 1)


def before(text: Column, marks: str) -> Column:
    """Text up to the first character that is one of `marks`, or all of it."""
    for mark in marks:
        text = F.substring_index(text, mark, 1)
    return text


def part(url: Column, name: str) -> Column:
    return F.regexp_extract(url, PART_PATTERNS[name], 1)


def scheme_text(url: Column) -> Column:
    return F.substring_index(url, "://", 1)


def scheme(url: Column) -> Column:
    return F.when(has_scheme(url), F.lower(scheme_text(url))).otherwise("http")


def _behind_scheme(url: Column, found: Column) -> Column:
    return F.when(found, after(url, "://")).otherwise(url)


def hostport(url: Column) -> Column:
    """Host and port as they are spelled."""
    return F.substring_index(before(_behind_scheme(url, has_scheme(url)), "#?/"), "@", -1)


def host_of(hostport: Column) -> Column:
    """After an opening bracket the host runs to the closing one, else to the colon."""
    return F.when(F.contains(hostport, F.lit("[")), before(after(hostport, "["), "]")).otherwise(before(hostport, ":"))


def _port_of(hostport: Column) -> Column:
    return after(F.when(F.contains(hostport, F.lit("[")), after(after(hostport, "["), "]")).otherwise(hostport), ":")


def with_parts(df: DataFrame, url: str = "url", prefix: str = "_") -> DataFrame:
    """Add has_scheme, scheme, netloc, path, query, fragment, hostport, host, port_text.

    `url` must already be trimmed. The added names carry `prefix`.
    """
    compiled(df.sparkSession)
    u, found, rest, netloc, ends = F.col(url), *(F.col(prefix + n) for n in ("has_scheme", "rest", "netloc", "hostport"))
    steps = [
        {"has_scheme": has_scheme(u), "query": after(before(u, "#"), "?"), "fragment": after(u, "#")},
        {"scheme": F.when(found, F.lower(scheme_text(u))).otherwise("http"), "rest": _behind_scheme(u, found)},
        {"netloc": before(rest, "#?/")},
        {"hostport": F.substring_index(netloc, "@", -1), "path": before(F.substr(rest, F.length(netloc) + 1), "#?")},
        {"host": F.lower(host_of(ends)), "port_text": _port_of(ends)},
    ]
    for step in steps:
        df = df.withColumns({prefix + k: v for k, v in step.items()})
    return df.drop(prefix + "rest")


def _bad_authority(netloc: Column, port: Column) -> Column:
    opens, closes = F.contains(netloc, F.lit("[")), F.contains(netloc, F.lit("]"))
    bad_port = (port != "") & ~port.rlike(PORT_PATTERN)
    disguised = (F.length(netloc) != F.octet_length(netloc)) & netloc.rlike(
        "[" + chars.delimiter_lookalike_class() + "]")
    return (opens != closes) | bad_port | disguised


def bad_authority(prefix: str = "_") -> Column:
    """Unbalanced brackets, an unusable port, or a disguised delimiter."""
    return _bad_authority(F.col(prefix + "netloc"), F.col(prefix + "port_text"))


def usable(url: Column) -> Column:
    """A trimmed URL with a host and a sound authority; small enough for a filter."""
    return (part(url, "host") != "") & ~_bad_authority(part(url, "netloc"), part(url, "port_text"))


def reject_reason(url: str = "url", prefix: str = "_") -> Column:
    """'' for usable URLs, else the first reason that applies. Needs `with_parts`."""
    host = F.col(prefix + "host")
    return (
        F.when(F.col(url) == "", "empty_url")
        .when(F.col(url).rlike(r"[\x00-\x1f\x7f-\x{9f}]"), "literal_control_character")
        .when(bad_authority(prefix), "url_or_port_parse_error")
        .when(host == "", "empty_hostname")
        .when(host.rlike("[" + chars.whitespace_class() + "]"), "whitespace_in_hostname")
        .otherwise("")
    )


def canonical_netloc(prefix: str = "_") -> Column:
    """Only host and port are case-folded; user info keeps its case."""
    netloc, hostport = F.col(prefix + "netloc"), F.col(prefix + "hostport")
    user = F.substring(netloc, F.lit(1), F.length(netloc) - F.length(hostport))
    return F.concat(user, F.lower(hostport))


def url_key(prefix: str = "_") -> Column:
    """SHA-256 of the JSON array [scheme or "missing", netloc, path, query, fragment].

    Control characters never get here, so only backslash and quote need escaping.
    """
    def quoted(value):
        escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.concat(F.lit('"'), escaped, F.lit('"'))

    scheme = F.when(F.col(prefix + "has_scheme"), F.col(prefix + "scheme")).otherwise("missing")
    parts = [scheme, canonical_netloc(prefix)] + [
        F.col(prefix + n) for n in ("path", "query", "fragment")]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *map(quoted, parts)), F.lit("]")), 256)


def metadata_hostname(prefix: str = "_") -> Column:
    return F.rtrim(F.col(prefix + "host"), F.lit("."))


def inspect(df: DataFrame, url: str = "url") -> DataFrame:
    """Add url_key, hostname and reason; both are '' on a rejected row."""
    parts = with_parts(df, url).withColumn("reason", reject_reason(url))
    ok = F.col("reason") == ""
    keyed = parts.withColumns({
        "url_key": F.when(ok, url_key()).otherwise(""),
        "hostname": F.when(ok, metadata_hostname()).otherwise(""),
    })
    return keyed.select(*df.columns, "url_key", "hostname", "reason")


def validate(df: DataFrame, url: str = "url", max_length: int = K.MAX_URL_LENGTH,
             request_limit: int | None = None, keep_parts: bool = False) -> DataFrame:
    """Strict check of scoring input: adds valid, error_code and error_message.

    `request_limit` bounds the raw text first, as a request body schema does.
    The accepted URL keeps its own spelling, only trimmed. With `keep_parts` it is there as `_url`, its parts as `_v_...`.
    """
    raw = F.coalesce(F.col(url), F.lit(""))
    work = with_parts(df.withColumn("_url", strip(raw)), "_url", "_v_")
    u, host = F.col("_url"), F.col("_v_host")
    code = F.lit(None).cast("string")
    if request_limit:
        code = F.when((raw == "") | (F.length(raw) > request_limit), "REQUEST_SIZE")
        code = code.when(u == "", "EMPTY")
    else:
        code = F.when(u == "", "EMPTY")
    code = (
        code.when(F.length(u) > max_length, "TOO_LONG")
        .when(u.rlike(r"[\x00-\x20\x7f" + chars.whitespace_class() + "]"), "WHITESPACE")
        .when(~F.col("_v_scheme").isin("http", "https") | (host == "") | bad_authority("_v_"),
              "INVALID")
    )
    messages = dict(K.MESSAGES)
    if request_limit:
        messages["REQUEST_SIZE"] = f"The url field must have 1 to {request_limit} characters."
    checked = work.withColumn("error_code", code)
    kept = [c for c in work.columns if c not in df.columns] if keep_parts else []
    return checked.select(
        *df.columns, *kept, F.col("error_code").isNull().alias("valid"), "error_code",
        _message(F.col("error_code"), messages).alias("error_message"))


def validate_form(df: DataFrame, url: str = "url") -> DataFrame:
    """The form's check: full URL, dotted host or localhost, no user info."""
    raw = F.coalesce(F.col(url), F.lit(""))
    work = with_parts(df.withColumn("_url", strip(raw)), "_url", "_v_")
    host, netloc = F.col("_v_host"), F.col("_v_netloc")
    user = F.substring(netloc, F.lit(1), F.length(netloc) - F.length(F.col("_v_hostport")))
    broken = (~F.col("_v_has_scheme") | bad_authority("_v_") | (host == "")
              | host.rlike(r"[\s<>^|%\\]"))
    code = (
        F.when(F.col("_url") == "", "EMPTY")
        .when(F.length(raw) > K.MAX_REQUEST_LENGTH, "TOO_LONG")
        .when(raw.rlike(r"[\x00-\x1f\x7f]"), "CONTROL")
        .when(F.col("_url").rlike("^[A-Za-z][A-Za-z0-9+.\\-]*:")
              & ~F.col("_url").rlike("^(?i:https?):"), "SCHEME")
        .when(broken, "INVALID")
        .when(~F.contains(host, F.lit(".")) & (host != "localhost"), "HOST")
        .when(~user.isin("", "@", ":@"), "USERINFO")
    )
    checked = work.withColumn("error_code", code)
    return checked.select(
        *df.columns, F.col("error_code").isNull().alias("valid"), "error_code",
        _message(F.col("error_code"), K.FORM_MESSAGES).alias("error_message"))


def _message(code: Column, messages: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, text in messages.items():
        out = F.when(code == key, text).otherwise(out)
    return out

"""Fixed values the analytics must agree on: names, lists, thresholds, messages."""

from __future__ import annotations

# The 26 features, in model column order.
FEATURES = [
    "url_length", "hostname_length", "path_length", "query_length",
    "digit_count", "digit_ratio", "special_char_count", "hyphen_count",
    "dot_count", "slash_count", "entropy",
    "has_ip_address", "subdomain_count", "hostname_hyphen_count",
    "hostname_digit_count", "is_known_shortener",
    "has_punycode", "homoglyph_char_ratio", "percent_encoded_count",
    "brand_token_in_subdomain_or_path",
    "tld_length", "is_suspicious_tld",
    "uses_https", "has_at_symbol", "has_port", "has_double_slash_redirect",
]
DOUBLE_FEATURES = ["digit_ratio", "entropy", "homoglyph_char_ratio"]
FLAG_FEATURES = [
    "has_ip_address", "is_known_shortener", "has_punycode",
    "brand_token_in_subdomain_or_path", "is_suspicious_tld", "uses_https",
    "has_at_symbol", "has_port", "has_double_slash_redirect",
]
COUNT_FEATURES = [f for f in FEATURES if f.endswith(("_length", "_count"))]
OTHER_FEATURES = [f for f in FEATURES if f not in FLAG_FEATURES + COUNT_FEATURES]

# Top-level domains on the watch list.
SUSPICIOUS_TLDS = [
    "zip", "mov", "xyz", "top", "tk", "gq", "ml", "ga", "cf",
    "click", "link", "work", "support", "country", "kim", "rest",
    "info", "biz", "icu", "buzz", "loan", "win", "men", "date",
]

# Brand tokens, matched as substrings.
BRAND_TOKENS = [
    "paypal", "apple", "microsoft", "google", "amazon", "netflix",
    "facebook", "instagram", "bankofamerica", "chase", "wellsfargo",
    "dhl", "fedex", "irs", "outlook", "office365", "coinbase",
]

# URL shortener domains.
SHORTENER_DOMAINS = [
    "bit.ly", "tinyurl.com", "t.co", "goo.gl", "ow.ly", "is.gd",
    "buff.ly", "rebrand.ly", "cutt.ly",
]

# Fixed value: look-alike characters as they remain in a lower-cased host.
LOOKALIKE_CHARS = "0o1l"

# Display cut-offs. They never change a score.
THRESHOLDS = {
    "url_length": 60, "hostname_length": 30, "hyphen_count": 3,
    "hostname_hyphen_count": 2, "subdomain_count": 3, "entropy": 4.4,
    "digit_ratio": 0.2, "homoglyph_char_ratio": 0.35,
}

# Display names of the features.
FEATURE_TITLES = {
    "url_length": "URL length",
    "hostname_length": "Hostname length",
    "path_length": "Path length",
    "query_length": "Query length",
    "digit_count": "Digit count",
    "digit_ratio": "Digit proportion",
    "special_char_count": "Special character count",
    "hyphen_count": "Hyphen count",
    "dot_count": "Dot count",
    "slash_count": "Slash count",
    "entropy": "Character entropy",
    "has_ip_address": "IP address host",
    "subdomain_count": "Subdomain count heuristic",
    "hostname_hyphen_count": "Hostname hyphens",
    "hostname_digit_count": "Hostname digits",
    "is_known_shortener": "Known URL shortener",
    "has_punycode": "Punycode hostname",
    "homoglyph_char_ratio": "Look-alike character proportion",
    "percent_encoded_count": "Percent sign count",
    "brand_token_in_subdomain_or_path": "Brand token outside the main domain",
    "tld_length": "Top-level domain length",
    "is_suspicious_tld": "TLD in the illustrative watchlist",
    "uses_https": "HTTPS scheme",
    "has_at_symbol": "At symbol",
    "has_port": "Explicit port",
    "has_double_slash_redirect": "Repeated slash pattern",
}

# Sentences for the importance-weighted reasons.
REASON_TEXT = {
    "has_ip_address": "uses a raw IP address instead of a domain name",
    "is_suspicious_tld": "uses a top-level domain often associated with abuse (e.g. .xyz, .top, .click)",
    "has_punycode": "contains punycode (xn--), often used to fake look-alike characters",
    "homoglyph_char_ratio": "contains a high proportion of characters that can visually resemble other letters/digits",
    "has_at_symbol": "contains an '@' symbol, which can hide the real destination",
    "has_double_slash_redirect": "contains a suspicious '//' redirect pattern in the path",
    "is_known_shortener": "uses a URL-shortening service, which hides the real destination",
    "brand_token_in_subdomain_or_path": "mentions a well-known brand name outside of its real domain",
    "url_length": "is unusually long",
    "hostname_length": "has an unusually long hostname",
    "hyphen_count": "contains an unusually high number of hyphens",
    "subdomain_count": "has an unusually high number of subdomains",
    "entropy": "has unusually random-looking characters",
    "has_port": "specifies a non-standard port number",
    "uses_https": "does not use HTTPS",
}

# Messages of the strict input check.
MESSAGES = {
    "EMPTY": "Enter a URL to analyse.",
    "TOO_LONG": "Please use a URL of at most 8,192 characters.",
    "WHITESPACE": "The URL contains spaces or control characters. Use URL encoding where needed.",
    "INVALID": "Enter a valid HTTP or HTTPS address with a hostname or IP address.",
}
# Messages of the form check.
FORM_MESSAGES = {
    "EMPTY": "Please enter a URL to analyse.",
    "TOO_LONG": "The URL must be 2,048 characters or fewer.",
    "CONTROL": "Control characters are not allowed.",
    "SCHEME": "Only HTTP and HTTPS URLs are supported.",
    "HOST": "Enter a complete URL with a valid domain name.",
    "USERINFO": "URLs containing embedded usernames or passwords are not supported.",
    "INVALID": "Enter a valid URL, including https:// or http://.",
}
SCORE_MESSAGE = "The saved model returned an invalid score."
MAX_URL_LENGTH = 8192
MAX_REQUEST_LENGTH = 2048

# Decision threshold, split shares, history sizes.
THRESHOLD = 0.5
TRAIN_BELOW, VALIDATION_BELOW = 0.70, 0.85
SPLITS = ["train", "validation", "test"]
DEFAULT_SEED = 42
HISTORY_KEEP, HISTORY_RECENT, SESSION_KEEP = 100, 10, 30

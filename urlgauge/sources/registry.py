"""The two labelled sources: where their columns are and what their labels mean."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Source:
    name: str
    url_column: str
    label_column: str
    labels: dict[str, int]
    categories: dict[str, str]
    positive_class: str


# Column names, label maps (the second source's labels are inverted).
SOURCES = {
    "larger": Source(
        "larger", "url", "type",
        {"benign": 0, "phishing": 1, "defacement": 1, "malware": 1},
        {n: n for n in ("benign", "phishing", "defacement", "malware")},
        "any category but benign"),
    "smaller": Source(
        "smaller", "URL", "label", {"1": 0, "0": 1}, {"1": "benign", "0": "phishing"}, "the category phishing"),
}


def normal_label(original: Column) -> Column:
    from ..functions import urls
    return F.lower(urls.strip(F.coalesce(original, F.lit(""))))


def mapped(values: dict, key: Column) -> Column:
    """The value for a key of a fixed small map; NULL for any other key."""
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out

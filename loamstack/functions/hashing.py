"""Content hashes and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(*texts: Column, chars: int = 16) -> Column:
    """SHA-256 of the texts put together, nulls as nothing."""
    return F.substring(F.sha2(F.concat(*[F.coalesce(t, F.lit("")) for t in texts]), 256), 1, chars)


def messages_hash(messages: Column, chars: int = 16) -> Column:
    return F.substring(F.sha2(F.to_json(messages), 256), 1, chars)


def joined_hash(*texts: Column, chars: int = 16) -> Column:
    """SHA-256 of the texts with colons between."""
    return F.substring(F.sha2(F.concat_ws(":", *[F.coalesce(t, F.lit("")) for t in texts]), 256), 1, chars)


def short_md5(text: Column, chars: int = 12) -> Column:
    return F.substring(F.md5(text), 1, chars)


def canonical_map(labels: Column) -> Column:
    """A map as text that does not depend on the order of its entries, so that it can be a key."""
    return F.to_json(F.array_sort(F.map_entries(labels)))


def label_hash(labels: Column) -> Column:
    return F.substring(F.md5(canonical_map(labels)), 1, 8)


def event_hash(event_type: Column, source: Column, payload: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", event_type, source, canonical_map(payload))), 1, 16)


def unit_interval(*keys: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that the keys and the seed decide."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def semantic_version(text: Column) -> Column:
    """major.minor.patch as a struct that compares in order."""
    part = lambda n: F.try_element_at(F.split(F.regexp_replace(text, "^v", ""), r"[.\-+]"), F.lit(n)).try_cast("int")
    return F.struct(*[F.coalesce(part(k), F.lit(0)).alias(n) for k, n in ((1, "major"), (2, "minor"), (3, "patch"))])


def next_version(text: Column, kind: str) -> Column:
    v = semantic_version(text)
    one, zero = F.lit(1), F.lit(0)
    parts = {"major": (v["major"] + one, zero, zero), "minor": (v["major"], v["minor"] + one, zero), "patch": (v["major"], v["minor"], v["patch"] + one)}[kind]
    return F.concat_ws(".", *[p.cast("string") for p in parts])

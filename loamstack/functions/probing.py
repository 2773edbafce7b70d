"""First-present probing of dynamic keys, over JSON text or string maps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(column: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def present(column: Column) -> Column:
    """Stripped text, null if blank."""
    text = strip(column)
    return F.when(text != "", text)


def json_key(document: Column, key: str) -> Column:
    return F.get_json_object(document, f"$.{key}")


def _fields(document: Column, read) -> Column:
    """``read`` of a JSON object's fields, which are parsed once for all keys."""
    return F.transform(F.array(F.from_json(document, "map<string,string>")), read)[0]


def first_text(document: Column, keys: Sequence[str]) -> Column:
    """The first key with visible text; an object counts by its ``text``."""

    def read(fields: Column) -> Column:
        values = F.transform(F.array(*[F.try_element_at(fields, F.lit(k)) for k in keys]), lambda v: F.when(v.startswith("{"), F.get_json_object(v, "$.text")).otherwise(present(v)))
        return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))

    return _fields(document, read)


def first_number(document: Column, keys: Sequence[str]) -> Column:
    return _fields(document, lambda fields: F.coalesce(*[F.try_element_at(fields, F.lit(k)).try_cast("double") for k in keys]))


def joined_context(document: Column, keys: Sequence[str], named: bool = False) -> Column:
    """The present keys' values, a line each, null if none."""

    def read(fields: Column) -> Column:
        parts = [F.concat(F.lit(f"{k}: " if named else ""), F.try_element_at(fields, F.lit(k))) for k in keys]
        found = F.concat_ws("\n", *parts)
        return F.when(found != "", found)

    return _fields(document, read)


def kept_keys(document: Column, keys: Sequence[str]) -> Column:
    """A JSON object of the present keys only."""
    fields = F.from_json(document, "map<string,string>")
    return F.to_json(F.map_filter(fields, lambda k, _: k.isin(*keys)))


def iso_timestamp(column: Column) -> Column:
    """ISO-8601 text as an instant; a bare one is UTC; null if it can't be read."""
    return F.try_to_timestamp(F.regexp_replace(column, "Z$", "+00:00"))


def interpolated(settings: dict[str, str], environment: dict[str, str]) -> dict[str, object]:
    """Settings with ${NAME} and ${NAME:-default} from the environment, as numbers, truth values or text."""

    def fill(match: re.Match) -> str:
        return environment.get(match[1], match[2] or "")

    def typed(text: str) -> object:
        if text.lower() in ("true", "false"):
            return text.lower() == "true"
        for kind in (int, float):
            try:
                return kind(text)
            except ValueError:
                pass
        return text

    return {k: typed(re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", fill, v)) for k, v in settings.items()}

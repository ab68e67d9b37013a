"""JSON text: how it is read, and edits that leave everything else in a document as it is."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Read options: only standard quotes, and broken text fails.
STRICT = {"mode": "FAILFAST", "allowSingleQuotes": "false"}


def with_fields(document: Column, fields: Mapping[str, Column]) -> Column:
    """JSON text of the object ``document`` with ``fields`` (variants) added or replaced."""
    members = F.variant_get(F.parse_json(document), "$", "map<string,variant>")
    kept = F.map_filter(members, lambda name, _: ~name.isin(*fields))
    added = F.create_map(*[part for n, value in fields.items() for part in (F.lit(n), value)])
    return F.to_json(F.map_concat(kept, added))

"""Literal name mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.semantics import col_

# Country names re-mapped so the population table joins the
# case table.
COUNTRY_NAME_MAP = {
    "United States": "US",
    "South Korea": "Korea, South",
    "Czech Republic": "Czechia",
}


def map_names(c, mapping: dict | None = None) -> Column:
    """CASE name WHEN a THEN b ... ELSE name END; unmapped names pass."""
    mapping = COUNTRY_NAME_MAP if mapping is None else mapping
    c = col_(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return c if out is None else out.otherwise(c)

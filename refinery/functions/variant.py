"""Typed access to the Bronze variant.

``field`` mirrors the reference's ``raw_json:f::T`` but never fails a job: a
value that does not cast becomes NULL (``try_variant_get``) and the row is then
rejected by the Silver filters (D3).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW = "raw_json"


def field(name: str, type_: str, raw: str = RAW) -> Column:
    """``raw_json:name::type`` -> typed column, NULL if missing or not castable."""
    return F.try_variant_get(F.col(raw), f"$.{name}", type_)


def whole_number(name: str, type_: str = "bigint", raw: str = RAW) -> Column:
    """``raw_json:name::INTEGER`` / ``::NUMBER``: a fractional value is rounded
    half away from zero (3.5 -> 4), not truncated; NULL if not a number or out
    of range for ``type_``."""
    d = F.try_variant_get(F.col(raw), f"$.{name}", "decimal(38,6)")
    return F.round(d, 0).try_cast(type_)


def whole_number_of_record(name: str, raw: str = RAW) -> Column:
    """``whole_number`` as a bigint where the record is held whole (the load): a value
    that is an integer is taken as it is, only others pass through a decimal.

    Not for a scan of Bronze, which would read the field in three forms."""
    value = F.try_variant_get(F.col(raw), f"$.{name}", "variant")
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint")) \
        .otherwise(whole_number(name, raw=raw))


def castable_or_raise(value: Column, name: str, type_: str, raw: str = RAW) -> Column:
    """``value`` (a ``try_`` extraction of ``name``), or a job failure when the
    field holds a non-null JSON value that does not cast to ``type_`` -- the
    reference dialect fails the statement on such a cast (D3, strict mode)."""
    v = F.variant_get(F.col(raw), f"$.{name}", "variant")
    bad = v.isNotNull() & ~F.is_variant_null(v) & value.isNull()
    return F.when(bad, F.raise_error(F.lit(f"field '{name}' does not cast to {type_}"))) \
        .otherwise(value)


def present(name: str, raw: str = RAW) -> Column:
    """Path-level test ``raw_json:name IS NOT NULL``: a JSON null passes (F1)."""
    return F.variant_get(F.col(raw), f"$.{name}", "variant").isNotNull()


def array_size(name: str, raw: str = RAW) -> Column:
    """``ARRAY_SIZE(raw_json:name)``: NULL when missing or not an array.

    Elements are counted, not rebuilt: one that is no boolean is a NULL in the array."""
    return F.array_size(F.try_variant_get(F.col(raw), f"$.{name}", "array<boolean>"))

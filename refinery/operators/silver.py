"""Bronze -> Silver.

``extract`` is one narrow projection + filter over the variant column: no
shuffle, and Catalyst keeps it inside one whole-stage-codegen span.  The
filter is written on the extracted fields, so each variant path is read once.
``latest_per_key`` (upsert only) is the single shuffle, on the merge key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from refinery.functions.scalar import bounded, date_from_parts, epoch_ms_to_ts, md5_of, ntz
from refinery.functions.variant import array_size, castable_or_raise, field, present, whole_number
from refinery.spec import MethodSpec

# Silver row without the load clock.
SILVER_DATA_COLUMNS = [
    "review_id", "asin", "parent_asin", "user_id", "rating", "review_title",
    "review_text", "helpful_vote", "verified_purchase", "review_ts", "has_images",
]

# Ordering of W1: newest review_ts first; the remaining columns only break
# ties so that the kept row is the same on every run and engine.
LATEST_ORDER = ["review_ts", "rating", "helpful_vote", "verified_purchase",
                "review_title", "review_text", "parent_asin", "has_images"]

# What the id is made of: the keys as they were before any cut, and the time as it stood in the record.
ID_PARTS = ("_id_user", "_id_asin", "_id_time")


def _id_parts(spec: MethodSpec) -> tuple[str, ...]:
    """Columns of ``typed`` that make the id; keys that ``spec`` does not cut are not held twice."""
    return ("user_id", "asin", "_id_time") if spec.dedupe or not spec.string_widths else ID_PARTS



# VARCHAR widths of the Silver DDL of every method (fixed values).
WIDTHS = {"asin": 25, "parent_asin": 25, "user_id": 50, "review_title": 500}


# Keys of the upsert's merges: a longer one fails the run, as a cut would make one key of two.
UPSERT_KEYS = ("user_id", "asin", "parent_asin")


def _width(c: Column, n: int, spec: MethodSpec, name: str, strict: bool) -> Column:
    """Cut to the declared width (D2); with ``strict`` a longer value fails the run.

    The upsert's keys are left whole for ``keys_that_fit``.
    """
    if not spec.string_widths or spec.dedupe and name in UPSERT_KEYS:
        return c
    if not strict:
        return bounded(c, n)
    return F.when(F.length(c) > n, F.raise_error(F.lit(f"{name} is longer than {n} characters")).cast("string")).otherwise(c)


def extract(bronze: DataFrame, spec: MethodSpec, strict: bool = False, cut: Observation | None = None) -> DataFrame:
    """Typed, filtered Silver rows of ``spec`` (no ``loaded_at``), newest per key if it says so.

    A value that does not cast (``"rating": "abc"``) becomes NULL and the row
    is rejected; with ``strict=True`` the job fails instead, as the reference
    dialect does (D3).

    ``bronze`` must be a plain scan: an ``observe`` on it keeps the fields from
    being read alone, and every record is then rebuilt whole.
    """
    if not spec.dedupe:
        return with_review_id(typed(bronze, spec, strict, cut=cut), spec)
    silver = latest_per_key(typed(bronze, spec, strict, cut=cut))
    return with_review_id(keys_that_fit(silver) if spec.string_widths else silver, spec)


def with_review_id(rows: DataFrame, spec: MethodSpec) -> DataFrame:
    """``typed`` rows with their id (V1).  Made behind a shuffle of them: its 32 random
    digits would be most of what a row weighs there."""
    parts = [F.col(c) for c in _id_parts(spec)]
    rows = rows.withColumn("review_id", md5_of(*parts, sep=spec.id_separator))
    others = [c for c in rows.columns if c not in (*ID_PARTS, "review_id")]
    return rows.select("review_id", *others)


def typed(bronze: DataFrame, spec: MethodSpec, strict: bool = False, carry: tuple[str, ...] = (),
          cut: Observation | None = None) -> DataFrame:
    """All typed, filtered rows of ``spec``, duplicates included, with ``bronze``'s columns ``carry``
    and, in place of the id, what it is made of (``with_review_id``).

    ``cut`` counts the rows whose value is longer than its column's declared width (B4).
    """
    user_s = field("user_id", "string")
    asin_s = field("asin", "string")
    ts_ms = _checked(whole_number("timestamp"), "timestamp", "number", strict)
    ts = epoch_ms_to_ts(ts_ms)
    rating = _checked(field("rating", "double"), "rating", "double", strict)
    text = field("text", "string")
    n_images = array_size("images")

    if spec.images_default is None:
        has_images = n_images > 0
    else:
        has_images = F.when(n_images > 0, F.lit(True)).otherwise(F.lit(spec.images_default))
    helpful = _checked(whole_number("helpful_vote", "int"), "helpful_vote", "integer", strict)
    if spec.helpful_default is not None:
        helpful = F.coalesce(helpful, F.lit(spec.helpful_default))

    wide = {"asin": asin_s, "parent_asin": field("parent_asin", "string"), "user_id": user_s,
            "review_title": field("title", "string")}
    projected = bronze.select(
        *[c.alias(name) for name, c in zip(ID_PARTS, (user_s, asin_s, field("timestamp", "string")))
          if name in _id_parts(spec)],
        _width(asin_s, WIDTHS["asin"], spec, "asin", strict).alias("asin"),
        _width(wide["parent_asin"], WIDTHS["parent_asin"], spec, "parent_asin", strict).alias("parent_asin"),
        _width(user_s, WIDTHS["user_id"], spec, "user_id", strict).alias("user_id"),
        rating.alias("rating"),
        _width(wide["review_title"], WIDTHS["review_title"], spec, "title", strict).alias("review_title"),
        text.alias("review_text"),
        helpful.alias("helpful_vote"),
        _checked(field("verified_purchase", "boolean"), "verified_purchase", "boolean",
                 strict).alias("verified_purchase"),
        ts.alias("review_ts"),
        has_images.alias("has_images"),
        _valid(spec, ts, rating).alias("_valid"),
        *carry,
        *([(F.length(c) > WIDTHS[name]).alias(f"_long_{name}") for name, c in wide.items()] if cut else []),
    )
    silver = projected.filter("_valid").drop("_valid")
    if cut is not None:
        counts = [F.count_if(F.col(f"_long_{name}")).alias(name) for name in WIDTHS]
        silver = silver.observe(cut, *counts).drop(*(f"_long_{name}" for name in WIDTHS))
    return silver


def keys_that_fit(silver: DataFrame) -> DataFrame:
    """``silver``; a row whose key is longer than its column fails the run.

    A filter, as it leaves the key columns, and so the window's shuffle, as they are.
    """
    for name in UPSERT_KEYS:
        n = WIDTHS[name]
        error = F.raise_error(F.lit(f"{name} is longer than {n} characters")).cast("boolean")
        silver = silver.filter(F.when(F.length(name) > n, error).otherwise(F.lit(True)))
    return silver


def _checked(value: Column, name: str, type_: str, strict: bool) -> Column:
    return castable_or_raise(value, name, type_) if strict else value


def _valid(spec: MethodSpec, ts: Column, rating: Column) -> Column:
    """Row filter of ``spec`` over the raw variant."""
    if spec.null_test == "path":
        # A rating or a time that passes its range is present: only the keys are asked for their paths.
        cond = present("asin") & present("user_id")
        if spec.years is None and spec.lower is None and spec.upper is None:
            cond = cond & present("timestamp")
    else:
        cond = field("user_id", "string").isNotNull() & field("asin", "string").isNotNull()
    cond = cond & rating.between(1.0, 5.0) & (F.length(field("text", "string")) > 0)
    if spec.years is not None:
        first, end = (date_from_parts(y, 1, 1).cast("timestamp_ntz") for y in spec.years)
        cond = cond & (ts >= first) & (ts < end)
    if spec.lower is not None:
        cond = cond & (ts >= ntz(spec.lower))
    if spec.upper is not None:
        cond = cond & ((ts <= ntz(spec.upper)) if spec.upper_inclusive else (ts < ntz(spec.upper)))
    return F.coalesce(cond, F.lit(False))


def latest_per_key(silver: DataFrame, keys: tuple[str, ...] = ("user_id", "asin")) -> DataFrame:
    """Keep the newest row per key (W1): ``ROW_NUMBER() ... = 1``.

    Catalyst plans this as a partial ``WindowGroupLimit`` before the shuffle
    and a final one after it, so a hot key ships at most one row per map task.
    """
    order = [F.col(c).desc_nulls_last() for c in LATEST_ORDER]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (silver.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def newest_places(rows: DataFrame, keys: list[str], place: list[str], mark: list[str]) -> DataFrame:
    """The newest row per key (W1), without its payload: keys, ``mark``, ``place``, ``tied``.

    ``rows`` come from ``typed`` with their place in the input and a row
    fingerprint ``mark`` (two longs).  Only narrow columns are shuffled, after
    partial aggregation: a hot key costs one small record a task.  ``tied``
    says that rows alike in time and figures differ in text columns, which
    ``latest_per_key`` has to decide.
    """
    order = LATEST_ORDER[:4]
    top = F.max(F.struct(*order, *mark, *place)).alias("a")
    low = F.max(F.struct(*order, F.bitwise_not(mark[0]).alias("low"))).alias("b")
    return rows.groupBy(*keys).agg(top, low).select(
        *keys, *[F.col(f"a.{c}").alias(c) for c in [*mark, *place]],
        (F.col(f"a.{mark[0]}") != F.bitwise_not(F.col("b.low"))).alias("tied"))


def with_load_clock(silver: DataFrame, now: Column | None = None) -> DataFrame:
    """Append ``loaded_at`` (A10 default CURRENT_TIMESTAMP)."""
    return silver.withColumn("loaded_at", now if now is not None else F.localtimestamp())

"""Dimensions. Surrogate keys are hashes of the natural key, so reruns agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plazaflow.functions.columns import lookup, lookup_known
from plazaflow.functions.frames import literal_frame
from plazaflow.functions.ordering import with_sequence
from plazaflow.operators import calendar as cal
from plazaflow.operators.silver import phone_owners


def with_surrogate(df: DataFrame, natural_key: list[str], name: str, hashed: bool = True) -> DataFrame:
    """Hash by default: no sort, and stable when rows are added. hashed=False numbers 1..n.
    The uniqueness of hashed keys is one of the gold checks."""
    if hashed:
        return df.withColumn(name, F.xxhash64(*natural_key))
    return with_sequence(df, natural_key, "_seq").withColumn(name, F.col("_seq") + 1).drop("_seq")


def type1_dim(silver: DataFrame, cols: list[str], key: str, name: str) -> DataFrame:
    return with_surrogate(silver.select(*cols), [key], name)


# Columns of the landed master data.
VENUE_COLS = ["venue_id", "venue_name", "venue_type", "opened_date", "description"]
GATE_COLS = ["gate_id", "gate_name", "description"]
STABLE_COLS = ["stable_id", "box_no", "size_category", "status"]
INSTRUCTOR_COLS = ["instructor_id", "instructor_name", "specialty_level", "hire_date", "status"]
EVENT_COLS = ["event_id", "event_name", "event_type", "start_date", "end_date", "expected_attendance"]


def dim_product(silver: DataFrame, dim_venue: DataFrame) -> DataFrame:
    joined = lookup(silver, dim_venue.select("venue_key", "venue_id"), "venue_id")
    cols = joined.select("product_id", "product_code", "product_name", "venue_key", "category", "unit_price_kwd")
    return with_surrogate(cols, ["product_id"], "product_key")


def dim_channel(sessions: DataFrame, bookings: DataFrame) -> DataFrame:
    """Channels are discovered: no source lists them."""
    seen = sessions.select("channel").union(bookings.select("channel")).dropna().distinct()
    return with_surrogate(seen.withColumnRenamed("channel", "channel_name"), ["channel_name"], "channel_key")


def dim_customer(bookings: DataFrame) -> DataFrame:
    known = bookings.filter(F.col("customer_id").isNotNull())
    first = known.groupBy("customer_id").agg(F.to_date(F.min("booking_datetime")).alias("first_seen_date"))
    return with_surrogate(first, ["customer_id"], "customer_key")


def resolve_member(contracts: DataFrame) -> DataFrame:
    """Adds canonical_member_id: the lowest member id sharing the phone; no phone, own id.

    Aggregate and join, not a window: the per-phone minimum is combined before the
    shuffle and the join side of a very common phone can be split.
    """
    owner = phone_owners(contracts).select("phone_number", F.col("_low_member").alias("_owner"))
    joined = lookup_known(contracts, owner, "phone_number")
    return joined.withColumn("canonical_member_id", F.coalesce("_owner", "member_id")).drop("_owner")


def dim_member(contracts: DataFrame) -> DataFrame:
    resolved = resolve_member(contracts)
    has_phone = F.when(F.col("phone_number").isNotNull(), F.col("contract_id"))
    people = resolved.groupBy("canonical_member_id").agg(
        F.min_by("phone_number", has_phone).alias("phone"),
        F.min("start_date").alias("first_contract_start_date"),
    )
    return with_surrogate(people.withColumnRenamed("canonical_member_id", "member_id"), ["member_id"], "member_key")


def dim_tenant(versions: DataFrame) -> DataFrame:
    df = versions.select(
        "tenant_id", "tenant_name", "category", "unit_no", "unit_sqm", "lease_start", "lease_end",
        "base_rent_kwd", "turnover_rent_pct", "turnover_threshold_kwd", "status",
        F.col("effective_start_date").alias("valid_from"),
        F.col("effective_end_date").alias("valid_to"),
        F.col("effective_end_date").isNull().alias("is_current"),
    )
    return with_surrogate(df, ["tenant_id", "valid_from"], "tenant_key")


def place_changes(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """Late-arriving changes (tenant_id, effective_from, category), each with what becomes of it in `outcome`.

    `split`: a version begins before it and still holds it; `corrected`: a version begins that very
    day; `rejected`: no version of the tenant holds the day. A left join, so no change is lost.
    Of several changes of a tenant on one day the smallest category counts, the others are rejected.
    """
    c = changes.groupBy("tenant_id", "effective_from").agg(F.sort_array(F.collect_list("category")).alias("_categories"))
    c = c.select("tenant_id", "effective_from", F.posexplode("_categories").alias("_nth", "category"))
    v = versions.select("tenant_id", "valid_from", "valid_to").alias("v")
    holds = (F.col("v.valid_from") <= F.col("c.effective_from")) & (
        F.col("v.valid_to").isNull() | (F.col("c.effective_from") <= F.col("v.valid_to")))
    met = c.alias("c").join(v, (F.col("v.tenant_id") == F.col("c.tenant_id")) & holds, "left")
    outcome = F.when(F.col("v.valid_from").isNull() | (F.col("_nth") > 0), "rejected").when(
        F.col("v.valid_from") == F.col("c.effective_from"), "corrected").otherwise("split")
    return met.select("c.tenant_id", "c.effective_from", "c.category", F.col("v.valid_from").alias("of_version"), outcome.alias("outcome"))


def rebuild_scd2(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """The versions after late-arriving changes; `place_changes` says which were rejected.

    The version holding a change is split there, or corrected where it begins that day. A
    tenant has a few versions, so ordering them within the tenant is a small window.
    """
    attrs = [c for c in versions.columns if c not in ("tenant_key", "valid_from", "valid_to", "is_current", "category")]
    placed = place_changes(versions, changes).where("outcome <> 'rejected'").select(
        F.col("tenant_id").alias("_tenant"), "of_version", "effective_from", F.col("category").alias("_category"), "outcome")
    own = (F.col("tenant_id") == F.col("_tenant")) & (F.col("valid_from") == F.col("of_version"))
    fixed = versions.join(placed.where("outcome = 'corrected'"), own, "left").withColumn(
        "category", F.coalesce("_category", "category")).select(*attrs, "category", "valid_from", "valid_to")
    late = versions.join(placed.where("outcome = 'split'"), own).select(
        *attrs, F.col("_category").alias("category"), F.col("effective_from").alias("valid_from"), "valid_to")
    both = fixed.unionByName(late)
    upcoming = F.lead("valid_from").over(Window.partitionBy("tenant_id").orderBy("valid_from"))
    cut = both.withColumn("_next", F.date_sub(upcoming, 1)).withColumn(
        "valid_to", F.least(F.col("valid_to"), F.col("_next"))
    ).drop("_next")
    cut = cut.withColumn("is_current", F.col("valid_to").isNull())
    return with_surrogate(cut, ["tenant_id", "valid_from"], "tenant_key")


# Configuration blocks and the dimension columns they fill.
SPATIAL = [
    # (configuration block, dimension, natural key, columns)
    ("gates", "dim_gate", "gate_id", ["gate_label", "zone", "primary_venue_served"]),
    ("venues", "dim_venue", "venue_id", ["zone", "gate_proximity"]),
    ("tenants", "dim_tenant", "tenant_id", ["zone", "gate_proximity"]),
]


def spatial_frame(spark: SparkSession, block: dict, key: str, cols: list[str]) -> DataFrame:
    rows = [(k, *[attrs.get(c) for c in cols]) for k, attrs in block.items()]
    return literal_frame(spark, rows, {key: "string", **{c: "string" for c in cols}})


def apply_spatial(dim: DataFrame, entries: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Every version of a place gets its attributes; a place not configured gets nulls."""
    return lookup(dim.drop(*cols), entries.select(key, *cols), key)


def build_dims(spark: SparkSession, silver: dict[str, DataFrame], cfg: dict) -> dict[str, DataFrame]:
    dims = {"dim_date": cal.dim_date(spark, cfg)}
    dims["dim_date_weather"] = cal.date_weather(dims["dim_date"], silver["weather_daily"])
    dims["dim_venue"] = type1_dim(silver["venues"], VENUE_COLS, "venue_id", "venue_key")
    dims["dim_gate"] = type1_dim(silver["gates"], GATE_COLS, "gate_id", "gate_key")
    dims["dim_product"] = dim_product(silver["products"], dims["dim_venue"])
    dims["dim_stable"] = type1_dim(silver["stables"], STABLE_COLS, "stable_id", "stable_key")
    dims["dim_instructor"] = type1_dim(silver["instructors"], INSTRUCTOR_COLS, "instructor_id", "instructor_key")
    dims["dim_event"] = type1_dim(silver["events"], EVENT_COLS, "event_id", "event_key")
    dims["dim_channel"] = dim_channel(silver["web_sessions"], silver["web_bookings"])
    dims["dim_customer"] = dim_customer(silver["web_bookings"])
    dims["dim_member"] = dim_member(silver["contracts"])
    dims["dim_tenant"] = dim_tenant(silver["tenants"])
    for block, table, key, cols in SPATIAL:
        dims[table] = apply_spatial(dims[table], spatial_frame(spark, cfg["spatial"][block], key, cols), key, cols)
    return dims

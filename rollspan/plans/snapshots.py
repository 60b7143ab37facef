"""Families built from state tables, catalogues and billing lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollspan.functions.calendar import as_date, month_steps, safe_ts, shift_months, snapshot_windows, ymd, years_since
from rollspan.functions.fixed_values import (
    APPLE_CHIP, APPLE_CHIP_MARKS, BALANCE_BANDS, CAPABILITIES, CHIPSET_FAMILY, CONTINENT, DEVICE_RENAMES, DEVICE_TYPE,
    FEE_GROUPS, GENDER, GPU_FAMILY, MANUFACTURER_GROUP, RAM_BUCKETS, RAM_LAST, RAM_UNKNOWN, REVENUE_MEASURES,
    SERVICE_CLASS, TOP_MANUFACTURERS,
)
from rollspan.functions.numeric import band_flags, ratio
from rollspan.functions.text import any_of, first_match, like_rules, map_ids, multivalue_bucket, prefix_key
from rollspan.operators.aggregates import Measure, distinct_stats, sliced_stats
from rollspan.operators.joins import enrich, outer_merge
from rollspan.operators.rollups import WEEKS, lookback, month_steps_rollup, trend_ratios, window_stats
from rollspan.operators.state import NewestState
from rollspan.operators.windows import latest_per_key, top1_by_count
from rollspan.sources.tables import latest_per_period, latest_snapshot


# --- provinces seen ----------------------------------------------------------------------

def location(raw: DataFrame, snapshot: str, weeks: int = 4) -> DataFrame:
    """Distinct provinces, occurrences, entropy and the most frequent province.

    Everything derives from the (subscriber, province) counts, so the raw rows are
    shuffled once and reduced map-side. Entropy uses H = log2(N) - sum(n*log2 n)/N.
    """
    f = f"l{weeks}w"
    rows = lookback(raw, "s3_file_date", snapshot, weeks)
    counts = rows.groupBy("msisdn", "province").agg(F.count(F.lit(1)).alias("n"))
    n, whole = F.col("n"), F.sum("n")
    best = F.min(F.struct((-n).alias("neg"), F.col("province").alias("p")))
    out = counts.groupBy("msisdn").agg(
        F.count("province").alias(f"location_count_distinct_{f}"), whole.alias(f"location_occurrence_count_{f}"),
        (F.log2(whole) - F.sum(n * F.log2(n)) / whole).alias(f"location_entropy_{f}"), best.alias("_b"))
    top_n = -F.col("_b.neg")
    return out.select(
        *[c for c in out.columns if c != "_b"], F.col("_b.p").alias(f"location_top1_province_{f}"),
        top_n.alias(f"location_top1_province_count_{f}"),
        ratio(top_n, f"location_occurrence_count_{f}").alias(f"location_top1_province_ratio_{f}"))


# --- device of a subscriber -------------------------------------------------------------------

def tac_mapping(usage: DataFrame, snapshot: str) -> DataFrame:
    """Device type code seen on most days of the last month (ties: smaller code)."""
    start = ymd(shift_months(as_date(snapshot), -1))
    rows = usage.where((F.col("s3_file_date") >= start) & (F.col("s3_file_date") < snapshot) & (F.col("imei") != ""))
    daily = rows.select("msisdn", prefix_key("imei", 8).alias("tac"), "s3_file_date").distinct()
    return top1_by_count(daily, ["msisdn"], "tac").select("msisdn", "tac")


def latest_device(usage: DataFrame, catalogue: DataFrame, snapshot: str, attributes: Mapping[str, object],
                  asof_year: int) -> DataFrame:
    """Newest device rows of each subscriber in the month, enriched from the newest
    catalogue snapshot, gaps filled (``attributes``: column -> filler)."""
    lo, hi = snapshot_windows(snapshot)["month"]
    rows = usage.where((F.col("s3_file_date") >= lo) & (F.col("s3_file_date") < hi) & (F.col("imei") != ""))
    newest = latest_per_key(rows.select("msisdn", "s3_file_date", "imei"), ["msisdn"], ["s3_file_date"])
    dim = latest_per_key(latest_snapshot(catalogue, "s3_file_date").select("tac", *attributes), ["tac"], [])
    out = enrich(newest.withColumn("tac", prefix_key("imei", 8)), dim, ["tac"])
    out = out.withColumn("year_released_delta", F.lit(asof_year) - F.col("year_released").try_cast("int"))
    return out.fillna(dict(attributes)).drop("imei", "s3_file_date")


# --- device catalogue ------------------------------------------------------------------------------

def yes_no(c: str) -> Column:
    v = F.lower(F.col(c))
    return F.when(v.isin("y", "yes"), 1).when(v.isin("n", "no"), 0)


def apple_chip(c: str) -> Column:
    mark = F.lit(False)
    for m in APPLE_CHIP_MARKS:
        mark = mark | F.col(c).like(m)
    return F.col(c).rlike(APPLE_CHIP) & mark


def family_of(c: str, rules, chip: str) -> Column:
    named = [(like_rules(c, [(label, p)], "").eqNullSafe(label), label) for label, p in rules]
    return first_match([*named, (apple_chip(chip), "Apple")], "others")


def device_attributes(df: DataFrame, year: int, absent: str = "raise") -> dict[str, Column]:
    """All derived device columns; one whose inputs ``df`` lacks raises, or is left out with ``absent="skip"``."""
    have = {c.lower() for c in df.columns}

    def has(*cols):
        return all(c.lower() in have for c in cols)

    storage = F.col("Internal_Storage_Capacity").cast("double") if has("Internal_Storage_Capacity") else None
    candidates = {
        "device_age": (["Year_Released"], lambda: F.lit(year) - F.col("Year_Released").cast("int")),
        "device_type": (["GSMA_Device_Type"], lambda: map_ids("GSMA_Device_Type", DEVICE_TYPE, "other")),
        "device_manu": (["Manufacturer"], lambda: map_ids("Manufacturer", MANUFACTURER_GROUP, "other brands")),
        "device_top_manu": (["GSMA_manufacturer"], lambda: F.when(F.col("GSMA_manufacturer").isin(TOP_MANUFACTURERS), F.col("GSMA_manufacturer")).otherwise("other")),
        "device_lpwan": (["GSMA_LPWAN"], lambda: F.when(F.col("GSMA_LPWAN").isin("Not Known", "Not Supported"), F.col("GSMA_LPWAN"))
                         .when(F.col("GSMA_LPWAN").isNull() | (F.col("GSMA_LPWAN") == ""), "Not Known").otherwise("Supported")),
        "device_has_nanosim": (["SIM_Size"], lambda: F.when(F.col("SIM_Size").like("%Nano%"), 1).otherwise(0)),
        "device_has_minisim": (["SIM_Size"], lambda: F.when(F.col("SIM_Size").like("%Mini%"), 1).otherwise(0)),
        "device_has_microsim": (["SIM_Size"], lambda: F.when(F.col("SIM_Size").like("%Micro%"), 1).otherwise(0)),
        "device_internal_storage": (["Internal_Storage_Capacity"], lambda: F.when(storage.isin(2048.0, 24576.0), storage / 1024).otherwise(storage)),
        "device_has_bluetooth": (["GSMA_Bluetooth"], lambda: yes_no("GSMA_Bluetooth")),
        "device_has_wlan": (["GSMA_WLAN"], lambda: yes_no("GSMA_WLAN")),
        "device_os_family": (["OS_Name"], lambda: F.when(F.col("OS_Name").isin("Android", "iOS"), F.col("OS_Name")).otherwise("others")),
        "device_chipset_family": (["Chipset_Name"], lambda: family_of("Chipset_Name", CHIPSET_FAMILY, "Chipset_Name")),
        "device_gpu_family": (["GPU_Name", "Chipset_Name"], lambda: family_of("GPU_Name", GPU_FAMILY, "Chipset_Name")),
        "device_continent": (["GSMA_Country_Code"], lambda: map_ids(F.col("GSMA_Country_Code").try_cast("int"), CONTINENT, "unknown")),
        "device_ram_category": (["Total_RAM"], lambda: multivalue_bucket("Total_RAM", "/", RAM_BUCKETS, RAM_LAST, RAM_UNKNOWN, 100, 1024)),
        **{name: (cols, lambda cols=cols: any_of(cols)) for name, cols in CAPABILITIES.items()},
        **{new: ([old], lambda old=old: F.col(f"`{old}`")) for old, new in DEVICE_RENAMES.items()},
    }
    lacking = [name for name, (needs, _) in candidates.items() if not has(*needs)]
    if lacking and absent == "raise":
        raise ValueError(f"absent inputs of: {', '.join(lacking)}")
    return {name: make() for name, (_, make) in candidates.items() if name not in lacking}


def device(catalogue: DataFrame, snapshot: str, absent: str = "raise") -> DataFrame:
    """Device features of the newest catalogue within three months, one row per TAC.

    A narrower catalogue is served with ``absent="skip"``, which leaves out what it has no inputs for.
    """
    rows = latest_snapshot(catalogue, "s3_file_date", snapshot, 3)
    cols = device_attributes(rows, int(snapshot[:4]), absent)
    return latest_per_key(rows.select("tac", *[c.alias(n) for n, c in cols.items()]), ["tac"], [])


# --- demographics ---------------------------------------------------------------------------------

CHANGE_STAMP = "dd/MM/yyyy HH:mm:ss"
NO_CHANGE = "1980-01-01 00:00:00"


def gender_code(c: Column | str) -> Column:
    v = F.col(c) if isinstance(c, str) else c
    return first_match([(v.isin(names), code) for code, names in GENDER.items()], 2)


def change_rows(df: DataFrame, changed: str) -> DataFrame:
    """Rows with a change stamp, and when that was (``_at``); unparsable stamps sort as the 1980 sentinel."""
    return df.where(F.col(changed).isNotNull()).withColumn("_at", safe_ts(changed, [CHANGE_STAMP], NO_CHANGE))


def newest_change(df: DataFrame, key: str, changed: str, snapshot: str) -> DataFrame:
    """One row per key: newest file that has a change stamp, then the newest stamp in it.

    The file date test (``max`` over rows with a stamp) and the choice of the row are one
    aggregate of ordered structs over the whole history; :func:`registry_state` keeps it up day by day.
    """
    return latest_per_key(change_rows(df.where(F.col("s3_file_date") < snapshot), changed), [key], ["s3_file_date", "_at"])


def registry_state(spark: SparkSession, path: str, key: str) -> NewestState:
    """Stored newest changes of a registry, to be advanced with :func:`change_rows` of it."""
    return NewestState(spark, path, [key], ["s3_file_date", "_at"], "s3_file_date")


def recency_wins(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                 pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Outer join of two sources; per attribute the side changed last wins (ties: left).
    A missing stamp counts as 1980."""
    joined = left.join(right, key, "full_outer")
    old = F.lit(NO_CHANGE).cast("timestamp")
    first = F.coalesce(F.col(left_ts), old) >= F.coalesce(F.col(right_ts), old)
    return joined.select(key, *[F.when(first, F.col(a)).otherwise(F.col(b)).alias(n) for n, (a, b) in pairs.items()])


def prepaid_danhba(prepaid: DataFrame, directory: DataFrame, snapshot: str) -> DataFrame:
    """Sex and age group from whichever registry changed last."""
    return demographics(newest_change(prepaid, "msisdn", "modifydate", snapshot), newest_change(directory, "somay", "ngay_cn", snapshot))


def demographics(prepaid: DataFrame, directory: DataFrame) -> DataFrame:
    """:func:`prepaid_danhba` from the newest change per key of either registry, stored or not."""
    a = prepaid.select(
        "msisdn", F.col("_at").alias("a_at"), gender_code("gender").alias("a_sex"), F.col("age").cast("string").alias("a_age"))
    phai = F.col("phai")
    b = directory.select(
        F.col("somay").alias("msisdn"), F.col("_at").alias("b_at"),
        F.when(phai.isin(0, 1), phai.cast("int")).otherwise(2).alias("b_sex"), F.col("nhom_tuoi").cast("string").alias("b_age"))
    return recency_wins(a, b, "msisdn", "a_at", "b_at", {
        "prepaid_danhba_sex_l1w": ("a_sex", "b_sex"), "prepaid_danhba_age_group_l1w": ("a_age", "b_age")})


# --- balances and lifecycle ----------------------------------------------------------------------------

BALANCE_STATS = {
    "sub_balance_avg_per_day": ("avg", "account_balance"), "sub_balance_max_per_day": ("max", "account_balance"),
    "sub_balance_std_per_day": ("std", "account_balance"),
    **{f"sub_balance_pct_day_{b}": ("avg", f"band_{b}") for b in BALANCE_BANDS},
}


def sub_daily(raw: DataFrame) -> DataFrame:
    return band_flags(raw.withColumnRenamed("account_id", "msisdn"), "account_balance",
                      {f"band_{b}": spec for b, spec in BALANCE_BANDS.items()})


def latest_day_attributes(df: DataFrame, key: str, day: str, attributes: Mapping[str, str], since: str, upto: str) -> DataFrame:
    """Maximum of each attribute over the rows of the key's last day in ``[since, upto)``."""
    rows = df.where((F.col(day) >= since) & (F.col(day) < upto))
    per_day = rows.groupBy(key, day).agg(F.struct(*[F.max(c).alias(n) for n, c in attributes.items()]).alias("_a"))
    return per_day.groupBy(key).agg(F.max(F.struct(day, "_a")).alias("_m")).select(
        key, *[F.col(f"_m._a.{n}").alias(n) for n in attributes])


def sub(raw: DataFrame, snapshot: str, windows: Sequence[int] = WEEKS, active_days: int = 30) -> DataFrame:
    """Balance statistics per window and trends, plus activation attributes of the last
    active day."""
    daily = sub_daily(raw)
    wide = window_stats(daily, ["msisdn"], "s3_file_date", snapshot, BALANCE_STATS, windows)
    wide = trend_ratios(wide, list(BALANCE_STATS), windows)
    since = ymd(as_date(snapshot).fromordinal(as_date(snapshot).toordinal() - active_days))
    life = latest_day_attributes(daily, "msisdn", "s3_file_date", {
        "sub_activated_date": "account_activated_date", "sub_activated_flag": "account_activated_flag",
        "service_class_id": "service_class_id"}, since, snapshot)
    life = life.withColumns({
        "sub_service_type": map_ids("service_class_id", SERVICE_CLASS, "unknown"),
        "sub_activate_year": years_since(F.to_date("sub_activated_date"), snapshot)})
    return outer_merge([wide, life], ["msisdn"])


# --- billing lines -----------------------------------------------------------------------------------------

def billing(raw: DataFrame, snapshot: str, prefix: str, item: str, debt: str, tax: str) -> DataFrame:
    """Debt (or payment) features of the billing month complete at the snapshot: totals and
    per fee group counts of items, sums, maxima, deviations and shares."""
    month = snapshot_windows(snapshot)["bill"][0]
    rows = raw.where(F.col("s3_file_date") == month).select(
        "msisdn", F.col(item).alias("item"), F.col(debt).alias("debt"), F.col(tax).alias("tax"),
        (F.col(debt) + F.col(tax)).alias("amount"), map_ids(item, FEE_GROUPS, "other").alias("fee_cate"))
    values = ("debt", "tax", "amount")
    measures = [Measure(f"{prefix}_total_{v}_sum_l1m", "sum", v) for v in values]
    groups = [*FEE_GROUPS, "other"]
    for g in groups:
        cond = f"fee_cate = '{g}'"
        measures += [Measure(f"{prefix}_{g}_{v}_{a}_l1m", a, v, cond) for v in values for a in ("sum", "max", "std")]
    items = distinct_stats(rows, ["msisdn"], "item", {
        f"{prefix}_total_items_count_distinct_l1m": None,
        **{f"{prefix}_{g}_items_count_distinct_l1m": f"fee_cate = '{g}'" for g in groups}})
    out = outer_merge([sliced_stats(rows, ["msisdn"], measures), items], ["msisdn"])
    return out.withColumns({
        f"{prefix}_{g}_{v}_ratio_l1m": ratio(f"{prefix}_{g}_{v}_sum_l1m", f"{prefix}_total_{v}_sum_l1m")
        for g in groups for v in ("debt", "amount")})


def ccbs_no(raw: DataFrame, snapshot: str) -> DataFrame:
    return billing(raw.withColumnRenamed("ma_tb", "msisdn"), snapshot, "no", "khoanmuctt_id", "nogoc", "thue")


def ccbs_tra(raw: DataFrame, snapshot: str) -> DataFrame:
    return billing(raw.withColumnRenamed("ma_tb", "msisdn"), snapshot, "tra", "khoanmuctt_id", "tragoc", "trathue")


# --- month-to-date revenue ------------------------------------------------------------------------------------

MONTHS = (1, 2, 3, 6)


def smrs(raw: DataFrame, snapshot: str, measures: Mapping[str, str] = REVENUE_MEASURES) -> DataFrame:
    """1/2/3/6-month revenue features.

    The counters are cumulative within a month, so the last day of a month is its total.
    A snapshot takes the previous calendar month; k months are the snapshots D, D-4w, ...
    All measures come out of one scan of these days and one shuffle of (subscriber, step) sums.
    """
    steps = month_steps(snapshot, max(MONTHS))
    keys = [int(ymd(shift_months(as_date(s), -1))[:6]) for s in steps]
    last = latest_per_period(raw, "s3_file_date", "mo_key", sorted(set(keys)))
    # a month can serve two steps (D and D-4w inside one month)
    served = {k: [i for i, other in enumerate(keys) if other == k] for k in keys}
    steps_of = F.create_map(*[x for k, s in served.items() for x in (F.lit(k), F.array(*map(F.lit, s)))])
    sums = [F.sum(c).alias(f"smrs_{n}_sum") for c, n in measures.items()]
    # rows are added up per month before a month is dealt to its steps
    monthly = last.groupBy(F.col("accs_mthd_key").alias("msisdn"), "mo_key").agg(*sums)
    stems = [f"smrs_{n}_sum" for n in measures.values()]
    monthly = monthly.select("msisdn", F.explode(steps_of[F.col("mo_key")]).alias("step"), *stems)
    return trend_ratios(month_steps_rollup(monthly, ["msisdn"], "step", stems, MONTHS[1:]), stems, MONTHS, "all", "m")

"""Joins of the feature stage.

Broadcast hints are placed only on sides whose size has a bound that does
not grow with the fact table: the monthly series (one row per month), a
one-row latest record. Sides that are small as a rule but have no such bound (means or seen values per key) are
measured first (``join_measured``). Everything else is left to the planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.functions.parse import ELITE_INDICATORS, any_yes, address_key
from appraise.session import materialize
from appraise.sources.tables import PROPERTY_VOLATILE, SERIES_MEASURES

BROADCAST_BYTES = 32 << 20
"""Bytes (as JSON text) up to which ``join_measured`` broadcasts its small side."""


def join_measured(facts: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
                  max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Facts joined (``inner`` or ``left``) to a side that holds one row per key and is small as a rule.

    The small side is written and measured. Up to ``max_bytes`` it is broadcast and no fact is shuffled, however few keys hold
    them; beyond it the facts are split by ``join_heavy_apart``. Null keys match nothing.
    """
    small = materialize(small)
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()["b"] or 0
    if size <= max_bytes:
        return facts.join(F.broadcast(small), keys, how)
    return join_heavy_apart(facts, small, keys, how)


def join_heavy_apart(facts: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
                     parts: int | None = None) -> DataFrame:
    """The same join where ``small`` can't be broadcast: keys with more facts than a fair partition meet theirs by broadcast.

    There are fewer of those than partitions, whatever the data, and ``small`` has one row for each. Facts of null keys stay
    where they are too; the rest is shuffled. ``facts`` is read three times (counts, heavy and other rows).
    """
    n = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = materialize(facts.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n").alias("t")).first()["t"] or 0
    heavy = counts.where(F.col("_n") * n > total).select(*keys, F.lit(True).alias("_heavy"))
    flagged = facts.join(F.broadcast(heavy), keys, "left")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    stays = F.coalesce(F.col("_heavy"), F.lit(False)) | null_key
    of_heavy = small.join(F.broadcast(heavy), keys, "left_semi")
    hot = flagged.where(stays).drop("_heavy").join(F.broadcast(of_heavy), keys, how)
    rest = flagged.where(~stays).drop("_heavy").join(small, keys, how)
    return hot.unionByName(rest)


def split_by_cutoff(df: DataFrame, cutoff: str, month_col: str = "month", out: str = "split") -> DataFrame:
    """``train`` when month < cutoff, else ``test`` (one frame, a split column)."""
    return df.withColumn(
        out, F.when(F.col(month_col) < F.to_date(F.lit(cutoff)), F.lit("train")).otherwise(F.lit("test"))
    )


def between_months(df: DataFrame, start: str, end: str, month_col: str = "month") -> DataFrame:
    """B2: keep start <= month <= end (both inclusive, ``yyyy-MM`` bounds)."""
    return df.filter(
        F.col(month_col).between(F.to_date(F.lit(start + "-01")), F.to_date(F.lit(end + "-01")))
    )


def first_per_key(df: DataFrame, keys: list[str], order_col: str | list[str]) -> DataFrame:
    """The first row per key under explicit order column(s) (nulls last).

    An aggregate (``min_by`` over the whole row), not a window: partial
    aggregation on the map side keeps a key that holds a third of the rows
    from landing in one task.
    """
    cols = [order_col] if isinstance(order_col, str) else list(order_col)
    order = F.struct(*[x for c in cols for x in (F.col(c).isNull().alias(f"_n{c}"), F.col(c).alias(f"_v{c}"))])
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, order).alias("_r")).select("_r.*")


def latest_row(df: DataFrame, order_col: str = "month") -> DataFrame:
    """The row with the largest order value (top-1, no global sort)."""
    return df.orderBy(F.col(order_col).desc()).limit(1)


def join_buildings(tx: DataFrame, buildings: DataFrame, keys: tuple[str, ...] = ("block", "street_name")) -> DataFrame:
    """Left equi-join of per-building features onto sale records.

    Clashing non-key names from the right get a ``_y`` suffix.
    """
    clash = [c for c in buildings.columns if c in tx.columns and c not in keys]
    b = buildings.withColumnsRenamed({c: f"{c}_y" for c in clash}) if clash else buildings
    return tx.join(b, list(keys), "left")


def merge_property_info(tx: DataFrame, prop: DataFrame, drop_cols: list[str] | None = None) -> DataFrame:
    """Drop volatile columns, rename keys, left join on (block, street_name)."""
    p = prop.drop(*(drop_cols if drop_cols is not None else PROPERTY_VOLATILE))
    p = p.withColumnsRenamed({"blk_no": "block", "street": "street_name"})
    return tx.join(p, ["block", "street_name"], "left")


def unmatched_count(df: DataFrame, probe_col: str = "max_floor_lvl") -> DataFrame:
    """D12 after C2: rows without a match (one-row frame)."""
    return df.agg(F.count_if(F.col(probe_col).isNull()).alias("n_unmatched"))


def lag_series(series: DataFrame, lag_months: int = 1, month_col: str = "month") -> DataFrame:
    """Shift a monthly series forward so that the row keyed T carries T - lag."""
    return series.withColumn(month_col, F.trunc(F.add_months(F.col(month_col), lag_months), "month"))


def lagged_join(
    tx: DataFrame,
    series: DataFrame,
    lag_months: int = 1,
    month_col: str = "month",
    measures: list[str] | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """A record of month T gets the series values of month T - lag (no look-ahead).

    One series row per shifted month is kept (the first by ``order_col``).
    The series has one row per month, a size bounded by the calendar, so it
    is broadcast.
    """
    measures = [m for m in (measures or SERIES_MEASURES) if m in series.columns]
    s = series.withColumn("_src_month", F.col(month_col))
    s = lag_series(s, lag_months, month_col).withColumnRenamed(month_col, "_mm")
    s = first_per_key(s, ["_mm"], order_col or "_src_month").select("_mm", *measures)
    t = tx.withColumn("_mm", F.trunc(F.col(month_col), "month"))
    return t.join(F.broadcast(s), "_mm", "left").drop("_mm")


def missing_months(tx: DataFrame, series: DataFrame, month_col: str = "month") -> DataFrame:
    """Months of the records that the series lacks (anti-join)."""
    m = tx.select(F.trunc(F.col(month_col), "month").alias("month")).distinct()
    s = series.select(F.trunc(F.col(month_col), "month").alias("month")).distinct()
    return m.join(s, "month", "left_anti")


def impute_unseen(test: DataFrame, train: DataFrame, col: str, fallback: str) -> DataFrame:
    """Values of ``col`` not among the non-null train values (or null) -> fallback."""
    seen = train.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("_seen", F.lit(True))
    out = join_measured(test, seen, [col])
    filled = F.when(F.col("_seen").isNull(), F.lit(fallback)).otherwise(F.col(col))
    return out.withColumn(col, filled).drop("_seen")


def elite_lookup(refs: DataFrame, name_col: str = "ref_name", order_col: str = "ref_id",
                 indicators: list[str] | None = None) -> DataFrame:
    """C6 lookup table: first row per name, flag = any indicator equals 'Yes'."""
    inds = indicators or ELITE_INDICATORS
    first = first_per_key(refs, [name_col], order_col)
    return first.select(F.col(name_col).alias("_name"), any_yes(inds, refs.columns).alias("_flag"))


def add_elite_flags(df: DataFrame, refs: DataFrame, name_cols: list[str], name_col: str = "ref_name",
                    order_col: str = "ref_id") -> DataFrame:
    """Replace each name column by ``is_elite_<col>``; unknown or null names -> false."""
    look = elite_lookup(refs, name_col, order_col)
    out = df
    for c in name_cols:
        if c not in out.columns:
            continue
        lk = look.withColumnsRenamed({"_name": f"_n_{c}", "_flag": f"_f_{c}"})
        out = (
            out.join(lk, out[c] == lk[f"_n_{c}"], "left")
            .withColumn(f"is_elite_{c}", F.coalesce(F.col(f"_f_{c}"), F.lit(False)))
            .drop(c, f"_n_{c}", f"_f_{c}")
        )
    return out


def gazetteer_lookup(buildings: DataFrame, by_address: DataFrame, by_postal: DataFrame) -> DataFrame:
    """C11: coordinates by address key, then by postal code for the misses.

    Output adds ``latitude``, ``longitude`` and ``geo_source`` ('address',
    'postal' or NULL) to each building row.
    """
    b = buildings.withColumn("_addr", address_key("block", "street_name"))
    j = b.join(by_address.withColumnRenamed("address", "_addr"), "_addr", "left").join(by_postal, "postal_code", "left")
    return j.select(
        *[c for c in buildings.columns if c not in ("latitude", "longitude")],
        F.coalesce("g_lat", "p_lat").alias("latitude"),
        F.coalesce("g_lng", "p_lng").alias("longitude"),
        F.when(F.col("g_lat").isNotNull(), F.lit("address"))
        .when(F.col("p_lat").isNotNull(), F.lit("postal"))
        .alias("geo_source"),
    )


def attach_latest(df: DataFrame, series: DataFrame, measures: list[str] | None = None,
                  month_col: str = "month") -> DataFrame:
    """Add the latest series values to every row (one row, as literals)."""
    measures = [m for m in (measures or SERIES_MEASURES) if m in series.columns]
    row = latest_row(series, month_col).first()
    if row is None:
        return df.withColumns({m: F.lit(None).cast("double") for m in measures})
    return df.withColumns({m: F.lit(row[m]) for m in measures})


def impute_unseen_in_split(df: DataFrame, col: str, fallback: str, split_col: str = "split",
                           train_value: str = "train", test_value: str = "test") -> DataFrame:
    """C8 on a frame holding both splits: test values unseen in train (or null) -> fallback."""
    return impute_unseen_columns(df, {col: fallback}, split_col, train_value, test_value)


def impute_unseen_columns(df: DataFrame, fallbacks: dict[str, str], split_col: str = "split",
                          train_value: str = "train", test_value: str = "test") -> DataFrame:
    """C8 for several columns: test values unseen in train (or null) -> the column's fallback.

    The train values of all columns are found in one pass and written once. Columns are text.
    """
    if not fallbacks:
        return df
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in fallbacks]))
    seen = materialize(
        df.filter(F.col(split_col) == train_value).select(pairs.alias("p")).select("p.c", "p.v")
        .filter(F.col("v").isNotNull()).distinct())
    out = df
    for col, fallback in fallbacks.items():
        own = seen.filter(F.col("c") == col).select(F.col("v").alias(col), F.lit(True).alias("_seen"))
        unseen = (F.col(split_col) == test_value) & F.col("_seen").isNull()
        out = join_measured(out, own, [col])
        out = out.withColumn(col, F.when(unseen, F.lit(fallback)).otherwise(F.col(col))).drop("_seen")
    return out.select(*df.columns)

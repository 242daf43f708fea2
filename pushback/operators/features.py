"""Feature operators (B11-B22, E1-E4, D29-D30) and the feature-matrix job (H3-H5).

Label-free features are per-row expressions plus group counts; label-derived
encodings are fitted on the training rows only and looked up for test rows.
Every group statistic is an aggregate over its key (map-side combined, so a
key holding a third of the rows costs one partial row per task), joined back
through ``attach_stats`` — a broadcast when the key count is within limits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback import profile as P
from pushback.functions.calendar import federal_holidays
from pushback.functions.exprs import (departure_bank, departure_bank_code, hour_of_hhmm,
                                      joined_key, weather_intensity)
from pushback.operators.joins import MAX_BROADCAST_ROWS, attach_stats, keyed_stats
from pushback.operators.nearest_information import nearest_mutual_information
from pushback.session import cut_lineage

DEP_HOUR = "__dep_hour"
ARR_HOUR = "__arr_hour"
BANK = "departure_hour_bucket"


def add_temporal_features(df: DataFrame, year: str = "YEAR", month: str = "MONTH",
                          day: str = "DAY", dow: str = "DAY_OF_WEEK",
                          departure: str = "SCHEDULED_DEPARTURE",
                          arrival: str = "SCHEDULED_ARRIVAL") -> DataFrame:
    """Weekend, holiday, cyclic hour/month, departure bank and peak flags.

    The holiday list covers the table's year range (one small aggregate) and
    is inlined as a literal set.
    """
    span = df.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).first()
    days = federal_holidays(span["lo"], span["hi"]) if span["lo"] is not None else []
    dep_h = hour_of_hhmm(departure)
    arr_h = hour_of_hhmm(arrival)
    date = F.make_date(F.col(year), F.col(month), F.col(day))
    two_pi = 2 * math.pi
    out = (df.withColumn("is_weekend", F.col(dow).isin(6, 7).cast("int"))
             .withColumn("is_holiday", F.coalesce(date.isin(*days), F.lit(False)).cast("int")
                         if days else F.lit(0))
             .withColumn("scheduled_departure_hour_sin", F.sin(dep_h * two_pi / 24))
             .withColumn("scheduled_departure_hour_cos", F.cos(dep_h * two_pi / 24))
             .withColumn("scheduled_arrival_hour_sin", F.sin(arr_h * two_pi / 24))
             .withColumn("scheduled_arrival_hour_cos", F.cos(arr_h * two_pi / 24))
             .withColumn("month_sin", F.sin((F.col(month) - 1) * two_pi / 12))
             .withColumn("month_cos", F.cos((F.col(month) - 1) * two_pi / 12))
             .withColumn(BANK, departure_bank(dep_h))
             .withColumn("departure_hour_bucket_code", departure_bank_code(BANK)))
    for name, (lo, hi) in P.PEAK_BANKS.items():
        out = out.withColumn(name, dep_h.between(lo, hi).cast("int"))
    return out


def _ratio(count: str, mean: str) -> Column:
    return F.col(count) / F.col(mean)


def add_congestion_features(df: DataFrame, origin: str = "ORIGIN_AIRPORT",
                            dest: str = "DESTINATION_AIRPORT", dow: str = "DAY_OF_WEEK",
                            departure: str = "SCHEDULED_DEPARTURE",
                            arrival: str = "SCHEDULED_ARRIVAL") -> DataFrame:
    """E1 + E2: airport/day/hour and airport/day/bank counts, and their ratios to the
    row-weighted mean count within (airport, day).

    The four counts need two join-backs: the origin table is keyed by
    (origin, day, departure hour) — the bank is a function of that hour — and
    the destination table by (destination, day, arrival hour, departure hour).
    Both are aggregates whose window work runs on at most 24 x 24 rows per
    (airport, day). NULL keys form their own group, as in the reference.
    """
    rows = (df.withColumn(DEP_HOUR, hour_of_hhmm(departure))
              .withColumn(ARR_HOUR, hour_of_hhmm(arrival)))
    ad_o = Window.partitionBy(origin, dow)
    o = (rows.groupBy(origin, dow, DEP_HOUR).agg(F.count(F.lit(1)).alias("origin_hourly_departure_count"))
         .withColumn("__bank", departure_bank(DEP_HOUR)))
    o = o.withColumn("origin_departure_bank_count", F.sum("origin_hourly_departure_count").over(
        Window.partitionBy(origin, dow, "__bank")))
    c_h, c_b = F.col("origin_hourly_departure_count"), F.col("origin_departure_bank_count")
    o = (o.withColumn("__n", F.sum(c_h).over(ad_o))
          .withColumn("origin_congestion_ratio", c_h / (F.sum(c_h * c_h).over(ad_o) / F.col("__n")))
          .withColumn("origin_departure_bank_ratio", c_b / (F.sum(c_h * c_b).over(ad_o) / F.col("__n")))
          .drop("__bank", "__n"))

    ad_d = Window.partitionBy(dest, dow)
    d = (rows.groupBy(dest, dow, ARR_HOUR, DEP_HOUR).agg(F.count(F.lit(1)).alias("__c"))
         .withColumn("__bank", departure_bank(DEP_HOUR)))
    c = F.col("__c")
    d = (d.withColumn("destination_hourly_arrival_count",
                      F.sum(c).over(Window.partitionBy(dest, dow, ARR_HOUR)))
          .withColumn("destination_departure_bank_count",
                      F.sum(c).over(Window.partitionBy(dest, dow, "__bank"))))
    a_h, a_b = F.col("destination_hourly_arrival_count"), F.col("destination_departure_bank_count")
    d = (d.withColumn("__n", F.sum(c).over(ad_d))
          .withColumn("destination_congestion_ratio", a_h / (F.sum(c * a_h).over(ad_d) / F.col("__n")))
          .withColumn("destination_departure_bank_ratio",
                      a_b / (F.sum(c * a_b).over(ad_d) / F.col("__n")))
          .drop("__c", "__bank", "__n"))

    out = attach_stats(rows, o, [origin, dow, DEP_HOUR], null_safe=True)
    out = attach_stats(out, d, [dest, dow, ARR_HOUR, DEP_HOUR], null_safe=True)
    return out.drop(DEP_HOUR, ARR_HOUR)


def add_weather_scores(df: DataFrame) -> DataFrame:
    """B17 + B18: weather intensity (origin, destination) and congestion x weather."""
    oi, di = F.col("origin_weather_intensity"), F.col("destination_weather_intensity")
    ocr, dcr = F.col("origin_congestion_ratio"), F.col("destination_congestion_ratio")
    return (df.withColumn("origin_weather_intensity", weather_intensity(""))
              .withColumn("destination_weather_intensity", weather_intensity(P.DEST_PREFIX))
              .withColumn("origin_congestion_weather_score", ocr * oi)
              .withColumn("destination_congestion_weather_score", dcr * di)
              .withColumn("route_congestion_weather_score", (ocr + dcr) * (oi + di))
              .withColumn("origin_departure_bank_weather_score",
                          F.col("origin_departure_bank_ratio") * oi)
              .withColumn("destination_departure_bank_weather_score",
                          F.col("destination_departure_bank_ratio") * di))


def add_interaction_keys(df: DataFrame, airline: str = "AIRLINE",
                         origin: str = "ORIGIN_AIRPORT", dest: str = "DESTINATION_AIRPORT",
                         dow: str = "DAY_OF_WEEK") -> DataFrame:
    """Route and six dense interaction keys (NULL in, NULL out)."""
    out = df.withColumn("ROUTE", joined_key(origin, dest))
    return (out.withColumn("AIRLINE_DEPARTURE_BANK", joined_key(airline, BANK))
               .withColumn("ORIGIN_AIRPORT_DEPARTURE_BANK", joined_key(origin, BANK))
               .withColumn("ORIGIN_AIRPORT_DAY_OF_WEEK", joined_key(origin, dow))
               .withColumn("AIRLINE_ROUTE", joined_key(airline, "ROUTE"))
               .withColumn("ROUTE_DEPARTURE_BANK", joined_key("ROUTE", BANK))
               .withColumn("ROUTE_DAY_OF_WEEK", joined_key("ROUTE", dow)))


def prepare_model_features(df: DataFrame) -> DataFrame:
    """H3: every label-free feature (computed on one split at a time)."""
    return (df.transform(add_temporal_features)
              .transform(add_congestion_features)
              .transform(add_weather_scores)
              .transform(add_interaction_keys))


def historical_targets(label: str = P.TARGET) -> dict[str, Column]:
    """Rate name -> 0/1 indicator of the label."""
    return {name: F.col(label).isin(*classes).cast("double")
            for name, classes in P.HISTORICAL_RATES.items()}


@dataclass
class KeyFit:
    """What the encodings learn: rows, label sums (``names``) of each value of each key
    in ``stats``, whose slices of the ``small`` keys may be held whole, and the shares
    of the labels over all rows."""
    stats: DataFrame
    small: dict[str, bool]
    names: list[str]
    prior: dict[str, float]

    def slice(self, key: str) -> DataFrame:
        return self.stats.filter(F.col("__key") == key).drop("__key")


def fit_keys(train: DataFrame, keys: Sequence[str], label: str | None = None,
             classes: Sequence[str] = P.CLASS_ORDER) -> KeyFit:
    """Statistics of all ``keys`` by one aggregate over the training rows; label sums where ``label`` is given."""
    ind = historical_targets(label) if label else {}
    row = train.agg(*[F.avg(e).alias(n) for n, e in ind.items()]).first() if ind else {}
    prior = {n: (row[n] if row[n] is not None else 0.0) for n in ind}
    stats, small = keyed_stats(train.select(*keys, *[e.alias(f"__s_{n}") for n, e in ind.items()]), list(keys), "__n",
                               [f"__s_{n}" for n in ind],
                               # the training side of a join has a row a class
                               max_rows=MAX_BROADCAST_ROWS // len(classes) if ind else MAX_BROADCAST_ROWS)
    return KeyFit(stats, small, list(ind), prior)


def add_frequency_encoding(train: DataFrame, test: DataFrame,
                           columns: Sequence[str] = P.FREQUENCY_COLUMNS
                           ) -> tuple[DataFrame, DataFrame]:
    """E3 + C5: share of non-null training rows per value; unseen test value -> 0.

    A NULL value stays NULL on the training side and becomes 0 on the test side.
    All columns' counts come from one aggregate over the training rows.
    """
    fit = fit_keys(train, list(columns))
    return _encoded(train, fit, columns, {}), _encoded(test, fit, columns, {}, unseen=0.0)


def add_smoothed_rates(train: DataFrame, test: DataFrame,
                       keys: dict[str, str] = P.HISTORICAL_KEYS, label: str = P.TARGET,
                       smoothing: float = P.HISTORICAL_SMOOTHING,
                       classes: Sequence[str] = P.CLASS_ORDER, drop: Sequence[str] = ()
                       ) -> tuple[DataFrame, DataFrame]:
    """Smoothed leave-one-out target rates per key on train, smoothed rates on test.

    train: (group_sum - own + m*g) / (group_n - 1 + m)
    test:  (group_sum + m*g) / (group_n + m); unseen or NULL key -> g.

    All keys' sums come from one aggregate.
    Columns named by ``drop`` are left out of the result.
    """
    fit = fit_keys(train, list(keys), label, classes)
    m = float(smoothing)
    return (_encoded(train, fit, (), keys, m, label=label, classes=classes, drop=drop),
            _encoded(test, fit, (), keys, m, drop=drop))


def _encoded(df: DataFrame, fit: KeyFit, frequencies: Sequence[str], rates: dict[str, str], smoothing: float = 0.0,
             unseen: float | None = None, label: str | None = None, classes: Sequence[str] = (),
             drop: Sequence[str] = ()) -> DataFrame:
    """``df`` with the share of each of ``frequencies`` (``unseen`` where there is none)
    and the rates of the keys of ``rates``; with ``label`` the row's own label is left out of them.

    The rows go as one struct each beside their keys. Statistics of small keys are
    looked up in Arrow batches, so that a row is copied once, not once a key; those of
    others are joined, by a few columns.
    """
    keys = list(dict.fromkeys([*frequencies, *rates]))
    rows = df.select(F.struct(*[c for c in df.columns if c not in set(drop)]).alias("__row"),
                     *[F.col(k).cast("string").alias(f"__k_{i}") for i, k in enumerate(keys)],
                     *([F.col(label).cast("string").alias("__y")] if label else []))
    held = _held(fit, keys, sums=bool(rates)) if smoothing or not rates else {}  # unsmoothed, a rate may have no rows below it
    totals = {r["__key"]: r["n"] for r in fit.stats.groupBy("__key").agg(F.sum("__n").alias("n")).collect()} if frequencies else {}
    out = [*((k, None) for k in frequencies), *((k, n) for k in rates for n in fit.names)]
    names = {(k, n): f"{rates[k]}_{n}" if n else f"{k}_freq" for k, n in out}
    for i, key in enumerate(keys):
        if key not in held:
            rows = _joined(rows, fit, i, key, key in frequencies, key in rates, smoothing, label, classes)
    if held:
        rows = _looked_up(rows, fit, keys, held, [x for x in out if x[0] in held], totals, smoothing, bool(label), classes)
    shown = []
    for key, n in out:
        value = F.col(f"__v_{keys.index(key)}_{n or 'freq'}")
        if n:
            value = F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(fit.prior[n]))
        else:
            value = value / F.lit(max(totals.get(key, 0), 1))
            value = value if unseen is None else F.coalesce(value, F.lit(unseen))
        shown.append(value.alias(names[key, n]))
    return rows.select("__row.*", *shown)


def _held(fit: KeyFit, keys: Sequence[str], sums: bool) -> dict[str, pa.Table]:
    """The statistics of small keys, as far as they are bounded together."""
    small = [k for k in keys if fit.small[k]]
    cols = ["__n", *(f"__s_{n}" for n in fit.names if sums)]
    found = (fit.stats.filter(F.col("__key").isin(small)).select("__key", "__value", *cols).limit(MAX_BROADCAST_ROWS + 1)
             .toArrow().combine_chunks() if small else None)
    if found is None or found.num_rows > MAX_BROADCAST_ROWS:
        return {}
    return {k: found.filter(pc.equal(found["__key"], k)).drop_columns("__key").combine_chunks() for k in small}


def _joined(rows: DataFrame, fit: KeyFit, i: int, key: str, frequency: bool, rates: bool, smoothing: float, label: str | None,
            classes: Sequence[str]) -> DataFrame:
    """One key's statistics by a left join: for rates of training rows by its value and
    the own label, as leaving one row out only depends on the row's label."""
    side, cnt = fit.slice(key), F.col("__n")
    match = F.col(f"__k_{i}") == F.col("__value")
    if frequency:
        part = side.select("__value", cnt.alias(f"__v_{i}_freq"))
        rows = rows.join(F.broadcast(part) if fit.small[key] else part, match, "left").drop("__value")
    if rates:
        if label:
            side = side.select("*", F.explode(F.array(*[F.lit(c) for c in classes])).alias("__own"))
            match = match & (F.col("__y") == F.col("__own"))
        own = {n: F.col("__own").isin(*P.HISTORICAL_RATES[n]).cast("double") if label else None for n in fit.names}
        part = side.select("__value", *(["__own"] if label else []), *[
            ((F.col(f"__s_{n}") - own[n] + fit.prior[n] * smoothing) / (cnt - 1 + smoothing) if label
             else (F.col(f"__s_{n}") + fit.prior[n] * smoothing) / (cnt + smoothing)).alias(f"__v_{i}_{n}")
            for n in fit.names])
        rows = rows.join(F.broadcast(part) if fit.small[key] else part, match, "left").drop("__value", "__own")
    return rows.drop(f"__k_{i}")


def _looked_up(rows: DataFrame, fit: KeyFit, keys: Sequence[str], held: dict[str, pa.Table], out: Sequence[tuple],
               totals: dict[str, int], smoothing: float, train: bool, classes: Sequence[str]) -> DataFrame:
    """The statistics of the ``held`` keys by hash look-ups in Arrow batches."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != "__y" and not f.name.startswith("__k_")]
                          + [T.StructField(f"__v_{keys.index(k)}_{n or 'freq'}", T.DoubleType()) for k, n in out])
    kept = [f.name for f in schema.fields[:len(schema.fields) - len(out)]]
    shared = rows.sparkSession.sparkContext.broadcast(held)
    prior, rate_names, place = fit.prior, list(fit.names), {k: f"__k_{i}" for i, k in enumerate(keys)}
    counted = {n: np.array([float(c in P.HISTORICAL_RATES[n]) for c in classes] or [0.0]) for n in rate_names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: (t["__value"].combine_chunks(), t["__n"].to_numpy(), {n: t[f"__s_{n}"].to_numpy() for n in rate_names
                                                                           if f"__s_{n}" in t.column_names})
                  for k, t in shared.value.items()}
        labels = pa.array(list(classes), pa.string())
        for batch in batches:
            if not batch.num_rows:
                continue
            if train:
                own = pc.index_in(batch.column("__y"), value_set=labels.cast(batch.column("__y").type))
                listed, own = own.is_valid().to_numpy(zero_copy_only=False), own.fill_null(0).to_numpy()
            found, columns = {}, []
            for key, n in out:
                values, count, sums = tables[key]
                if key not in found:
                    at = pc.index_in(batch.column(place[key]), value_set=values.cast(batch.column(place[key]).type))
                    found[key] = at.is_valid().to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy()
                known, at = found[key]
                if not len(values):
                    columns.append(pa.nulls(len(at), pa.float64()))
                    continue
                if n is None:
                    columns.append(pa.array(count[at].astype(np.float64), mask=~known))
                elif train:
                    value = (sums[n][at] - counted[n][own] + prior[n] * smoothing) / (count[at] - 1 + smoothing)
                    columns.append(pa.array(value, mask=~(known & listed)))
                else:
                    columns.append(pa.array(((sums[n] + prior[n] * smoothing) / (count + smoothing))[at], mask=~known))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def encoded_categoricals() -> list[str]:
    """The keys that are encoded and the bank label."""
    return list(P.HISTORICAL_KEYS) + list(P.INTERACTION_HISTORICAL_KEYS) + [BANK]


def drop_encoded_categoricals(df: DataFrame) -> DataFrame:
    """Drop the keys that were encoded and the bank label."""
    return df.drop(*[c for c in encoded_categoricals() if c in df.columns])


def adapt_for_mode(train: DataFrame, test: DataFrame, mode: str
                   ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Histogram-boosting modes drop every ``*_historical_*`` column."""
    if mode not in P.HIST_GRADIENT_MODES:
        return train, test, []
    dropped = [c for c in train.columns if "_historical_" in c and c in test.columns]
    return train.drop(*dropped), test.drop(*dropped), dropped


def mutual_information(df: DataFrame, columns: Sequence[str], label: str = P.TARGET,
                       bins: int = 10, accuracy: int = 10_000) -> DataFrame:
    """D29 (re-aimed): binned mutual information of each column with the label.

    Columns with at most ``bins`` distinct values are binned by value, others
    by approximate quantile edges. One pass over the unpivoted (column, bin,
    label) triples; sum over cells of p * ln(p / (p_bin * p_label)).
    """
    cols = list(columns)
    long = (df.select(F.col(label).alias("__y"), *[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot("__y", cols, "column", "value")
              .filter(F.col("value").isNotNull() & F.col("__y").isNotNull()))
    distinct = (long.groupBy("column", "value").agg(F.lit(1).alias("one"))
                .groupBy("column").agg(F.count("one").alias("nd")))
    edges = long.groupBy("column").agg(
        F.percentile_approx("value", [i / bins for i in range(1, bins)], accuracy).alias("edges")).join(
        distinct, "column")
    binned = long.join(F.broadcast(edges), "column").withColumn(
        "bin", F.when(F.col("nd") <= bins, F.col("value")).otherwise(
            F.size(F.filter("edges", lambda e: e < F.col("value"))).cast("double")))
    cell = binned.groupBy("column", "bin", "__y").agg(F.count(F.lit(1)).alias("nxy"))
    wc = Window.partitionBy("column")
    cell = (cell.withColumn("n", F.sum("nxy").over(wc))
                .withColumn("nx", F.sum("nxy").over(Window.partitionBy("column", "bin")))
                .withColumn("ny", F.sum("nxy").over(Window.partitionBy("column", "__y"))))
    term = (F.col("nxy") / F.col("n")) * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return cell.groupBy("column").agg(F.sum(term).alias("mutual_info"))


def varying_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with more than one distinct non-null value (one aggregate)."""
    cols = list(columns)
    row = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] > 1]


def select_informative(train: DataFrame, test: DataFrame, label: str = P.TARGET,
                       method: str = "none", min_mutual_info: float = P.DEFAULT_MIN_MUTUAL_INFO,
                       exclude: Sequence[str] = ("row_id",), estimator: str = "nearest"
                       ) -> tuple[DataFrame, DataFrame, list[str]]:
    """D29 + D30: keep columns scoring at least ``min_mutual_info``, by nearest
    neighbours or (``estimator="binned"``) by bins.

    Constant columns go first; if none vary the first column is kept; if none
    passes the threshold the best one is kept. Unknown method raises.
    """
    features = [c for c in train.columns if c not in set(exclude) | {label}]
    if method == "none":
        return train, test, features
    if method != "mutual_info":
        raise ValueError(f"no feature selection by '{method}', only 'none' or 'mutual_info'")
    keep_always = [c for c in train.columns if c in set(exclude) | {label}]
    varying = varying_columns(train, features)
    if not varying:
        chosen = features[:1]
    else:
        estimate = {"nearest": nearest_mutual_information, "binned": mutual_information}[estimator]
        scores = {r["column"]: r["mutual_info"] for r in estimate(train, varying, label).collect()}
        chosen = [c for c in varying if (scores.get(c) or 0.0) >= min_mutual_info]
        if not chosen:
            chosen = [max(varying, key=lambda c: scores.get(c) or 0.0)]
    test_keep = [c for c in keep_always if c in test.columns]
    return train.select(*keep_always, *chosen), test.select(*test_keep, *chosen), chosen


def build_feature_matrices(train: DataFrame, test: DataFrame, label: str = P.TARGET,
                           method: str = "none",
                           min_mutual_info: float = P.DEFAULT_MIN_MUTUAL_INFO
                           ) -> tuple[DataFrame, DataFrame]:
    """H5 (after the split): label-free features per split, then train-fitted encodings.

    The label column stays on both outputs (labels are not detached vectors);
    ``row_id`` is carried through for joins.
    """
    # the encodings' keys need no congestion joins, so their statistics are read from
    # rows without them, and a row's features are worked out once, on the way to the result
    keys = {**P.HISTORICAL_KEYS, **P.INTERACTION_HISTORICAL_KEYS}
    tr, te = (drop_non_predictive(df).transform(add_temporal_features).transform(add_interaction_keys)
              for df in (train, test))
    fit = fit_keys(tr, list(keys), label)
    tr, te = (df.transform(add_congestion_features).transform(add_weather_scores) for df in (tr, te))
    shares, m, drop = [c for c in P.FREQUENCY_COLUMNS if c in tr.columns], P.HISTORICAL_SMOOTHING, encoded_categoricals()
    tr = _encoded(tr, fit, shares, keys, m, label=label, classes=P.CLASS_ORDER, drop=drop)
    te = _encoded(te, fit, shares, keys, m, unseen=0.0, drop=drop)
    if method != "none":  # written once: each score reads the result again
        tr, te = cut_lineage(tr, "train_features"), cut_lineage(te, "test_features")
    tr, te, _ = select_informative(tr, te, label, method, min_mutual_info)
    return tr, te


def drop_non_predictive(df: DataFrame) -> DataFrame:
    """DIVERTED and CANCELLATION_REASON leak the label."""
    return df.drop(*[c for c in P.NON_PREDICTIVE_COLUMNS if c in df.columns])

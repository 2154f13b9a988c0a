"""Population drift between a reference (side 0) and a current (side 1)
sample, over a long (feature, side, value) table: every feature in the same
query, so the number of shuffles is fixed whatever the number of features.

Histogram rule (numpy's): bins [e_i, e_{i+1}) except the last, [e_{n-1}, e_n];
values outside the edges are dropped. bin = #(edges <= v) − 1, capped at the
last bin. Edge arrays are per feature (≤ 11 values), so the edge table is
bounded by #features and broadcast.

PSI variants:
* ``floor`` (A): share = bin / len(sample); a zero share → 0.0001;
  Σ (e − a)·ln(e/a).
* ``smoothed`` (B): (bin + 0.0001) renormalised; max(0, Σ (a − e)·ln(a/e));
  NaN and ±inf removed first; an empty sample gives +inf.
* ``smoothed_strict`` (C): as B, NaN removed only, and no equal-width fallback
  for a constant reference (no bins → PSI 0).

String features take the shares of their levels (``psi_categorical``), smoothed
as B, in place of bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import (DRIFT_ADVICE_HIGH, DRIFT_ADVICE_MEDIUM, DRIFT_THRESHOLD, KL_EPS, PSI_FLOOR,
                      PSI_HIGH, PSI_MEDIUM, PSI_SMOOTH)
from ..functions.tails import nan_to_null, p_chi2, p_ks
from ..session import materialize
from .ranks import bounded_broadcast, count_le, cumulative_counts, quantile_arrays
from .reshape import long_format

MAX_FEATURES = 100_000


def small_table(df: DataFrame) -> DataFrame:
    """Write a per-feature summary (bounded by #features rows) once, so the
    several joins that read it do not each re-run the query behind it."""
    return materialize(df, spread=False)


def two_sample_long(ref: DataFrame, cur: DataFrame, cols: list[str], side: str = "side") -> DataFrame:
    """(feature, side, value) from two wide samples (side 0 = ref, 1 = cur)."""
    a = long_format(ref, cols).withColumn(side, F.lit(0))
    b = long_format(cur, cols).withColumn(side, F.lit(1))
    return a.unionByName(b)


def clean_values(lf: DataFrame, finite: bool = True) -> DataFrame:
    v = F.col("value")
    cond = v.isNotNull() & ~F.isnan(v)
    if finite:
        cond = cond & (F.abs(v) < F.lit(float("inf")))
    return lf.filter(cond)


def psi_edges(lf: DataFrame, side: str = "side", buckets: int = 10, fallback: bool = True,
              kernel_buckets: int | None = None) -> DataFrame:
    """(feature, edges): exact reference percentiles 0,10..100 with
    duplicates removed; with ``fallback`` a reference with < 2 distinct edges
    gets ``buckets + 1`` equal-width edges over [min, max]."""
    ref = lf.filter(F.col(side) == 0)
    probs = [i / buckets for i in range(buckets + 1)]
    q = quantile_arrays(ref, ["feature"], probs, buckets=kernel_buckets, n_keys_bound=MAX_FEATURES)
    edges = q.select("feature", F.array_distinct("quantiles").alias("edges"),
                     F.element_at("quantiles", 1).alias("_mn"), F.element_at("quantiles", -1).alias("_mx"))
    if not fallback:
        return edges.select("feature", "edges")
    # the 0 % and 100 % quantiles are the min and max: no extra pass for the fallback
    step = (F.col("_mx") - F.col("_mn")) / F.lit(float(buckets))
    lin = F.transform(F.sequence(F.lit(0), F.lit(buckets)),
                      lambda i: F.when(i == buckets, F.col("_mx")).otherwise(i * step + F.col("_mn")))
    return edges.select("feature", F.when(F.size("edges") < 2, lin).otherwise(F.col("edges")).alias("edges"))


def assign_bins(lf: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds ``bin`` (−1 when outside the edges) and ``n_bins``. Edges of equal
    width come with ``_mn`` and ``_step``: the division names the bin, its two
    edges confirm it, and only a value that they do not hold is looked up."""
    e = bounded_broadcast(edges, MAX_FEATURES)
    j = lf.join(e, "feature")
    v, nb = F.col("value"), F.size("edges") - 1
    k = count_le("edges", v)
    if "_step" in edges.columns:
        j = j.withColumn("_at", F.least(F.greatest(F.floor(F.try_divide(v - F.col("_mn"), F.col("_step"))), F.lit(0)), nb)
                         .cast("int"))
        above = F.coalesce(v < F.get("edges", F.col("_at") + 1), F.lit(True))
        k = F.when((F.get("edges", F.col("_at")) <= v) & above, F.col("_at") + 1).otherwise(k)
    j = j.withColumn("_k", k)
    inside = (F.col("_k") >= 1) & (v <= F.get("edges", nb)) & (nb >= 1)
    return j.select(*lf.columns, F.when(inside, F.least(F.col("_k"), nb) - 1).otherwise(F.lit(-1)).alias("bin"),
                    nb.alias("n_bins"))


def bin_table(lf: DataFrame, edges: DataFrame, side: str = "side") -> DataFrame:
    """(feature, bin, c_ref, c_cur, n_ref, n_cur, n_bins): every bin present
    for both sides (zero-filled), n_* = sample sizes incl. dropped values. The
    values are read once: their counts (≤ #edges rows a feature) are written."""
    b = assign_bins(lf, edges)
    cnt = small_table(b.groupBy("feature", "bin").agg(
        F.count_if(F.col(side) == 0).alias("c_ref"), F.count_if(F.col(side) == 1).alias("c_cur")))
    sizes = cnt.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    seq = F.when(F.size("edges") >= 2, F.sequence(F.lit(0), F.size("edges") - 2)) \
        .otherwise(F.array().cast("array<int>"))
    allb = edges.select("feature", F.explode(seq).alias("bin"))
    nbins = edges.select("feature", (F.size("edges") - 1).alias("n_bins"))
    t = (allb.join(cnt.filter(F.col("bin") >= 0), ["feature", "bin"], "left")
         .select("feature", "bin", F.coalesce("c_ref", F.lit(0)).alias("c_ref"),
                 F.coalesce("c_cur", F.lit(0)).alias("c_cur")))
    return (nbins.join(sizes, "feature", "left").join(t, "feature", "left")
            .select("feature", "bin", "c_ref", "c_cur",
                    F.coalesce("n_ref", F.lit(0)).alias("n_ref"), F.coalesce("n_cur", F.lit(0)).alias("n_cur"),
                    "n_bins"))


def psi_from_bins(bins: DataFrame, method: str = "smoothed") -> DataFrame:
    """(feature, psi) from a bin table."""
    w = Window.partitionBy("feature")      # ≤ 10 bins per feature
    if method == "floor":
        e = F.try_divide(F.col("c_ref"), F.col("n_ref"))
        a = F.try_divide(F.col("c_cur"), F.col("n_cur"))
        e = F.when(e == 0, F.lit(PSI_FLOOR)).otherwise(e)
        a = F.when(a == 0, F.lit(PSI_FLOOR)).otherwise(a)
        term = (e - a) * F.log(e / a)
        agg = bins.groupBy("feature").agg(F.sum(term).alias("psi"), F.first("n_ref").alias("n_ref"),
                                          F.first("n_cur").alias("n_cur"))
        return agg.select("feature", F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.col("psi"))
                          .alias("psi"))
    sr = F.col("c_ref") + F.lit(PSI_SMOOTH)
    sc = F.col("c_cur") + F.lit(PSI_SMOOTH)
    x = bins.select("feature", "bin", "n_ref", "n_cur",
                    (sr / F.sum(sr).over(w)).alias("e"), (sc / F.sum(sc).over(w)).alias("a"))
    term = F.when(F.col("bin").isNotNull(), (F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e")))
    agg = x.groupBy("feature").agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"),
                                   F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"))
    return agg.select("feature", F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), F.lit(float("inf")))
                      .otherwise(F.greatest(F.col("psi"), F.lit(0.0))).alias("psi"))


#: Per PSI variant: whether ±inf is dropped with NaN, and whether a constant reference gets equal-width edges.
PSI_RULES = {"floor": (False, True), "smoothed": (True, True), "smoothed_strict": (False, False)}


def sample_counts(lf: DataFrame, side: str = "side", levels: DataFrame | None = None) -> DataFrame:
    """(feature, is_string, value, level, n_0, n_1), written once: the rows of
    each sample per distinct value of every feature, numbers in ``value`` and the
    strings of ``levels`` (feature, side, value string) in ``level``. NULL is a
    value here, so every feature has a row. Everything that the drift reports say
    follows from this table, so the samples are unpivoted and read once."""
    rows = lf.select("feature", F.lit(False).alias("is_string"), F.col(side).alias("_side"),
                     F.col("value").cast("double").alias("value"), F.lit(None).cast("string").alias("level"))
    if levels is not None:
        rows = rows.unionByName(levels.select("feature", F.lit(True).alias("is_string"), F.col(side).alias("_side"),
                                              F.lit(None).cast("double").alias("value"), F.col("value").alias("level")))
    return materialize(rows.groupBy("feature", "is_string", "value", "level")
                       .agg(F.count_if(F.col("_side") == 0).alias("n_0"), F.count_if(F.col("_side") == 1).alias("n_1")),
                       spread=False)


def _sum(cols: list[Column]) -> Column:
    return sum(cols[1:], cols[0])


def drift_profile(counts: DataFrame, method: str = "smoothed", buckets: int = 10, max_levels: int = 20) -> DataFrame:
    """One row per feature of ``sample_counts``: psi, ks (largest distance of the
    distribution functions), chi2_statistic and dof of features with fewer than
    ``max_levels`` distinct reference values and of strings, moments of numbers.

    A running sum over the values gives the reference's exact percentiles and
    the distances; the edges then come back to the count table as one small row
    per feature, and a second aggregate yields bins, squares and chi-square."""
    finite, fallback = PSI_RULES[method]
    num = counts.filter(~F.col("is_string") & F.col("value").isNotNull() & ~F.isnan("value"))
    usable = (F.abs("value") < F.lit(float("inf"))) if finite else F.lit(True)
    num = num.select("feature", "value", "n_0", "n_1", *[F.when(usable, F.col(f"n_{i}")).otherwise(F.lit(0)).alias(f"f_{i}")
                                                         for i in (0, 1)])
    cum = cumulative_counts(num, ["feature"], ["f_0", "f_1"], n_keys_bound=MAX_FEATURES)
    probs = [i / buckets for i in range(buckets + 1)]
    pos = [(F.col("tot_f_0") - 1).cast("double") * F.lit(p) for p in probs]

    def at(ix: Column) -> Column:
        return F.max(F.when((ix >= F.col("cum_f_0") - F.col("f_0")) & (ix < F.col("cum_f_0")), F.col("value")))
    first = cum.groupBy("feature").agg(
        F.max("tot_f_0").alias("tot_f_0"), F.max("tot_f_1").alias("tot_f_1"),
        *[at(F.floor(x)).alias(f"_lo{i}") for i, x in enumerate(pos)],
        *[at(F.ceil(x)).alias(f"_hi{i}") for i, x in enumerate(pos)],
        F.max(F.abs(F.try_divide("cum_f_0", "tot_f_0") - F.try_divide("cum_f_1", "tot_f_1"))).alias("ks"),
        *[F.sum(f"n_{i}").alias(f"t_{i}") for i in (0, 1)],
        *[F.sum(F.when(F.col(f"n_{i}") > 0, F.col(f"n_{i}") * F.col("value"))).alias(f"_s{i}") for i in (0, 1)],
        F.count_if(F.col("n_0") > 0).alias("_levels"), F.count(F.lit(1)).alias("_k"))
    quantile = [F.when(F.floor(x) == F.ceil(x), F.col(f"_lo{i}")).otherwise(
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (x - F.floor(x))) for i, x in enumerate(pos)]
    facts = first.select("feature", "ks", "t_0", "t_1", "tot_f_0", "tot_f_1", "_levels", "_k",
                         F.array(*quantile).alias("_q"),
                         *[F.try_divide(F.col(f"_s{i}"), F.col(f"t_{i}")).alias(f"_m{i}") for i in (0, 1)])
    edges = F.array_distinct("_q")
    if fallback:
        lo, hi = F.get("_q", F.lit(0)), F.get("_q", F.lit(buckets))
        step = (hi - lo) / F.lit(float(buckets))
        even = F.array(*[hi if i == buckets else F.lit(i) * step + lo for i in range(buckets + 1)])
        edges = F.when(F.size(edges) < 2, even).otherwise(edges)
    facts = small_table(facts.withColumn("edges", F.when(F.col("tot_f_0") > 0, edges)).drop("_q"))

    n_features = facts.count()      # the written table's own row count
    j = num.join(bounded_broadcast(facts, n_features), "feature")
    nb = F.size("edges") - 1
    k = count_le("edges", F.col("value"), buckets + 1)
    inside = (k >= 1) & (F.col("value") <= F.get("edges", nb)) & (nb >= 1)
    j = j.withColumn("_bin", F.when(inside, F.least(k, nb) - 1).otherwise(F.lit(-1)))
    exp = F.try_divide(F.col("n_0") * F.col("t_1"), F.col("t_0"))
    chi = F.try_divide((F.col("n_1") - exp) * (F.col("n_1") - exp), exp)
    second = j.groupBy("feature").agg(
        *[F.sum(F.when(F.col("_bin") == b, F.col(f"f_{i}")).otherwise(F.lit(0))).alias(f"_c{i}_{b}")
          for i in (0, 1) for b in range(buckets)],
        *[F.sum(F.when(F.col(f"n_{i}") > 0, F.col(f"n_{i}") * (F.col("value") - F.col(f"_m{i}"))
                       * (F.col("value") - F.col(f"_m{i}")))).alias(f"_v{i}") for i in (0, 1)],
        F.sum(chi).alias("_chi"), F.count_if((exp == 0) & (F.col("n_1") > 0)).alias("_new"))
    rows = second.join(bounded_broadcast(facts, n_features), "feature")
    rows = _psi_terms(rows, method, buckets)
    none = F.lit(None).cast("double")
    categorical = F.col("_levels") < max_levels
    both = (F.col("t_0") > 0) & (F.col("t_1") > 0)
    numbers = rows.select(
        "feature", F.lit(False).alias("is_string"), "psi", "ks", "tot_f_0", "tot_f_1",
        F.when(categorical & both, F.when(F.col("_new") > 0, F.lit(float("inf"))).otherwise(F.col("_chi")))
        .alias("chi2_statistic"), F.when(categorical & both, F.col("_k") - 1).alias("dof"),
        *[F.col(f"_m{i}").alias(f"{n}_mean") for i, n in enumerate(("reference", "current"))],
        *[F.when(F.col(f"t_{i}") > 1, F.sqrt(F.col(f"_v{i}") / (F.col(f"t_{i}") - 1))).alias(f"{n}_std")
          for i, n in enumerate(("reference", "current"))])
    strings = _level_profile(counts.filter("is_string and level is not null")).select(
        "feature", F.lit(True).alias("is_string"), "psi", none.alias("ks"), F.col("t_0").alias("tot_f_0"),
        F.col("t_1").alias("tot_f_1"), "chi2_statistic", "dof",
        *[none.alias(f"{n}_{m}") for m in ("mean", "std") for n in ("reference", "current")])
    absent = none if method == "floor" else F.lit(float("inf"))
    names = counts.groupBy("feature", "is_string").agg(F.lit(0).alias("_x")).drop("_x")
    return (names.join(numbers.unionByName(strings), ["feature", "is_string"], "left")
            .withColumn("psi", F.coalesce("psi", absent)))


def _psi_terms(rows: DataFrame, method: str, buckets: int) -> DataFrame:
    """Adds ``psi`` from the counts _c0_b, _c1_b of the first size(edges) - 1
    bins. Shares, then terms: each level is referenced by name."""
    nb = F.size("edges") - 1
    within = [F.lit(b) < nb for b in range(buckets)]
    if method == "floor":
        share = [[F.when(m, F.coalesce(F.nullif(F.try_divide(F.col(f"_c{i}_{b}"), F.col(f"tot_f_{i}")), F.lit(0.0)),
                                       F.lit(PSI_FLOOR))).alias(f"_p{i}_{b}") for b, m in enumerate(within)] for i in (0, 1)]
    else:
        rows = rows.select("*", *[_sum([F.when(m, F.col(f"_c{i}_{b}") + F.lit(PSI_SMOOTH)).otherwise(F.lit(0.0))
                                        for b, m in enumerate(within)]).alias(f"_w{i}") for i in (0, 1)])
        share = [[F.when(m, (F.col(f"_c{i}_{b}") + F.lit(PSI_SMOOTH)) / F.col(f"_w{i}")).alias(f"_p{i}_{b}")
                  for b, m in enumerate(within)] for i in (0, 1)]
    rows = rows.select("*", *share[0], *share[1])
    total = _sum([F.coalesce((F.col(f"_p1_{b}") - F.col(f"_p0_{b}")) * F.log(F.col(f"_p1_{b}") / F.col(f"_p0_{b}")),
                             F.lit(0.0)) for b in range(buckets)])
    both = (F.col("tot_f_0") > 0) & (F.col("tot_f_1") > 0)
    if method == "floor":
        return rows.withColumn("psi", F.when(both & (nb >= 1), total))
    return rows.withColumn("psi", F.when(both, F.greatest(total, F.lit(0.0))).otherwise(F.lit(float("inf"))))


def _level_profile(counts: DataFrame) -> DataFrame:
    """(feature, psi, t_0, t_1, chi2_statistic, dof) over the levels of string features."""
    tot = counts.groupBy("feature").agg(F.sum("n_0").alias("t_0"), F.sum("n_1").alias("t_1"),
                                        F.count(F.lit(1)).alias("k"))
    j = counts.join(tot, "feature")
    e, a = ((F.col(f"n_{i}") + F.lit(PSI_SMOOTH)) / (F.col(f"t_{i}") + F.col("k") * F.lit(PSI_SMOOTH)) for i in (0, 1))
    exp = F.try_divide(F.col("n_0") * F.col("t_1"), F.col("t_0"))
    got = j.groupBy("feature", "t_0", "t_1", "k").agg(
        F.sum((a - e) * F.log(a / e)).alias("_psi"), F.sum(F.try_divide((F.col("n_1") - exp) * (F.col("n_1") - exp), exp))
        .alias("_chi"), F.count_if((exp == 0) & (F.col("n_1") > 0)).alias("_new"))
    both = (F.col("t_0") > 0) & (F.col("t_1") > 0)
    return got.select("feature", "t_0", "t_1", F.when(both, F.greatest(F.col("_psi"), F.lit(0.0))).alias("psi"),
                      F.when(both, F.when(F.col("_new") > 0, F.lit(float("inf"))).otherwise(F.col("_chi")))
                      .alias("chi2_statistic"), F.when(both, F.col("k") - 1).alias("dof"))


def psi(lf: DataFrame, method: str = "smoothed", side: str = "side", buckets: int = 10) -> DataFrame:
    """(feature, psi) for every feature of a long two-sample table. Without
    usable values on a side: +inf (smoothed methods) or NULL (floor)."""
    if method not in PSI_RULES:
        raise ValueError(method)
    return drift_profile(sample_counts(lf, side), method, buckets).select("feature", "psi")


def psi_categorical(levels: DataFrame, side: str = "side") -> DataFrame:
    """(feature, psi) of string features, over the shares of the levels seen
    on either side, smoothed as variant B. A level is a row of counts, so a
    feature may have any number of them; NULL is no level. Without values on
    a side: +inf."""
    cnt = (levels.filter(F.col("value").isNotNull()).groupBy("feature", F.col("value").alias("level"))
           .agg(F.count_if(F.col(side) == 0).alias("n_0"), F.count_if(F.col(side) == 1).alias("n_1")))
    tot = cnt.groupBy("feature").agg(F.sum("n_0").alias("t_0"), F.sum("n_1").alias("t_1"),
                                     F.count(F.lit(1)).alias("k"))
    j = cnt.join(bounded_broadcast(tot, MAX_FEATURES), "feature")
    e, a = ((F.col(f"n_{i}") + F.lit(PSI_SMOOTH)) / (F.col(f"t_{i}") + F.col("k") * F.lit(PSI_SMOOTH)) for i in (0, 1))
    found = j.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"), F.first("t_0").alias("t_0"),
                                     F.first("t_1").alias("t_1"))
    found = found.select("feature", F.when((F.col("t_0") > 0) & (F.col("t_1") > 0),
                                           F.greatest(F.col("psi"), F.lit(0.0))).alias("psi"))
    return levels.select("feature").distinct().join(found, "feature", "left") \
        .select("feature", F.coalesce("psi", F.lit(float("inf"))).alias("psi"))


def kl_divergence(lf: DataFrame, side: str = "side", n_edges: int = 20) -> DataFrame:
    """(feature, kl): 19 equal-width bins over the pooled range, densities
    (count / (n · width)) + 1e-10, renormalised, Σ p·ln(p/q), p = reference.
    A zero pooled range gives NULL, and so does a feature without finite values."""
    v = F.col("value")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    # every feature's name with its finite range: one pass
    mm = lf.groupBy("feature").agg(F.min(F.when(finite, v)).alias("_mn"), F.max(F.when(finite, v)).alias("_mx"))
    div = n_edges - 1
    mm = mm.withColumn("_step", (F.col("_mx") - F.col("_mn")) / F.lit(float(div)))
    names = small_table(mm.select("feature", "_mn", "_step", F.transform(
        F.sequence(F.lit(0), F.lit(div)),
        lambda i: F.when(i == div, F.col("_mx")).otherwise(i * F.col("_step") + F.col("_mn"))).alias("edges"),
        (F.col("_mx") > F.col("_mn")).alias("_ok")))
    edges = names.filter(F.col("_mn").isNotNull())
    bins = bin_table(clean_values(lf, finite=True), edges.drop("_ok"), side)
    ew = bounded_broadcast(edges.select("feature", "edges", "_ok"), MAX_FEATURES)
    bw = bins.join(ew, "feature").withColumn(
        "width", F.element_at("edges", F.col("bin") + 2) - F.element_at("edges", F.col("bin") + 1))
    w = Window.partitionBy("feature")
    p0 = F.try_divide(F.col("c_ref"), F.col("n_ref") * F.col("width")) + F.lit(KL_EPS)
    q0 = F.try_divide(F.col("c_cur"), F.col("n_cur") * F.col("width")) + F.lit(KL_EPS)
    x = bw.select("feature", "_ok", p0.alias("p0"), q0.alias("q0"))
    x = x.select("feature", "_ok", (F.col("p0") / F.sum("p0").over(w)).alias("p"),
                 (F.col("q0") / F.sum("q0").over(w)).alias("q"))
    found = (x.groupBy("feature")
             .agg(F.first("_ok").alias("_ok"), F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("kl"))
             .select("feature", F.when(F.col("_ok"), F.col("kl")).alias("kl")))
    return names.select("feature").join(found, "feature", "left")


def target_drift(ref: DataFrame, cur: DataFrame, label: str) -> DataFrame:
    a = ref.agg(F.avg(label).alias("_a"))
    b = cur.agg(F.avg(label).alias("_b"))
    return a.crossJoin(b).select(F.abs(F.col("_a") - F.col("_b")).alias("target_drift"))


def drift_status(psi_rows: DataFrame, col: str = "psi") -> DataFrame:
    """high if any PSI > 0.2, medium if any in (0.1, 0.2], else low."""
    p = F.col(col)
    agg = psi_rows.agg(F.count_if(p > PSI_HIGH).alias("high_drift_features_count"),
                       F.count_if((p > PSI_MEDIUM) & (p <= PSI_HIGH)).alias("medium_drift_features_count"))
    return agg.withColumn("drift_status",
                          F.when(F.col("high_drift_features_count") > 0, "high")
                          .when(F.col("medium_drift_features_count") > 0, "medium").otherwise("low"))


def drift_recommendations(status: DataFrame) -> DataFrame:
    s = F.col("drift_status")
    return status.select("drift_status", F.when(s == "high", F.lit(DRIFT_ADVICE_HIGH))
                         .when(s == "medium", F.lit(DRIFT_ADVICE_MEDIUM)).alias("recommendation"))


def categorical_features(lf: DataFrame, side: str = "side", max_levels: int = 20) -> DataFrame:
    """(feature) rows whose reference sample has fewer than ``max_levels``
    distinct non-null values: distinct (feature, value) pairs, then a count
    per feature — one row per feature comes out."""
    ref = lf.filter((F.col(side) == 0) & F.col("value").isNotNull()).select("feature", "value").distinct()
    return ref.groupBy("feature").agg(F.count(F.lit(1)).alias("_nd")).filter(F.col("_nd") < max_levels) \
        .select("feature")


def feature_drift_report(lf: DataFrame, categorical: DataFrame | None = None, side: str = "side",
                         threshold: float = DRIFT_THRESHOLD, auto_categorical: bool = True,
                         levels: DataFrame | None = None) -> DataFrame:
    """Per feature: PSI (smoothed), drift flag, χ² with its p-value for
    categorical features (``categorical``: (feature) rows; by default the
    features with < 20 distinct reference values), and the moments of both
    samples. ``levels``: the string features (feature, side, value string),
    which get PSI over their levels, χ², and NULL moments."""
    counts = sample_counts(lf, side, levels)
    every = categorical is not None
    out = drift_profile(counts, "smoothed", max_levels=1 << 62 if every else 20 if auto_categorical else 0)
    if every:
        marked = categorical.select("feature").distinct().withColumn("_cat", F.lit(True))
        keep = F.col("is_string") | F.coalesce(F.col("_cat"), F.lit(False))
        out = out.join(bounded_broadcast(marked, MAX_FEATURES), "feature", "left")
        out = out.withColumn("chi2_statistic", F.when(keep, F.col("chi2_statistic"))).withColumn(
            "dof", F.when(keep, F.col("dof")))
    return out.select(
        "feature", "psi", "reference_mean", "current_mean", "reference_std", "current_std",
        (F.col("psi") > F.lit(threshold)).alias("drift_detected"), "chi2_statistic",
        nan_to_null(p_chi2(F.col("chi2_statistic"), F.col("dof").cast("double"))).alias("p_value"))


def key_feature_drift(lf: DataFrame, target: DataFrame, side: str = "side") -> DataFrame:
    """(feature, psi, ks, ks_p_value, target_drift, drift_status, high and medium
    counts): PSI (floor) and Kolmogorov–Smirnov of each key feature, beside the
    label's drift (``target``, one row) and the status of the whole. A feature
    without values on a side has NULL measures."""
    prof = small_table(drift_profile(sample_counts(lf, side), "floor"))
    both = (F.col("tot_f_0") > 0) & (F.col("tot_f_1") > 0)
    ks = F.when(both, F.col("ks"))
    rows = prof.select("feature", "psi", ks.alias("ks"),
                       nan_to_null(p_ks(ks, F.col("tot_f_0").cast("double"), F.col("tot_f_1").cast("double"))).alias("ks_p_value"))
    return rows.crossJoin(F.broadcast(target)).crossJoin(F.broadcast(drift_status(prof)))   # one row each


def drift_summary(report: DataFrame, threshold_col: str = "drift_detected") -> DataFrame:
    """total, drifted, max PSI among drifted features (0.0 when none, as the
    source), and max PSI over all features."""
    d = F.col(threshold_col)
    return report.agg(F.count(F.lit(1)).alias("total_features"),
                      F.count_if(d).alias("drifted_features"),
                      F.coalesce(F.max(F.when(d, F.col("psi"))), F.lit(0.0)).alias("max_psi"),
                      F.max("psi").alias("max_psi_all"),
                      (F.count_if(d) > 0).alias("drift_detected"))

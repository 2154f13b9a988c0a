"""Two-sample tests (§2.5) over a long (feature, value, side) table, all
features in one query. Statistics are computed JVM-side; p-values are a tail
function on the one-row-per-feature result (``functions.tails``).
Sides are 0 (first sample / class 0) and 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import nan_to_null, p_chi2, p_f, p_ks, p_norm, p_t
from .ranks import bounded_broadcast, midrank_sums


def side_moments(lf: DataFrame, side: str = "side") -> DataFrame:
    """(feature, n0, n1, mean_0, mean_1, var_0, var_1) in one aggregate."""
    v = F.col("value")
    s0, s1 = F.col(side) == 0, F.col(side) == 1
    return (lf.filter(v.isNotNull())
            .groupBy("feature")
            .agg(F.count(F.when(s0, v)).alias("n0"), F.count(F.when(s1, v)).alias("n1"),
                 F.avg(F.when(s0, v)).alias("mean_0"), F.avg(F.when(s1, v)).alias("mean_1"),
                 F.var_samp(F.when(s0, v)).alias("var_0"), F.var_samp(F.when(s1, v)).alias("var_1")))


def t_test(lf: DataFrame, side: str = "side", p_values: bool = True) -> DataFrame:
    """Pooled-variance two-sample t: t = (m0 − m1) / sqrt(sp²·(1/n0 + 1/n1))."""
    m = side_moments(lf, side)
    df_ = F.col("n0") + F.col("n1") - 2
    sp2 = F.try_divide((F.col("n0") - 1) * F.col("var_0") + (F.col("n1") - 1) * F.col("var_1"), df_.cast("double"))
    se = F.sqrt(sp2 * (F.lit(1.0) / F.col("n0") + F.lit(1.0) / F.col("n1")))
    out = m.select("feature", "n0", "n1", "mean_0", "mean_1",
                   F.try_divide(F.col("mean_0") - F.col("mean_1"), se).alias("statistic"),
                   df_.cast("double").alias("df"))
    if p_values:
        out = out.withColumn("p_value", nan_to_null(p_t(F.col("statistic"), F.col("df"))))
    return out


def mann_whitney_u(lf: DataFrame, side: str = "side", p_values: bool = True,
                   buckets: int | None = None, n_keys_bound: int = 1000) -> DataFrame:
    """U of the first sample (side 0), and the normal approximation with tie
    and continuity correction: z = (max(U0, U1) − n0·n1/2 − 0.5) / σ,
    σ² = n0·n1/12 · ((n + 1) − Σ(t³ − t)/(n(n − 1)))."""
    r = midrank_sums(lf, ["feature"], side, buckets=buckets, n_keys_bound=n_keys_bound)
    n = (F.col("n0") + F.col("n1")).cast("double")
    sigma = F.sqrt(F.col("n0") * F.col("n1") / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    z = F.try_divide(F.greatest("u0", "u1") - F.col("n0") * F.col("n1") / 2.0 - 0.5, sigma)
    out = r.select("feature", "n0", "n1", F.col("u0").alias("statistic"), z.alias("z"), F.col("ks"))
    if p_values:
        out = out.withColumn("p_value", nan_to_null(p_norm(F.col("z"))))
    return out.drop("ks")


def ks_two_sample(lf: DataFrame, side: str = "side", p_values: bool = True,
                  buckets: int | None = None, n_keys_bound: int = 1000) -> DataFrame:
    """D = sup |F0 − F1| over the pooled values (exact), asymptotic p-value."""
    r = midrank_sums(lf, ["feature"], side, buckets=buckets, n_keys_bound=n_keys_bound)
    out = r.select("feature", "n0", "n1", F.col("ks").alias("statistic"))
    if p_values:
        out = out.withColumn("p_value", nan_to_null(p_ks(F.col("statistic"), F.col("n0"), F.col("n1"))))
    return out


def anova_f(lf: DataFrame, label: str = "label", p_values: bool = True, n_classes_bound: int = 100) -> DataFrame:
    """One-way ANOVA F of each feature against the class column:
    F = (SSB/(K−1)) / (SSW/(N−K)); per-class moments in one aggregate, read once.
    ``n_classes_bound`` is kept for callers of the earlier form and not used."""
    v = F.col("value")
    per = (lf.filter(v.isNotNull() & F.col("feature").isNotNull()).groupBy("feature", label)
           .agg(F.count(v).alias("nk"), F.avg(v).alias("mk"), F.var_pop(v).alias("vk")))
    whole = Window.partitionBy("feature")     # a row per class
    j = per.select("*", F.sum("nk").over(whole).alias("N"), F.count(F.lit(1)).over(whole).alias("K"),
                   (F.sum(F.col("nk") * F.col("mk")).over(whole) / F.sum("nk").over(whole)).alias("gm"))
    agg = j.groupBy("feature").agg(
        F.first("N").alias("N"), F.first("K").alias("K"),
        F.sum(F.col("nk") * (F.col("mk") - F.col("gm")) * (F.col("mk") - F.col("gm"))).alias("ssb"),
        F.sum(F.col("nk") * F.col("vk")).alias("ssw"))
    d1, d2 = (F.col("K") - 1).cast("double"), (F.col("N") - F.col("K")).cast("double")
    fstat = F.try_divide(F.col("ssb") / d1, F.try_divide(F.col("ssw"), d2))
    out = agg.select("feature", fstat.alias("f_statistic"), d1.alias("df_between"), d2.alias("df_within"))
    if p_values:
        out = out.withColumn("p_value", nan_to_null(p_f(F.col("f_statistic"), F.col("df_between"),
                                                        F.col("df_within"))))
    return out


def aligned_counts(ref_counts: DataFrame, cur_counts: DataFrame, keys: list[str],
                   cat: str = "category") -> DataFrame:
    """Full outer join of two count tables on (keys, category); missing → 0."""
    a = ref_counts.withColumnRenamed("n", "n_ref")
    b = cur_counts.withColumnRenamed("n", "n_cur")
    return (a.join(b, [*keys, cat], "full_outer")
            .select(*keys, cat, F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
                    F.coalesce("n_cur", F.lit(0)).alias("n_cur")))


def chi_square_gof(lf: DataFrame, side: str = "side", p_values: bool = True) -> DataFrame:
    """Current (side 1) category counts against reference (side 0) counts
    rescaled to the current total, over the union of categories:
    χ² = Σ (obs − exp)² / exp; an expected 0 with observed > 0 gives +inf."""
    v = F.col("value")
    cnt = (lf.filter(v.isNotNull()).groupBy("feature", side, v.alias("category"))
           .agg(F.count(F.lit(1)).alias("n")))
    al = aligned_counts(cnt.filter(F.col(side) == 0).drop(side), cnt.filter(F.col(side) == 1).drop(side),
                        ["feature"])
    tot = al.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"),
                                    F.count(F.lit(1)).alias("k"))
    j = al.join(bounded_broadcast(tot, 100_000), "feature")
    exp = F.try_divide(F.col("n_ref") * F.col("t_cur"), F.col("t_ref"))
    term = F.try_divide((F.col("n_cur") - exp) * (F.col("n_cur") - exp), exp)
    agg = j.groupBy("feature").agg(
        F.sum(term).alias("_s"), F.count_if((exp == 0) & (F.col("n_cur") > 0)).alias("_inf"),
        F.first("k").alias("k"), F.first("t_ref").alias("t_ref"), F.first("t_cur").alias("t_cur"))
    stat = F.when((F.col("t_ref") == 0) | (F.col("t_cur") == 0), F.lit(None).cast("double")) \
        .when(F.col("_inf") > 0, F.lit(float("inf"))).otherwise(F.col("_s"))
    out = agg.select("feature", stat.alias("chi2_statistic"), (F.col("k") - 1).alias("dof"))
    if p_values:
        out = out.withColumn("p_value", nan_to_null(p_chi2(F.col("chi2_statistic"), F.col("dof").cast("double"))))
    return out


def feature_significance(lf: DataFrame, t_features: list[str], side: str = "side",
                         alpha: float = 0.05, p_values: bool = True,
                         buckets: int | None = None) -> DataFrame:
    """t-test for ``t_features``, Mann–Whitney U for the others; class means;
    ``significant`` = p < alpha. Both tests share the same long input."""
    t_in = lf.filter(F.col("feature").isin(*t_features))
    u_in = lf.filter(~F.col("feature").isin(*t_features))
    t = t_test(t_in, side, p_values).select(
        "feature", F.lit("t_test").alias("test"), "statistic", *(["p_value"] if p_values else []))
    u = mann_whitney_u(u_in, side, p_values, buckets).select(
        "feature", F.lit("mann_whitney_u").alias("test"), "statistic", *(["p_value"] if p_values else []))
    means = side_moments(lf, side).select("feature", "mean_0", "mean_1")
    out = t.unionByName(u).join(means, "feature")
    if p_values:
        out = out.withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
    return out

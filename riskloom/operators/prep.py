"""Preparation for the classifiers (§2.8): median imputation of numeric
columns (exact medians), constant 0 for categorical ones, standardisation by
the population std, one-hot indicators with unknown levels → all zeros, and
ANOVA-F selection of the k best prepared columns.

The fitted statistics are bounded by the number of columns (a few dozen
numbers), so they are brought to the driver and written into one
``SQLTransformer`` statement: the fitted preparation is an ordinary, saveable
pipeline stage and stays inside whole-stage codegen at scoring time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import LABEL, MODEL_CATEGORICAL, MODEL_NUMERIC
from ..session import materialize
from .ranks import exact_quantiles
from .reshape import long_format
from .twosample import anova_f

MAX_LEVELS = 1000


@dataclass
class PrepState:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    levels: dict[str, list] = field(default_factory=dict)
    f_scores: dict[str, float] = field(default_factory=dict)
    selected: list[str] | None = None

    @property
    def prepared_columns(self) -> list[str]:
        return list(self.numeric) + [f"{c}_{_lv(v)}" for c in self.categorical for v in self.levels.get(c, [])]


def _lv(v) -> str:
    return str(int(v)) if float(v).is_integer() else str(v).replace(".", "_").replace("-", "m")


def fit_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, median) — exact, interpolated (numpy/DuckDB definition)."""
    q = exact_quantiles(long_format(df, cols), ["feature"], [0.5], n_keys_bound=len(cols))
    return q.select("feature", F.col("quantile").alias("median"))


def impute_exprs(state: PrepState) -> dict[str, F.Column]:
    out = {}
    for c in state.numeric:
        m = state.medians.get(c)
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double")) if m is not None else F.col(c).cast("double")
    for c in state.categorical:
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return out


def impute_median(df: DataFrame, cols: list[str], medians: DataFrame) -> DataFrame:
    """Fill NULLs of ``cols`` with the fitted medians (one-row broadcast)."""
    wide = medians.agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_m_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(wide))
    return j.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def impute_constant(df: DataFrame, cols: list[str], value: float = 0) -> DataFrame:
    return df.fillna(value, subset=list(cols))


def _standard(c: str, state: PrepState) -> str:
    m, s = state.means[c], state.stds[c]
    med = state.medians.get(c)
    x = f"coalesce(CAST(`{c}` AS DOUBLE), {med!r})" if med is not None else f"CAST(`{c}` AS DOUBLE)"
    # a constant column (std 0) is centred only, as the source's scaler does
    return f"({x} - {m!r}) / {s if s else 1.0!r}"


def prep_sql(state: PrepState, keep=("ID",)) -> str:
    """SELECT statement of the fitted preparation over __THIS__."""
    parts = [f"`{k}`" for k in keep]
    for c in state.numeric:
        parts.append(f"{_standard(c, state)} AS `{c}`")
    for c in state.categorical:
        for v in state.levels.get(c, []):
            parts.append(f"CASE WHEN coalesce(CAST(`{c}` AS DOUBLE), 0.0) = {float(v)!r} THEN 1.0 ELSE 0.0 END "
                         f"AS `{c}_{_lv(v)}`")
    return "SELECT " + ", ".join(parts) + " FROM __THIS__"


def prepare(df: DataFrame, state: PrepState, keep=("ID",)) -> DataFrame:
    keep = [k for k in keep if k in df.columns]
    return SQLTransformer(statement=prep_sql(state, keep)).transform(df)


def fit_prep(train: DataFrame, numeric=MODEL_NUMERIC, categorical=MODEL_CATEGORICAL,
             label: str = LABEL, k: int = 20) -> PrepState:
    """Fit medians, population mean/std, levels and the k-best selection on
    ``train`` (a handful of aggregate jobs; results bounded by #columns)."""
    numeric = [c for c in numeric if c in train.columns]
    categorical = [c for c in categorical if c in train.columns]
    st = PrepState(list(numeric), list(categorical))
    if numeric:
        st.medians = {r["feature"]: r["median"] for r in fit_medians(train, numeric).collect()}
    imp = train.select(*[e.alias(c) for c, e in impute_exprs(st).items()], label)
    if numeric:
        row = imp.agg(*[F.avg(c).alias(f"m_{c}") for c in numeric],
                      *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric]).collect()[0]
        st.means = {c: row[f"m_{c}"] for c in numeric}
        st.stds = {c: row[f"s_{c}"] for c in numeric}
    if categorical:
        found = materialize(long_format(imp, categorical).select("feature", "value").distinct(), spread=False)
        sizes = {r["feature"]: r["n"] for r in found.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        for c, n in sizes.items():     # counted before any level leaves the cluster
            if n > MAX_LEVELS:
                raise ValueError(f"{c} has {n} levels, too many for a statement: encode it with levels.fit_levels")
        for r in found.collect():      # ≤ MAX_LEVELS rows a column
            st.levels.setdefault(r["feature"], []).append(r["value"])
        st.levels = {c: sorted(v) for c, v in st.levels.items()}
    prepared = prepare(train, st, keep=(label,))
    cols = st.prepared_columns
    fs = anova_f(long_format(prepared, cols, ids=[label]), label, p_values=False)
    st.f_scores = {r["feature"]: r["f_statistic"] for r in fs.collect()}
    kk = min(k, len(numeric) + 10)
    ranked = sorted(cols, key=lambda c: (-(st.f_scores.get(c) if st.f_scores.get(c) is not None else -1.0),
                                         cols.index(c)))
    chosen = set(ranked[:kk])
    st.selected = [c for c in cols if c in chosen]
    return st


def select_k_best(state: PrepState) -> list[tuple[str, float, int]]:
    ranked = sorted(state.selected or [], key=lambda c: -state.f_scores[c])
    return [(c, state.f_scores[c], i + 1) for i, c in enumerate(ranked)]


def prep_stages(state: PrepState, keep=("ID",), features_col: str = "features"):
    """[SQLTransformer, VectorAssembler] of the fitted preparation."""
    sql = SQLTransformer(statement=prep_sql(state, keep))
    asm = VectorAssembler(inputCols=list(state.selected or state.prepared_columns), outputCol=features_col,
                          handleInvalid="keep")
    return [sql, asm]


def prep_model(state: PrepState, keep=("ID",)) -> PipelineModel:
    """The fitted preparation as a PipelineModel (every stage is already a
    Transformer, so no fit is needed)."""
    return PipelineModel(stages=prep_stages(state, keep))

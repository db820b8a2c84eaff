"""Preparation: impute, outliers, one-hot, scaling, products, narrow types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.operators.groupby import group_mode
from foldwright.plans.quantiles import group_quantiles


def select_features(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep)


def drop_columns(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    return df.drop(*drop)


def fit_impute(
    df: DataFrame, cols: Sequence[str], strategy: str = "median", constant: float = -999.0
) -> DataFrame:
    """A one-row table with the fill value of every column."""
    if strategy == "constant":
        return df.sparkSession.range(1).select(*[F.lit(constant).alias(c) for c in cols])
    if strategy == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in cols])
    if strategy == "median":
        middle = group_quantiles(df, [], cols, [0.5])
        return middle.select(*[F.element_at(c, 1).alias(c) for c in cols])
    if strategy == "mode":
        out = None
        for c in cols:
            one = group_mode(df.withColumn("__fw_k", F.lit(0)), ["__fw_k"], c, c).select(c)
            out = one if out is None else out.crossJoin(F.broadcast(one))
        return out
    raise ValueError(f"Unknown strategy: {strategy}")


def impute(df: DataFrame, fills: DataFrame) -> DataFrame:
    """Fill nulls from the one-row table of :func:`fit_impute`."""
    one = fills.select(*[F.col(c).alias(f"__fw_{c}") for c in fills.columns])
    out = df.crossJoin(F.broadcast(one))
    fixed = {c: F.coalesce(F.col(c), F.col(f"__fw_{c}")) for c in fills.columns}
    return out.withColumns(fixed).drop(*one.columns)


def fit_outlier_bounds(
    df: DataFrame, cols: Sequence[str], method: str = "iqr", threshold: float = 1.5
) -> DataFrame:
    """A one-row table ``{c}_low``, ``{c}_high``."""
    if method == "iqr":
        q = group_quantiles(df, [], cols, [0.25, 0.75])
        bounds = []
        for c in cols:
            low, high = F.element_at(c, 1), F.element_at(c, 2)
            reach = (high - low) * F.lit(float(threshold))
            bounds += [(low - reach).alias(f"{c}_low"), (high + reach).alias(f"{c}_high")]
        return q.select(*bounds)
    if method == "zscore":
        made = []
        for c in cols:
            reach = F.stddev_samp(c) * F.lit(float(threshold))
            made += [(F.avg(c) - reach).alias(f"{c}_low"), (F.avg(c) + reach).alias(f"{c}_high")]
        return df.agg(*made)
    raise ValueError(f"Unknown outlier method: {method}")


def handle_outliers(df: DataFrame, bounds: DataFrame, cols: Sequence[str], mode: str = "flag") -> DataFrame:
    """``flag`` adds ``{c}_outlier``, ``clip`` limits the values, ``drop`` removes the rows."""
    out = df.crossJoin(F.broadcast(bounds))
    inside = {c: F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")) for c in cols}
    if mode == "flag":
        out = out.withColumns({f"{c}_outlier": (~inside[c]).cast("int") for c in cols})
    elif mode == "clip":
        limit = {
            c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.col(f"{c}_low")), F.col(f"{c}_high")))
            for c in cols
        }
        out = out.withColumns(limit)
    elif mode == "drop":
        for c in cols:
            out = out.filter(F.coalesce(inside[c], F.lit(True)))
    else:
        raise ValueError(f"Unknown mode: {mode}")
    return out.drop(*bounds.columns)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A one-row table of means and population standard deviations."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mu") for c in cols], *[F.stddev_pop(c).alias(f"{c}_sd") for c in cols]
    )


def standardise(df: DataFrame, scaler: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by ``(v - mean) / sd``; a constant column becomes 0."""
    out = df.crossJoin(F.broadcast(scaler))
    scaled = {
        c: (F.col(c) - F.col(f"{c}_mu")) / F.when(F.col(f"{c}_sd") > 0, F.col(f"{c}_sd")).otherwise(1.0) for c in cols
    }
    return out.withColumns(scaled).drop(*scaler.columns)


def fit_categories(df: DataFrame, cols: Sequence[str], most: int | None = None) -> dict[str, list]:
    """The sorted categories per column; a caller may refuse more than ``most``.

    Every category becomes a column, so they are known to the driver anyway;
    ``one_hot_vector`` takes any number without that.
    """
    found = {}
    for c in cols:
        distinct = df.select(c).filter(F.col(c).isNotNull()).distinct()
        values = (distinct if most is None else distinct.limit(most + 1)).collect()
        if most is not None and len(values) > most:
            raise ValueError(f"column '{c}' has more than {most} categories")
        found[c] = sorted(v[0] for v in values)
    return found


def one_hot_columns(df: DataFrame, categories: dict[str, list], drop: bool = True) -> DataFrame:
    """Add ``{c}_{category}`` 0/1 columns; unknown and null categories are all 0."""
    made = {
        f"{c}_{v}": F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0) for c, values in categories.items() for v in values
    }
    out = df.withColumns(made)
    return out.drop(*categories) if drop else out


def one_hot_vector(df: DataFrame, cols: Sequence[str], name: str = "one_hot") -> DataFrame:
    """Add one sparse vector of all categories of ``cols``, any number of them; unknown and null ones are all 0."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    indexed, coded = [f"__fw_{c}_i" for c in cols], [f"__fw_{c}_v" for c in cols]
    text = df.withColumns({f"__fw_{c}_s": F.col(c).cast("string") for c in cols})
    stages = [
        StringIndexer(inputCols=[f"__fw_{c}_s" for c in cols], outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=True),
        VectorAssembler(inputCols=coded, outputCol=name),
    ]
    return Pipeline(stages=stages).fit(text).transform(text).select(*df.columns, name)


def products(df: DataFrame, cols: Sequence[str], interaction_only: bool = True, most: int | None = None) -> DataFrame:
    """Add ``{a}_x_{b}`` for every pair, and squares unless ``interaction_only``."""
    start = 1 if interaction_only else 0
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + start :]]
    if most is not None and len(pairs) > most:
        raise ValueError(f"{len(pairs)} products exceed the limit of {most}")
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


# Exact bounds of the signed integer types.
_INTEGERS: list[tuple[T.DataType, int, int]] = [
    (T.ByteType(), -(2**7), 2**7 - 1),
    (T.ShortType(), -(2**15), 2**15 - 1),
    (T.IntegerType(), -(2**31), 2**31 - 1),
]


def narrow_types(df: DataFrame, floats: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cast integer columns to the smallest type that holds them; returns a report too.

    Doubles become floats only on request, and only if every value survives the
    round trip. Other types are untouched. One aggregate decides all columns.
    """
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)] if floats else []
    checks: list[Column] = []
    for c in whole:
        checks += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    for c in real:
        lossless = F.col(c).cast("float").cast("double") == F.col(c)
        checks.append(F.bool_and(F.coalesce(lossless, F.lit(True))).alias(f"{c}__ok"))
    seen = df.agg(*checks).first() if checks else {}
    target: dict[str, T.DataType] = {}
    for c in whole:
        low, high = seen[f"{c}__lo"], seen[f"{c}__hi"]
        if low is None:
            continue
        fits = [t for t, a, b in _INTEGERS if a <= low and high <= b]
        if fits:
            target[c] = fits[0]
    for c in real:
        if seen[f"{c}__ok"]:
            target[c] = T.FloatType()
    narrowed = df.select(*[F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])
    lines = [(c, dict(df.dtypes)[c], dict(narrowed.dtypes)[c]) for c in df.columns]
    report = df.sparkSession.createDataFrame(lines, "column string, before string, after string")
    return narrowed, report

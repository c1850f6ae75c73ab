"""Imputation, scaling and one-hot encoding, always fitted on train rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelops.operators.ranks import quantiles


def impute_median(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL and NaN become the exact train median."""
    medians = quantiles(train, cols, {"median": 0.5})
    wide = medians.agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in cols])
    ).scalar()
    filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), wide[c]) for c in cols}
    return df.withColumns(filled)


def category_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, n): one aggregate for all columns, combined map-side."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = texts.unpivot([], list(cols), "column", "level").filter("level is not null")
    return long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))


def modes(levels: DataFrame) -> DataFrame:
    """(column, mode): the most frequent level, the smallest one on ties."""
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("level").alias("level")))
    return levels.groupBy("column").agg(first.alias("m")).select("column", F.col("m.level").alias("mode"))


def impute_mode(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL becomes the most frequent train level."""
    top = modes(category_levels(train, cols)).agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c) for c in cols])
    ).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), top[c]) for c in cols})


def standardise(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population std of train; a constant column is only centred."""
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        parts += [F.avg(x).alias(f"{c}_mean"), F.stddev_pop(x).alias(f"{c}_std")]
    s = train.agg(F.struct(*parts)).scalar()
    scaled = {}
    for c in cols:
        std = F.when(s[f"{c}_std"] > 0, s[f"{c}_std"]).otherwise(F.lit(1.0))
        scaled[c] = (F.col(c).cast("double") - s[f"{c}_mean"]) / std
    return df.withColumns(scaled)


def one_hot_levels(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, level, n, position): dummies in sorted order, position 0 is the dropped first level.

    The window orders the levels of a column, a dictionary, not its rows.
    """
    place = F.row_number().over(Window.partitionBy("column").orderBy("level")) - 1
    return category_levels(train, cols).withColumn("position", place)


@dataclass(frozen=True)
class Preparation:
    """Fitted preparation: a few numbers per column and the level names, all on the driver."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    medians: dict[str, float]
    modes: dict[str, str]
    centre: dict[str, float]
    scale: dict[str, float]
    levels: dict[str, list[str]]  # dummies only: sorted, without the dropped first level

    @property
    def feature_names(self) -> list[str]:
        dummies = [f"{c}_{level}" for c in self.categorical for level in self.levels[c]]
        return [*self.numeric, *dummies]

    def fill(self, df: DataFrame) -> DataFrame:
        """Imputed (and scaled, if fitted so) numeric columns and imputed categories."""
        out = {}
        for c in self.numeric:
            x = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(self.medians.get(c, 0.0)))
            if c in self.scale:
                x = (x - F.lit(self.centre[c])) / F.lit(self.scale[c])
            out[c] = x
        for c in self.categorical:
            out[c] = F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))
        return df.withColumns(out)

    def _indexed(self, df: DataFrame) -> DataFrame:
        """`_i_<column>`: place among the kept levels; every other level shares the place after them.

        The dictionaries are hash maps as long as the one-hot vector is wide.
        """
        for c in self.categorical:
            if self.levels[c]:
                df = StringIndexerModel.from_labels(
                    self.levels[c], inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep"
                ).transform(df)
        return df

    def codes(self, df: DataFrame, prefix: str = "_code_") -> DataFrame:
        """Integer code per category: 0 for the dropped or an unknown level, else its position."""
        out = {}
        for c in self.categorical:
            place = F.col(f"_i_{c}") if self.levels[c] else F.lit(0)
            out[prefix + c] = F.when(place < len(self.levels[c]), place + 1).otherwise(0).cast("int")
        return self._indexed(df).withColumns(out).drop(*[f"_i_{c}" for c in self.categorical])

    def assemble(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Feature vector; the dropped first level and unknown levels are zero vectors."""
        out = self._indexed(self.fill(df))
        used = [c for c in self.categorical if self.levels[c]]
        index, hot = [f"_i_{c}" for c in used], [f"_h_{c}" for c in used]
        if used:
            # The encoder drops the last index, the one of all other levels.
            encoder = OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True)
            out = encoder.fit(out).transform(out)
        vector = VectorAssembler(inputCols=[*self.numeric, *hot], outputCol=output).transform(out)
        return vector.drop(*index, *hot)


def fit_preparation(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], scale: bool
) -> Preparation:
    """Medians, modes, level dictionaries and, with `scale`, means and population deviations."""
    medians = {r["column"]: r["median"] for r in quantiles(train, numeric, {"median": 0.5}).collect()}
    # The level dictionary: the one-hot vector holds one entry per row of it.
    counted: dict[str, list] = {c: [] for c in categorical}
    if categorical:
        for r in category_levels(train, categorical).collect():
            counted[r["column"]].append((r["level"], r["n"]))
    modes_ = {c: min(v, key=lambda t: (-t[1], t[0]))[0] for c, v in counted.items() if v}
    levels = {c: sorted(level for level, _ in v)[1:] for c, v in counted.items()}
    fitted = Preparation(tuple(numeric), tuple(categorical), medians, modes_, {}, {}, levels)
    return with_scale(fitted, train) if scale else fitted


def with_scale(fitted: Preparation, train: DataFrame) -> Preparation:
    """The same preparation with standardised numbers; a constant column is only centred."""
    if not fitted.numeric:
        return fitted
    aggs = []
    for c in fitted.numeric:
        aggs += [F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s")]
    row = fitted.fill(train).agg(*aggs).first()
    centre = {c: row[f"{c}_m"] for c in fitted.numeric}
    spread = {c: row[f"{c}_s"] or 1.0 for c in fitted.numeric}
    return replace(fitted, centre=centre, scale=spread)

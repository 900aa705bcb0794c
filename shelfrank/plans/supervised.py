"""Training flow of the quality model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.features import feature_matrix, fit_features
from shelfrank.operators.quality import QualityModel, compare_models, grid_search, split_sets, within_tolerance


def train_quality_model(
    clean: DataFrame,
    as_of_year: int,
    kinds: Sequence[str] = ("linear", "ridge", "random_forest"),
    grids: Mapping[str, Mapping] | None = None,
    save_to: str | None = None,
    **settings,
) -> tuple[QualityModel, DataFrame]:
    """Engineer features, compare model types, tune the best one, and measure it on training and held-out rows.

    Returns the tuned model and the comparison table.
    """
    state = fit_features(clean, as_of_year)
    matrix = feature_matrix(clean, state)
    best, comparison = compare_models(matrix, state, kinds, **settings)
    model = grid_search(matrix, state, best, grid=(grids or {}).get(best))
    labelled = matrix.where(F.col("label").isNotNull())
    predicted = model.predict(split_sets(labelled, {"train": 0.8, "test": 0.2}), clipped=False)
    for row in within_tolerance(predicted).collect():
        model.metrics[f"{row['set']}_within_10"] = row["within_10"]
    if save_to is not None:
        model.save(save_to)
    return model, comparison

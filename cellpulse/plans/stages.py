"""The chain from incidents to predictions, with the written tables everything later reads."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse.config import GridConfig
from cellpulse.operators import features, grid, panel, predictions
from cellpulse.operators.clean import clean_incidents
from cellpulse.staging import written


class Stages:
    """Lazy views over raw incidents; `panel` and `features` are written on first use.

    The grid corner is found once, from the critical columns, and is a literal in every later plan, so gridding is
    a projection whose filters reach the scan. The panel is at most cells times windows large, and every
    feature, report and model reads it or the feature table, never the incidents.
    """

    def __init__(self, incidents: DataFrame, config: GridConfig):
        self.incidents = incidents
        self.config = config

    @property
    def cleaned(self) -> DataFrame:
        return clean_incidents(self.incidents, self.config)

    @cached_property
    def anchored(self) -> GridConfig:
        """The configuration with the grid corner of the data filled in."""
        if self.config.origin is not None:
            return self.config
        corner = grid.data_bounds(self.cleaned).first()
        return replace(self.config, origin=(corner["lat_min"], corner["lon_min"]))

    @property
    def gridded(self) -> DataFrame:
        return grid.assign_windows(grid.assign_cells(self.cleaned, self.anchored), self.anchored)

    def build_panel(self) -> DataFrame:
        return panel.grid_time_panel(self.gridded)

    def build_features(self) -> DataFrame:
        return features.advanced_matrix(self.panel, self.config)

    @cached_property
    def panel(self) -> DataFrame:
        return written(self.build_panel(), "panel")

    @cached_property
    def features(self) -> DataFrame:
        return written(self.build_features(), "features")

    def predictions(self, predicted: Column | None = None) -> DataFrame:
        """Predictions table; without a model column the 7-window rolling mean stands in."""
        value = F.col("rolling_mean_7") if predicted is None else predicted
        return predictions.predictions(self.features, value, self.config)

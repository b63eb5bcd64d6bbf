"""Preparation, features, splits, training and evaluation of bar series as Spark DataFrame jobs."""

from barflow.plans.prepare import (
    all_features, bars_to_features, build_features, build_lr_features, fill_bars, scale_features,
)
from barflow.plans.reports import compare_runs, yearly_profile
from barflow.plans.training import train
from barflow.series import Bars, Series
from barflow.session import build_session, configure, stage

__all__ = [
    "Bars", "Series", "all_features", "bars_to_features", "build_features", "build_lr_features", "build_session",
    "compare_runs", "configure", "fill_bars", "scale_features", "stage", "train", "yearly_profile",
]

"""DataFrame -> DataFrame operators (chainable with ``.transform``)."""

from barflow.operators.combine import combine_assets, reconcile_counts
from barflow.operators.joins import attach_security_name, bounded_broadcast
from barflow.operators.metrics import regression_metrics
from barflow.operators.model import (
    eval_curve,
    load_model,
    predict,
    save_model,
    select_tree_count,
    train_and_evaluate,
    train_volume_model,
)
from barflow.operators.prepare import (
    dedupe_features,
    drop_incomplete,
    prepare_training_set,
    sample_split,
)
from barflow.operators.preview import preview
from barflow.operators.rolling import (
    add_rolling_features,
    moving_average,
    rolling_mean,
    rolling_median,
    trailing_window,
)
from barflow.operators.score import score_guard, score_volume

__all__ = [
    "add_rolling_features", "attach_security_name", "bounded_broadcast", "combine_assets",
    "dedupe_features", "drop_incomplete", "eval_curve", "load_model", "moving_average",
    "predict", "prepare_training_set", "preview", "reconcile_counts", "regression_metrics",
    "rolling_mean", "rolling_median", "sample_split", "save_model", "score_guard",
    "score_volume", "select_tree_count", "trailing_window", "train_and_evaluate",
    "train_volume_model",
]

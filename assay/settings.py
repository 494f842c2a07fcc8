"""Limits that make a run depend on a table's size. None that touches large tables is on by default."""

from __future__ import annotations

from dataclasses import dataclass

from assay import thresholds as th


@dataclass(frozen=True)
class Limits:
    """What a run may skip or cut on large tables (None: never), and what counts as a small one.

    PUBLISHED holds the fixed values that the rule queries report.
    """

    small_rows: int = th.SMALL_ROWS  # under so many rows: simple models, no tuning, more folds
    cv_max_cells: int | None = None  # no cross-validation above so many cells
    cv_max_features: int | None = None  # nor from so many features on
    tuning_cells: int | None = None  # reduced tuning above so many cells
    tune_rows: int | None = None  # rows of the reduced tuning sample
    missing_limits: tuple[tuple[int | None, float], ...] = ((None, th.MISSING_LIMIT_SMALL),)  # (rows below, percent)
    boosting_max_rows: int | None = None  # classic boosting only under so many rows
    margin_max_rows: int | None = None  # margin model only under so many rows
    margin_max_cols: int | None = None  # and up to so many columns
    unit_variance_min_rows: int = 0
    corr_drop_pairs: int | None = None  # correlated pairs that the drop list looks at


PUBLISHED = Limits(
    small_rows=th.SMALL_ROWS, cv_max_cells=th.CV_MAX_CELLS, cv_max_features=th.CV_MAX_FEATURES, tuning_cells=th.TUNING_CELLS,
    tune_rows=th.TUNE_ROWS,
    missing_limits=((th.SMALL_ROWS, th.MISSING_LIMIT_SMALL), (th.LARGE_ROWS, th.MISSING_LIMIT_MEDIUM), (None, th.MISSING_LIMIT_LARGE)),
    boosting_max_rows=th.LARGE_ROWS, margin_max_rows=th.SMALL_ROWS, margin_max_cols=th.MARGIN_MODEL_MAX_COLS,
    unit_variance_min_rows=th.UNIT_VARIANCE_MIN_ROWS, corr_drop_pairs=th.CORR_TOP,
)

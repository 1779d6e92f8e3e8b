"""What preparing loans has learned, as a pipeline that is saved and scores new raw loans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame

from riskloom.operators.clean import ZERO_FILL_COLUMNS, feature_columns
from riskloom.operators.encode import MAX_LEVELS, Vocabulary, fit_vocabulary
from riskloom.operators.profile import TARGETS, numeric_columns, text_columns
from riskloom.operators.spread import fit_fences


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _select(columns: Sequence[str]) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT {', '.join(columns)} FROM __THIS__")


def fit_preparation(
    clean: DataFrame,
    key: str = "loan_id",
    vocabulary: Vocabulary | None = None,
    cap_outliers: bool = False,
    exclude_target_inputs: bool = False,
    null_category: bool = False,
    max_levels: int = MAX_LEVELS,
) -> PipelineModel:
    """The steps from a raw loan, whose outcome is not known yet, to the key, ``EAD`` and the encoded features.

    ``clean`` are cleaned loans; options as of :func:`riskloom.plans.prepare.encoded_loans`,
    whose columns the features equal. Zero fills, fences and vocabulary stand in
    the pipeline, so new loans are treated as the ones it was fitted on.
    """
    features = feature_columns(clean, (key, "PD", "LGD", "EAD"))
    texts = [c for c in text_columns(clean, [key]) if c in features]
    numbers = [c for c in features if c not in texts]
    zero = [f"COALESCE({_name(c)}, 0) AS {_name(c)}" if c in ZERO_FILL_COLUMNS else _name(c) for c in numbers]
    cast = [f"CAST({_name(c)} AS STRING) AS {_name(c)}" for c in texts]
    stages = [_select([_name(key), f"{_name('funded_amnt')} AS EAD", *zero, *cast])]
    if cap_outliers:
        capped = []
        for c, f in fit_fences(clean, [c for c in numeric_columns(clean, TARGETS) if c != key]).items():
            x = f"CAST({_name(c)} AS DOUBLE)"
            limits = f"CASE WHEN {x} < {f.low!r}D THEN {f.q1!r}D WHEN {x} > {f.high!r}D THEN {f.q3!r}D ELSE {x} END"
            capped.append(f"{x if f.q1 is None else limits} AS {_name(c)}")
        others = [c for c in numbers if c not in numeric_columns(clean, TARGETS)]
        stages.append(_select([_name(key), "EAD", *capped, *map(_name, [*others, *texts])]))
    if vocabulary is None:
        vocabulary = fit_vocabulary(clean, texts, max_levels)
    dummies = []
    for c, levels in vocabulary.items():
        dummies += [f"CASE WHEN {_name(c)} = {_text(v)} THEN 1 ELSE 0 END AS {_name(f'{c}_{v}')}" for v in levels[1:]]
        if null_category:
            dummies.append(f"CASE WHEN {_name(c)} IS NULL THEN 1 ELSE 0 END AS {_name(f'{c}_nan')}")
    dropped = {"max_bal_owed", "funded_amnt"} if exclude_target_inputs else set()
    kept = [_name(c) for c in features if c not in vocabulary and c not in dropped]
    stages.append(_select([_name(key), "EAD", *kept, *dummies]))
    return PipelineModel(stages)

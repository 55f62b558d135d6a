"""Batch scoring with validity checks.

The reference served one prediction per HTTP request, re-loading the model
each time. Here scoring is a DataFrame operator: models are loaded once per
job and applied to any number of rows (batch or stream), one model per asset
class, then guarded row by row with built-in expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from barflow.functions.names import unused

FEATURES = ("vol_moving_avg", "adj_close_rolling_med")

# Status codes and message texts of the scoring response.
STATUS_OK = "ok"
STATUS_INVALID_INPUT = "invalid_input"
STATUS_INVALID_OUTPUT = "invalid_output"
STATUS_NEGATIVE = "negative"
MSG_INVALID_INPUT = ("Invalid input. Please enter numeric values for vol_moving_avg "
                     "and adj_close_rolling_med.")
MSG_NEGATIVE = ("Invalid Output. Please enter valid values for vol_moving_avg and "
                "adj_close_rolling_med.")
MSG_OK = "The predicted %s volume given (%s, %s) is %d."


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double; text that is no number becomes NULL instead of failing."""
    c = F.col(name)
    return c.try_cast("double") if df.schema[name].dataType == StringType() else c.cast("double")


def _finite(d: Column) -> Column:
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))


def number_text(value: Column, text: Column | None = None) -> Column:
    """A double itself as text: the shortest digits that name it, in plain
    notation with a fraction from 0.001 up to 1e15, in the engine's beyond.
    ``text``: the engine's text of it, where it is at hand."""
    text = value.cast("string") if text is None else text
    plain = F.regexp_replace(text.try_cast("decimal(38,12)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(value)
    return F.when(text.contains("E") & (size < 1e15) & (size >= 1e-3), plain).otherwise(text)


def score_guard(df: DataFrame, prediction: str = "prediction", class_col: str = "asset_class",
                features=FEATURES) -> DataFrame:
    """Add ``predicted_volume`` (prediction truncated toward zero), ``status``
    and ``message``.

    * a feature that is NULL, NaN, infinite or text without a number ->
      ``invalid_input`` (the reference's typed parameters reject non-numbers);
    * prediction NULL / NaN / infinite -> ``invalid_output``;
    * truncated prediction < 0 -> ``negative``, however large (so -0.5 truncates
      to 0 and is accepted, as in the reference, and -1e30 is not);
    * a prediction beyond the range of a bigint -> ``invalid_output``;
    * else ``ok`` with the message, which names the given numbers. ``ok`` always
      comes with a volume.
    """
    # numbers and their texts are worked out once, in steps of their own
    numbers = unused(df, *[f"_number_{i}" for i in range(len(features))])
    texts_of = unused(df, *[f"_text_{i}" for i in range(len(features[:2]))])
    inputs_ok = F.lit(True)
    for n in numbers:
        inputs_ok = inputs_ok & _finite(F.col(n))
    p = as_number(df, prediction)
    pv = p.try_cast("long")
    status = (F.when(~inputs_ok, F.lit(STATUS_INVALID_INPUT))
              .when(~_finite(p), F.lit(STATUS_INVALID_OUTPUT))
              .when(p <= -1, F.lit(STATUS_NEGATIVE))
              .when(pv.isNull(), F.lit(STATUS_INVALID_OUTPUT))
              .otherwise(F.lit(STATUS_OK)))
    cls = F.col(class_col) if class_col in df.columns else F.lit("stock")
    cls = F.when(cls == "etf", F.lit("etfs")).otherwise(cls)
    given = [F.coalesce(cls, F.lit("null")), *[number_text(F.col(n), F.col(t)) for n, t in zip(numbers, texts_of)],
             pv.cast("string")]
    texts = MSG_OK.replace("%d", "%s").split("%s")
    ok_text = F.concat(F.lit(texts[0]), *[c for g, t in zip(given, texts[1:]) for c in (g, F.lit(t))])
    # so is the status, and the message from it
    at, whole, said = unused(df, "_status", "_whole", "_message")
    known = F.col(at)
    msg = (F.when(known == STATUS_INVALID_INPUT, F.lit(MSG_INVALID_INPUT))
           .when(known == STATUS_OK, ok_text).otherwise(F.lit(MSG_NEGATIVE)))
    out = (df.withColumns({n: as_number(df, f) for n, f in zip(numbers, features)})
           .withColumns({t: F.col(n).cast("string") for n, t in zip(numbers, texts_of)}))
    return (out.withColumns({at: status, whole: pv}).withColumn(said, msg).withColumns({
        "predicted_volume": F.when(known == STATUS_OK, F.col(whole)),
        "status": known,
        "message": F.col(said),
    }).drop(at, whole, said, *numbers, *texts_of))


def score_volume(df: DataFrame, models: Mapping[str, object], class_col: str = "asset_class",
                 features=FEATURES) -> DataFrame:
    """M9: predict with the model of each row's asset class, then guard.

    ``models`` maps class -> fitted ``PipelineModel`` ([assembler, booster],
    see ``barflow.operators.model``). One pass over the input: the features
    are assembled once, every class's booster adds its own prediction column
    (map-only), and each row keeps the one of its class. Rows whose class has
    no model get a NULL prediction (status ``invalid_output``). Text features
    are read as numbers; where that fails they score as missing and the guard
    rejects the row.
    """
    from barflow.operators.model import assembler

    aside, *names = unused(df, "_features", *[f"_given_{i}" for i in range(len(features))],
                           *[f"_prediction_{i}" for i in range(len(models))])
    given, tmp = dict(zip(features, names)), names[len(features):]
    # the models read a column ``features``; the input's own of that name steps aside
    out = df.withColumnRenamed("features", aside).withColumns({g: F.col(f) for f, g in given.items()})
    out = assembler(features).transform(out.withColumns({f: as_number(df, f) for f in features}))
    pick = F.lit(None).cast("double")
    for col, (cls, model) in zip(tmp, models.items()):
        booster = model.stages[-1].copy().setPredictionCol(col)
        out = booster.transform(out)
        pick = F.when(F.col(class_col) == cls, F.col(col)).otherwise(pick)
    out = out.withColumn("prediction", pick).drop("features", *tmp).withColumnRenamed(aside, "features")
    out = out.withColumns({f: F.col(g) for f, g in given.items()}).drop(*given.values())
    return score_guard(out, "prediction", class_col, features)

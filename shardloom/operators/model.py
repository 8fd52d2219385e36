"""Batch inference and classifier scoring (N1-N8), and batch functions that survive failing rows.

Scoring of given logits (argmax, softmax, cross-entropy, accuracy) is pure
expressions.  Python runs only where a model must: ``predict_batches`` keeps
one model for each Python worker and calls it on full batches of
``batch_size`` rows inside ``mapInPandas`` (Arrow batches in and out), and
``isolate_failures`` halves a failing batch until the failing rows are alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import argmax, log_softmax_at, softmax
from ..session import scratch_path

#: models that one Python worker keeps, the least recently used goes first
KEPT_MODELS = 2


def _rebatch_function():
    # nested functions travel to Python workers by value: they need no package on their path
    def rebatch(frames, size):
        """Frames of exactly ``size`` rows from frames of any size; only the last one is shorter."""
        import pandas as pd
        waiting, n = [], 0
        for frame in frames:
            waiting.append(frame)
            n += len(frame)
            if n < size:
                continue
            whole = pd.concat(waiting, ignore_index=True) if len(waiting) > 1 else frame
            for start in range(0, n - n % size, size):
                yield whole.iloc[start:start + size].reset_index(drop=True)
            waiting, n = [whole.iloc[n - n % size:]], n % size
        if n:
            yield pd.concat(waiting, ignore_index=True)

    return rebatch


_rebatch = _rebatch_function()


def predict_batches(df: DataFrame, make_model: Callable[..., Callable], input_cols: Sequence[str],
                    out_type: T.DataType | str, batch_size: int = 100,
                    out_col: str = "prediction", profile=None, weights=None) -> DataFrame:
    """Keep every column, add ``out_col`` = model(batch).  ``out_type`` may
    be a struct (say label and score); the model then returns dicts.
    ``profile`` is a ResourceProfile for the stage (say a GPU for each task).

    ``make_model()`` - or ``make_model(weights)`` with ``weights`` broadcast once -
    runs once for each Python worker, not for each task: workers keep their last
    ``KEPT_MODELS`` models under a digest of the function and the weights, so a
    worker that gets the next task of the stage (or of a later query with the same
    model) calls the one it has.  The returned callable takes a pandas DataFrame
    of ``input_cols`` and returns a sequence of outputs of the same length.  Batches
    have exactly ``batch_size`` rows across Arrow batches; only the last of a
    partition may be shorter.  Filter and limit *before* calling this: Catalyst
    cannot move them below a Python map.
    """
    if isinstance(out_type, str):
        out_type = T._parse_datatype_string(out_type)
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, out_type, True)])
    cols, rebatch, kept = list(input_cols), _rebatch, KEPT_MODELS
    packed = cloudpickle.dumps((make_model, weights))
    digest = hashlib.sha256(packed).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(weights) if weights is not None else None
    del packed, weights

    def run(batches):
        import sys

        import pandas as pd
        models = vars(sys).setdefault("_shardloom_models", {})  # of this process, whatever tasks it runs
        model = models.pop(digest, None)
        if model is None:
            model = make_model() if shared is None else make_model(shared.value)
        models[digest] = model
        while len(models) > kept:
            del models[next(iter(models))]
        for frame in rebatch(batches, batch_size):
            yield frame.assign(**{out_col: pd.Series(list(model(frame[cols])), index=frame.index, dtype=object)})

    return df.mapInPandas(run, schema, profile=profile) if profile is not None else df.mapInPandas(run, schema)


def isolate_failures(df: DataFrame, fn: Callable, input_cols: Sequence[str], out_type: T.DataType | str,
                     batch_size: int = 100, out_col: str = "result", error_col: str = "error",
                     require_rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """``fn`` on batches, failing rows set aside; returns ``(good, failed)``.

    ``fn`` takes a pandas DataFrame of ``input_cols`` and returns as many outputs.  A batch
    for which it raises (or returns another number of outputs) is halved, and so on, until
    the failing rows are single: n bad rows cost at most 2 n log2(batch) further calls, and
    a bad row takes no good one with it.  Good rows have ``out_col``; failed ones keep
    their columns and have ``error_col``, the exception's type and text.  The outcome is
    written once to the shared folder, both results read it, so ``fn`` runs once for each
    row and not again for the second result.  ``fn`` must be repeatable: a lost task and
    a halved batch call it again.  ``require_rows`` raises when rows came in and none survived.
    """
    if isinstance(out_type, str):
        out_type = T._parse_datatype_string(out_type)
    row, cols, rebatch = T.StructType(df.schema.fields), list(input_cols), _rebatch
    schema = T.StructType([*row.fields, T.StructField(out_col, out_type, True), T.StructField(error_col, T.StringType(), True)])

    def run(batches):
        import pandas as pd

        def attempt(frame, outputs, errors):
            todo = [(0, len(frame))]  # halves still to try, a stack
            while todo:
                a, b = todo.pop()
                try:
                    got = list(fn(frame[cols].iloc[a:b].reset_index(drop=True)))
                    if len(got) != b - a:
                        raise ValueError(f"{len(got)} outputs for {b - a} rows")
                    outputs[a:b] = got
                except Exception as e:  # kept with the row once it is alone
                    if b - a == 1:
                        errors[a] = f"{type(e).__name__}: {e}"
                    else:
                        todo += [((a + b) // 2, b), (a, (a + b) // 2)]

        for frame in rebatch(batches, batch_size):
            outputs, errors = [None] * len(frame), [None] * len(frame)
            attempt(frame, outputs, errors)
            yield frame.assign(**{out_col: pd.Series(outputs, dtype=object), error_col: pd.Series(errors, dtype=object)})

    spark = df.sparkSession
    path = scratch_path(spark, "isolated")
    df.mapInPandas(run, schema).write.parquet(path)
    done = spark.read.schema(schema).parquet(path)
    good, failed = done.filter(F.col(error_col).isNull()).drop(error_col), done.filter(F.col(error_col).isNotNull()).drop(out_col)
    if require_rows and good.limit(1).count() == 0 and failed.limit(1).count():
        raise ValueError("no row survived")
    return good, failed


def with_argmax(df: DataFrame, logits: str, out: str = "pred") -> DataFrame:
    """Argmax of a logit array (first wins ties)."""
    return df.withColumn(out, argmax(logits))


def decode(df: DataFrame, names: Sequence[str], id_col: str, out: str) -> DataFrame:
    """Class name by 0-based list position (null past the end)."""
    arr = F.array(*[F.lit(n) for n in names])
    return df.withColumn(out, F.get(arr, F.col(id_col)))


def classify(df: DataFrame, logits: str, names: Sequence[str] | None = None,
             label_out: str = "label", score_out: str = "score") -> DataFrame:
    """Best class and its softmax probability (stable softmax)."""
    p = softmax(logits)
    out = df.withColumn("_p", p).withColumn("_k", argmax(logits))
    lab = F.get(F.array(*[F.lit(n) for n in names]), F.col("_k")) if names else F.col("_k")
    return (out.withColumn(label_out, lab)
            .withColumn(score_out, F.get(F.col("_p"), F.col("_k")))
            .drop("_p", "_k"))


def cross_entropy(df: DataFrame, logits: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean ``-log softmax(logits)[label]`` (log-sum-exp form)."""
    loss = -log_softmax_at(logits, F.col(label))
    agg = [F.avg(loss).alias("cross_entropy"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*by).agg(*agg) if by else df.agg(*agg)


def accuracy(df: DataFrame, pred: str | Column, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Micro-averaged accuracy."""
    p = F.col(pred) if isinstance(pred, str) else pred
    agg = [F.avg((p == F.col(label)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*by).agg(*agg) if by else df.agg(*agg)


def fit_classifier(df: DataFrame, text_col: str, label_col: str, num_features: int = 1 << 18,
                   max_iter: int = 50, reg: float = 0.0):
    """N5 (re-aimed fine-tuning): a distributed text classifier with the
    same input and output (text -> label, probability): tokenise, hash term
    counts, logistic regression.  Returns a fitted ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True)
    tf = HashingTF(inputCol="_words", outputCol="_features", numFeatures=num_features)
    lr = LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=max_iter, regParam=reg,
                            predictionCol="prediction", probabilityCol="probability",
                            rawPredictionCol="_raw")
    return Pipeline(stages=[tok, tf, lr]).fit(df.withColumn(label_col, F.col(label_col).cast("double")))


def score_saved(df: DataFrame, model_path: str) -> DataFrame:
    """Load a saved pipeline and score rows; adds ``prediction`` and
    ``score`` (probability of the predicted class)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    model = PipelineModel.load(model_path)
    out = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    return (out.withColumn("score", F.get(probs, F.col("prediction").cast("int")))
            .drop("_words", "_features", "_raw", "probability"))

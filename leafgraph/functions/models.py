"""Columns that need a model: computed where one is given, null where none is."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: A model gets the texts of a batch and returns a column for each of these names, as many rows, nulls where it knows nothing.
TOKEN_COLUMNS = ("lemma", "pos", "ner_label")
Model = Callable[[pd.Series], pd.DataFrame]


def with_model_columns(tokens: DataFrame, model: Model | None = None, names: tuple[str, ...] = TOKEN_COLUMNS) -> DataFrame:
    """``tokens`` with the columns of a model.  Without a model, or where it fails on a batch, they are null."""
    if model is None:
        return tokens.withColumns({name: F.lit(None).cast("string") for name in names})

    @pandas_udf(", ".join(f"{name} string" for name in names))
    def ask(texts: pd.Series) -> pd.DataFrame:
        try:
            known = model(texts).reset_index(drop=True).reindex(columns=list(names)).astype(object)
            return known.where(known.notna(), None)
        except Exception:  # a model that fails is a model that is not there
            return pd.DataFrame({name: [None] * len(texts) for name in names}, dtype=object)

    answered = tokens.withColumn("model_columns", ask(F.col("text")))
    return answered.select(*tokens.columns, *(F.col(f"model_columns.{name}").alias(name) for name in names))

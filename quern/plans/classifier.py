"""A text classifier that Spark trains where the texts are, for the label filter."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, NGram, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import materialize, scratch_dir


def fit_labels(rows: DataFrame, text: str, label: str, features: int = 1 << 14, max_iter: int = 15, regularization: float = 1e-3) -> PipelineModel:
    """A pipeline that writes the likeliest label of a text into the column ``label``.

    Learns from every row with a label: hashed words and characters in threes, weighted by inverse document frequency, and logistic
    regression. The distinct labels come to the driver. Null texts count as empty. Its working columns begin with ``_ml``.
    """
    known = rows.where(F.col(label).isNotNull())
    labels = [r[0] for r in known.select(label).distinct().orderBy(label).collect()]
    if len(labels) < 2:
        raise ValueError("a classifier needs rows of two labels or more")
    number = F.lit(None).cast("double")
    for k, name in enumerate(labels):
        number = F.when(F.col(label) == name, float(k)).otherwise(number)
    shape = [
        SQLTransformer(statement=f"SELECT *, lower(coalesce(`{text}`, '')) AS _ml_text FROM __THIS__"),
        RegexTokenizer(inputCol="_ml_text", outputCol="_ml_words", pattern=r"\s+", toLowercase=False, minTokenLength=0),
        RegexTokenizer(inputCol="_ml_text", outputCol="_ml_chars", pattern=r"(?s).", gaps=False, toLowercase=False),
        NGram(n=3, inputCol="_ml_chars", outputCol="_ml_grams"),
        HashingTF(inputCol="_ml_words", outputCol="_ml_word_counts", numFeatures=features),
        HashingTF(inputCol="_ml_grams", outputCol="_ml_gram_counts", numFeatures=features),
        VectorAssembler(inputCols=["_ml_word_counts", "_ml_gram_counts"], outputCol="_ml_counts"),
    ]
    learn = [
        IDF(inputCol="_ml_counts", outputCol="_ml_features", minDocFreq=1),
        LogisticRegression(featuresCol="_ml_features", labelCol="_ml_label", predictionCol="_ml_prediction", probabilityCol="_ml_probability",
                           rawPredictionCol="_ml_raw", maxIter=max_iter, regParam=regularization),
        IndexToString(inputCol="_ml_prediction", outputCol="label", labels=labels),
    ]
    # Texts are taken apart once; both fits read the counts.
    counted = PipelineModel(stages=shape).transform(known.select(F.col(text), number.alias("_ml_label")))
    counted = materialize(counted.select("_ml_label", "_ml_counts"), "classifier-counts")
    model = PipelineModel(stages=[*shape, *Pipeline(stages=learn).fit(counted).stages])
    # The model as stored: the fitted one holds its training session, which cannot go to tasks once it has observed a write.
    path = f"{scratch_dir(rows.sparkSession)}/classifier-{uuid.uuid4().hex}"
    model.write().save(path)
    return PipelineModel.load(path)

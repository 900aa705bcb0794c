"""Text to vectors: a pluggable encoder, with hashed TF-IDF as the built-in one."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.similarity import Query, nearest, with_catalog

DIMENSION = 384
BATCH = 64

Encoder = Callable[[Sequence[str]], np.ndarray]


class TfIdfEmbedder:
    """Hashed TF-IDF of unit length; fitted once on a corpus, then applied to any text."""

    def __init__(self, dimension: int = DIMENSION):
        self.dimension = dimension
        self.model: PipelineModel | None = None

    def fit(self, texts: DataFrame, column: str) -> "TfIdfEmbedder":
        stages = [
            RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\s+"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=self.dimension),
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_unit"),
        ]
        self.model = Pipeline(stages=stages).fit(texts.select(F.coalesce(column, F.lit("")).alias("_text")))
        return self

    def transform(self, texts: DataFrame, column: str, output: str = "embedding") -> DataFrame:
        if self.model is None:
            raise ValueError("fit the embedder first")
        prepared = texts.withColumn("_text", F.coalesce(column, F.lit("")))
        encoded = self.model.transform(prepared).withColumn(output, vector_to_array("_unit", "float32"))
        return encoded.drop("_text", "_words", "_tf", "_idf", "_unit")

    def encode_single(self, spark, text: str) -> list[float]:
        row = self.transform(spark.createDataFrame([(text,)], "text string"), "text").first()
        return list(row["embedding"])

    def save(self, path: str) -> str:
        if self.model is None:
            raise ValueError("fit the embedder first")
        self.model.write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, path: str) -> "TfIdfEmbedder":
        embedder = cls()
        embedder.model = PipelineModel.load(path)
        embedder.dimension = embedder.model.stages[1].getNumFeatures()
        return embedder


def embed(
    texts: DataFrame, column: str, load_encoder: Callable[[], Encoder], key: str = "item_id", batch: int = BATCH
) -> DataFrame:
    """Vectors from a user's model: ``load_encoder`` runs once per task, the encoder sees ``batch`` texts at a time."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder()
        for rows in batches:
            values = [t if t is not None else "" for t in rows.column("text").to_pylist()]
            for start in range(0, len(values), batch):
                vectors = np.asarray(encoder(values[start : start + batch]), dtype=np.float32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(key).slice(start, len(vectors)), pa.array(list(vectors), pa.list_(pa.float32()))],
                    names=[key, "embedding"],
                )

    return texts.select(key, F.col(column).alias("text")).mapInArrow(encode, f"{key} bigint, embedding array<float>")


def describe_query(
    catalog: DataFrame, items: DataFrame, description: str, embedder: TfIdfEmbedder, k: int = 10
) -> DataFrame:
    """Items closest to a free text, which is embedded the way the items were."""
    vector = embedder.encode_single(items.sparkSession, description)
    return with_catalog(nearest(items, [Query(description, vector)], k), catalog)

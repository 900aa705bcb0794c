"""Building the embedding table of a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.embedding import TfIdfEmbedder
from shelfrank.operators.projections import semantic_view
from shelfrank.operators.text_prep import combined_text
from shelfrank.sources.vectors import load_embeddings, save_embeddings


def build_index(clean: DataFrame, path: str, embedder: TfIdfEmbedder | None = None) -> tuple[DataFrame, TfIdfEmbedder]:
    """Rows with text, combined and embedded, stored as one table; the embedder is fitted when it is not yet."""
    texts = combined_text(semantic_view(clean))
    embedder = embedder or TfIdfEmbedder()
    if embedder.model is None:
        embedder.fit(texts, "overview_processed")
    save_embeddings(embedder.transform(texts, "overview_processed"), path)
    return load_embeddings(clean.sparkSession, path), embedder


def index_vectors(index: DataFrame) -> DataFrame:
    return index.select("item_id", F.col("embedding"))

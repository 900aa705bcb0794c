"""Quality classifier: the labels of the nearest latent-semantic vectors vote, weighted by similarity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import numbered, pick, stored, whole
from shelfrank.llm.text_shape import TERMS, shape_terms

MAX_REFERENCES = 4096
DIMENSIONS = 64
NEIGHBOURS = 15
SHARPNESS = 64
TEXTS_AT_ONCE = 256
SMOOTHING = 0.3


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no model learns from."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


@dataclass
class NeighbourVotes:
    """Reference vectors of unit length in the latent space, their labels and vote weights."""

    projection: np.ndarray  # terms x dimensions, term weights included
    references: np.ndarray  # references x dimensions
    labels: np.ndarray
    weights: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS
    sharpness: int = SHARPNESS

    @classmethod
    def fit(cls, terms: np.ndarray, labels: np.ndarray, totals: tuple[float, float], dimensions: int = DIMENSIONS, **settings):
        """Term weights, the leading singular directions of the weighted references, and class weights that restore ``totals``,
        the numbers of labelled rows with label 0 and 1."""
        n = len(labels)
        held = (terms > 0).sum(axis=0)
        used = np.flatnonzero(held)  # most terms occur in no reference; the driver need not carry them
        idf = np.log((1 + n) / (1 + held[used])) + SMOOTHING
        weighted = terms[:, used] * idf.astype(np.float32)
        products = np.zeros((len(used), len(used)))
        for start in range(0, n, TEXTS_AT_ONCE):
            block = weighted[start : start + TEXTS_AT_ONCE].astype(np.float64)
            products += block.T @ block
        _, directions = np.linalg.eigh(products)
        directions = directions[:, ::-1][:, :dimensions]
        sampled = np.bincount(labels, minlength=2)
        weights = np.where(labels == 1, totals[1] / max(1, sampled[1]), totals[0] / max(1, sampled[0]))
        prior = totals[1] / sum(totals) if sum(totals) else 0.5
        projection = np.zeros((terms.shape[1], directions.shape[1]))
        projection[used] = idf[:, None] * directions
        return cls(projection, unit(weighted @ directions), labels.astype(np.float64), weights, prior, **settings)

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Share of the vote for label 1, for each row of ``terms``."""
        if not len(self.labels) or not len(terms):
            return np.full(len(terms), self.prior)
        cosines = np.round(unit(terms.astype(np.float64) @ self.projection) @ self.references.T, 9)
        k = min(self.neighbours, cosines.shape[1])
        kth = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, cosines.shape[1] - k]
        row, column = np.nonzero((cosines >= kth[:, None]) & (cosines > 0))
        votes = cosines[row, column] ** self.sharpness * self.weights[column]
        for_one = np.bincount(row, votes * self.labels[column], minlength=len(terms))
        total = np.bincount(row, votes, minlength=len(terms))
        return np.where(total > 0, np.minimum(1.0, for_one / np.where(total > 0, total, 1)), self.prior)


def unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(size > 0, size, 1)


def _terms_of(texts: list[str]) -> np.ndarray:
    return np.stack([shape_terms(t) for t in texts]) if texts else np.empty((0, TERMS), np.float32)


def fit_votes(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_references: int = MAX_REFERENCES,
    **settings,
) -> NeighbourVotes:
    """References are at most ``max_references`` labelled rows, half of them of each label, chosen by a hash of the id.

    Only ids that are not held out and are found in ``docs`` count.  Labels other than 0 and 1, null ids and null labels are left
    out; an id with several labels takes the more frequent one (1 on a tie), an id with several texts the smallest text.
    What the driver receives is bounded by ``max_references`` vectors of a fixed length.
    """
    known = pick(labels, id=id_col, label=label_col).where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    texts = pick(docs, id=id_col, text=text_col)
    known = stored(known.join(texts.select("id").distinct(), "id", "left_semi"), "labelled-ids")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    half = max_references // 2
    sample = [known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(half) for v in (0, 1)]
    chosen = F.broadcast(sample[0].unionByName(sample[1]))
    rows = texts.join(chosen, "id").groupBy("id", "label").agg(F.min(whole(F.col("text"))).alias("text"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"hash": batch["id"], "label": batch["label"], "terms": [shape_terms(t).tobytes() for t in batch["text"]]})

    found = rows.select(F.xxhash64("id").alias("id"), "label", "text").mapInPandas(vectors, "hash long, label int, terms binary").toPandas()
    found = found.sort_values(["hash", "label"])
    terms = np.stack([np.frombuffer(t, np.float32) for t in found["terms"]]) if len(found) else np.empty((0, TERMS), np.float32)
    return NeighbourVotes.fit(terms, found["label"].to_numpy(np.int64), (totals.get(0, 0), totals.get(1, 0)), **settings)


def score_quality(df: DataFrame, model: NeighbourVotes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and score (0 to 1, higher is better) of every row; nothing but the whole text is an input.

    The model is broadcast (a fixed number of vectors); each batch is multiplied with all of them.  An empty or null text, and
    one that is like no reference, scores the share of label 1 among the labelled rows; so does every text if there are no
    labelled rows (0.5 then).  Neighbours tied with the last one all vote.  Repeated rows, null ids and empty tables need no
    special care; other columns are ignored.
    """
    rows = pick(df, id=id_col, text=text_col).select("id", whole(F.col("text")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        votes = shared.value
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[start : start + TEXTS_AT_ONCE]
                yield pd.DataFrame({"id": part["id"], "score": votes.score(_terms_of(part["text"].tolist()))})

    return rows.mapInPandas(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, model: NeighbourVotes, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``df`` that score at least ``least``, with all their columns.

    A null text scores as an empty one; see ``score_quality``.  Every row is judged alone, so ties and repeated rows all stay or all go;
    an empty table stays empty, null ids need no care, and other columns may have any names.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [texts.iloc[i : i + TEXTS_AT_ONCE].tolist() for i in range(0, len(texts), TEXTS_AT_ONCE)]
        return pd.Series(np.concatenate([shared.value.score(_terms_of(p)) for p in parts]) if parts else [], dtype="float64")

    rows = numbered(df)
    return rows.restored(rows.frame.where(score(whole(F.col(rows.name(text_col)))) >= F.lit(least)))

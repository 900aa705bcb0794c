"""Substring deduplication: runs of consecutive sentences that occur again elsewhere are removed from all but the first place."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import pick, stored, whole

BOUNDARY = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")
MIN_SENTENCES = 2
MIN_WORDS = 25
ROWS_AT_ONCE = 2000


def sentences_of(text: str) -> list[tuple[int, int]]:
    """Start and end of every sentence, the white space after it included; together they make up the text."""
    ends = [m.end() for m in BOUNDARY.finditer(text)]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    return [(a, b) for a, b in zip([0, *ends], ends, strict=False) if b > a]


def runs_of(words: list[int], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """The runs (first, end) to compare, given the number of words of each sentence.

    From every sentence on, and back from every sentence, the shortest run of at least ``min_sentences`` sentences and
    ``min_words`` words; a sentence with twice as many words is a run of its own.  A repeated passage that holds a run is covered to both ends.
    """
    n = len(words)
    total = [0, *accumulate(words)]
    runs = {(i, i + 1) for i in range(n) if words[i] >= 2 * min_words}
    end = 0
    for first in range(n):
        end = max(end, first + min_sentences)
        while end <= n and total[end] - total[first] < min_words:
            end += 1
        if end > n:
            break
        runs.add((first, end))
    first = n
    for end in range(n, 0, -1):
        first = min(first, end - min_sentences)
        while first >= 0 and total[end] - total[first] < min_words:
            first -= 1
        if first < 0:
            break
        runs.add((first, end))
    return sorted(runs)


class Sentences:
    """A text cut into sentences, with the hashes of its runs."""

    def __init__(self, text: str, min_sentences: int, min_words: int) -> None:
        self.text = text
        self.spans = sentences_of(text)
        split = [text[a:b].lower().split() for a, b in self.spans]
        self.runs = runs_of([len(w) for w in split], min_sentences, min_words)
        joined = [" ".join(w) for w in split]
        self.hashes = [xxhash.xxh3_128_digest("\n".join(joined[a:b]).encode("utf-8", "replace")) for a, b in self.runs]

    def without(self, repeated: set[bytes]) -> tuple[str, list[tuple[int, int]], int]:
        """What is left without the sentences of runs that are in ``repeated`` or stood before in this text; the removed stretches;
        the number of removed sentences."""
        gone = np.zeros(len(self.spans), dtype=bool)
        seen: dict[bytes, int] = {}
        for (a, b), key in zip(self.runs, self.hashes, strict=True):
            # An overlap with its own first occurrence would remove that one too.
            if key in repeated or a >= seen.setdefault(key, b) and seen[key] != b:
                gone[a:b] = True
        kept = "".join(self.text[a:b] for (a, b), g in zip(self.spans, gone, strict=True) if not g)
        stretches: list[tuple[int, int]] = []
        for (a, b), g in zip(self.spans, gone, strict=True):
            if g and stretches and stretches[-1][1] == a:
                stretches[-1] = (stretches[-1][0], b)
            elif g:
                stretches.append((a, b))
        return kept, stretches, int(gone.sum())


def remove_repeated_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per row of ``df``: id, the text that is left, the numbers of sentences and of removed ones, and ``removed``, the
    removed stretches as (start, end) in characters of the old text.

    Sentences end at ``.``, ``!`` or ``?`` before white space and at line ends, and are compared in lower case with white space evened out.
    Of all places of a run the first stays: the document with the smallest id, and there the first place.  All runs of the whole table
    are compared by their 128-bit hash.  A null text counts as empty and stays empty.  Rows that share an id count as one document and remove
    nothing from each other; a null id counts as the largest, and rows with null ids remove nothing from each other.  An
    empty table gives an empty result; other columns are ignored.

    A run that very many documents share is counted by partial sums; the join that returns its places splits it.
    """
    rows = pick(df, id=id_col, text=text_col).select("id", whole(F.col("text")).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    places = stored(rows.mapInPandas(_hashes_with(kind, min_sentences, min_words), f"id {kind}, digest long, h1 long, h2 long"), "runs")
    shared = places.groupBy("h1", "h2").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("id").alias("known"), F.count(F.lit(1)).alias("n")
    )
    shared = stored(
        shared.where("first IS NOT NULL AND (first <> last OR known < n)").select("h1", "h2", "first"), "repeated-runs"
    )
    later = places.join(shared, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("first")))
    covered = later.groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(F.collect_set(F.struct("h1", "h2")).alias("repeated"))
    covered = stored(covered, "covered-runs")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    joined = rows.join(covered, same, "left").select("id", "text", "repeated")
    schema = f"id {kind}, text string, n_sentences int, n_removed int, removed array<struct<start:int,end:int>>"
    return joined.mapInPandas(_removal_with(min_sentences, min_words), schema).withColumnsRenamed({"id": id_col, "text": text_col})


def _hashes_with(kind: str, min_sentences: int, min_words: int):
    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[begin : begin + ROWS_AT_ONCE]
                found = [sorted(set(Sentences(t, min_sentences, min_words).hashes)) for t in part["text"]]
                counts = [len(f) for f in found]
                numbers = np.frombuffer(b"".join(h for f in found for h in f), dtype="<i8").reshape(-1, 2)
                yield pd.DataFrame(
                    {
                        "id": part["id"].repeat(counts).to_numpy(),
                        "digest": part["digest"].repeat(counts).to_numpy(),
                        "h1": numbers[:, 0],
                        "h2": numbers[:, 1],
                    }
                )

    return hashes


def _removal_with(min_sentences: int, min_words: int):
    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[begin : begin + ROWS_AT_ONCE]
                out = []
                for text, repeated in zip(part["text"], part["repeated"], strict=True):
                    keys = () if repeated is None else repeated
                    wanted = {np.array([k["h1"], k["h2"]], dtype="<i8").tobytes() for k in keys}
                    cut = Sentences(text, min_sentences, min_words)
                    kept, stretches, count = cut.without(wanted)
                    out.append((kept, len(cut.spans), count, [{"start": a, "end": b} for a, b in stretches]))
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "text": [o[0] for o in out],
                        "n_sentences": [o[1] for o in out],
                        "n_removed": [o[2] for o in out],
                        "removed": [o[3] for o in out],
                    }
                )

    return remove

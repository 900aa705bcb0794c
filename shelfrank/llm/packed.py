"""Packed counts: keys of many rows travel as arrays, by ranges of their hashes, and are summed where they meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import tidy, written
from shelfrank.llm.shingle_sets import FACTOR, mixed

REPLY_SCHEMA = "chunk long, bucket int, counts binary, total long, different long"


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def opened(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def chunks_of(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[tuple[int, pd.DataFrame]]:
    """Runs of rows with about ``limit`` characters of text in all, each with a number that no other run of the job has."""
    number, size, held = TaskContext.get().partitionId() << 32, 0, []
    for batch in batches:
        if not len(batch):
            continue
        ends = size + batch["text"].str.len().fillna(0).to_numpy(np.int64).cumsum()
        for turn, part in batch.groupby(ends // limit):
            if turn and held:
                yield number, pd.concat(held, ignore_index=True)
                number, held = number + 1, []
            held.append(part)
        size = int(ends[-1] % limit)
    if held:
        yield number, pd.concat(held, ignore_index=True)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending keys have ascending buckets."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin, and the end of the last."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])), len(values))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in ascending order, and how often each occurs."""
    keys = np.sort(keys)
    cuts = runs(keys)
    return keys[cuts[:-1]], np.diff(cuts)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in ascending order, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = runs(keys)[:-1]
    return keys[starts], np.add.reduceat(counts, starts)


def ngram_keys(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A key for each run of ``width`` values, in order; other widths and seeds have other keys."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    out = np.full(len(hashes) - width + 1, np.uint64(width))
    for i in range(width):
        out = out * FACTOR + hashes[i : len(hashes) - width + 1 + i]
    return mixed(out, seed)


def pieces(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, keys, counts) for ascending different keys."""
    bucket = bucket_of(keys, buckets)
    cuts = runs(bucket)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(bucket[a]), keys[a:b].tobytes(), squeezed(counts[a:b].astype(np.uint32))


def sums_of(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of one bucket as one: different keys and the sums of their counts."""
    keys = np.frombuffer(b"".join(group["keys"]), np.uint64)
    return summed(keys, np.concatenate([opened(b, np.uint32) for b in group["counts"]]).astype(np.int64))


def asks(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """The pieces by which one chunk tells what it adds to the counts of its keys (rows of two 64-bit values), and asks for the sums."""
    bucket = bucket_of(mixed(keys[:, 0], 11), buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = runs(bucket[order])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows = order[a:b]
        yield int(bucket[rows[0]]), keys[rows].tobytes(), squeezed(counts[rows].astype(np.int64))


def replies(asked: DataFrame, extra=None, schema: str = REPLY_SCHEMA) -> DataFrame:
    """For every piece asked with (chunk, bucket, keys, counts): the sums over all chunks, in the order of its keys.

    A bucket also gives one row without a chunk, with the sum of its counts and the number of its keys that have one; ``extra`` may add columns to
    this row, made of the keys and sums.  The number of buckets follows the data, so a bucket stays small; a key is in at most one piece of a
    chunk, so a frequent one is no more than its number of chunks.
    """

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint64).reshape(-1, 2)
        counts = [opened(b, np.int64) for b in group["counts"]]
        ends = np.cumsum([len(c) for c in counts])
        counts = np.concatenate(counts)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        ranked = keys[order]
        new = np.append(True, (ranked[1:] != ranked[:-1]).any(axis=1))
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts[order], starts)
        mine = np.empty(len(keys), np.int64)
        mine[order] = sums[np.cumsum(new) - 1]
        bucket = int(group["bucket"].iloc[0])
        out = {"chunk": group["chunk"].to_list(), "bucket": bucket, "counts": [squeezed(p) for p in np.split(mine, ends[:-1])]}
        whole = {"chunk": [None], "bucket": bucket, "counts": [None], "total": [int(sums.sum())], "different": [int((sums > 0).sum())]}
        if extra is not None:
            whole |= {name: [value] for name, value in extra(ranked[starts], sums).items()}
        columns = [c.split()[0] for c in schema.split(", ")]
        answers = pd.DataFrame(out | {"total": 0, "different": 0}).reindex(columns=columns)
        return pd.concat([answers.astype(object), pd.DataFrame(whole)[columns].astype(object)], ignore_index=True)

    return asked.groupBy("bucket").applyInPandas(answer, schema)


def with_replies(chunks: DataFrame, answered: DataFrame) -> DataFrame:
    """The chunks with ``replies``: their sums by ascending bucket, as ``reply_of`` takes them."""
    own = answered.where("chunk IS NOT NULL").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("replies"))
    own = written(own.select("chunk", F.col("replies.counts").alias("replies")), "replies")
    return chunks.join(own, "chunk", "left")


def reply_of(replied, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The sums for the keys of one chunk, in their order."""
    out = np.zeros(len(keys), np.int64)
    if len(keys):
        order = np.argsort(bucket_of(mixed(keys[:, 0], 11), buckets), kind="stable")
        out[order] = np.concatenate([opened(bytes(b), np.int64) for b in replied])
    return out


class Bits:
    """A set of keys in a fixed number of bits: it may hold more than what was put in, never less."""

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.shift, self.data = np.uint64(64 - bits), data if data is not None else np.zeros(max(1, 2**bits // 8), np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1

    @staticmethod
    def slice(keys: np.ndarray, bits: int) -> tuple[int, bytes]:
        """The bytes from the first to the last bit of ascending keys, and where they begin."""
        at = (keys >> np.uint64(64 - bits)).astype(np.int64)
        first = int(at[0]) >> 3
        flags = np.zeros((int(at[-1]) // 8 + 1 - first) * 8, np.uint8)
        flags[at - first * 8] = 1
        return first, np.packbits(flags, bitorder="little").tobytes()

    @classmethod
    def gathered(cls, slices: DataFrame, bits: int) -> Bits:
        """From rows (first, data); all of them together have about 2^bits bits, whatever the size of the corpus."""
        out = cls(bits)
        with tidy(slices.sparkSession):
            rows = slices.select("first", "data").collect()
        for first, data in rows:
            part = np.frombuffer(bytes(data), np.uint8)
            out.data[first : first + len(part)] |= part
        return out

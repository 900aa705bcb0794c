"""Language-model scoring: quantised n-gram counts in a log-frequency Bloom filter, read by repeated membership probes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import dropped, pick, whole, written
from shelfrank.llm.packed import (
    REPLY_SCHEMA,
    asks,
    bucket_of,
    chunks_of,
    counted,
    ngram_keys,
    opened,
    pieces,
    replies,
    reply_of,
    squeezed,
    sums_of,
    with_replies,
)
from shelfrank.llm.shingle_sets import mixed

HELD_OUT_OF, HELD_OUT = 7, 2
CHARS_AT_ONCE = 4_000_000
CHARS_PER_BUCKET = 8_000_000
#: N-grams of at least so many occurrences are in the filter; the mass of rarer ones goes to shorter contexts.
LEAST = 2
#: Level j of the filter stands for LEAST * BASE^(j - 1) occurrences or more.
BASE = 1.5
PROBES = 4
#: A filter of one order that takes at most so many bytes is broadcast; a larger one stays in slices where its n-grams are, and chunks ask those.
MAX_FILTER_BYTES = 48_000_000
#: Counts of 64 bits have fewer levels.
TOP_LEVEL = 120
#: Neither can be a word, as both hold a blank.
END, START = b" end", b" start"


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of the training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == HELD_OUT


def level_of(counts: np.ndarray) -> np.ndarray:
    """The highest level whose least count each count (of ``LEAST`` or more) reaches."""
    ends = [LEAST]
    while ends[-1] <= counts.max(initial=0):
        ends.append(math.ceil(LEAST * BASE ** len(ends)))
    return np.searchsorted(np.array(ends), counts, side="right")


def value_of(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the geometric middle of those it holds; 0 for level 0."""
    low = np.ceil(LEAST * BASE ** (np.maximum(levels, 1) - 1.0))
    high = np.maximum(np.ceil(LEAST * BASE ** np.maximum(levels, 1).astype(float)) - 1, low)
    return np.where(levels > 0, np.sqrt(low * high), 0.0)


class LogFrequencyFilter:
    """Bits of ``buckets`` slices of equal size; a key and its level j are ``PROBES`` bits in the slice of the key."""

    def __init__(self, buckets: int, slice_bits: int, data: np.ndarray | None = None, top: int = TOP_LEVEL) -> None:
        """``top`` is the highest level that was put in."""
        self.buckets, self.slice_bits, self.top = buckets, slice_bits, top
        self.data = np.zeros(buckets * slice_bits // 8, np.uint8) if data is None else data

    def places(self, keys: np.ndarray, level: int, probe: int) -> np.ndarray:
        """Of the bit in the key's slice."""
        return ((mixed(keys, 100 + level * PROBES + probe) >> np.uint64(32)) * np.uint64(self.slice_bits)) >> np.uint64(32)

    def slice_with(self, keys: np.ndarray, levels: np.ndarray) -> bytes:
        """The slice that holds these keys of one bucket, at all levels up to their own."""
        flags = np.zeros(self.slice_bits, np.uint8)
        for level in range(1, int(levels.max(initial=0)) + 1):
            reached = keys[levels >= level]
            for probe in range(PROBES):
                flags[self.places(reached, level, probe).astype(np.int64)] = 1
        return np.packbits(flags, bitorder="little").tobytes()

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: the last one up to which every probe finds its bit.  Never lower than what was put in."""
        out = np.zeros(len(keys), np.int64)
        left, slices = np.arange(len(keys)), bucket_of(keys, self.buckets) * self.slice_bits
        for level in range(1, self.top + 1):
            if not len(left):
                break
            for probe in range(PROBES):
                at = slices + self.places(keys, level, probe).astype(np.int64)
                found = (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                left, keys, slices = left[found], keys[found], slices[found]
            out[left] = level
        return out


def slice_bits_for(entries: int, slices: int = 1) -> int:
    """Bits of each slice for so many keys and levels in all."""
    # Half of the bits set is the best use of them.
    return max(64, math.ceil(entries * PROBES / math.log(2) / slices) // 8 * 8 + 8)


def levels_in_slice(stored: np.ndarray, levels: np.ndarray):
    """A function of keys that reads their levels in the filter's slice of one bucket: ascending keys with the levels that were put in.

    The slice rejects most keys that were not put in; what it invents, the stored keys beside it take back, so these levels are exact.
    """
    own = LogFrequencyFilter(1, slice_bits_for(int(levels.sum(dtype=np.int64))), top=int(levels.max(initial=0)))
    own.data = np.frombuffer(own.slice_with(stored, levels), np.uint8)

    def of(keys: np.ndarray) -> np.ndarray:
        found = own.levels(keys)
        here = np.flatnonzero(found)
        place = np.searchsorted(stored, keys[here])
        place[place == len(stored)] = 0
        found[here] = np.where(stored[place] == keys[here], np.minimum(found[here], levels[place]), 0) if len(stored) else 0
        return found

    return of


class _Stream:
    """The tokens of a chunk as hashes, with a start before each text."""

    def __init__(self, row: dict) -> None:
        self.row, self.n_words = row, row["n_words"]
        self.sizes, self.train = opened(row["sizes"], np.int64), opened(row["train"], bool)
        self.tokens = opened(row["tokens"], np.int32)
        starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.first = np.zeros(len(self.tokens), bool)
        self.first[starts] = True
        self.trained = self.train[self.doc]
        # The number of the word before; the start has the last.
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[starts] = self.n_words

    @cached_property
    def keys(self) -> np.ndarray:
        return word_keys(words_in(self.row))

    @cached_property
    def hashes(self) -> np.ndarray:
        hashes = np.append(self.keys[:, 0], np.uint64(xxhash.xxh3_64_intdigest(START)))
        return hashes[np.insert(self.tokens, np.cumsum(self.sizes) - self.sizes, self.n_words)]

    @cached_property
    def at(self) -> np.ndarray:
        """The place of each token among the hashes."""
        return np.arange(len(self.tokens)) + self.doc + 1

    def bigrams(self) -> np.ndarray:
        return ngram_keys(self.hashes, 2)[self.at - 1]

    def can_be_held(self) -> np.ndarray:
        """The tokens with two before them (a start counts) whose two bigrams are held; no other trigram is."""
        held = opened(self.row["held"], np.uint8) > 0
        return np.flatnonzero(~self.first & held & np.append(False, held[:-1]))

    def trigrams(self, places: np.ndarray) -> np.ndarray:
        return ngram_keys(self.hashes, 3)[self.at[places] - 2]


def words_in(row: dict) -> list[bytes]:
    # The end's own name has a blank, so it is left out before the first one.
    return [END, *zstandard.decompress(row["words"]).split(b" ")[1:]]


def word_keys(words: list[bytes]) -> np.ndarray:
    """128 bits for each word, as rows of two values."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


#: What scoring reads, without and with the words.
SCORED = "chunk long, ids array<string>, train binary, sizes binary, tokens binary, n_words long"
CHUNKS = f"{SCORED}, words binary"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for number, chunk in chunks_of(batches, CHARS_AT_ONCE):
        numbers, tokens, sizes = _Numbers({END: 0}), [], []
        for text in chunk["text"]:
            words = (text or "").encode("utf-8", "replace").lower().split()
            tokens += [np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
            sizes.append(len(words) + 1)
        row = {
            "chunk": number,
            "ids": chunk["id"].to_list(),
            "train": squeezed(~chunk["held_out"].to_numpy(bool)),
            "sizes": squeezed(np.array(sizes, np.int64)),
            "tokens": squeezed(np.concatenate(tokens)),
            "n_words": len(numbers),
            "words": zstandard.compress(b" ".join([b"", *[w for w in numbers if w is not END]]), 1),
        }
        yield pd.DataFrame({k: [v] for k, v in row.items()})


def score_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """The log10 probability of every text under an interpolated trigram model of the rows that are not held out.

    A-Z are lower-cased; tokens are the words between ASCII white space and one end.  Training are the rows whose crc32 of the id as text (null:
    empty) leaves another remainder than ``HELD_OUT`` by ``HELD_OUT_OF``.  ``base_score`` adds one to each exact token count; it and ``n_known`` come from exact
    counts that the chunks of the table ask for once per different word, as no list of all words would have a bounded size.

    Bigrams and trigrams of at least two occurrences in training are counted exactly, by packed arrays that are summed per key range, and go into a
    log-frequency Bloom filter each (a trigram only if both its bigrams are in theirs): level j stands for at least 2 * 1.5^(j-1) occurrences, all levels up to
    the n-gram's own are set, and a probe climbs levels until a bit is missing.  Filters grow with the n-grams and are broadcast up to ``filter_bytes``; a larger one
    stays in slices, each with the n-grams of its bucket, and is probed there: chunks send their keys, and levels found too high are mended by those n-grams.  The probability of a word is its share among what followed the longer context, plus the mass
    of rare and unseen continuations (measured over the whole training side for contexts of like frequency) times that under the shorter context; at the bottom stands the
    base model, so no text has probability zero.

    Null and empty texts are one token, the end.  Repeated rows count each time; a null id is trained on if the empty text would be; very long texts are one
    chunk; ties do not arise.  An empty table has no rows; without a training row every token has the share 1.  Other columns are ignored.
    Returns id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.select(F.col("id").cast("string").alias("id"), whole(F.col("text")).alias("text"), held_out(F.col("id")).alias("held_out"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // CHARS_PER_BUCKET + 1)

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in _rows(batches):
            part = _Stream(row)
            counts = np.bincount(part.tokens[part.trained], minlength=part.n_words)
            yield pd.DataFrame([(row["chunk"], *p) for p in asks(part.keys, counts, buckets)], columns=["chunk", "bucket", "keys", "counts"])

    def with_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in _rows(batches):
            keys = word_keys(words_in(row))
            row["counts"] = squeezed(reply_of(row.pop("replies"), keys, buckets))
            yield pd.DataFrame({k: [v] for k, v in row.items()})

    read = written(rows.mapInPandas(_read, CHUNKS), "token-chunks")
    answered = written(replies(read.mapInPandas(asked, "chunk long, bucket int, keys binary, counts binary")), "word-counts")
    total, different = answered.where("chunk IS NULL").agg(F.sum("total"), F.sum("different")).first()
    total, different = total or 0, different or 0
    chunks = written(with_replies(read, answered).mapInPandas(with_counts, f"{CHUNKS}, counts binary"), "counted-chunks")
    dropped(read, answered)

    def bigrams(part: _Stream) -> np.ndarray:
        # Words of one occurrence cannot be in a repeated pair; the start always can.
        often = np.append(opened(part.row["counts"], np.int64) >= least, True)
        return part.bigrams()[part.trained & often[part.tokens] & often[part.before]]

    def trigrams(part: _Stream) -> np.ndarray:
        places = part.can_be_held()
        return part.trigrams(places[part.trained[places]])

    pairs = _repeated(chunks, bigrams, least, buckets)
    paired = _with_levels(chunks, f"{CHUNKS}, counts binary", "held", _Stream.bigrams, pairs, buckets, filter_bytes)
    dropped(chunks, pairs)
    triples = _repeated(paired, trigrams, least, buckets)
    known = _with_levels(
        paired, f"{CHUNKS}, counts binary, held binary", "known", lambda part: part.trigrams(part.can_be_held()), triples, buckets, filter_bytes, ("words",), _seen
    )
    dropped(paired, triples)
    masses = _masses(known)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in _rows(batches):
            part, counts = _Stream(row), opened(row["counts"], np.int64)
            share = (counts + 1) / (total + different + 1)
            single = share[part.tokens]
            starts = np.cumsum(part.sizes) - part.sizes
            likely = _likely(part, counts, single, masses)
            yield pd.DataFrame(
                {
                    "id": list(row["ids"]),
                    "held_out": ~part.train,
                    "n_tokens": part.sizes,
                    "n_known": np.add.reduceat((counts > 0)[part.tokens].astype(np.int64), starts),
                    "train_tokens": total,
                    "base_score": np.add.reduceat(np.log10(single), starts),
                    "score": np.add.reduceat(np.log10(likely), starts),
                }
            )

    schema = "id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return known.drop("seen").mapInPandas(scored, schema).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_dict("records")


def _repeated(chunks: DataFrame, grams, least: int, buckets: int) -> DataFrame:
    """The n-grams that ``grams`` gives for each chunk and that occur ``least`` times in all: a row per bucket with ascending keys and their levels."""

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in _rows(batches):
            yield pd.DataFrame(list(pieces(*counted(grams(_Stream(row))), buckets)), columns=["bucket", "keys", "counts"])

    def often(group: pd.DataFrame) -> pd.DataFrame:
        keys, sums = sums_of(group)
        keys, sums = keys[sums >= least], sums[sums >= least]
        levels = level_of(sums)
        made = (int(group["bucket"].iloc[0]), keys.tobytes(), squeezed(levels.astype(np.uint8)), int(levels.sum()), int(levels.max(initial=0)))
        return pd.DataFrame([made], columns=["bucket", "keys", "levels", "entries", "top"])

    packed = chunks.mapInPandas(occurrences, "bucket int, keys binary, counts binary")
    return written(packed.groupBy("bucket").applyInPandas(often, "bucket int, keys binary, levels binary, entries long, top int"), "repeated-ngrams")


def _filter(kept: DataFrame, buckets: int, filter_bytes: int):
    """A broadcast filter with the n-grams of ``_repeated``; None if they need more bytes and it stays in slices."""
    entries, top = kept.agg(F.sum("entries"), F.max("top")).first()
    slice_bits = slice_bits_for(entries or 0, buckets)
    if buckets * slice_bits // 8 > max(filter_bytes, buckets * 8):
        return None
    empty = LogFrequencyFilter(buckets, slice_bits)

    def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shape = LogFrequencyFilter(buckets, slice_bits, np.empty(0, np.uint8))
        for row in _rows(batches):
            data = shape.slice_with(np.frombuffer(row["keys"], np.uint64), opened(row["levels"], np.uint8))
            yield pd.DataFrame({"bucket": [row["bucket"]], "data": [data]})

    size = slice_bits // 8
    for bucket, data in kept.select("bucket", "keys", "levels").mapInPandas(sliced, "bucket int, data binary").toLocalIterator():
        empty.data[bucket * size : (bucket + 1) * size] = np.frombuffer(bytes(data), np.uint8)
    return kept.sparkSession.sparkContext.broadcast((buckets, slice_bits, empty.data, top or 0))


def _with_levels(
    chunks: DataFrame, schema: str, name: str, keys_of, kept: DataFrame, buckets: int, filter_bytes: int, without: tuple[str, ...] = (), more=None
) -> DataFrame:
    """The chunks with the levels of the n-grams that ``keys_of`` gives; ``more`` makes a further column of the stream and the levels.

    Levels come from a broadcast filter; of one too large for that, each slice is probed where its bucket is, and the chunks get replies.
    """
    kept_fields = [f for f in schema.split(", ") if f.split()[0] not in without]
    out_schema = ", ".join([*kept_fields, f"{name} binary", *([more.schema] if more else [])])
    names = [f.split()[0] for f in out_schema.replace("<width int, context int, n long, kept long>", "").split(", ")]

    def extended(row: dict, part: _Stream, levels: np.ndarray) -> pd.DataFrame:
        row = row | {name: squeezed(levels.astype(np.uint8))}
        if more:
            row |= {more.schema.split()[0]: more(part, levels)}
        return pd.DataFrame([[row[c] for c in names]], columns=names)

    shared = _filter(kept, buckets, filter_bytes)
    if shared is not None:

        def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for row in _rows(batches):
                part = _Stream(row)
                yield extended(row, part, LogFrequencyFilter(*shared.value).levels(keys_of(part)))

        return written(chunks.mapInPandas(probed, out_schema), f"chunks-{name}")

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in _rows(batches):
            found = pieces(*counted(keys_of(_Stream(row))), buckets)
            yield pd.DataFrame([(row["chunk"], bucket, keys) for bucket, keys, _ in found], columns=["chunk", "bucket", "keys"])

    def answer(asking: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(stored["keys"].iloc[0], np.uint64) if len(stored) else np.empty(0, np.uint64)
        of = levels_in_slice(keys, opened(stored["levels"].iloc[0], np.uint8) if len(stored) else np.empty(0, np.uint8))
        found = [squeezed(of(np.frombuffer(k, np.uint64)).astype(np.uint8)) for k in asking["keys"]]
        return pd.DataFrame({"chunk": asking["chunk"], "bucket": asking["bucket"], "counts": found})

    asking = chunks.mapInPandas(asked, "chunk long, bucket int, keys binary").groupBy("bucket")
    replied = asking.cogroup(kept.select("bucket", "keys", "levels").groupBy("bucket")).applyInPandas(answer, "chunk long, bucket int, counts binary")
    answered = written(replied, "levels")

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in _rows(batches):
            part = _Stream(row)
            _, which = np.unique(keys_of(part), return_inverse=True)
            replies_ = row.pop("replies")
            levels = np.concatenate([opened(bytes(b), np.uint8) for b in replies_]) if len(which) else np.empty(0, np.uint8)
            yield extended(row, part, levels[which])

    out = written(with_replies(chunks, answered).mapInPandas(placed, out_schema), f"chunks-{name}")
    dropped(answered)
    return out


def _classes(counts: np.ndarray) -> np.ndarray:
    """Contexts by the level of their count; those seen less often than the filter holds are class 0."""
    return np.where(counts >= LEAST, level_of(counts), 0)


def _seen(part: _Stream, known: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(width, context, occurrences in training, those that the filter holds) for the bigrams and trigrams of a chunk, by the level of the context."""
    counts, held = opened(part.row["counts"], np.int64), opened(part.row["held"], np.uint8)
    classes = _classes(np.append(counts, counts[0]))[part.before]
    places = np.flatnonzero(~part.first & part.trained)
    three = np.zeros(len(held), bool)
    three[part.can_be_held()] = known > 0
    out = []
    for width, context, kept in ((2, classes[part.trained], (held > 0)[part.trained]), (3, held[places - 1], three[places])):
        all_of = np.bincount(context, minlength=1)
        kept_of = np.bincount(context[kept], minlength=len(all_of))
        out += [(width, i, int(all_of[i]), int(kept_of[i])) for i in np.flatnonzero(all_of).tolist()]
    return out


_seen.schema = "seen array<struct<width int, context int, n long, kept long>>"


def _masses(chunks: DataFrame) -> dict[int, np.ndarray]:
    """For bigrams (2) and trigrams (3), by the level of the context: the share of occurrences in training that are not held."""
    sums = chunks.select(F.inline("seen")).groupBy("width", "context").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"))
    out = {width: np.ones(256) for width in (2, 3)}
    for width, context, n, kept in sums.where("n > 0").collect():
        out[width][context] = 1 - kept / n
    return out


def _likely(part: _Stream, counts: np.ndarray, single: np.ndarray, masses: dict) -> np.ndarray:
    """The probability of every token of a chunk."""
    held, three = opened(part.row["held"], np.uint8).astype(np.int64), np.zeros(len(part.tokens), np.int64)
    three[part.can_be_held()] = opened(part.row["known"], np.uint8)
    before = np.append(counts, counts[0])[part.before]  # the start is as frequent as the end
    value = value_of(np.arange(TOP_LEVEL + 1))
    seen = value[held]
    share = np.where(before > 0, np.minimum(seen, before) / np.maximum(before, 1), 0.0)
    pair = np.minimum(1.0, share + masses[2][_classes(before)] * single)
    places = np.flatnonzero(~part.first)
    last = held[places - 1]
    context, known = value[last], value[three[places]]
    share = np.where(last > 0, np.minimum(known, context) / np.maximum(context, 1.0), 0.0)
    out = pair.copy()
    out[places] = np.where(last > 0, np.minimum(1.0, share + masses[3][last] * pair[places]), pair[places])
    return np.maximum(out, np.finfo(float).tiny)

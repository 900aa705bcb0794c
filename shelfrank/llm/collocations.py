"""Phrase collocations by SON partitioning: shards mined whole at a proportional support, then one exact count of what any shard found."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import pick, whole, written
from shelfrank.llm.packed import Bits, bucket_of, chunks_of, counted, ngram_keys, opened, runs, squeezed
from shelfrank.scale import broadcast_if_small, top_k_per_group

SUPPORT, LONGEST, TOP, ABSORB = 100, 5, 2_000, 100
SHARDS = 8
#: Bits of the sets of locally frequent words, pairs and longer phrases: 8, 16 and 16 MB at any size of the corpus.
WORD_BITS, PAIR_BITS, LONG_BITS = 26, 27, 27
CHARS_AT_ONCE = 6_000_000
CHARS_PER_BUCKET = 8_000_000
CACHED_WORDS = 200_000
NO_LANG = "und"
#: Stands between pieces; no text in UTF-8 has this byte.
CUT = b"\xff"
BETWEEN = re.compile(rb"[.,;:!?\n-\r]")
WORDS = r"[^ \t.,;:!?\n-\r]+"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
            self[CUT] = 0
        self[word] = value = xxhash.xxh3_64_intdigest(word) | 1  # 0 is kept for the cut
        return value


def _words(texts: list[str | None]) -> list[bytes]:
    """The words of all texts in order, with a cut before, between and after pieces."""
    joined = b"".join(b" \xff " + (t or "").encode("utf-8", "replace") for t in texts) + b" \xff"
    return BETWEEN.sub(b" \xff ", joined.lower()).split()


class _Phrases:
    """All runs of words of some texts in one language, found by their keys."""

    def __init__(self, lang: str, texts: list[str | None], hashes: _WordHashes) -> None:
        self.seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace")) & 0x7FFFFFFF
        self.words = _words(texts)
        self.hashes = np.fromiter(map(hashes.__getitem__, self.words), np.uint64, len(self.words))

    def keys(self, width: int) -> np.ndarray:
        """The key of the run of ``width`` words that begins at each place."""
        return ngram_keys(self.hashes, width, self.seed)

    def open(self, width: int, words: Bits | None, pairs: Bits | None) -> np.ndarray:
        """At which places a run of ``width`` words lies within a piece and is made of words and pairs of the sets."""
        good = self.hashes != 0
        if words is not None:
            good[good] = words.has(self.keys(1)[good])
        if width == 1:
            return good
        ends = len(good) - 1
        two = good[:-1] & good[1:]
        if pairs is not None:
            two[two] = pairs.has(self.keys(2)[two])
        out = two[: ends - (width - 2)].copy() if ends >= width - 1 else np.zeros(0, bool)
        for i in range(1, width - 1):
            out &= two[i : i + len(out)]
        return out


def collocations(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    longest: int = LONGEST,
    top: int = TOP,
    absorb: int = ABSORB,
    shards: int = SHARDS,
) -> DataFrame:
    """The ``top`` phrases of two to ``longest`` words of each language whose words stand together more often than chance says.

    A-Z are lower-cased, texts cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs.  A phrase with at least
    ``support`` occurrences (within pieces, overlaps included) is a candidate.  It is cut after its first k words where 1000 a n / (l r),
    rounded down, is lowest (ties: smallest k); a, l and r are the occurrences of the phrase and its two parts, n those of all words.  Candidates inside
    a longer one that occurs at least ``absorb`` percent as often are dropped.

    SON: every row belongs to one of ``shards`` by a hash of its text.  A shard that holds a share s of a language's words is mined whole at support ceil(s ``support``),
    words first, then pairs of its frequent words, then longer phrases all of whose pairs are frequent; a phrase with ``support`` occurrences reaches the
    local support in one shard at least.  The union of what is frequent anywhere is kept as bits of a fixed number, so it may hold more, never
    less.  All of these phrases are then counted exactly over the whole corpus, as strings.  The shard number is fixed, so the local support stays well above one at every size.
    A shard is no task: its counts are packed by key ranges and summed wherever they meet.

    Null texts are empty, a null language is ``und``.  Texts without words give nothing; repeated rows count each time; a very long text is one row of
    a task.  Ties in score go to the more frequent phrase, then to the smaller one in byte order.  An empty table has no rows; other columns are ignored.
    Returns lang, rank, phrase, a, l, r, n, score.
    """
    spark = df.sparkSession
    docs = pick(df, text=text_col, lang=lang_col).select(
        whole(F.col("text")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang")
    )
    docs = docs.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    totals = docs.groupBy("lang", "shard").agg(F.sum(F.regexp_count("text", F.lit(WORDS))).alias("words"), F.sum(F.length("text")).alias("chars"))
    totals = written(totals, "phrase-totals")
    sizes = totals.groupBy("lang").agg(F.sum("words").alias("n"))
    chars = totals.agg(F.sum("chars")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // CHARS_PER_BUCKET + 1)
    # ceil(support * words / n) in whole numbers
    local = totals.join(sizes, "lang").where("words > 0").selectExpr("lang", "shard", f"CAST((words * {support} + n - 1) div n AS INT) AS support")

    context = spark.sparkContext
    words = context.broadcast(_mined(docs, local, (1,), None, None, buckets, WORD_BITS))
    pairs = context.broadcast(_mined(docs, local, (2,), words, None, buckets, PAIR_BITS))
    longer = context.broadcast(_mined(docs, local, tuple(range(3, longest + 1)), words, pairs, buckets, LONG_BITS))
    found = written(_counted(docs, support, longest, words, pairs, longer, buckets), "phrase-counts")
    return _ranked(found, sizes, top, absorb)


def _mined(docs: DataFrame, local: DataFrame, widths: tuple[int, ...], words, pairs, buckets: int, bits: int) -> Bits:
    """The phrases of these widths that are frequent in some shard."""

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes({CUT: 0})
        known, joined = words.value if words else None, pairs.value if pairs else None
        for _, chunk in chunks_of(batches, CHARS_AT_ONCE):
            found = []
            for (lang, shard, local_support), part in chunk.groupby(["lang", "shard", "support"], sort=False):
                phrases = _Phrases(lang, part["text"].to_list(), hashes)
                keys = [phrases.keys(w)[phrases.open(w, known, joined)] for w in widths]
                keys, counts = counted(np.concatenate(keys) if keys else np.empty(0, np.uint64))
                found.append((keys, counts, np.full(len(keys), shard), np.full(len(keys), local_support)))
            if found:
                yield _packed([np.concatenate(x) for x in zip(*found, strict=True)], buckets)

    def frequent(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint64)
        counts, shard, local_support = np.concatenate([opened(b, np.uint32).reshape(3, -1) for b in group["counts"]], axis=1).astype(np.int64)
        # A key belongs to one language, so its support is that of its shard.
        order = np.lexsort((shard, keys))
        keys, shard = keys[order], shard[order]
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1]))) if len(keys) else np.empty(0, np.int64)
        sums = np.add.reduceat(counts[order], starts) if len(keys) else counts
        keys = np.unique(keys[starts][sums >= local_support[order][starts]])
        return pd.DataFrame([Bits.slice(keys, bits)] if len(keys) else [], columns=["first", "data"])

    docs = docs.join(broadcast_if_small(local), ["lang", "shard"])
    packed = docs.mapInPandas(occurrences, "bucket int, keys binary, counts binary")
    return Bits.gathered(packed.groupBy("bucket").applyInPandas(frequent, "first long, data binary"), bits)


def _packed(found: list[np.ndarray], buckets: int) -> pd.DataFrame:
    """One row for each bucket with the keys of a chunk, all languages and shards; counts, shards and supports are three rows of ``counts``."""
    order = np.argsort(found[0], kind="stable")
    keys, counts, shard, local_support = (x[order] for x in found)
    bucket = bucket_of(keys, buckets)
    cuts = runs(bucket)
    rest = np.stack([counts, shard, local_support]).astype(np.uint32)
    out = [(int(bucket[a]), keys[a:b].tobytes(), squeezed(rest[:, a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pd.DataFrame(out, columns=["bucket", "keys", "counts"])


def _counted(docs: DataFrame, support: int, longest: int, words, pairs, longer, buckets: int) -> DataFrame:
    """lang, phrase and its exact occurrences, for all phrases of the sets that reach the support."""

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes({CUT: 0})
        for _, chunk in chunks_of(batches, CHARS_AT_ONCE):
            out = []
            for lang, part in chunk.groupby("lang", sort=False):
                phrases = _Phrases(lang, part["text"].to_list(), hashes)
                for width in range(1, longest + 1):
                    places = np.flatnonzero(phrases.open(width, words.value, pairs.value))
                    keys = phrases.keys(width)[places]
                    if width > 2:
                        there = longer.value.has(keys)
                        places, keys = places[there], keys[there]
                    order = np.argsort(keys, kind="stable")
                    cuts = runs(keys[order])
                    different, at, counts = keys[order[cuts[:-1]]], places[order[cuts[:-1]]], np.diff(cuts)
                    by_bucket = runs(bucket_of(different, buckets))
                    for a, b in zip(by_bucket[:-1], by_bucket[1:], strict=True):
                        names = b"\n".join(b" ".join(phrases.words[i : i + width]) for i in at[a:b].tolist())
                        bucket = int(bucket_of(different[a : a + 1], buckets)[0])
                        out.append((bucket, lang, zstandard.compress(names, 1), squeezed(counts[a:b].astype(np.uint32))))
            yield pd.DataFrame(out, columns=["bucket", "lang", "phrases", "counts"])

    def summed_up(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for lang, part in group.groupby("lang", sort=False):
            sums = defaultdict(int)
            for names, counts in zip(part["phrases"], part["counts"], strict=True):
                for name, n in zip(zstandard.decompress(names).split(b"\n"), opened(counts, np.uint32).tolist(), strict=True):
                    sums[name] += n
            found += [(lang, name.decode("utf-8", "replace"), n) for name, n in sums.items() if n >= support]
        return pd.DataFrame(found, columns=["lang", "phrase", "a"])

    packed = docs.mapInPandas(occurrences, "bucket int, lang string, phrases binary, counts binary")
    return packed.groupBy("bucket").applyInPandas(summed_up, "lang string, phrase string, a long")


def _ranked(found: DataFrame, sizes: DataFrame, top: int, absorb: int) -> DataFrame:
    """The best phrases of each language by their lowest cut."""
    listed = found.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w"))
    candidates = listed.where("size > 1")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    part = found.select("lang", "phrase", "a")
    cut = cut.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
    exact = "CAST(a AS DECIMAL(18,0)) * CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(15,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
    cut = cut.join(broadcast_if_small(sizes), "lang").withColumn("score", F.expr(exact))
    lowest = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where("size > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase"), "a")
    covering = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = lowest.join(covering, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer"), F.lit(-1)) * 100 < F.col("a") * absorb)
    own = own.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = top_k_per_group(own, ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], top, "phrase")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Benchmark decontamination: CGK random walks and bit sampling over item-sized windows, then exact edit verification.

A CGK walk reads a window word by word; a random bit, which depends on the step and on the word, says whether it moves on or reads the same word
again.  Walks over two texts fall back into step after an edit, so a small edit distance becomes a small Hamming distance of what was read.
Tables sample a few steps of a walk of their own each; their number is found by a simulation at the most edits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product, repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import numbered, pick, whole

WORD = re.compile(r"\w+")
MIN_WORDS = 5
MAX_EDITS = 0.2
#: Share of the items with the most edits that the tables must bring to the verification, for each kind of edit alone.
RECALL = 0.99
#: Tables to try with three, with two and with one sampled step, the first that reach the recall being taken.
TABLES = ((3, 16), (2, 32), (1, 256))
#: A walk of so many steps per word has most probably not passed the end; sampled steps get fewer towards its end.
REACH = 1.5
TRIALS = 200
RUNG = 1.25
CELLS_AT_ONCE = 1_000_000
WORDS_PER_PASS = 2_000_000
CHARS_AT_ONCE = 1_000_000
HITS_AT_ONCE = 1_000_000
MIX = np.int64(-7046029254386353131)
MIX_AGAIN = np.int64(-4658895280553007687)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def nearest_stretch(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Smallest edit distance between ``item`` and any stretch of ``words``, with that stretch (start, end); the first such one.

    The table is filled item word by item word; insertions along a row are a running minimum.
    """
    n = len(words)
    across = np.arange(n + 1)
    row, begin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    for i, word in enumerate(item):
        swap = row[:-1] + (words != word)
        drop = row[1:] + 1
        best = np.empty(n + 1, dtype=np.int64)
        best[0], best[1:] = i + 1, np.minimum(swap, drop)
        source = np.empty(n + 1, dtype=np.int64)
        source[0], source[1:] = begin[0], np.where(swap <= drop, begin[:-1], begin[1:])
        shifted = best - across
        running = np.minimum.accumulate(shifted)
        origin = np.maximum.accumulate(np.where(shifted == running, across, 0))
        row, begin = running + across, source[origin]
    end = int(np.argmin(row))
    return int(row[end]), int(begin[end]), end


def _sequences(words: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every length up to ``longest`` a hash of the sequence of so many words from each place on."""
    hashed = np.zeros(len(words), dtype=np.int64)
    for length in range(1, min(longest, len(words)) + 1):
        hashed = (hashed[: len(words) - length + 1] ^ words[length - 1 :]) * MIX
        hashed = hashed ^ (hashed >> 29)
        yield length, hashed


class Lookup:
    """Ascending keys, which may repeat, with a table of hash bits that turns away nearly all values that are none of them."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.shift = keys, np.int64(64 - min(max(len(keys).bit_length() + 7, 12), 24))
        self.may = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        self.may[self._slots(keys)] = True

    def _slots(self, values: np.ndarray) -> np.ndarray:
        return ((values * MIX) >> self.shift) & np.int64(len(self.may) - 1)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are keys, and the first place of each among the keys."""
        at = np.flatnonzero(self.may[self._slots(values)])
        place = np.searchsorted(self.keys, values[at])
        same = np.append(self.keys, np.int64(0))[place] == values[at]
        same &= place < len(self.keys)
        return at[same], place[same]


@dataclass(frozen=True)
class Walks:
    """Random walks with the steps that are sampled of each: one row per table."""

    bits: np.ndarray  # (tables, steps): seeds of the random bits
    sampled: np.ndarray  # (tables, samples): numbers of steps

    @classmethod
    def made(cls, size: int, tables: int, samples: int) -> Walks:
        """Walks for windows of ``size`` words or a little more; the first table never reads past so many words."""
        rng = np.random.default_rng([size, samples])
        steps = max(int(REACH * size), 1)
        # Drawn table by table, so that fewer tables are the first of more.
        draws = [(rng.integers(-(2**62), 2**62, steps), rng.random(samples) ** 2) for _ in range(tables)]
        sampled = np.array([place * (min(steps, size) if i == 0 else steps) for i, (_, place) in enumerate(draws)])
        return cls(np.array([bits for bits, _ in draws]), sampled.astype(np.int64))

    def read(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(tables, samples, starts): the words that the walks from each start read in the sampled steps."""
        tables, samples = self.sampled.shape
        at = np.tile(starts, (tables, 1))
        out = np.empty((tables, samples, len(starts)), dtype=np.int64)
        for step in range(int(self.sampled.max()) + 1):
            here = words[at]
            for table, sample in zip(*np.nonzero(self.sampled == step), strict=True):
                out[table, sample] = here[table]
            mixed = (here ^ self.bits[:, step, None]) * MIX
            mixed = (mixed ^ (mixed >> np.int64(32))) * MIX_AGAIN
            at += (mixed >> np.int64(62)) & 1
        return out

    def keys(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(tables, starts): one hash of the table and what its sampled steps have read."""
        read = self.read(words, starts)
        hashed = np.repeat(np.arange(1, len(read) + 1, dtype=np.int64)[:, None] * MIX_AGAIN, len(starts), axis=1)
        for sample in range(read.shape[1]):
            hashed = (hashed ^ read[:, sample]) * MIX
            hashed = hashed ^ (hashed >> np.int64(29))
        return hashed


def _edited(item: np.ndarray, edits: int, kind: str, rng: np.random.Generator) -> list[int]:
    words = item.tolist()
    for _ in range(edits):
        how = rng.choice(("replace", "insert", "delete")) if kind == "mixed" else kind
        place = int(rng.integers(len(words)))
        if how == "replace":
            words[place] = 0
        elif how == "insert":
            words.insert(place, 0)
        elif len(words) > 1:
            words.pop(place)
    return words


@lru_cache(maxsize=None)
def planned_walks(least: int, most: int, max_edits: float, recall: float) -> Walks:
    """Walks for items of ``least`` to ``most`` words: as many tables as bring ``recall`` of items of either size with the most edits.

    Measured on items of different words, each kind of edit at random places and all kinds mixed, with the window that begins
    where the stretch does; that the search tries other starts too only adds to it.  Raises ValueError if the largest number of
    tables is too small.
    """
    if int(max_edits * most) == 0:
        return Walks.made(least, 1, TABLES[0][0])
    blank = [0] * (2 * most + 4)
    for samples, tables in TABLES:
        walks = Walks.made(least, tables, samples)
        needed = 0
        for size, kind in product(sorted({least, most}), ("replace", "insert", "delete", "mixed")):
            item = np.arange(1, size + 1, dtype=np.int64)
            wanted = walks.keys(np.concatenate([item, blank]), np.array([0]))
            rng, words, starts = np.random.default_rng(size), [], []
            for _ in range(TRIALS):
                starts.append(len(words))
                words += _edited(item, int(max_edits * size), kind, rng) + blank
            found = walks.keys(np.array(words, dtype=np.int64), np.array(starts)) == wanted
            share = np.logical_or.accumulate(found, axis=0).mean(axis=1)
            needed = max(needed, int(np.argmax(share >= recall)) + 1 if share[-1] >= recall else tables + 1)
        if needed <= tables:
            return Walks(walks.bits[:needed], walks.sampled[:needed])
    raise ValueError(f"no {TABLES[-1][1]} tables find {recall} of items of {least} to {most} words at the most edits")


@dataclass
class Rung:
    """The items of similar size, which share their walks."""

    walks: Walks
    sizes: list[int]
    keys: Lookup  # over all tables
    numbers: np.ndarray  # the item of each key


@dataclass
class BenchmarkIndex:
    """Vocabulary, known word pairs, walks and pieces of a list of benchmark items, which is bounded by its caller."""

    vocabulary: dict[str, int]
    items: list[np.ndarray]
    edits: np.ndarray
    pairs: Lookup
    own_keys: Lookup  # different word pairs of all items: number of the item times number of pairs, plus number of the pair
    sizes: np.ndarray
    least: np.ndarray  # how many of these any stretch within the edits still holds
    rungs: list[Rung]
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # words of a piece -> sorted hashes, item numbers, places in the items

    @classmethod
    def build(cls, texts: list[str], max_edits: float = MAX_EDITS, recall: float | None = RECALL) -> BenchmarkIndex:
        """Walks that reach ``recall``; or, if it is None, pieces for the exact search: each item is cut into one more piece than
        it may have edits (into single words if it has fewer), so one stays whole."""
        split = [words_of(t) for t in texts]
        vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for words in split for w in words}))}
        items = [np.array([vocabulary[w] for w in words], dtype=np.int64) for words in split]
        width = len(vocabulary) + 1
        own_pairs = [np.unique(x[:-1] * width + x[1:]) for x in items]
        pairs = np.unique(np.concatenate(own_pairs)) if items else np.empty(0, np.int64)
        numbered_pairs = [i * len(pairs) + np.searchsorted(pairs, own) for i, own in enumerate(own_pairs)]
        own_keys = np.concatenate(numbered_pairs) if items else np.empty(0, np.int64)
        edits = np.array([int(max_edits * len(x)) for x in items], dtype=np.int64)
        least = np.array([len(x) for x in own_pairs], dtype=np.int64) - 2 * edits
        sizes = np.array([len(x) for x in items], dtype=np.int64)
        rungs = [] if recall is None else _rungs(items, sizes, max_edits, recall)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, item in enumerate(items if recall is None else []):
            count = min(int(edits[i]) + 1, len(item))
            cuts = [len(item) * n // max(count, 1) for n in range(count + 1)]
            hashed = dict(_sequences(item, max(np.diff(cuts), default=0)))
            for a, b in zip(cuts, cuts[1:], strict=False):
                found.setdefault(b - a, []).append((int(hashed[b - a][a]), i, a))
        pieces = {}
        for length, rows in found.items():
            table = np.array(sorted(rows), dtype=np.int64)
            pieces[length] = tuple(np.ascontiguousarray(table[:, c]) for c in range(3))
        return cls(vocabulary, items, edits, Lookup(pairs), Lookup(own_keys), sizes, least, rungs, pieces)

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, end, distance): for each text and item the nearest stretch found within the item's edits."""
        if not self.items:
            return []
        get = self.vocabulary.get
        gap = 2 * (max(len(x) for x in self.items) + int(self.edits.max()) + 1)
        coded, starts, at = [], [], 0
        blank = np.zeros(gap, dtype=np.int64)
        for text in texts:
            ids = np.fromiter(map(get, words_of(text), repeat(0)), dtype=np.int64)
            starts.append(at)
            coded += [ids, blank]
            at += len(ids) + gap
        words, starts = np.concatenate(coded), np.array(starts)
        pair_at = np.full(len(words), -1, dtype=np.int64)
        seen = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
        same, number = self.pairs.find(words[seen] * (len(self.vocabulary) + 1) + words[seen + 1])
        pair_at[seen[same]] = number
        total = np.concatenate([[0], np.cumsum(pair_at >= 0)])
        known = pair_at[pair_at >= 0]
        candidates = self._by_walks(words, total, known) if self.rungs else self._by_pieces(words, total, known)
        if not candidates:
            return []
        return self._verified(np.unique(np.concatenate(candidates), axis=0), words, starts, gap)

    def _by_walks(self, words: np.ndarray, total: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
        """(item, start) of windows that some table puts together with the item.

        An edit breaks two pairs of neighbouring words at most, so windows that hold fewer known pairs need no walk.
        """
        candidates = []
        edits_of = dict(zip(self.sizes.tolist(), self.edits.tolist(), strict=True))
        longest = max(size + edits_of[size] for rung in self.rungs for size in rung.sizes)
        sums = np.concatenate([total, np.full(longest, total[-1])]).astype(np.int32)
        for rung in self.rungs:
            # What holds too few pairs for any size of the rung goes first, in one step over all places.
            reach = max(size + edits_of[size] for size in rung.sizes)
            fewest = min(size - 1 - 2 * edits_of[size] for size in rung.sizes)
            starts = np.flatnonzero(sums[reach : reach + len(words)] - sums[: len(words)] >= fewest if fewest > 0 else words > 0)
            may = np.zeros(len(starts), dtype=bool)
            for size in rung.sizes:
                edits = edits_of[size]
                may |= sums[starts + size + edits] - sums[starts] >= size - 1 - 2 * edits
            starts = starts[may]
            if not len(starts):
                continue
            padded = np.concatenate([words, np.zeros(rung.walks.bits.shape[1] + 1, dtype=np.int64)])
            width = max(CELLS_AT_ONCE // rung.walks.sampled.size, 1)
            for part in range(0, len(starts), width):
                here = starts[part : part + width]
                hashed = rung.walks.keys(padded, here).ravel()
                hit, low = rung.keys.find(hashed)
                count = np.searchsorted(rung.keys.keys, hashed[hit], "right") - low
                for rows in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(np.cumsum(count) // HITS_AT_ONCE)) + 1):
                    n = count[rows]
                    entry = np.repeat(low[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    found = np.stack([rung.numbers[entry], np.repeat(here[hit[rows] % len(here)], n)], axis=1)
                    found = np.unique(found, axis=0)
                    candidates.append(found[self._holds_own_pairs(found[:, 0], found[:, 1], total, known)])
        return candidates

    def _holds_own_pairs(self, item: np.ndarray, start: np.ndarray, total: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Whether enough different pairs of the item itself lie around each start; any stretch within the edits holds them.

        ``known`` are the known pairs in order, and ``total`` says how many of them lie before each place.
        """
        edits = self.edits[item]
        low = np.clip(start - edits, 0, len(total) - 1)
        high = np.clip(start + self.sizes[item] + 2 * edits - 1, low, len(total) - 1)
        first, count, least = total[low], total[high] - total[low], self.least[item]
        enough = least <= 0
        rows = np.flatnonzero((count >= least) & ~enough)
        for part in np.split(rows, np.flatnonzero(np.diff(np.cumsum(count[rows]) // CELLS_AT_ONCE)) + 1):
            n = count[part]
            row = np.repeat(np.arange(len(part)), n)
            pair = known[np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            at, place = self.own_keys.find(item[part][row] * len(self.pairs.keys) + pair)
            different = np.unique(row[at] * len(self.own_keys.keys) + place) // max(len(self.own_keys.keys), 1)
            enough[part] = np.bincount(different, minlength=len(part)) >= least[part]
        return enough

    def _by_pieces(self, words: np.ndarray, total: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
        """(item, place where it would begin) of all pieces that occur.

        Fewer edits than an item has pieces leave one piece whole, at most ``edits`` words away from its place in the stretch; and an
        edit breaks two pairs of neighbouring words at most.  So places of a piece whose surroundings hold too few known pairs lose
        nothing, and no stretch within the edits is missed.
        """
        candidates = []
        for length, hashed in _sequences(words, max(self.pieces, default=0)):
            if length not in self.pieces:
                continue
            keys, numbers, places = self.pieces[length]
            # All pairs inside a whole piece are known.
            at = np.flatnonzero((total[length - 1 : len(words)] - total[: len(hashed)] == length - 1) & (words[: len(hashed)] > 0))
            low, high = np.searchsorted(keys, hashed[at], "left"), np.searchsorted(keys, hashed[at], "right")
            at, low, count = at[high > low], low[high > low], (high - low)[high > low]
            for rows in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(count) // HITS_AT_ONCE)) + 1):
                n = count[rows]
                piece = np.repeat(low[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
                item, begin = numbers[piece], np.repeat(at[rows], n) - places[piece]
                first = np.maximum(begin - self.edits[item], 0)
                last = np.minimum(begin + self.sizes[item] + self.edits[item], len(words))
                enough = total[last] - total[first] >= self.least[item]
                found = np.unique(np.stack([item[enough], begin[enough]], axis=1), axis=0)
                candidates.append(found[self._holds_own_pairs(found[:, 0], found[:, 1], total, known)])
        return candidates

    def _verified(self, candidates: np.ndarray, words: np.ndarray, starts: np.ndarray, gap: int) -> list[tuple[int, int, int, int, int]]:
        """The matches among (item, place at most its edits away from a beginning), in this order."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[int, int] = {}  # item -> end of the region that was verified last
        for item, begin in candidates.tolist():
            size, edits = len(self.items[item]), int(self.edits[item])
            if begin + size + 2 * edits <= done.get(item, -1):
                continue
            # The piece itself may lie further on than the place where the item would begin.
            text = int(np.searchsorted(starts, begin + size - 1, "right")) - 1
            limit = int(starts[text + 1]) - gap if text + 1 < len(starts) else len(words) - gap
            low = max(int(starts[text]), begin - edits)
            high = min(limit, begin + 2 * size + 2 * edits)
            distance, first, end = nearest_stretch(self.items[item], words[low:high])
            done[item] = high
            if distance <= edits:
                match = (distance, low + first - int(starts[text]), low + end - int(starts[text]))
                best[text, item] = min(match, best.get((text, item), match))
        return [(text, item, first, end, distance) for (text, item), (distance, first, end) in sorted(best.items())]


def _rungs(items: list[np.ndarray], sizes: np.ndarray, max_edits: float, recall: float) -> list[Rung]:
    """Items dealt by size to rungs that grow by ``RUNG``, with the keys of all items in all tables."""
    out, most = [], 0
    for least in sorted(set(sizes[sizes > 0].tolist())):
        if least <= most:
            continue
        most = int(least * RUNG)
        chosen = np.flatnonzero((sizes >= least) & (sizes <= most))
        walks = planned_walks(least, most, max_edits, recall)
        blank = np.zeros(walks.bits.shape[1] + 1, dtype=np.int64)
        ends = np.cumsum(sizes[chosen] + len(blank))
        words = np.concatenate([x for i in chosen for x in (items[i], blank)])
        hashed = walks.keys(words, ends - sizes[chosen] - len(blank))
        order = np.argsort(hashed, axis=None, kind="stable")
        out.append(Rung(walks, sorted(set(sizes[chosen].tolist())), Lookup(hashed.ravel()[order]), np.tile(chosen, len(hashed))[order]))
    return out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    max_edits: float = MAX_EDITS,
    min_words: int = MIN_WORDS,
    words_per_pass: int = WORDS_PER_PASS,
    recall: float | None = RECALL,
) -> DataFrame:
    """One row per document and benchmark item that it holds: ids, words of the stretch (start, end), characters, and edits.

    Texts are compared as lower-case words; an item is held if some stretch differs from it by at most ``max_edits`` of its
    words (rounded down), each inserted, lost or replaced.  Items without edits are always found, those with the most edits at random
    places with probability ``recall`` at least; with ``recall=None`` an exact search finds every one.  Items of fewer than
    ``min_words`` words, null ones included, occur by chance and are left out.  Different item texts are broadcast in parts of about
    ``words_per_pass`` words, one pass over the documents for each part, so a benchmark of any size is handled.  Whole texts are searched, very
    long ones too, and each row on its own; only matches meet the items' ids by a join.  A null or empty text holds
    nothing; rows with a null id are searched too; repeated rows give repeated results (repeated items likewise); of equally near
    stretches the first counts; empty tables give an empty result; other columns are ignored.
    """
    rows = pick(docs, id=id_col, text=text_col).select("id", whole(F.col("text")).alias("text"))
    items = pick(benchmark, item=item_id_col, text=item_text_col).select("item", whole(F.col("text")).alias("text"))
    items = items.withColumn("_key", F.sha2("text", 256))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, _key string, first_word long, end_word long, start_char long, end_char long, edits long"
    out = None
    for shared in _indexes(items.select("text"), max_edits, min_words, words_per_pass, recall):
        found = rows.mapInPandas(_search_with(shared, schema), schema)
        out = found if out is None else out.unionByName(found)
    named = out.join(items.select("item", "_key"), "_key")
    columns = ("first_word", "end_word", "start_char", "end_char", "edits")
    return named.select(F.col("id").alias(id_col), F.col("item").alias(item_id_col), *columns)


def _indexes(texts: DataFrame, max_edits: float, min_words: int, words_per_pass: int, recall: float | None) -> list[Broadcast]:
    """The broadcast parts of a benchmark: the index of each and the digests of its texts, each text once."""
    texts = texts.distinct()
    n_words = texts.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    passes, out = n_words // words_per_pass + 1, []
    for number in range(passes):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == number).withColumn("_key", F.sha2("text", 256)).collect()
        part = [r for r in part if len(words_of(r["text"])) >= max(min_words, 1)]
        index = BenchmarkIndex.build([r["text"] for r in part], max_edits, recall)
        out.append(texts.sparkSession.sparkContext.broadcast((index, [r["_key"] for r in part])))
    return out


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_text_col: str = "text",
    max_edits: float = MAX_EDITS,
    min_words: int = MIN_WORDS,
    words_per_pass: int = WORDS_PER_PASS,
    recall: float | None = RECALL,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; see ``contaminated``.

    Null and empty texts hold none and stay; very long texts are searched whole.  Every row is judged alone, so repeated rows all stay or
    all go.  An empty table stays empty, without items nothing goes; null ids need no care, and other columns may have any names.
    """
    items = pick(benchmark, text=item_text_col).select(whole(F.col("text")).alias("text"))
    rows = numbered(docs)
    kept = rows.frame
    for shared in _indexes(items, max_edits, min_words, words_per_pass, recall):
        kept = kept.where(~_holds_with(shared)(whole(F.col(rows.name(text_col)))))
    return rows.restored(kept)


def _holds_with(shared: Broadcast):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        index, _ = shared.value
        out = np.zeros(len(texts), dtype=bool)
        sizes = (texts.str.len().cumsum() // CHARS_AT_ONCE).to_numpy()
        for number in np.unique(sizes):
            places = np.flatnonzero(sizes == number)
            out[places[[m[0] for m in index.matches(texts.iloc[places].tolist())]]] = True
        return pd.Series(out)

    return holds


def _search_with(shared: Broadcast, schema: str):
    columns = [field.split(" ")[0] for field in schema.split(", ")]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, names = shared.value
        for batch in batches:
            sizes = batch["text"].str.len().cumsum() // CHARS_AT_ONCE
            for _, part in batch.groupby(sizes.to_numpy()):
                texts, ids = part["text"].tolist(), part["id"].tolist()
                rows, places = [], {}
                for text, item, first, end, edits in index.matches(texts):
                    if text not in places:
                        places[text] = [m.span() for m in WORD.finditer(texts[text].lower())]
                    spans = places[text]
                    rows.append((ids[text], names[item], first, end, spans[first][0], spans[end - 1][1], edits))
                yield pd.DataFrame(rows, columns=columns)

    return search


def held_items(found: DataFrame, id_col: str = "doc_id", item_id_col: str = "item_id") -> DataFrame:
    """Per document the number of items it holds."""
    return found.groupBy(id_col).agg(F.countDistinct(item_id_col).alias("n_items"))


def brute_matches(texts: list[str], items: list[str], max_edits: float = MAX_EDITS) -> Counter:
    """Every pair (text, item) within the edits, by comparing each item with each whole text; for tests."""
    out: Counter = Counter()
    for t, text in enumerate(texts):
        words = words_of(text)
        for i, item in enumerate(items):
            wanted = words_of(item)
            codes = {w: n for n, w in enumerate(dict.fromkeys(wanted))}
            coded = np.array([codes.get(w, -1) for w in words], dtype=np.int64)
            distance, _, _ = nearest_stretch(np.array([codes[w] for w in wanted]), coded)
            if distance <= int(max_edits * len(wanted)):
                out[t, i] = distance
    return out

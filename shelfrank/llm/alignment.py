"""Cross-tokenizer alignment: divide and conquer at byte offsets where both tokenizers end a token."""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.bpe import byte_letters
from shelfrank.llm.common import pick, whole, written
from shelfrank.llm.packed import REPLY_SCHEMA, asks, chunks_of, counted, opened, replies, reply_of, runs, squeezed, with_replies

CHARS_AT_ONCE = 2_000_000
#: Links of one group are made so many at a time.
LINKS_AT_ONCE = 2_000_000
#: The key of a pair is the first id times this, plus the second.
WIDTH = 1 << 24
CHARS_PER_BUCKET = 16_000_000
NO_GROUPS = ""
#: Letters up to here, and common dashes and quotes, are in the same class in every version of Unicode.
NEWER = re.compile(r"[^\x00-ɏ‐-‧‰-⁞]")


class ByteTokenizer:
    """The byte-level tokenizer.  Where letter classes cannot differ between versions of Unicode, the same merges run in tiktoken, which is faster."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        byte_of = {letter: i for i, letter in enumerate(byte_letters())}
        vocabulary = config["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *specials.values()]))
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(byte_of[x] for x in token)
        for token, number in specials.items():
            self.bytes[number] = token.encode()
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and not NEWER.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class PieceTokenizer:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            is_byte = self.model.is_byte(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), dtype=np.int64)


@cache
def tokenizers(a_path: str, ranks_path: str | None, pattern: str | None, b_path: str) -> tuple[ByteTokenizer, PieceTokenizer]:
    """Loaded once in each worker."""
    return ByteTokenizer(a_path, ranks_path, pattern), PieceTokenizer(b_path)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of both sides after which the texts are cut, all texts at once.

    ``first`` and ``last`` are rows (place in a, place in b): where each text begins and ends.  An interval looks for a common end near its middle, by
    bisection in the other side's ends, in a window that grows around the middle until one is found or nothing is left.  Found ends split it in two; an interval
    without any is a leaf.  All intervals of a level are looked at together.
    """
    a0, a1 = first[:, 0], last[:, 0]
    done_a, done_b = [last[:, 0] - 1], [last[:, 1] - 1]
    reach = np.zeros(len(a0), np.int64)
    while len(a0):
        middle = (a0 + a1 - 1) // 2
        low, high = np.maximum(a0, middle - reach), np.minimum(a1 - 1, middle + reach + 1)  # a1 - 1 itself is an end already
        wide = np.maximum(high - low, 0)
        owner = np.repeat(np.arange(len(a0)), wide)
        places = np.arange(int(wide.sum())) + np.repeat(low - (np.cumsum(wide) - wide), wide)
        at = np.searchsorted(ends_b, ends_a[places])
        hit = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[places]
        owner, places, at = owner[hit], places[hit], at[hit]
        # The hit nearest to the middle of each interval.
        order = np.lexsort((np.abs(places - middle[owner]), owner))
        nearest = order[runs(owner[order])[:-1]]
        owner, places, at = owner[nearest], places[nearest], at[nearest]
        done_a.append(places)
        done_b.append(at)
        found = np.zeros(len(a0), bool)
        found[owner] = True
        again = ~found & ((low > a0) | (high < a1 - 1))
        halves_0, halves_1 = np.concatenate([a0[owner], places + 1]), np.concatenate([places + 1, a1[owner]])
        more = halves_1 - halves_0 > 1
        a0 = np.concatenate([halves_0[more], a0[again]])
        a1, reach = np.concatenate([halves_1[more], a1[again]]), np.concatenate([np.zeros(int(more.sum()), np.int64), 2 * reach[again] + 2])
    done_a, done_b = np.concatenate(done_a), np.concatenate(done_b)
    return np.sort(done_a), np.sort(done_b)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def links_of(a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, key and number of links of every different pair of a text, ordered by text and key.

    Groups with many links first count their different ids, and pairs are merged whenever ``LINKS_AT_ONCE`` of them have been made.
    """
    start_a, start_b = np.append(0, cuts_a[:-1] + 1), np.append(0, cuts_b[:-1] + 1)
    size_a, size_b = cuts_a + 1 - start_a, cuts_b + 1 - start_b
    links = size_a * size_b
    large = np.flatnonzero(links > 4096)
    found = []

    def merge(doc_key: tuple[np.ndarray, np.ndarray], n: np.ndarray) -> None:
        d, k = doc_key
        order = np.lexsort((k, d))
        d, k, n = d[order], k[order], n[order]
        new = np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1])) if len(d) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        found.append((d[at], k[at], np.add.reduceat(n, at) if len(at) else n))

    small = np.flatnonzero(links <= 4096)
    turns = np.cumsum(links[small]) // LINKS_AT_ONCE
    cuts = runs(turns)
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        g = small[i:j]
        # Every a of a group, once for each b of it; the bs in turn.
        each_a = _spread(start_a[g], size_a[g])
        group_of_a = np.repeat(np.arange(len(g)), size_a[g])
        times = size_b[g][group_of_a]
        left = np.repeat(a[each_a], times)
        right = b[_spread(start_b[g][group_of_a], times)]
        merge((np.repeat(doc[g][group_of_a], times), left * WIDTH + right), np.ones(len(left), np.int64))
    for g in large.tolist():
        ids_a, n_a = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
        ids_b, n_b = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
        step = max(1, LINKS_AT_ONCE // len(ids_b))
        for i in range(0, len(ids_a), step):
            keys = (ids_a[i : i + step, None] * WIDTH + ids_b).ravel()
            merge((np.full(len(keys), doc[g]), keys), (n_a[i : i + step, None] * n_b).ravel())
    if len(found) > 1:
        d, k, n = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        merge((d, k), n)
    return found[0] if found else (np.empty(0, np.int64),) * 3


def _group_texts(a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, texts: tuple[list[str], list[str]]) -> tuple[list[str], np.ndarray]:
    """The written form of all groups as parts, a part for each token in order of the groups, and the number of parts up to each group's end."""
    # A token is written with what follows it: a comma inside its side, a bar after the last a, a semicolon after the last b.
    of_a, of_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    of_a[cuts_a], of_b[cuts_b] = 1, 2
    order_a = np.searchsorted(cuts_a, np.arange(len(a)))
    order_b = np.searchsorted(cuts_b, np.arange(len(b)))
    group = np.concatenate([2 * order_a, 2 * order_b + 1])
    order = np.argsort(group, kind="stable")
    parts_a, parts_b = texts
    index = np.concatenate([a * 3 + of_a, b * 3 + of_b + len(parts_a)])[order]
    both = parts_a + parts_b
    return list(map(both.__getitem__, index.tolist())), cuts_a + cuts_b + 2


class Aligner:
    def __init__(self, a_path: str, ranks_path: str | None, pattern: str | None, b_path: str) -> None:
        self.a, self.b = tokenizers(a_path, ranks_path, pattern, b_path)
        self.length_a, self.length_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.texts = tuple([f"{i}{sep}" for i in range(len(t.bytes)) for sep in (",", "|", ";")] for t in (self.a, self.b))

    def _ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        wanted = (" " + text).encode("utf-8", "replace")
        b = self.b.encode(text)
        if b"".join(map(self.b.bytes.__getitem__, b.tolist())) != wanted:
            return none, none
        a = self.a.encode(" " + text)
        if b"".join(map(self.a.bytes.__getitem__, a.tolist())) != wanted:
            return none, none
        return a, b

    def align(self, texts: list[str | None]) -> tuple[dict[str, list], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Figures of each text, and doc, key and number of links of its pairs."""
        ids = [self._ids(t) for t in texts]
        n_a, n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
        a, b = (np.concatenate([x[side] for x in ids]) if ids else np.empty(0, np.int64) for side in (0, 1))
        out = {"n_a": n_a.tolist(), "n_b": n_b.tolist()}
        there = np.flatnonzero(n_a)
        if not len(there):
            zeros = [0] * len(texts)
            return out | {"n_groups": zeros, "n_links": zeros, "groups_sha256": [NO_GROUPS] * len(texts)}, (np.empty(0, np.int64),) * 3
        # Offsets run on over all texts, so ends of different texts never agree.
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last = np.stack([np.cumsum(n_a), np.cumsum(n_b)], axis=1)
        first = last - np.stack([n_a, n_b], axis=1)
        cuts_a, cuts_b = shared_cuts(ends_a, ends_b, first[there], last[there])
        doc = there[np.searchsorted(last[there, 0], cuts_a, side="right")]
        n_groups = np.bincount(doc, minlength=len(texts))
        pairs = links_of(a, b, cuts_a, cuts_b, doc, len(texts))
        starts = runs(pairs[0])
        n_links = np.zeros(len(texts), np.int64)
        n_links[pairs[0][starts[:-1]]] = np.add.reduceat(pairs[2], starts[:-1])
        parts, ends = _group_texts(a, b, cuts_a, cuts_b, self.texts)
        digests, at = [NO_GROUPS] * len(texts), 0
        for i, end in zip(there.tolist(), ends[runs(doc)[1:] - 1].tolist(), strict=True):
            digests[i] = hashlib.sha256("".join(parts[at:end])[:-1].encode()).hexdigest()
            at = end
        return out | {"n_groups": n_groups.tolist(), "n_links": n_links.tolist(), "groups_sha256": digests}, pairs


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
CHUNKS = "chunk long, ids array<string>, figures array<array<long>>, digests array<string>, pairs binary, links binary, sizes binary, keys binary, docs binary"


def align_documents(
    df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """How the tokens of a byte-level tokenizer (a) and of a piece tokenizer (b) share the bytes of every text, and how common its linked pairs are.

    Byte offsets where both end a token cut a text into groups; each a of a group is linked with each b of it.  The count of an id pair is the number of
    rows that hold it linked.  Per row: n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their a id, ties included), count_sum (over links)
    and groups_sha256, a digest of the groups (``a1,a2|b1;...``).

    Rows are aligned in chunks of about two million characters and written once, with their pairs as numbers of the chunk's own different pairs.
    Each chunk asks for the counts of these once, so a frequent pair travels once per chunk, not once per link.  The highest count of each a id is
    bounded by the vocabulary and broadcast.  Special tokens written in a text are plain text.

    Null and empty texts, and those whose joined token bytes differ from the text with a leading blank, have no tokens: zeros and an empty digest.  Repeated
    rows and null ids are rows of their own and count each; a group of very many tokens is linked in blocks of different ids; a very long text is one
    chunk.  Ties for the highest count all count.  An empty table has no rows; other columns are ignored.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.select(F.col("id").cast("string").alias("id"), whole(F.col("text")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // CHARS_PER_BUCKET + 1)

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(a_path, ranks_path, pattern, b_path)
        for number, chunk in chunks_of(batches, CHARS_AT_ONCE):
            figures, (doc, keys, links) = aligner.align(chunk["text"].to_list())
            different, docs = counted(keys)
            row = {
                "chunk": number,
                "ids": chunk["id"].to_list(),
                "figures": [figures[c] for c in FIGURES],
                "digests": figures["groups_sha256"],
                "pairs": squeezed(np.searchsorted(different, keys).astype(np.int32)),
                "links": squeezed(links),
                "sizes": squeezed(np.bincount(doc, minlength=len(chunk))),
                "keys": squeezed(different),
                "docs": squeezed(docs),
            }
            yield pd.DataFrame({k: [v] for k, v in row.items()})

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, keys, docs in zip(batch["chunk"], batch["keys"], batch["docs"], strict=True):
                out = [(chunk, *piece) for piece in asks(_wide(opened(keys, np.int64)), opened(docs, np.int64), buckets)]
                yield pd.DataFrame(out, columns=["chunk", "bucket", "keys", "counts"])

    def highest(keys: np.ndarray, sums: np.ndarray) -> dict:
        a = (keys[:, 0] // np.uint64(WIDTH)).astype(np.int64)
        starts = runs(a)[:-1]
        return {"best": squeezed(np.stack([a[starts], np.maximum.reduceat(sums, starts)]))}

    chunks = written(rows.mapInPandas(aligned, CHUNKS), "aligned")
    asking = chunks.select("chunk", "keys", "docs").mapInPandas(asked, "chunk long, bucket int, keys binary, counts binary")
    answered = written(replies(asking, highest, f"{REPLY_SCHEMA}, best binary"), "pair-counts")

    def maxima(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for blob in batch["best"]:
                a, n = opened(blob, np.int64).reshape(2, -1)
                yield pd.DataFrame({"a": a, "n": n})

    best = answered.where("chunk IS NULL").select("best").mapInPandas(maxima, "a int, n long").groupBy("a").agg(F.max("n").alias("n")).toPandas()
    table = np.zeros(int(best["a"].max()) + 1 if len(best) else 1, np.int64)
    table[best["a"].to_numpy(np.int64)] = best["n"].to_numpy(np.int64)
    table = spark.sparkContext.broadcast(table)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                keys = opened(row["keys"], np.int64)
                counts = reply_of(row["replies"], _wide(keys), buckets)
                top = counts == table.value[keys // WIDTH]
                pairs, links = opened(row["pairs"], np.int32), opened(row["links"], np.int64)
                sizes = opened(row["sizes"], np.int64)
                ends = np.append(0, np.cumsum(sizes))
                sums, bests = (np.append(0, np.cumsum(v))[ends] for v in (counts[pairs] * links, top[pairs] * links))
                made = {c: np.asarray(v, np.int64) for c, v in zip(FIGURES, row["figures"], strict=True)}
                made |= {"n_best": np.diff(bests), "count_sum": np.diff(sums), "groups_sha256": list(row["digests"])}
                yield pd.DataFrame({"id": list(row["ids"])} | made)

    schema = "id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out = with_replies(chunks.drop("docs"), answered).mapInPandas(judged, schema)
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def _wide(keys: np.ndarray) -> np.ndarray:
    """Keys of one 64-bit value as rows of two."""
    return np.stack([keys.view(np.uint64), np.zeros(len(keys), np.uint64)], axis=1)

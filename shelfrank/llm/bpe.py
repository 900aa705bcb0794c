"""BPE encoding and decoding: batched numpy merge rounds over the words of many texts at once."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from shelfrank.llm.common import pick

# Fixed values of the tokenizer's definition: its white space and its contractions.
SPACE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def category_ranges(kind: str) -> str:
    """By Python's Unicode tables (characters they do not know yet count as neither letter nor number), all of a general category (``L`` or ``N``) as the ranges of a character class."""
    inside = np.array([unicodedata.category(chr(i))[0] == kind for i in range(sys.maxunicode + 1)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in zip(edges[::2], edges[1::2], strict=True))


LETTERS, NUMBERS = category_ranges("L"), category_ranges("N")
WORD = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^{SPACE}{LETTERS}{NUMBERS}]+")
SPACES = re.compile(f"[{SPACE}]+")
#: str.split() also cuts at these, which the tokenizer keeps.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
END = "</w>"
CACHED_CHUNKS = 250_000
TEXTS_AT_ONCE = 512


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: the printable ones for themselves, the others from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


class _Numbers(dict):
    """chunk -> its number; a chunk not seen before gets the next one."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


def gather(values: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i] : starts[i + 1]]`` of all chosen i, one after the other."""
    first = starts[chosen]
    sizes = starts[chosen + 1] - first
    return values[np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)]


class WordBpe:
    """A lower-casing BPE with word ends, read from the JSON text of its definition."""

    def __init__(self, definition: str) -> None:
        config = json.loads(definition)
        vocabulary, merges = config["model"]["vocab"], config["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, number in [*vocabulary.items(), *self.special.items()]:
            self.tokens[number] = token
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        self.first = np.array([vocabulary[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocabulary[x + END] for x in letters], dtype=np.int64)
        self.width = len(self.tokens)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = made  # by rank
        # A round may merge every occurrence of a pair only if what it makes takes no part in an earlier merge.
        earliest = np.full(self.width, len(pairs), dtype=np.int64)
        ranks = np.arange(len(pairs))
        np.minimum.at(earliest, left, ranks)
        np.minimum.at(earliest, right, ranks)
        self.all_at_once = earliest[made] > ranks

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and how many each word has.

        Every round finds the lowest-ranked pair of each unfinished word by binary search over the sorted pair keys.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.first[flat]
        ends = np.cumsum(sizes)
        filled = sizes > 0
        symbols[ends[filled] - 1] = self.last[flat[ends[filled] - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_owner = [], []
        never = len(self.made)
        rank = self._rank(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            wanted = np.repeat(lowest, np.diff(np.append(starts, len(symbols))))
            finished = wanted == never
            if finished.any():
                done_symbols.append(symbols[finished])
                done_owner.append(owner[finished])
                active = ~finished
                symbols, owner, rank, wanted = symbols[active], owner[active], rank[active], wanted[active]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == wanted)
            hits = hits[self._apart(hits, owner, rank)]
            symbols[hits] = self.made[rank[hits]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            # Only the pairs on both sides of a merge are new.
            merged = hits - np.arange(len(hits))
            changed = np.concatenate([merged, merged[merged > 0] - 1])
            rank[changed] = self._rank(symbols, owner, changed)
        if not done_symbols:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(words))

    def _rank(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``; the number of merges where there is none."""
        following = np.minimum(at + 1, len(symbols) - 1)
        inside = (owner[at] == owner[following]) & (following > at)
        pairs = symbols[at] * self.width + symbols[following]
        found = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(inside & (self.keys[found] == pairs), self.ranks[found], len(self.made))

    def _apart(self, hits: np.ndarray, owner: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Which hits to merge now: of touching ones every other from the left; only a word's first where order matters."""
        new_run = np.append(True, np.diff(hits) != 1)
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hits)), 0))
        chosen = (np.arange(len(hits)) - run_start) % 2 == 0
        first = np.append(True, owner[hits][1:] != owner[hits][:-1])
        return chosen & (first | self.all_at_once[rank[hits]])

    def chunks(self, text: str) -> list[str]:
        """The text, normalised and cut at white space; a special token is a chunk of its own, marked by a leading blank."""
        if "<|" in text and self._special.search(text):
            out = []
            for i, part in enumerate(self._special.split(text)):
                out += [" " + part] if i % 2 else self._plain(part)
            return out
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            # Lower case letter by letter: a capital sigma becomes the same small one everywhere.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in NOT_SPACE):
            return [c for c in SPACES.split(text) if c]
        return text.split()

    def encode_chunks(self, chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in one array, and how many each has."""
        numbers, used, of_chunk, special = _Numbers(), [], [], []
        for i, chunk in enumerate(chunks):
            if chunk.isalpha():
                used.append(numbers[chunk])
                of_chunk.append(i)
            elif chunk[0] == " ":
                special.append(i)
            else:
                for word in WORD.findall(chunk):
                    used.append(numbers[word])
                    of_chunk.append(i)
        symbols, sizes = self.merge([w.encode("utf-8") for w in numbers])
        used = np.array(used, dtype=np.int64)
        symbols = gather(symbols, np.append(0, np.cumsum(sizes)), used)
        owner = np.repeat(np.array(of_chunk, dtype=np.int64), sizes[used])
        if special:
            symbols = np.concatenate([symbols, np.array([self.special[chunks[i][1:]] for i in special], dtype=np.int64)])
            owner = np.concatenate([owner, np.array(special, dtype=np.int64)])
            order = np.argsort(owner, kind="stable")
            symbols, owner = symbols[order], owner[order]
        return symbols, np.bincount(owner, minlength=len(chunks))

    def decode(self, ids: np.ndarray) -> str:
        """The tokens with a blank between them: the definition names no decoder, so word ends stay visible."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


class BatchEncoder:
    """Encodes many texts; chunks seen before are looked up, up to ``cached`` of them."""

    def __init__(self, tokenizer: WordBpe, cached: int = CACHED_CHUNKS) -> None:
        self.tokenizer, self.cached = tokenizer, cached
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        if len(self.numbers) > self.cached:
            self._forget()
        known = len(self.numbers)
        per_text = [np.array([self.numbers[c] for c in self.tokenizer.chunks(t or "")], dtype=np.int64) for t in texts]
        if len(self.numbers) > known:
            fresh = list(self.numbers)[known:]
            symbols, sizes = self.tokenizer.encode_chunks(fresh)
            self.ids = np.concatenate([self.ids, symbols.astype(np.int32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return [gather(self.ids, self.starts, numbers) for numbers in per_text]


def _definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _batches(texts: Sequence[str | None], at_once: int = TEXTS_AT_ONCE) -> Iterator[Sequence[str | None]]:
    for start in range(0, len(texts), at_once):
        yield texts[start : start + at_once]


def encode_documents(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, decoded: bool = True
) -> DataFrame:
    """One row per row of ``df``: the id, n_tokens, optionally the token ids and the text decoded from them, and digests.

    The definition is read on the driver and broadcast (its size does not depend on the data).  ``ids_sha256`` covers the
    decimal ids joined by one blank, ``decoded_sha256`` the decoded text in UTF-8.  Each row is independent, so there is no
    shuffle.  A null or empty text has no tokens; special tokens written out in a text become their ids; repeated rows and
    null ids are kept; an empty table gives an empty result; other columns are ignored.
    """
    rows = pick(df, id=id_col, text=text_col).selectExpr("id", "cast(text as string) AS text")
    kind = rows.schema["id"].dataType.simpleString()
    definition = df.sparkSession.sparkContext.broadcast(_definition(tokenizer_path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = WordBpe(definition.value)
        encoder = BatchEncoder(tokenizer)
        decimal = [str(i) for i in range(tokenizer.width)]
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[start : start + TEXTS_AT_ONCE]
                encoded = encoder.encode(part["text"].tolist())
                texts = [tokenizer.decode(x) for x in encoded]
                made = {
                    "id": part["id"].to_numpy(),
                    "n_tokens": [len(x) for x in encoded],
                    "ids_sha256": [hashlib.sha256(" ".join([decimal[i] for i in x.tolist()]).encode()).hexdigest() for x in encoded],
                    "decoded_sha256": [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts],
                }
                if ids:
                    made["ids"] = encoded
                if decoded:
                    made["decoded"] = texts
                yield pd.DataFrame(made)

    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * ids + ", decoded string" * decoded
    return rows.mapInPandas(run, schema).withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of every row's token ids; null ids give an empty text."""
    rows = pick(df, id=id_col, ids=ids_col)
    kind = rows.schema["id"].dataType.simpleString()
    definition = df.sparkSession.sparkContext.broadcast(_definition(tokenizer_path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = WordBpe(definition.value)
        for batch in batches:
            texts = [tokenizer.decode(np.asarray(x, dtype=np.int64)) if x is not None else "" for x in batch["ids"]]
            yield pd.DataFrame({"id": batch["id"], "decoded": texts})

    return rows.mapInPandas(run, f"id {kind}, decoded string").withColumnRenamed("id", id_col)

"""Collocations, tokenizer alignment and language-model scoring against plain versions, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfrank.llm.alignment import NEWER, Aligner, align_documents, links_of, shared_cuts
from shelfrank.llm.bpe import byte_letters
from shelfrank.llm.collocations import collocations
from shelfrank.llm.language_model import LEAST, LogFrequencyFilter, level_of, levels_in_slice, score_documents, value_of
from shelfrank.llm.packed import Bits, bucket_of

from .frames import ROWS, documents, sorted_rows, with_clashes

A, B, RANKS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_lang(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def aligned(df):
    return align_documents(df, A, B, ranks_path=RANKS, pattern=public_tokenizers.PATTERN)


# Collocations


def plain_collocations(rows, support, longest, top, absorb):
    n, count = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    count[lang, tuple(words[i : i + size])] += 1
    candidates = {k: f for k, f in count.items() if len(k[1]) > 1 and f >= support}
    longer = defaultdict(int)
    for (lang, words), f in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                longer[part] = max(longer[part], f)
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if longer[lang, words] * 100 >= absorb * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = count[lang, words[:k]], count[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items()
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top])
    }


@pytest.mark.parametrize("seed, absorb, shards", [(1, 100, 8), (2, 80, 3), (3, 100, 1)])
def test_collocations_equal_a_plain_count(spark, seed, absorb, shards):
    r = random.Random(seed)
    pool = [*"abcdefgh", "the", "The", "É", "\x1c", "x\x00y", "a b c", "New York City", "d e. f"]
    rows = [(i, "".join(r.choice(pool) + r.choice(["  ", " ", " ", "\t", ". ", "\n"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None])) for i in range(300)]
    rows += [(1000 + i, "one very common passage that many texts share here", "en") for i in range(90)] + [(None, None, "en"), (5, "", None)]
    got = {tuple(x) for x in collocations(with_lang(spark, rows), support=12, top=40, absorb=absorb, shards=shards).collect()}
    assert got == plain_collocations(rows, 12, 5, 40, absorb)
    assert got


def test_collocations_score_beyond_64_bits(spark):
    from shelfrank.llm.collocations import _ranked

    found = spark.createDataFrame([("en", "a b", 10**12), ("en", "a", 10**12), ("en", "b", 3 * 10**12)], "lang string, phrase string, a long")
    sizes = spark.createDataFrame([("en", 9 * 10**14)], "lang string, n long")
    row = _ranked(found, sizes, 10, 100).first()
    assert row["score"] == 1000 * 10**12 * 9 * 10**14 // (10**12 * 3 * 10**12)


def test_collocations_of_empty_and_wordless_tables(spark):
    assert collocations(with_lang(spark, [])).collect() == []
    assert collocations(with_lang(spark, [(1, None, None), (2, " . ", "en")]), support=1).collect() == []
    alone = collocations(with_lang(spark, [(1, "a b. a b", "en"), (1, "a b. a b", "en")]), support=4).collect()
    assert [(r["phrase"], r["a"]) for r in alone] == [("a b", 4)]


# Alignment


def plain_alignment(texts):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {letter: i for i, letter in enumerate(byte_letters())}
    docs, held = [], Counter()
    for text in texts:
        groups = []
        if text:
            a = [(i, bytes(byte_of[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode()) for i in s.encode(text)]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                i = j = at_a = at_b = 0
                own_a, own_b = [], []
                while i < len(a) or j < len(b):
                    if at_a <= at_b and i < len(a):
                        own_a.append(a[i][0])
                        at_a, i = at_a + len(a[i][1]), i + 1
                    else:
                        own_b.append(b[j][0])
                        at_b, j = at_b + len(b[j][1]), j + 1
                    if at_a == at_b:
                        groups.append((own_a, own_b))
                        own_a, own_b = [], []
        docs.append(groups)
        held.update({(x, y) for p, q in groups for x in p for y in q})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for groups in docs:
        links = [(x, y) for p, q in groups for x in p for y in q]
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        sizes = sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links)
        out.append((*sizes, sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), digest))
    return out


def test_alignment_equals_a_two_pointer_walk(spark):
    r = random.Random(4)
    pool = ["the ", "Größe ", "日本語", "  ", "\n", "😀", "naïve", "aaaaaaaa", "0123456789", "<|endoftext|>", "</s>", "x" * 40, "Ɓ", "▁", "ﬁ", "é", "\x00", "\t"]
    texts = ["".join(r.choices(pool, k=r.randint(1, 30))) for _ in range(200)]
    texts += [None, "", " ", "a", "a" * 30_000, "ab" * 5_000, "".join(r.choices("bcdfgh", k=20_000)), *[x[1] for x in ROWS]]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {x[0]: tuple(x[1:]) for x in aligned(documents(spark, rows)).collect()}
    for i, want in enumerate(plain_alignment(texts)):
        assert got[i] == want, texts[i]


def test_shared_cuts_are_all_common_ends():
    r = random.Random(5)
    for _ in range(300):
        a, b, first, last, want, offset = [], [], [], [], [], 0
        for _ in range(r.randint(1, 6)):
            size = r.randint(1, 80)
            share = r.choice([0.02, 0.3, 0.9])
            own = [sorted({x for x in range(1, size) if r.random() < share} | {size}) for _ in range(2)]
            first.append((len(a), len(b)))
            want += [offset + x for x in own[0] if x in own[1]]
            a, b = a + [offset + x for x in own[0]], b + [offset + x for x in own[1]]
            last.append((len(a), len(b)))
            offset += size
        a, b = np.array(a), np.array(b)
        cuts_a, cuts_b = shared_cuts(a, b, np.array(first), np.array(last))
        assert a[cuts_a].tolist() == b[cuts_b].tolist() == want


def test_links_of_large_groups_equal_those_of_small_ones(monkeypatch):
    r = np.random.default_rng(6)
    a, b = r.integers(0, 40, 300), r.integers(0, 40, 280)
    want = Counter((x, y) for x in a.tolist() for y in b.tolist())
    monkeypatch.setattr("shelfrank.llm.alignment.LINKS_AT_ONCE", 500)
    doc, keys, links = links_of(a, b, np.array([299]), np.array([279]), np.array([0]), 1)
    assert {(k >> 24, k & 0xFFFFFF): n for k, n in zip(keys.tolist(), links.tolist(), strict=True)} == want
    assert doc.tolist() == [0] * len(keys)


def test_the_fast_encoder_is_only_used_where_it_is_the_same():
    tokenizer = Aligner(A, RANKS, public_tokenizers.PATTERN, B).a
    r = random.Random(7)
    pool = [chr(i) for i in range(0x250)] + list("   \n\t''stdmll0123<|endoftext|>") * 6
    for _ in range(3000):
        text = " " + "".join(r.choices(pool, k=r.randint(1, 40)))
        assert not NEWER.search(text)
        assert tokenizer.encode(text).tolist() == tokenizer.slow.encode(text, add_special_tokens=False).ids
    assert NEWER.search("日") and NEWER.search("͸")


# Language model


def test_counts_of_the_language_model_are_exact(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["É", "The", "\x1c", "a.b"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 50)))) for i in range(400)] + [(None, "w1 w2"), (None, None), (7, None), *ROWS]
    token_lists = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for x, h in zip(token_lists, held, strict=True) if not h for w in x)
    total, different = sum(count.values()), len(count)
    want = sorted(
        (str(i), h, len(x), sum(count[w] > 0 for w in x), total, round(sum(math.log10((count[w] + 1) / (total + different + 1)) for w in x), 6))
        for (i, _), x, h in zip(rows, token_lists, held, strict=True)
    )
    got = score_documents(documents(spark, rows)).collect()
    assert sorted((str(g[0]), *g[1:5], round(g[5], 6)) for g in got) == want
    assert all(g["score"] < 0 for g in got)


def test_the_model_predicts_held_out_texts_better_than_single_words(spark):
    r = random.Random(9)
    following = {i: r.sample(range(200), 4) for i in range(200)}
    rows = []
    for i in range(1500):
        word, words = r.randrange(200), []
        for _ in range(40):
            words.append(f"n{word}")
            word = r.choice(following[word])
        rows.append((i, " ".join(words)))
    got = score_documents(documents(spark, rows)).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert got[0] > 0.5 * got[1]  # log10 of 4 against log10 of 200


def test_the_filter_never_forgets_and_rarely_invents():
    r = np.random.default_rng(10)
    keys = np.unique(r.integers(0, 2**64, 40_000, dtype=np.uint64))
    stored_keys, others = keys[::2], keys[1::2]
    counts = r.zipf(1.6, len(stored_keys)).clip(LEAST, 10**9)
    levels = level_of(counts)
    buckets, bits = 5, int(levels.sum() * 4 / math.log(2) / 5) // 8 * 8 + 8
    shape = LogFrequencyFilter(buckets, bits)
    of = bucket_of(stored_keys, buckets)
    data = b"".join(shape.slice_with(stored_keys[of == i], levels[of == i]) for i in range(buckets))
    full = LogFrequencyFilter(buckets, bits, np.frombuffer(data, np.uint8))
    assert (full.levels(stored_keys) >= levels).all()
    assert (full.levels(stored_keys) == levels).mean() > 0.9
    assert (full.levels(others) > 0).mean() < 0.12
    assert np.abs(np.log(value_of(levels) / counts)).max() <= math.log(1.5)


def plain_scores(rows):
    """The interpolated trigram model with exact levels, by counting in dictionaries."""
    texts = {i: [" start", *(text or "").translate(LOWER).encode().decode("ascii", "ignore").split(), " end"] for i, text in rows}
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = [Counter(tuple(t[j : j + n]) for i in train for j, t in ((j, texts[i]) for j in range(1 if n == 1 else 0, len(texts[i]) - n + 1))) for n in (1, 2, 3)]
    single = Counter({k[0]: v for k, v in counts[0].items()})
    level = lambda count: int(level_of(np.array([count]))[0]) if count >= LEAST else 0
    value = lambda found: float(value_of(np.array([found]))[0])
    held = {k: level(v) for k, v in counts[1].items()}
    held3 = {k: level(v) if held[k[:2]] and held[k[1:]] else 0 for k, v in counts[2].items()}
    often = lambda word: single[" end" if word == " start" else word]
    seen2, seen3 = Counter(), Counter()
    for k, v in counts[1].items():
        seen2[level(often(k[0])), "all"] += v
        seen2[level(often(k[0])), "kept"] += v * (held[k] > 0)
    for k, v in counts[2].items():
        seen3[held[k[:2]], "all"] += v
        seen3[held[k[:2]], "kept"] += v * (held3[k] > 0)
    mass = lambda seen, at: 1 - seen[at, "kept"] / seen[at, "all"] if seen[at, "all"] else 1.0
    out = {}
    for i, text in texts.items():
        score = 0.0
        for j in range(1, len(text)):
            before, base = often(text[j - 1]), (single[text[j]] + 1) / (sum(single.values()) + len(single) + 1)
            pair = value(held.get(tuple(text[j - 1 : j + 1]), 0))
            share = min(pair, before) / before if before else 0.0
            likely = min(1.0, share + mass(seen2, level(before)) * base)
            last = held.get(tuple(text[j - 2 : j]), 0) if j > 1 else 0
            if last:
                share = min(value(held3.get(tuple(text[j - 2 : j + 1]), 0)), value(last)) / value(last)
                likely = min(1.0, share + mass(seen3, last) * likely)
            score += math.log10(likely)
        out[i] = score
    return out


def test_ngrams_too_many_for_a_filter_have_exact_levels(spark):
    r = random.Random(12)
    rows = [(i, " ".join(f"w{int(r.paretovariate(0.7)) % 40}" for _ in range(r.randrange(0, 60)))) for i in range(300)]
    got = {g["doc_id"]: g["score"] for g in score_documents(documents(spark, rows), filter_bytes=0).collect()}
    want = plain_scores(rows)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-9


def test_a_filter_too_large_to_broadcast_is_probed_in_slices(monkeypatch):
    r = np.random.default_rng(13)
    keys = np.unique(r.integers(0, 2**64, 20_000, dtype=np.uint64))
    stored_keys, others = keys[::2], keys[1::2]
    levels = level_of(r.zipf(1.6, len(stored_keys)).clip(LEAST, 10**9)).astype(np.uint8)
    of = levels_in_slice(stored_keys, levels)
    assert np.array_equal(of(stored_keys), levels) and not of(others).any() and len(of(others[:0])) == 0
    assert not levels_in_slice(stored_keys[:0], levels[:0])(others).any()
    # What the probes of the filter do not find is not found.
    monkeypatch.setattr(LogFrequencyFilter, "levels", lambda self, keys: np.minimum(1, keys % 2).astype(np.int64))
    assert np.array_equal(of(stored_keys), stored_keys % 2)


def test_a_full_filter_ends_at_its_highest_level():
    full = LogFrequencyFilter(1, 64, np.full(8, 255, np.uint8), 7)
    assert full.levels(np.arange(5, dtype=np.uint64)).tolist() == [7] * 5


def test_bits_hold_every_key():
    r = np.random.default_rng(11)
    keys = np.unique(r.integers(0, 2**64, 500, dtype=np.uint64))
    bits = Bits(16)
    for part in np.array_split(keys, 7):
        first, data = Bits.slice(part, 16)
        bits.data[first : first + len(data)] |= np.frombuffer(data, np.uint8)
    assert bits.has(keys).all() and bits.has(r.integers(0, 2**64, 10_000, dtype=np.uint64)).mean() < 0.02


# Awkward rows

PER_ROW = {"alignment": aligned, "language model": score_documents}


@pytest.mark.parametrize("name", PER_ROW)
def test_awkward_rows_and_clashing_columns(spark, name):
    plain = sorted_rows(PER_ROW[name](documents(spark)))
    assert len(plain) == len(ROWS)
    assert plain == sorted_rows(PER_ROW[name](with_clashes(documents(spark))))


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(spark, name):
    assert PER_ROW[name](documents(spark, [])).collect() == []


def test_collocations_with_clashing_columns(spark):
    rows = [(i, "some words stand together", "en") for i in range(5)]
    plain = sorted_rows(collocations(with_lang(spark, rows), support=3))
    assert plain and plain == sorted_rows(collocations(with_clashes(with_lang(spark, rows)), support=3))

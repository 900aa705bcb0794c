"""Each operator against a plain version of the same thing."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfrank.llm import curve_search
from shelfrank.llm.bpe import BatchEncoder, WordBpe, decode_documents, encode_documents
from shelfrank.llm.components import connected_components
from shelfrank.llm.decontamination import BenchmarkIndex, Lookup, Walks, brute_matches, nearest_stretch, planned_walks
from shelfrank.llm.hilbert import hilbert_positions
from shelfrank.llm.jaccard_join import jaccard_join
from shelfrank.llm.secret_scan import CLASSES, SCALE, WINDOW, smallest_weight
from shelfrank.llm.sharding import balanced_shards, least_loaded
from shelfrank.llm.shingle_sets import PartEnum, Shingles
from shelfrank.llm.span_dedup import MIN_SENTENCES, MIN_WORDS, runs_of, sentences_of
from shelfrank.llm.url_filter import Rule, UrlTrie

from .frames import documents, word_soup

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as _file:
    OURS = WordBpe(_file.read())


# 1


def test_quality_votes_on_held_out_rows(spark):
    from shelfrank.llm.queries import quality

    folder = "/root/testdata/sf0.1"
    scored = quality(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    both = scored.merge(labels, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.99


def test_votes_equal_a_plain_loop():
    from shelfrank.llm.quality_votes import NeighbourVotes

    r = np.random.default_rng(0)
    terms, labels, asked = r.random((50, 20)).astype(np.float32), r.integers(0, 2, 50), r.random((9, 20)).astype(np.float32)
    model = NeighbourVotes.fit(terms, labels, (30.0, 70.0), dimensions=5, neighbours=7, sharpness=3)
    for row, score in zip(asked, model.score(asked), strict=True):
        latent = row.astype(float) @ model.projection
        cosines = [float(latent @ ref) / np.linalg.norm(latent) for ref in model.references]
        best = sorted(range(50), key=lambda i: -cosines[i])[:7]
        votes = [(max(cosines[i], 0) ** 3 * model.weights[i], labels[i]) for i in best]
        assert score == pytest.approx(sum(v for v, y in votes if y) / sum(v for v, _ in votes), rel=1e-6)


# 2


def test_window_entropy_equals_a_recount(spark):
    r = random.Random(2)
    for alphabet, _ in CLASSES.values():
        texts = ["".join(r.choice(alphabet) for _ in range(r.randint(15, 70))) for _ in range(60)] + ["!" * 30, "a" * 30]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        for text, least in df.select("t", smallest_weight(df.t, alphabet)).collect():
            windows = [text[i : i + WINDOW] for i in range(len(text) - WINDOW + 1)]
            weights = [sum(round(c * math.log2(c) * SCALE) for c in Counter(w).values()) for w in windows if set(w) <= set(alphabet)]
            assert least == min(weights, default=None)


# 3


@given(st.lists(st.integers(0, 40), max_size=25))
def test_runs_are_the_shortest_ones(words):
    n = len(words)
    long = {(a, b) for a in range(n) for b in range(a + MIN_SENTENCES, n + 1) if sum(words[a:b]) >= MIN_WORDS}
    starts = {a: min(b for x, b in long if x == a) for a, _ in long}
    ends = {b: max(a for a, y in long if y == b) for _, b in long}
    single = {(i, i + 1) for i, w in enumerate(words) if w >= 2 * MIN_WORDS}
    assert set(runs_of(words)) == single | set(starts.items()) | {(a, b) for b, a in ends.items()}


@given(st.text(alphabet="ab .!?\n", max_size=60))
def test_sentences_make_up_the_text(text):
    spans = sentences_of(text)
    assert "".join(text[a:b] for a, b in spans) == text


def test_repeated_passages_stay_once(spark):
    from shelfrank.llm.span_dedup import remove_repeated_spans

    soup = [" ".join(f"s{i}" for i in range(n * 12, n * 12 + 12)) + ". " for n in range(300)]
    passage = "".join(soup[:5])
    rows = [(i, "".join(soup[5 + i * 6 : 8 + i * 6]) + passage + "".join(soup[8 + i * 6 : 11 + i * 6])) for i in range(40)]
    rows.append((40, passage + "Between. " + passage))
    rows += [(50, rows[3][1]), (51, "".join(soup[280:]))]
    left = {r.doc_id: r for r in remove_repeated_spans(documents(spark, rows)).collect()}
    assert left[0].text == rows[0][1] and left[51].text == rows[-1][1]
    for i in range(1, 40):
        assert left[i].text == rows[i][1].replace(passage, "")
        assert [rows[i][1][a:b] for a, b in left[i].removed] == [passage]
    assert left[40].text == "Between. " and left[50].text == ""


# 4


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 4), (2, 3), (3, 2), (5, 1), (4, 2)])
def test_hilbert_neighbours_touch(dimensions, bits):
    axes = np.meshgrid(*[np.arange(2**bits)] * dimensions, indexing="ij")
    cells = np.stack(axes, -1).reshape(-1, dimensions)
    position = hilbert_positions(cells, bits)
    assert sorted(position) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(position)], axis=0)).sum(axis=1) == 1).all()


def test_recall_and_exact_scores(spark):
    from pyspark.sql import functions as F

    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = curve_search.nearest_by_curves(vectors, F.col("id") % 100 == 0).toPandas()
    table = vectors.toPandas().sort_values("vec_id")
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    hit = 0
    for i in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        mine = found[found.query_id == ids[i]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert np.allclose(mine.score, distance[np.searchsorted(ids, mine.vec_id)], rtol=1e-13)
        assert mine.score.is_monotonic_increasing
        distance[i] = np.inf
        hit += len(set(ids[np.lexsort((ids, distance))[:10]]) & set(mine.vec_id))
    assert hit / (10 * (ids % 100 == 0).sum()) >= 0.9


def test_windows_over_several_blocks_are_exact_when_they_hold_all(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(curve_search, "BLOCK", 50)
    monkeypatch.setattr(curve_search, "QUERIES_AT_ONCE", 40)
    r = np.random.default_rng(1)
    x = np.repeat(r.normal(size=(60, 6)), 3, axis=0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = curve_search.nearest_by_curves(df, F.col("id") % 9 == 0, k=4, curves=3, share=1.0)
    got = defaultdict(list)
    for row in sorted(found.collect(), key=lambda row: (row.query_id, row["rank"])):
        got[row.query_id].append(row.vec_id)
    for i in range(0, len(x), 9):
        distance = np.sqrt(np.square(x - x[i]).sum(axis=1))
        distance[i] = np.inf
        assert got[i] == list(np.lexsort((np.arange(len(x)), distance))[:4])


# 5


def test_nearest_stretch_equals_all_stretches():
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    r = random.Random(3)
    for _ in range(150):
        item, words = [r.randrange(4) for _ in range(r.randint(1, 7))], [r.randrange(4) for _ in range(r.randint(0, 12))]
        best = min(edits(item, words[a:b]) for a in range(len(words) + 1) for b in range(a, len(words) + 1))
        distance, a, b = nearest_stretch(np.array(item), np.array(words, dtype=np.int64))
        assert distance == best == edits(item, words[a:b])


def test_lsh_recall_of_edited_items():
    r = random.Random(4)
    items = word_soup(5, 40, vocabulary=900, words=(12, 50))
    texts = word_soup(6, 400, vocabulary=900, words=(80, 200))
    for i, text in enumerate(texts[:300]):
        words, host = items[i % 40].split(), text.split()
        for _ in range(r.randint(0, int(0.2 * len(words)))):
            at = r.randrange(len(words))
            words[at : at + r.randint(0, 1)] = ["other"] * r.randint(0, 1)
        at = r.randrange(len(host))
        texts[i] = " ".join(host[:at] + words + host[at:])
    expected = brute_matches(texts, items)
    found = {(m[0], m[1]): m[4] for m in BenchmarkIndex.build(items).matches(texts)}
    assert set(found) <= set(expected)
    assert len(set(expected) & set(found)) >= 0.97 * len(expected)
    exact = {k for k, v in expected.items() if v == 0}
    assert exact <= set(found)


@pytest.mark.parametrize("kind", ["replace", "insert", "delete", "mixed"])
@pytest.mark.parametrize("size", [8, 12, 20, 40, 59, 100, 150])
def test_items_with_all_allowed_edits_are_found(kind, size):
    r = random.Random(f"{kind} {size}")
    items = [" ".join(f"i{r.randrange(60)}" for _ in range(size)) for _ in range(10)]
    texts = []
    for item in items * 2:
        words = item.split()
        for at in sorted(r.sample(range(size), int(0.2 * size)), reverse=True):
            edit = r.choice(["replace", "insert", "delete"]) if kind == "mixed" else kind
            words[at : at + (edit != "insert")] = [] if edit == "delete" else [f"i{r.randrange(80)}"]
        before, after = ([f"i{r.randrange(80)}" for _ in range(r.choice([0, 3, 90]))] for _ in range(2))
        texts.append(" ".join(before + words + after))
    exact = {(m[0], m[1]): m[4] for m in BenchmarkIndex.build(items, recall=None).matches(texts)}
    expected = brute_matches(texts, items)
    assert len(expected) >= 20
    assert exact == expected
    found = {(m[0], m[1]) for m in BenchmarkIndex.build(items).matches(texts)}
    assert found <= set(expected)
    assert len(found) >= 0.9 * len(expected)


def test_number_of_tables_follows_the_stated_recall():
    few, many = planned_walks(40, 50, 0.2, 0.5), planned_walks(40, 50, 0.2, 0.99)
    assert len(few.bits) < len(many.bits) or few.sampled.shape[1] > many.sampled.shape[1]
    assert len(planned_walks(40, 50, 0.0, 0.99).bits) == 1
    with pytest.raises(ValueError):
        planned_walks(40, 50, 0.95, 1.0)


def test_walks_bring_edit_distance_to_hamming_distance():
    walks = Walks.made(100, 60, 2)
    item = np.arange(1, 101)
    edited = np.concatenate([item[:30], [0], item[30:60], item[61:]])
    other = np.arange(1000, 1100)
    blank = np.zeros(200, dtype=np.int64)
    words = np.concatenate([item, blank, edited, blank, other, blank])
    read = walks.read(words, np.array([0, 300, 600]))
    assert (read[:, :, 0] == read[:, :, 1]).mean() > 0.6
    assert (read[:, :, 0] == read[:, :, 2]).mean() < 0.05
    assert set(walks.read(words, np.array([0]))[0].ravel()) <= set(item)


# 7


def test_trie_equals_a_scan_of_the_rules():
    r = random.Random(7)
    labels, segments = ["a", "b", "com", "net"], ["", "x", "xy", "en"]
    rules = [Rule(r.choice(["allow", "block"]), ".".join(r.choices(labels, k=r.randint(1, 3))), "/" + "/".join(r.choices(segments, k=r.randint(0, 3)))) for _ in range(60)]
    trie = UrlTrie(rules)
    for _ in range(3000):
        host, path = ".".join(r.choices(labels, k=r.randint(1, 4))), r.choice(["", "/"]) + "/".join(r.choices(segments, k=r.randint(0, 4)))
        fitting = [x for x in rules if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fitting, key=lambda x: (len(x.text), len(x.host), x.verdict == "block"), default=None)
        found = trie.longest(host, path)
        assert (found and (found.text, found.verdict)) == (best and (best.text, best.verdict))


# 8


@pytest.mark.parametrize(("n2", "k2"), [(2, 1), (3, 1), (4, 2)])
def test_similar_sets_share_a_signature(n2, k2):
    r, scheme = np.random.default_rng(8), PartEnum(n2=n2, k2=k2)
    for _ in range(400):
        size = int(r.integers(1, 900))
        base = r.integers(0, 2**63, size * 2, dtype=np.int64).view(np.uint64)
        lost = int(r.integers(0, size // 4 + 1))
        a, b = np.unique(base[:size]), np.unique(np.concatenate([base[lost:size], base[size : size + int(r.integers(0, lost + 1))]]))
        common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * common < 75 * union:
            continue
        (sa, exposed_a), (sb, exposed_b) = scheme.signatures(a), scheme.signatures(b)
        assert len(np.intersect1d(sa, sb)) or exposed_a and exposed_b


def brute_components(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words)} if 0 < len(words) < 5 else {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_components_equal_brute_force(spark):
    r = random.Random(9)
    texts = word_soup(10, 60, words=(1, 120))
    for text in list(texts):
        for _ in range(r.randint(0, 5)):  # chains of copies, each a little different from the last
            words = text.split()
            for _ in range(max(1, len(words) // 40)):
                words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
            text = " ".join(words)
            texts.append(text)
    shared = " ".join(f"p{i}" for i in range(60))
    texts += [f"{t} {shared}" for t in word_soup(11, 60, words=(40, 90))]
    rows = list(enumerate(texts)) + [(10_000, texts[3]), (10_001, None), (10_002, "")]
    r.shuffle(rows)
    found = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join(documents(spark, rows)).labelled("doc_id").collect()}
    assert found == brute_components(rows)


def near_copies(seed=12):
    r = random.Random(seed)
    texts = word_soup(seed, 25, words=(40, 160))
    for text in list(texts):
        for _ in range(r.randint(0, 7)):
            words = text.split()
            for _ in range(r.randint(1, 1 + len(words) // 60)):
                words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
            texts.append(" ".join(words))
    rows = list(enumerate(texts)) + [(10_000, texts[3])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("entries", [500_000, 300])
def test_links_equal_brute_force(spark, monkeypatch, entries):
    from shelfrank.llm import jaccard_join as module

    monkeypatch.setattr(module, "BLOCK_ENTRIES", entries, raising=False)
    rows, shingles = near_copies(), Shingles()
    sets = {i: frozenset(shingles.set_of(text).tolist()) for i, text in rows}
    different = set(sets.values())
    linked = {a: {b for b in different if a != b and 100 * len(a & b) >= 75 * len(a | b)} for a in different}
    made = jaccard_join(documents(spark, rows))
    found = {x.doc_id: x.n_links for x in made.labelled("doc_id").collect()}
    assert found == {i: len(linked[s]) for i, s in sets.items()}
    assert made.links.count() == sum(map(len, linked.values())) // 2


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 250), (250, 275)]
    found = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}, 250: 250, 275: 250, 300: 250}


def test_shingles_by_definition():
    assert len(Shingles().set_of("a b")) == 1 and len(Shingles().set_of("a b c d e")) == 1
    assert len(Shingles().set_of("a b c d e f a b c d e")) == 7 - 1
    assert list(Shingles().set_of("A b\tC\x0bd E")) == list(Shingles().set_of("a  B c d e"))
    assert list(Shingles().set_of("é b c d e")) != list(Shingles().set_of("é b c d e"))


# 9


def test_heap_places_the_largest_first():
    placed = least_loaded([(1, 5), (2, 4), (3, 3), (4, 3), (5, 3)], 2)
    loads = Counter()
    for key, size in ((1, 5), (2, 4), (3, 3), (4, 3), (5, 3)):
        loads[placed[key]] += size
    assert sorted(loads.values()) == [8, 10]


def test_shards_are_balanced_and_keep_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    frame = balanced_shards(docs, 40).toPandas().merge(docs.toPandas()[["doc_id", "text"]], on="doc_id")
    assert len(frame) == docs.count()
    assert (frame["size"] == [len((t or "").encode()) + 16 for t in frame.text]).all()
    assert (frame.text_crc32 == [zlib.crc32((t or "").encode()) for t in frame.text]).all()
    assert frame.fillna({"text": ""}).groupby("text").shard.nunique().max() == 1
    bytes_of = frame.groupby("shard")["size"].sum()
    assert len(bytes_of) == 40 and bytes_of.max() - bytes_of.min() < 0.01 * bytes_of.mean()
    for _, part in frame.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


# 10


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cn", "Cs")), max_size=40) | st.text(alphabet="aeiltn 'sd123.,!Σσé \x1c <|>", max_size=60))
def test_ids_equal_the_library(text):
    mine = BatchEncoder(OURS).encode([text])[0]
    theirs = LIBRARY.encode(text, add_special_tokens=False).ids
    assert mine.tolist() == theirs
    assert OURS.decode(mine) == LIBRARY.decode(theirs, skip_special_tokens=False)


def test_special_tokens_and_long_words():
    texts = ["<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "a" * 5000, "abab" * 2000, "the" * 900]
    for text, mine in zip(texts, BatchEncoder(OURS, cached=1).encode(texts), strict=True):
        assert mine.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_documents_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    encoded = encode_documents(docs, PATH)
    for row in encoded.join(docs, "doc_id").collect():
        theirs = LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == theirs and row.n_tokens == len(theirs)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, theirs)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(theirs, skip_special_tokens=False).encode()).hexdigest()
    before = encoded.select("doc_id", encoded.decoded.alias("before"))
    assert all(r.decoded == r.before for r in decode_documents(encoded, PATH).join(before, "doc_id").collect())


def test_a_lookup_finds_every_key_and_no_other_value():
    r = np.random.default_rng(5)
    keys = np.sort(np.repeat(r.integers(-(2**63), 2**63 - 1, 3_000), r.integers(1, 3, 3_000)))
    values = np.concatenate([keys[::3], [0, -1, 2**62], r.integers(-(2**63), 2**63 - 1, 50_000)])
    at, place = Lookup(keys).find(values)
    assert at.tolist() == np.flatnonzero(np.isin(values, keys)).tolist()
    assert place.tolist() == np.searchsorted(keys, values[at]).tolist()
    assert [len(x) for x in Lookup(np.empty(0, np.int64)).find(values)] == [0, 0]


def test_small_graphs_take_few_tasks(spark):
    """Rounds on few links must not write as many files as there are shuffle partitions."""
    changed = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        found = connected_components(spark.createDataFrame([(i, i + 1) for i in range(1, 300) if i % 3], "a long, b long"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["node"]: r["component"] for r in found.collect()} == {n: n - (n - 1) % 3 for n in range(1, 301)}
    assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism

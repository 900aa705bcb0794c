"""N-gram Jaccard join: PartEnum signatures find the candidates, exact set sizes decide."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import dropped, numbered, pick, stored, written
from shelfrank.llm.components import connected_components
from shelfrank.llm.shingle_sets import SHINGLE, PartEnum, Shingles, fingerprint, mixed

PERCENT = 75
CHARS_AT_ONCE = 4_000_000
#: Members found in more than this share of the sets are left out of the domain; at most ``MAX_FREQUENT`` of them, which loses nothing.
FREQUENT_SHARE = 0.002
MAX_FREQUENT = 250_000
ENTRIES_PER_BUCKET = 1_000_000
#: Members of sets that count as much as a row of small columns where work is dealt to tasks.
MEMBERS_A_ROW = 20
#: Sets that share a signature in one batch beyond this many go around the bucket of that signature.
CROWD = 8
#: Bytes that are compared at once when sketches meet in pairs.
BYTES_AT_ONCE = 4_000_000
#: Sets that are compared in pairs stand in blocks of about so many members; by their sketches alone, of so many times more.
BLOCK_ENTRIES = 500_000
SKETCHED = 4
#: What a set counts in a block besides its members, for its sketch and its place in the table.
SET_ENTRIES = 64
MAX_BROADCAST = 500_000
BLOCK_KEYS = "array<struct<k0:int,k1:int,k2:int,k3:int,k4:int>>"


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    sizes = batch["text"].str.len().fillna(0).cumsum() // CHARS_AT_ONCE
    for _, part in batch.groupby(sizes.to_numpy()):
        yield part


@dataclass
class JaccardJoin:
    """The links of a table of texts, as classes of equal sets and links between different ones."""

    rows: DataFrame  # id, digest (of the text), n_shingles, f1, f2: one per row of the table
    classes: DataFrame  # node, f1, f2, first (smallest id), size: one per different set
    forest: DataFrame  # a, b: links that connect each component
    degrees: DataFrame | None  # node, n_links: with how many different sets a set is linked, where it is with any
    components: DataFrame = field(repr=False)  # node, component, for nodes with a link
    _blocks: DataFrame = field(repr=False)
    _sets: DataFrame = field(repr=False)
    _decisions: DataFrame = field(repr=False)  # behind forest and degrees
    _percent: int

    def labelled(self, id_col: str) -> DataFrame:
        """Per row: id, n_shingles, component_id, and the number of different sets that its own is linked with."""
        if self.degrees is None:
            raise ValueError("the join was made without the number of links")
        nodes = self._nodes()
        first = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
        known = nodes.join(self.degrees, "node", "left").join(first, "component")
        known = stored(known.select("f1", "f2", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "class-components")
        # Rows without a set go around the join.
        empty = self.rows.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
        full = self.rows.where("n_shingles > 0").join(known, ["f1", "f2"]).select("id", "n_shingles", "component_id", "n_links")
        return full.unionByName(empty).withColumnRenamed("id", id_col)

    @cached_property
    def links(self) -> DataFrame:
        """a, b: nodes of different sets that are linked, once for each pair.  A component of n sets has up to n * (n - 1) / 2 of them,
        so this is made only when asked for."""
        return _decided(self._blocks, self._sets, self._percent, "pairs").select("a", "b")

    def _nodes(self) -> DataFrame:
        return self.classes.join(self.components, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def chosen(self) -> DataFrame:
        """id and digest of the row that stands for each component, and how many rows have both: the smallest id, null last, and of
        its texts the one with the smallest digest."""
        nodes = written(self._nodes().select("f1", "f2", "component"), "class-components")
        placed = self.rows.where("n_shingles > 0").join(nodes, ["f1", "f2"])
        counted = placed.groupBy("component", "id", "digest").agg(F.count(F.lit(1)).alias("n"))
        least = counted.groupBy("component").agg(F.min(F.struct(F.isnull("id").alias("no_id"), "id", "digest", "n")).alias("row"))
        out = written(least.select("row.id", "row.digest", "row.n"), "chosen-rows")
        dropped(nodes)
        return out

    def drop(self) -> None:
        """Delete the tables behind the join; what was made from them and not written cannot be read any more."""
        dropped(self.rows, self.classes, self._blocks, self._sets, self._decisions, self.components)


def jaccard_join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, every_link: bool = True
) -> JaccardJoin:
    """All links between texts whose shingle sets have a Jaccard similarity of at least ``percent`` / 100, decided exactly.

    A set holds the different ``shingle``-word sequences of a text, A-Z lower-cased; a text of fewer words is one sequence; a null
    text or one without words has an empty set and no links.  Rows with equal sets form a class, whose members are linked; only
    one of them goes through the search.  Repeated rows are two rows of one class.  A null id never names a component unless all its ids
    are null.  An empty table has no rows; other columns are ignored.  A very long text is one set like any other; its sketch grows with it.

    Signatures travel packed, by buckets whose number follows the number of shingles.  In a bucket each set is paired with the
    first set of its signature.  Pairs that sizes and sketches (a lower bound on the difference) let pass connect sets to groups.  Only
    signatures whose sets then lie in different groups are looked at again: there all sets meet in blocks, and those that may be linked
    connect groups.  So any two linked sets are in one group, and no step but the last makes more than a few rows for each set.

    Then all sets of a group meet in blocks with their members, and every pair that size and sketch let pass is decided exactly.  Tasks
    return how many links each set has and only such links as connect sets that no other link of the task does.  ``every_link`` = False
    skips pairs that are connected already, for callers that only want the components; there are no numbers of links then.
    """
    spark = df.sparkSession
    texts = pick(df, id=id_col, text=text_col).select("id", F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("digest", F.xxhash64("text"))
    kind = texts.schema["id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    schema = f"id {kind}, digest long, n_shingles long, f1 long, f2 long, is_row boolean, sketch binary"
    surveyed = written(texts.mapInPandas(_survey_with(shingle), schema), "shingle-survey")
    classes = surveyed.where("is_row AND n_shingles > 0").groupBy("f1", "f2").agg(
        F.min("id").alias("first"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "shingle-classes", texts.count())
    n_classes, n_members = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    counted = surveyed.where("NOT is_row").groupBy("f1").agg(F.sum("n_shingles").alias("n"))
    frequent = counted.where(F.col("n") > F.lit(max(2.0, FREQUENT_SHARE * n_classes))).orderBy(F.desc("n"), "f1").limit(MAX_FREQUENT)
    frequent = np.sort(frequent.select("f1").toPandas()["f1"].to_numpy(np.int64).view(np.uint64))
    rows = written(surveyed.where("is_row").drop("is_row", "sketch"), "shingle-rows", n_classes)
    dropped(surveyed)

    buckets = max(parts, n_members // ENTRIES_PER_BUCKET + 1)
    shared = spark.sparkContext.broadcast(frequent)
    packed = texts.mapInPandas(
        _signatures_with(shared, shingle, percent, buckets), "bucket int, crowd boolean, signatures binary, heads binary, nodes binary"
    )
    met = packed.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_meet, "signature long, a long, b long")
    met = written(met, "signature-pairs", n_members // MEMBERS_A_ROW)
    n_joined = n_classes + 2 * met.count()  # what the joins of pairs with sets go through

    pairs = written(_near_only(_with_nodes(met.select("a", "b").distinct(), classes), percent), "near-pairs", n_joined)
    groups = connected_components(pairs)
    opened = _openings(met, groups, classes, percent, n_joined)
    if opened is not None:
        # What was found before goes in as stars, which are settled already.
        wider = connected_components(groups.toDF("a", "b").unionByName(opened))
        dropped(groups, opened)
        groups = wider
    dropped(met, pairs)

    blocks = groups.join(classes.select("node", "size"), "node").withColumnRenamed("component", "group")
    blocks = written(_in_blocks(blocks, "group", F.col("size") + SET_ENTRIES, BLOCK_ENTRIES, percent).drop("group"), "group-blocks", n_classes)
    sets = _members(texts, classes, groups.select("node"), shingle, n_members // MEMBERS_A_ROW)
    decided = written(_decided(blocks, sets, percent, "all" if every_link else "forest"), "links", n_members // MEMBERS_A_ROW)
    forest = decided.where("b IS NOT NULL").select("a", "b")
    degrees = decided.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links")) if every_link else None
    components = connected_components(forest)
    dropped(groups)
    return JaccardJoin(rows, classes, forest, degrees, components, blocks, sets, decided, percent)


def _survey_with(shingle: int):
    def survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Size and fingerprint of every set; and, for members that several sets of a batch hold, by how many."""
        shingles = Shingles(shingle)
        for batch in batches:
            for part in _chunks(batch):
                sets = [shingles.set_of(t) for t in part["text"]]
                marks = [fingerprint(s) for s in sets]
                made = {"n_shingles": [len(s) for s in sets], "f1": [m[0] for m in marks], "f2": [m[1] for m in marks], "is_row": True}
                made["sketch"] = [_sketch(s) for s in sets]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "digest": part["digest"].to_numpy(), **made})
                different = list(dict(zip(marks, sets, strict=True)).values())
                members, counts = np.unique(np.concatenate(different), return_counts=True)
                often = counts >= max(3, FREQUENT_SHARE * len(different))
                if often.any():
                    found = {"n_shingles": counts[often], "f1": members[often].view(np.int64), "f2": 0, "is_row": False, "sketch": None}
                    yield pd.DataFrame({"id": pd.Series([None] * int(often.sum()), dtype="object"), "digest": 0, **found})

    return survey


def _signatures_with(shared, shingle: int, percent: int, buckets: int):
    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, shingles, scheme = shared.value, Shingles(shingle), PartEnum(percent)
        number = 0
        for batch in batches:
            for part in _chunks(batch):
                found, nodes, seen = [], [], set()
                for text in part["text"]:
                    members = shingles.set_of(text)
                    if not len(members) or (node := fingerprint(members)[0]) in seen:
                        continue
                    seen.add(node)
                    found.append(_of_set(members, frequent, scheme))
                    nodes.append(node)
                number += 1
                if found:
                    owners = np.repeat(np.array(nodes, dtype=np.int64), [len(f) for f in found])
                    yield _packed(np.concatenate(found), owners, buckets, number)

    return signatures


def _of_set(members: np.ndarray, frequent: np.ndarray, scheme: PartEnum) -> np.ndarray:
    """Signatures without the frequent members.  A set that is exposed without them adds those with all members, to meet others of its
    kind; one exposed even then adds its single members."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
        rare = members[frequent[at] != members]
    else:
        rare = members
    out, exposed = scheme.signatures(rare, len(members))
    if exposed and len(rare) < len(members):
        whole, exposed = scheme.signatures(members, space=1)
        out = np.concatenate([out, whole])
    if exposed:
        out = np.concatenate([out, mixed(members, 9)])
    return np.unique(out)


def _packed(signatures: np.ndarray, owners: np.ndarray, buckets: int, number: int) -> pd.DataFrame:
    """One row for each bucket.  Of a crowd with one signature only the first set goes to that signature's bucket; the others
    travel with it, as pairs, to buckets chosen by the signature and the batch."""
    order = np.lexsort((owners, signatures))
    signatures, owners = signatures[order], owners[order]
    starts = np.flatnonzero(np.append(True, signatures[1:] != signatures[:-1]))
    sizes = np.diff(np.append(starts, len(signatures)))
    heads = np.repeat(owners[starts], sizes)
    crowd = np.repeat(sizes >= CROWD, sizes) & (heads != owners)
    bucket = ((signatures >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    salted = mixed(signatures ^ mixed(owners.view(np.uint64), 3), 4)
    bucket = np.where(crowd, ((salted >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), bucket).astype(np.int64)
    out = []
    for is_crowd in (False, True):
        chosen = np.flatnonzero(crowd == is_crowd)
        chosen = chosen[np.argsort(bucket[chosen], kind="stable")]
        if not len(chosen):
            continue
        cuts = np.flatnonzero(np.append(True, bucket[chosen][1:] != bucket[chosen][:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(chosen)), strict=True):
            rows = chosen[a:b]
            head = heads[rows].tobytes() if is_crowd else b""
            out.append((int(bucket[rows[0]]), is_crowd, signatures[rows].tobytes(), head, owners[rows].tobytes()))
    return pd.DataFrame(out, columns=["bucket", "crowd", "signatures", "heads", "nodes"])


def _joined(blobs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.int64)


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """The first set (the smallest node) of every signature that several sets share, with each of the others."""
    crowd, single = group[group["crowd"]], group[~group["crowd"]]
    signatures, nodes = _joined(single["signatures"]), _joined(single["nodes"])
    order = np.lexsort((nodes, signatures))
    signatures, nodes = signatures[order], nodes[order]
    starts = np.flatnonzero(np.append(True, signatures[1:] != signatures[:-1])) if len(nodes) else np.empty(0, np.int64)
    first = np.repeat(nodes[starts], np.diff(np.append(starts, len(nodes))))
    several = first != nodes
    again = np.append(False, (signatures[1:] == signatures[:-1]) & (nodes[1:] == nodes[:-1])) if len(nodes) else several
    several &= ~again
    return pd.DataFrame(
        {
            "signature": np.concatenate([signatures[several], _joined(crowd["signatures"])]),
            "a": np.concatenate([first[several], _joined(crowd["heads"])]),
            "b": np.concatenate([nodes[several], _joined(crowd["nodes"])]),
        }
    )


def _sketch(members: np.ndarray) -> bytes:
    """A bit for each part of the domain: whether an odd number of members falls into it.  Parts are the last bits of the members, and
    at least 64 and twice the members; the exclusive or of both halves is the sketch for half as many parts."""
    bits = 64
    while bits < 2 * len(members):
        bits *= 2
    part = (members & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(part, minlength=bits) & 1).astype(np.uint8)).tobytes()


class Sketches:
    """Sketches of different lengths, folded to a common one where two meet."""

    def __init__(self, sketches) -> None:
        self.length = np.array([len(s) for s in sketches], dtype=np.int64)
        self.place = np.empty(len(self.length), np.int64)
        self.of_length = {}
        for length in np.unique(self.length).tolist():
            at = np.flatnonzero(self.length == length)
            self.place[at] = np.arange(len(at))
            self.of_length[length] = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), length // 8)

    def _folded(self, rows: np.ndarray, length: int) -> np.ndarray:
        out = np.empty((len(rows), length // 8), np.uint64)
        for own in np.unique(self.length[rows]).tolist():
            at = np.flatnonzero(self.length[rows] == own)
            words = self.of_length[own][self.place[rows[at]]]
            while words.shape[1] > length // 8:
                half = words.shape[1] // 2
                words = words[:, :half] ^ words[:, half:]
            out[at] = words
        return out

    def may_link(self, other: Sketches, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
        """Whether the sketches of rows ``a`` and of the rows ``b`` of ``other`` differ in no more bits than similar sets of these sizes
        may differ in members: each member that only one set has turns one bit."""
        common = np.minimum(self.length[a], other.length[b])
        near = np.zeros(len(a), bool)
        for length in np.unique(common).tolist():
            chosen = np.flatnonzero(common == length)
            step = max(1, BYTES_AT_ONCE // length)
            for start in range(0, len(chosen), step):
                at = chosen[start : start + step]
                turned = np.bitwise_count(self._folded(a[at], length) ^ other._folded(b[at], length)).sum(axis=1, dtype=np.int64)
                near[at] = turned * (100 + percent) <= (size_a[at] + size_b[at]) * (100 - percent)
        return near


def _with_nodes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of fingerprints as pairs of nodes with their sizes and sketches."""
    nodes = classes.select("node", "f1", "size", "sketch")
    left = nodes.toDF("node_a", "a", "size_a", "sketch_a")
    right = nodes.toDF("node_b", "b", "size_b", "sketch_b")
    joined = pairs.join(left, "a").join(right, "b").where("node_a <> node_b")
    return joined.drop("a", "b").withColumnsRenamed({"node_a": "a", "node_b": "b"})


def _near_only(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that may be similar, by their sizes and sketches."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                every = np.arange(len(batch))
                a, b = (Sketches(batch[c].tolist()) for c in ("sketch_a", "sketch_b"))
                keep = a.may_link(b, every, every, batch["size_a"].to_numpy(), batch["size_b"].to_numpy(), percent)
                yield batch.loc[keep, ["a", "b"]]

    fitting = pairs.where(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent)
    return fitting.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInPandas(near, "a long, b long")


def _members(texts: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int, rows: int) -> DataFrame:
    """node and its whole set, for the wanted nodes."""
    wanted = written(classes.join(wanted, "node").select("node", F.col("first").alias("_id"), "f1", "f2"), "wanted-sets", rows)
    chosen = texts.join(_small(wanted), F.col("id").eqNullSafe(F.col("_id"))).select("node", "f1", "f2", "text")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(shingle)
        for batch in batches:
            for part in _chunks(batch):
                found = [shingles.set_of(t) for t in part["text"]]
                marks = list(zip(part["f1"], part["f2"], strict=True))
                keep = [fingerprint(s) == m for s, m in zip(found, marks, strict=True)]
                yield pd.DataFrame({"node": part["node"][keep], "members": [s.view(np.int64) for s, k in zip(found, keep, strict=True) if k]})

    made = chosen.mapInPandas(sets, "node long, members array<long>")
    out = written(made.groupBy("node").agg(F.first("members").alias("members")), "sets", rows)
    dropped(wanted)
    return out


def _openings(met: DataFrame, groups: DataFrame, classes: DataFrame, percent: int, rows: int) -> DataFrame | None:
    """Pairs that connect groups: sets that share a signature, lie in different groups and may be linked.  None if no signature has
    sets of different groups."""
    label = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")).select("node", "f1", "component")
    label = written(label, "labels", rows)
    # Every set of a signature, with its node and group; the first one is in each of its pairs.
    ends = met.select("signature", F.col("b").alias("f1"))
    heads = met.select("signature", F.col("a").alias("f1")).distinct()
    signed = written(ends.unionByName(heads).join(label, "f1").select("signature", "node", "component").distinct(), "signed", rows)
    # Of two sets the pair is known already; of signatures that the same sets share one is enough.
    mixed_up = signed.groupBy("signature").agg(
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x2"),
    )
    mixed_up = mixed_up.where("least < most AND n > 2").groupBy("n", "x1", "x2").agg(F.min("signature").alias("signature"))
    mixed_up = written(mixed_up.select("signature"), "mixed-signatures", rows)
    open_sets = signed.join(mixed_up, "signature").join(classes.select("node", "size"), "node")
    blocked = written(_in_blocks(open_sets, "signature", F.col("size") + SET_ENTRIES, SKETCHED * BLOCK_ENTRIES, percent).drop("signature"), "signature-blocks", rows)
    dropped(label, signed, mixed_up)
    out = None
    if buckets := _buckets(blocked, SKETCHED * ENTRIES_PER_BUCKET):
        sketched = blocked.join(classes.select("node", "sketch"), "node").withColumn("bucket", F.pmod("key", F.lit(buckets)))
        out = written(sketched.groupBy("bucket").applyInPandas(_openings_with(percent), "a long, b long").distinct(), "openings", rows)
    dropped(blocked)
    return out


def _buckets(blocked: DataFrame, entries: int) -> int:
    """How many buckets of about so many members hold the blocks; 0 if there are none."""
    total = blocked.agg(F.sum(F.col("size") + SET_ENTRIES)).first()[0]
    return 0 if total is None else max(int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // entries + 1)


class Connected:
    """Which rows are connected so far, for whole arrays of rows."""

    def __init__(self, labels: np.ndarray) -> None:
        self.label = np.unique(labels, return_inverse=True)[1]
        self.parent = np.arange(self.label.max(initial=-1) + 1)

    def settle(self) -> None:
        while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
            self.parent = up

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As of the last ``settle``."""
        return self.parent[self.label[a]] != self.parent[self.label[b]]

    def _root(self, label: int) -> int:
        while (up := self.parent[label]) != label:
            self.parent[label] = self.parent[up]
            label = up
        return label

    def roots(self, a: int, b: int) -> tuple[int, int]:
        return self._root(self.label[a]), self._root(self.label[b])


def _openings_with(percent: int):
    def openings(group: pd.DataFrame) -> pd.DataFrame:
        """Pairs under one key that may be linked, as many as connect the groups in this task: fewer than there are sets."""
        group = group.sort_values(["key", "size", "node"])
        key, node, side, size, part = (group[c].to_numpy(np.int64) for c in ("key", "node", "side", "size", "component"))
        connected, found = Connected(part), []
        for a, b in _near(key, size, side, Sketches(group["sketch"].tolist()), percent, connected):
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                low, high = sorted(connected.roots(i, j))
                if low != high:
                    connected.parent[high] = low
                    found.append((node[i], node[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return openings


def _near(
    key: np.ndarray, size: np.ndarray, side: np.ndarray, sketch: Sketches, percent: int, connected: Connected | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs under one key, on different sides or both on side -1, that are not ``connected`` yet and whose sketches do not
    differ by more than the sets may.

    In the order of key and size each set is compared with its next, then its second next, and so on, all keys at once.
    """
    first, step = np.arange(len(key)), 0
    while len(first):
        step += 1
        first = first[first + step < len(key)]
        # Sizes ascend: once a partner is too large, all later ones are.
        first = first[(key[first] == key[first + step]) & (size[first] * 100 >= size[first + step] * percent)]
        chosen = first[(side[first] != side[first + step]) | (side[first] < 0)]
        if connected is not None:
            connected.settle()
            chosen = chosen[connected.apart(chosen, chosen + step)]
        near = chosen[sketch.may_link(sketch, chosen, chosen + step, size[chosen], size[chosen + step], percent)]
        if len(near):
            yield near, near + step


def _decided(blocks: DataFrame, sets: DataFrame, percent: int, what: str) -> DataFrame:
    """The exact decision on all pairs that meet in blocks, as rows (a, b, n).

    ``what``: "pairs" gives every linked pair; "forest" links that connect the sets of a task, without looking at pairs that are
    connected; "all" such links too, and rows without b for the number of links that a has under one key.
    """
    buckets = _buckets(blocks, ENTRIES_PER_BUCKET) or 1
    grouped = blocks.join(sets, "node").withColumn("bucket", F.pmod("key", F.lit(buckets))).groupBy("bucket")
    return grouped.applyInPandas(_decided_with(percent, what), "a long, b long, n long")


def _decided_with(percent: int, what: str):
    def decided(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "size", "node"])
        key, node, side, size = (group[c].to_numpy(np.int64) for c in ("key", "node", "side", "size"))
        sets = [np.asarray(m, dtype=np.int64).view(np.uint64) for m in group["members"]]
        connected, links, degree = Connected(node), [], np.zeros(len(node), np.int64)
        near = _near(key, size, side, Sketches([_sketch(m) for m in sets]), percent, connected if what == "forest" else None)
        for a, b in near:
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                low, high = sorted(connected.roots(i, j))
                if (what == "forest" and low == high) or not _similar(sets[i], sets[j], percent):
                    continue
                degree[i] += 1
                degree[j] += 1
                if low != high or what == "pairs":
                    connected.parent[high] = low
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
        out = pd.DataFrame(links, columns=["a", "b"], dtype="Int64")
        if what == "all":
            linked = np.flatnonzero(degree)
            out = pd.concat([out, pd.DataFrame({"a": node[linked], "n": degree[linked]}, dtype="Int64")])
        return out.reindex(columns=["a", "b", "n"]).astype("Int64")

    return decided


def _similar(smaller: np.ndarray, larger: np.ndarray, percent: int) -> bool:
    at = np.minimum(np.searchsorted(larger, smaller), len(larger) - 1)
    common = int(np.count_nonzero(larger[at] == smaller))
    return common * 100 >= (len(smaller) + len(larger) - common) * percent


def _in_blocks(rows: DataFrame, group: str, weight: Column, limit: int, percent: int) -> DataFrame:
    """``rows`` with ``key`` and ``side``: any two of a group whose sizes allow a link meet under one key, on different sides or
    both on side -1.

    A group of more than ``limit`` in weight is cut by size into bands, of which similar sets are in the same or the next one, and bands by a
    hash of the node into blocks of about ``limit``.  Every key holds one block or two.
    """
    width = math.log(100 / percent) * 1.000001 + 1e-6
    banded = rows.withColumn("_band", F.floor(F.log(F.col("size").cast("double")) / width).cast("int"))
    heavy = banded.groupBy(group, "_band").agg(F.ceil(F.sum(weight) / limit).cast("int").alias("n"), F.sum(weight).alias("w"))
    heavy = heavy.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("_band", "n"))).alias("_blocks"), F.sum("w").alias("w"))
    heavy = heavy.where(F.col("w") > limit).select(group, "_blocks")
    placed = banded.join(heavy, group, "left").withColumn("_part", F.pmod(F.xxhash64("node"), F.element_at("_blocks", F.col("_band"))).cast("int"))

    def meeting(step: int) -> Column:
        """The keys shared with the blocks of the band ``step`` further on: (low band, low block, high band, high block, side)."""
        other = F.col("_band") + step

        def key(q: Column) -> Column:
            if step < 0:
                values = (other, q, F.col("_band"), F.col("_part"), F.lit(1))
            elif step > 0:
                values = (F.col("_band"), F.col("_part"), other, q, F.lit(0))
            else:
                side = F.when(q == F.col("_part"), -1).otherwise((q < F.col("_part")).cast("int"))
                values = (other, F.least(q, "_part"), other, F.greatest(q, "_part"), side)
            return F.struct(*[v.cast("int").alias(f"k{i}") for i, v in enumerate(values)])

        there = F.element_at("_blocks", other)
        return F.when(there.isNotNull(), F.transform(F.sequence(F.lit(0), there - 1), key)).otherwise(F.array().cast(BLOCK_KEYS))

    alone = F.array(F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate((0, 0, 0, 0, -1))])).cast(BLOCK_KEYS)
    keys = F.when(F.isnull("_blocks"), alone).otherwise(F.concat(*[meeting(step) for step in (-1, 0, 1)]))
    out = placed.withColumn("_key", F.explode(keys))
    out = out.withColumn("key", F.xxhash64(group, "_key.k0", "_key.k1", "_key.k2", "_key.k3")).withColumn("side", F.col("_key.k4"))
    return out.drop("_band", "_blocks", "_part", "_key")


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of the Jaccard join, with all its columns: the one with the smallest id.

    Rows without words (null and empty texts too) all stay.  Of rows that repeat id and text one stays; ties of ids go to the text with
    the smallest digest; a null id stands for a component only if all its ids are null.  Very long texts are whole sets.  An empty table
    stays empty.  Other columns may have any names.
    """
    join = jaccard_join(df, id_col, text_col, every_link=False)
    try:
        chosen = join.chosen().toDF("_id", "_chosen", "_n")
    finally:
        join.drop()
    rows = numbered(df)
    id_at, text_at = rows.name(id_col), rows.name(text_col)
    has_words = F.coalesce(F.col(text_at).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = rows.frame.where(has_words).withColumn("_digest", F.xxhash64(F.col(text_at).cast("string")))
    here = F.col(id_at).eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_chosen"))
    once = marked.join(_small(chosen.where("_n = 1")), here, "left_semi")
    # Only rows that repeat id and text have to meet.
    several = marked.join(_small(chosen.where("_n > 1")), here, "left_semi").dropDuplicates([id_at, "_digest"])
    return rows.restored(once.unionByName(several).drop("_digest").unionByName(rows.frame.where(~has_words)))


def _small(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if it is found to be short; a longer table is joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST else rows

"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, and exact set checks.

A document is the set of its word shingles. Its signature holds SYMBOLS minimum hashes of
SYMBOL_BITS bits. Two sets of similarity s differ in each symbol with probability 1 - s, so at 0.8
they differ in more than DISTANCE of them with a probability below 0.00001.

Candidates. The signature is cut into CHUNKS chunks. If two signatures differ in at most DISTANCE
symbols, some chunk differs in at most ERRORS = DISTANCE // CHUNKS = 1 of them (pigeonhole). For
each chunk a document has a key for every symbol left out, so all such pairs share a key.

Links. Documents that share a key are linked where their whole sets are similar enough. Groups of
copies may be large, so pairs are never listed. In each key one member is the hub, and the others
are compared to it first: what is within DISTANCE of its hub is one near group, and what the exact
sets confirm is one component. Left are two kinds of pairs between components.
Members of different near groups that share a key: a key has one row for each near group, so a large
group of copies counts once, or as its blocks of at most BLOCK members. A block has a centre and a
radius. Two blocks further apart than DISTANCE and both radii hold no pair within DISTANCE; of single
documents, whose radius is 0, just the pairs within DISTANCE are left. Blocks that are closer are
compared once, whatever number of keys they share.
Members of one near group: pairs of blocks of at most BLOCK documents, but for two blocks of one
large component. Each pair of blocks gives a spanning forest of its links.
So every pair within DISTANCE that could change a component is checked on its whole sets, without
a task that holds a whole group.

Candidates are found by hashes of words; links are confirmed on the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.components import components
from depotlake.llm.tables import Scratch, keep_rows, row_key, same_row
from depotlake.llm.words import batches, mix, shingles

WIDTH = 5
#: Least similarity of linked documents, in hundredths.
SIMILARITY = 80
#: Smaller sets are linked with equal sets only: one shingle more or less is too much.
LEAST_SET = SIMILARITY // (100 - SIMILARITY)

SYMBOLS = 100
SYMBOL_BITS = 16
CHUNKS = 20
DISTANCE = 39
ERRORS = DISTANCE // CHUNKS
CHUNK_SYMBOLS = SYMBOLS // CHUNKS
assert ERRORS == 1 and CHUNKS * CHUNK_SYMBOLS == SYMBOLS

#: Documents of a block.
BLOCK = 256
#: A key is hot if this part of a sample has it, and HOT_LEAST of the sample; one node in HOT_SAMPLE is looked at.
HOT_SHARE, HOT_LEAST, HOT_SAMPLE = 0.01, 10, 50

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _random.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The signature of a set of hashes."""
    least = np.full(SYMBOLS, np.uint64(2**64 - 1))
    for start in range(0, len(shingle_set), 2048):
        part = shingle_set[start : start + 2048, None] * _FACTORS + _ADDENDS
        least = np.minimum(least, part.min(axis=0))
    return (mix(least) >> np.uint64(64 - SYMBOL_BITS)).astype("<u2")


class _WordHashes(dict):
    """64-bit hashes of words, by the word."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_sets(text: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The set of each text of a binary column, as sorted hashes. Letters A-Z count as a-z."""
    words = [t.lower().split() for t in text.to_pylist()]  # of bytes: ASCII letters and white space only
    known = _WordHashes()
    hashes = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64)
    found, begins = shingles(hashes, np.cumsum([0, *map(len, words)]), width)
    for start, end in zip(begins[:-1], begins[1:]):
        yield np.unique(found[start:end])


def exact_sets(texts: Sequence[bytes], width: int) -> list[np.ndarray]:
    """The set of each text as sorted numbers; two shingles have one number if their words are equal."""
    known: dict[bytes, int] = {}
    words = [[known.setdefault(w, len(known)) for w in t.lower().split()] for t in texts]
    none = len(known)  # fills up the only shingle of a short text
    words = [w + [none] * (width - len(w)) if 0 < len(w) < width else w for w in words]
    flat = np.fromiter(chain.from_iterable(words), np.int64)
    counts = np.array([max(len(w) - width + 1, 0) for w in words], np.int64)
    firsts = np.cumsum([0, *map(len, words)])[:-1]
    ends = np.cumsum(counts)
    at = np.arange(counts.sum()) + np.repeat(firsts - (ends - counts), counts)
    numbers = flat[at]
    for k in range(1, width):  # both factors are below 2**31
        numbers = np.unique(numbers * (none + 1) + flat[at + k], return_inverse=True)[1]
    return [np.unique(numbers[end - count : end]) for end, count in zip(ends, counts)]


SKETCH = [("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("signature", pa.binary())]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_a and set_b (128 bits that name the set), signature."""
    named = docs.select(*row_key(docs), "text")
    kind = named.schema["doc_id"].dataType.simpleString()

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for batch in batches(whole):
                rows = []
                for found in shingle_sets(batch.column(2), width):
                    name = np.frombuffer(hashlib.blake2b(found, digest_size=16).digest(), "<i8").tolist()
                    rows.append((len(found), *name, signature(found).tobytes() if len(found) else b""))
                columns = [pa.array(values, kind_of) for values, (_, kind_of) in zip(zip(*rows), SKETCH)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_key", *[n for n, _ in SKETCH]])

    return named.mapInArrow(run, f"doc_id {kind}, text_key long, n_shingles long, set_a long, set_b long, signature binary")


def chunk_keys(
    nodes: DataFrame, column: str, only: np.ndarray | None = None, without: np.ndarray | None = None, hubs: np.ndarray | None = None
) -> DataFrame:
    """key and a column of the node: for each chunk of its signature and each symbol left out of it.

    ``only`` and ``without`` are sorted keys to take or to leave out. With ``hubs``, one for each key of
    ``only``, the hub stands in the place of the key.
    """

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, SYMBOLS).astype(np.uint64)
                keys = np.empty((len(symbols), SYMBOLS), np.uint64)
                for left_out in range(SYMBOLS):
                    first = left_out - left_out % CHUNK_SYMBOLS
                    key = np.full(len(symbols), left_out + 1, np.uint64)
                    for place in range(first, first + CHUNK_SYMBOLS):
                        if place != left_out:
                            key = mix(key * np.uint64(0x9FB21C651E98DF25) + symbols[:, place])
                    keys[:, left_out] = key
                key, node = keys.reshape(-1).astype(np.int64), np.repeat(batch.column(0).to_numpy(), SYMBOLS)
                for chosen, wanted in ((only, True), (without, False)):
                    if chosen is not None:
                        kept = np.isin(key, chosen) == wanted
                        key, node = key[kept], node[kept]
                shown = key if hubs is None else hubs[np.searchsorted(only, key)]
                yield pa.RecordBatch.from_arrays([pa.array(shown), pa.array(node)], ["key", column])

    return nodes.where(F.col("n") >= LEAST_SET).select(column, "signature").mapInArrow(run, f"key long, {column} long")


def hot_keys(nodes: DataFrame) -> np.ndarray:
    """Keys that many nodes have, found in a sample of nodes; sorted, SYMBOLS / HOT_SHARE at most."""
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(HOT_SAMPLE)) == 0)
    least = max(HOT_LEAST, int(HOT_SHARE * sample.count()))
    found = chunk_keys(sample, "node").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r["key"] for r in found.select("key").collect()], np.int64))


def hub_pairs(nodes: DataFrame, hot: np.ndarray) -> DataFrame:
    """(a, b), distinct: a is the hub of a key that b has as well.

    Keys are grouped in one shuffle. Hot keys go around it: their hubs are found by combining in each
    task, and each node looks them up.
    """
    rank = F.struct(F.xxhash64("node").alias("rank"), "node")
    of_key = Window.partitionBy("key")
    cold = chunk_keys(nodes, "node", without=hot).select("node", F.min(rank).over(of_key).alias("hub"))
    pairs = cold.select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    if len(hot):
        hubs = chunk_keys(nodes, "node", only=hot).groupBy("key").agg(F.min(rank).alias("hub"))
        of_hot = {r["key"]: r["hub"]["node"] for r in hubs.collect()}
        found = chunk_keys(nodes, "node", only=hot, hubs=np.array([of_hot[k] for k in hot.tolist()], np.int64))
        pairs = pairs.unionByName(found.select(F.col("key").alias("a"), F.col("node").alias("b")))
    return pairs.where("a <> b").distinct()


class _Block:
    """Nodes that are compared: rows of an Arrow table (node, component, n, signature, text)."""

    def __init__(self, table: pa.Table):
        self.node = table["node"].to_numpy()
        self.component = table["component"].to_numpy()
        self.n = table["n"].to_numpy()
        self.signature = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(-1, SYMBOLS)


def _candidates(a: _Block, b: _Block, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a, the rows of b in other components within the bounds of size and distance."""
    for i in range(len(a.node)):
        small, large = np.minimum(a.n[i], b.n), np.maximum(a.n[i], b.n)
        chosen = (a.component[i] != b.component) & (100 * small >= SIMILARITY * large)
        if same:
            chosen[: i + 1] = False
        rows = np.flatnonzero(chosen)
        if len(rows):
            rows = rows[(b.signature[rows] != a.signature[i]).sum(axis=1) <= DISTANCE]
        if len(rows):
            yield i, rows


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    first = table.filter(pc.equal(table["side"], 0))
    second = table.filter(pc.equal(table["side"], 1))
    return first, second if second.num_rows else first, not second.num_rows


def _linked(table: pa.Table, width: int) -> pa.Table:
    """Links between rows whose sets are similar enough: a forest of them, over components."""
    first, second, same = _sides(table)
    a, b = _Block(first), _Block(second)
    root = {int(c): int(c) for c in np.concatenate([a.component, b.component])}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    candidates = list(_candidates(a, b, same))
    links: list[tuple[int, int]] = []
    if candidates:
        needed_a, needed_b = [i for i, _ in candidates], np.unique(np.concatenate([rows for _, rows in candidates]))
        texts = [*first["text"].take(pa.array(needed_a)).to_pylist(), *second["text"].take(pa.array(needed_b)).to_pylist()]
        sets = exact_sets(texts, width)
        sets_a, sets_b = dict(zip(needed_a, sets)), dict(zip(needed_b.tolist(), sets[len(needed_a) :]))
        words, ids = np.unique(np.concatenate([sets_b[int(j)] for j in needed_b]), return_inverse=True)
        ends = np.cumsum([len(sets_b[int(j)]) for j in needed_b])
        of = {int(j): ids[end - len(sets_b[int(j)]) : end] for j, end in zip(needed_b, ends)}
        for i, rows in candidates:
            rows = [int(j) for j in rows if find(int(a.component[i])) != find(int(b.component[j]))]
            if not rows:
                continue
            inside = np.isin(words, sets_a[i], assume_unique=True)
            sizes = np.array([len(of[j]) for j in rows])
            common = np.add.reduceat(inside[np.concatenate([of[j] for j in rows])].astype(np.int64), np.cumsum(sizes) - sizes)
            similar = 100 * common >= SIMILARITY * (len(sets_a[i]) + sizes - common)
            for j in np.array(rows)[similar].tolist():
                left, right = find(int(a.component[i])), find(int(b.component[j]))
                if left != right:
                    root[max(left, right)] = min(left, right)
                    links.append((int(a.node[i]), int(b.node[j])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _compatible(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _near_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures are within DISTANCE and whose sizes allow a link."""
    left, right = (nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"signature_{side}")) for side in "ab")
    both = pairs.join(left, "a").join(right, "b").where(_compatible(F.col("n_a"), F.col("n_b"))).select("a", "b", "signature_a", "signature_b")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, SYMBOLS) for k in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((one != two).sum(axis=1) <= DISTANCE))

    return both.mapInArrow(run, "a long, b long")


def link_nodes(nodes: DataFrame, texts_of, width: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join all similar nodes, from nodes (node, n, signature, ...).

    texts_of gives node and text for a table of nodes.
    """
    hot = hot_keys(nodes)
    stars = scratch.put(hub_pairs(nodes, hot), "hub-pairs")
    near = scratch.put(_near_pairs(stars, nodes), "near-hubs")
    members = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = nodes.join(members, "node", "left_semi")
    texts = scratch.put(texts_of(some), "texts")
    full = scratch.put(some.select("node", "n", "signature").join(texts, "node"), "members")
    scratch.drop("texts")
    first = scratch.put(_star_links(near, full, width, scratch, "hubs"), "hub-links")

    groups = components(near, scratch, "near").withColumnRenamed("component", "near_group")
    linked = components(first, scratch, "linked")
    placed = full.select("node", "n", "signature").join(groups, "node", "left").join(linked, "node", "left")
    placed = placed.select("node", "n", "signature", F.coalesce("near_group", "node").alias("near_group"), F.coalesce("component", "node").alias("component"))
    placed = scratch.put(placed, "placed")
    scratch.drop("hub-pairs", "near-hubs")
    across = scratch.put(_pairs_across(placed, hot, scratch), "pairs-across")
    second = scratch.put(_star_links(across, full, width, scratch, "across"), "links-across")
    third = _block_links(placed.drop("n", "signature"), full, width, scratch)
    return first.unionByName(second).unionByName(third)


def _star_links(pairs: DataFrame, full: DataFrame, width: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar, but for those that others imply: a with some b at a time."""
    counts = scratch.put(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("count")), f"counts-{name}")
    spread = pairs.join(counts, "a").select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("count") / BLOCK))).alias("block"))
    columns = ["block", "side", "node", F.col("node").alias("component"), "n", "signature", "text"]
    centres = spread.select("a", "block").distinct().join(full, F.col("a") == full["node"]).withColumn("side", F.lit(0))
    others = spread.join(full, F.col("b") == full["node"]).withColumn("side", F.lit(1))
    rows = centres.select(columns).unionByName(others.select(columns))
    return rows.groupBy("block").applyInArrow(lambda table: _linked(table, width), "a long, b long")


def _differing(a: Column, b: Column) -> Column:
    """In how many symbols two signatures differ."""
    size = SYMBOL_BITS // 8

    def symbol(signature: Column, place: Column) -> Column:
        return F.substring(signature, place * size + 1, F.lit(size))

    places = F.sequence(F.lit(0), F.lit(SYMBOLS - 1))
    return F.aggregate(places, F.lit(0), lambda count, i: count + F.when(symbol(a, i) == symbol(b, i), 0).otherwise(1))


BLOCK_SCHEMA = "near_group long, block long, centre binary, radius int, single boolean, nodes array<struct<node:long,n:long,component:long,signature:binary>>"


def _blocks(placed: DataFrame) -> DataFrame:
    """The members of near groups in blocks of about BLOCK, each with a centre and the largest distance to it.

    The centre has the most frequent symbol of the members in each place.
    """
    sizes = placed.groupBy("near_group").agg(F.count(F.lit(1)).alias("members"))
    dealt = placed.join(sizes, "near_group").withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)).cast("long"))
    node = F.struct("node", "n", "component", "signature")
    alone = dealt.where("members = 1").select(
        "near_group", "block", F.col("signature").alias("centre"), F.lit(0).alias("radius"), F.lit(True).alias("single"), F.array(node).alias("nodes")
    )
    held = dealt.where("members > 1").groupBy("near_group", "block").agg(F.collect_list(node).alias("nodes"))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            centres, radii = [], []
            for nodes in batch.column(2):
                symbols = _Block(pa.Table.from_struct_array(nodes.values)).signature
                ordered = np.sort(symbols, axis=0)
                # the length of the run that ends at each place, by column
                place = np.arange(len(ordered))[:, None]
                new = np.vstack([np.ones((1, SYMBOLS), bool), ordered[1:] != ordered[:-1]])
                lengths = place - np.maximum.accumulate(np.where(new, place, 0), axis=0)
                centre = ordered[lengths.argmax(axis=0), np.arange(SYMBOLS)]
                centres.append(centre.astype("<u2").tobytes())
                radii.append(int((symbols != centre).sum(axis=1).max()))
            more = [pa.array(centres, pa.binary()), pa.array(radii, pa.int32()), pa.array([False] * len(radii))]
            names = ["near_group", "block", "centre", "radius", "single", "nodes"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *more, batch.column(2)], names)

    return alone.unionByName(held.select("near_group", "block", "nodes").mapInArrow(run, BLOCK_SCHEMA))


def _pairs_across(placed: DataFrame, hot: np.ndarray, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) within DISTANCE in different near groups and components, of groups that share a key."""
    of_key = Window.partitionBy("key")
    cold = chunk_keys(placed, "near_group", without=hot).distinct()
    several = cold.withColumn("groups", F.count(F.lit(1)).over(of_key)).where("groups > 1").select("key", "near_group")
    if len(hot):
        several = several.unionByName(chunk_keys(placed, "near_group", only=hot).distinct())
    several = scratch.put(several, "several-groups")
    blocks = scratch.put(_blocks(placed.join(several.select("near_group").distinct(), "near_group", "left_semi")), "near-blocks")
    rows = several.join(blocks.withColumn("one", F.col("nodes")[0]).select("near_group", "block", "centre", "radius", "single", "one.node", "one.n", "one.component"), "near_group")
    left, right = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "key"]) for side in "ab")
    single = F.col("single_a") & F.col("single_b")
    allowed = ~single | (_compatible(F.col("n_a"), F.col("n_b")) & (F.col("component_a") != F.col("component_b")))
    close = _differing(F.col("centre_a"), F.col("centre_b")) <= DISTANCE + F.col("radius_a") + F.col("radius_b")
    pairs = left.join(right, "key").where((F.col("near_group_a") < F.col("near_group_b")) & allowed & close)
    chosen = ["near_group_a", "block_a", "near_group_b", "block_b", single.alias("single"), F.col("node_a").alias("a"), F.col("node_b").alias("b")]
    pairs = scratch.put(pairs.select(*chosen).distinct(), "block-pairs-across")
    return pairs.where("single").select("a", "b").unionByName(_pairs_of_blocks(pairs.where("not single"), blocks))


def _pairs_of_blocks(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes within DISTANCE, in different components, of pairs of blocks."""
    both = pairs
    for side in "ab":
        names = ("near_group", "block", "nodes")
        both = both.join(blocks.select(*[F.col(c).alias(f"{c}_{side}") for c in names]), [f"near_group_{side}", f"block_{side}"])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for one, two in zip(batch.column(0), batch.column(1)):
                a, b = (_Block(pa.Table.from_struct_array(nodes.values)) for nodes in (one, two))
                found = list(_candidates(a, b, False))
                pairs_a = np.repeat(a.node[[i for i, _ in found]], [len(rows) for _, rows in found])
                pairs_b = np.concatenate([b.node[rows] for _, rows in found]) if found else pairs_a
                yield pa.RecordBatch.from_arrays([pa.array(pairs_a), pa.array(pairs_b)], ["a", "b"])

    return both.select("nodes_a", "nodes_b").mapInArrow(run, "a long, b long")


def _block_links(placed: DataFrame, full: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """Links within near groups of several components."""
    mixed = placed.groupBy("near_group").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("near_group")
    inside = placed.join(mixed, "near_group", "left_semi")
    large = inside.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= BLOCK).select(F.col("component").alias("large"))
    apart = inside.join(large, inside["component"] == large["large"], "left")  # a large component has blocks of its own
    counts = apart.groupBy("near_group", "large").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    counts = counts.withColumnsRenamed({"near_group": "of_group", "large": "of_large"})
    same = (F.col("near_group") == F.col("of_group")) & F.col("large").eqNullSafe(F.col("of_large"))
    block = F.xxhash64("near_group", "large", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block")
    blocked = scratch.put(apart.join(counts, same).select("node", "near_group", "large", "component", block), "blocks")
    blocks = blocked.select("near_group", "block", "large").distinct()
    one, two = (blocks.select("near_group", F.col("block").alias(f"block_{side}"), F.col("large").alias(f"large_{side}")) for side in "ab")
    needed = (F.col("block_a") <= F.col("block_b")) & (F.col("large_a").isNull() | ~F.col("large_a").eqNullSafe(F.col("large_b")))
    pairs = scratch.put(one.join(two, "near_group").where(needed).select("block_a", "block_b"), "block-pairs")
    rows = scratch.put(full.join(blocked.select("node", "component", "block"), "node"), "block-rows")
    columns = ["block_a", "block_b", "side", "node", "component", "n", "signature", "text"]
    left = pairs.join(rows, pairs["block_a"] == rows["block"]).withColumn("side", F.lit(0))
    right = pairs.where("block_a <> block_b").join(rows, F.col("block_b") == rows["block"]).withColumn("side", F.lit(1))
    both = left.select(columns).unionByName(right.select(columns))
    return both.groupBy("block_a", "block_b").applyInArrow(lambda table: _linked(table, width), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each row: doc_id, text_key, n_shingles, component_id, kept, first.

    Texts whose sets are equal are one node from the start, so exact copies are never compared.
    component_id is the smallest doc_id that links reach, nulls last. kept holds for the rows whose
    doc_id that is. first holds for the first row of the component by doc_id and text; rows that
    repeat are first together. Null and empty texts and texts without words are linked with
    nothing. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near")
    found = scratch.put(sketches(docs, width), "sketches")
    by_set = ["n_shingles", "set_a", "set_b"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    sets = found.where("n_shingles > 0").groupBy(*by_set).agg(first, F.first("signature").alias("signature"))
    nodes = scratch.put(sets.select(F.monotonically_increasing_id().alias("node"), F.col("n_shingles").alias("n"), *by_set, "first", "signature"), "nodes")

    def texts_of(some: DataFrame) -> DataFrame:
        """The texts of the first rows of nodes; rows of equal doc_id and text are one."""
        keys = some.select("node", "first.doc_id", "first.text_key")
        named = docs.select(*row_key(docs), F.col("text").cast("binary").alias("text"))
        return named.join(keys, same_row(named, keys)).select("node", "text").dropDuplicates(["node"])

    links = scratch.put(link_nodes(nodes, texts_of, width, scratch), "links")
    groups = components(links, scratch, "components")
    joined = nodes.join(groups, "node", "left").select(*by_set, "first", F.coalesce("component", "node").alias("component"))
    firsts = joined.groupBy("component").agg(F.min("first").alias("first"))
    named = joined.drop("first").join(firsts, "component").select(*by_set, "first")
    rows = found.drop("signature").join(named, by_set, "left")
    alone = F.col("first").isNull()
    component_id = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    is_first = alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))
    return rows.select("doc_id", "text_key", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"), is_first.alias("first"))


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of each component, all columns."""
    found = near_duplicates(docs, width).select("doc_id", "text_key", F.col("first").alias("kept"))
    return keep_rows(docs, found, Scratch(docs.sparkSession, "near-kept"))

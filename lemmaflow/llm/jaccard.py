"""N-gram Jaccard join over word shingles: MinHash LSH forest, then exact verification.

1. Texts with the same words in the same order are copies: one of them, that of least doc_id, stands for all, with their number.
2. Every representative has a MinHash signature, which is also its label of ``DEEPEST`` values in each of ``TREES`` tries. Sorted by trie
   and label, the nodes of a trie are runs of rows with equal prefixes. From whole labels on, the matched prefix of a node is shortened
   by one value at a time: rows that meet there and whose signatures agree well enough for the threshold (but for five standard deviations)
   are candidates and form one set. It ends when the node is one set, or at the prefix at which the tries together reach ``recall``
   for a pair at the threshold.
3. The candidates' connected components are families. In each, the shingle sets are compared exactly, all with all, as exact numbers of links ask.
   Links are counted, not listed, and classes are the connected components of the links.

A task gives at most an edge for each of its rows, not the pairs. Nodes and families of over ``block`` members are split into blocks, and every two
blocks meet in a task of their own. There are at most ``MOST_BLOCKS`` blocks, so a member is in as many tasks, until blocks of that number would hold
more than a task can: ``NODE_ROWS`` rows of a node, ``VOLUME`` shingles of a family. Only then does their number grow. Within a task blocks are compared
slice by slice. Copies never meet as pairs. Frequent keys go by broadcasts of at most 500 rows.

Defined results: null and empty texts and texts without a word have no shingles: they are their own class, with no link; texts of fewer words than
a shingle have one shingle, all their words; a null doc_id is linked to nothing and has a null class; rows of equal doc_id
count as copies if their words are equal, and else as one document with several texts; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lemmaflow.llm.common import heavy_keys, staged
from lemmaflow.llm.textnum import chunks, mix, powers, shingles, word_hashes

TREES, DEEPEST = 16, 6
N = TREES * DEEPEST
_SEEDS = np.random.default_rng(20240101).integers(0, 1 << 63, N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SIGNED = "doc_id long, t long, a long, b long, n long, sig binary"
#: Blocks of a node or family, unless they would hold more rows or shingles than these.
MOST_BLOCKS, NODE_ROWS, VOLUME = 16, 1 << 15, 1 << 22
#: Rows and shingles of a slice that is compared at once.
SLICE_ROWS, SLICE_VOLUME = 512, 1 << 19


def prefix_length(similarity: float, recall: float) -> int:
    """The longest prefix at which the tries together find a pair of this similarity with probability ``recall``; 1 at least."""
    depth = DEEPEST
    while depth > 1 and 1 - (1 - similarity**depth) ** TREES < recall:
        depth -= 1
    return depth


def least_agreement(similarity: float) -> int:
    """Equal values among N that a pair of this similarity has, but for five standard deviations."""
    return max(0, math.floor(N * similarity - 5 * math.sqrt(N * similarity * (1 - similarity))))


def signed(docs: DataFrame, k: int) -> DataFrame:
    """A row for each document: two hashes of its words in order, its number of shingles and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                words, tokens = word_hashes(part)
                n_words = np.diff(tokens)
                place = np.arange(len(words)) - np.repeat(tokens[:-1], n_words)
                weight = powers(int(n_words.max(initial=0)) + 1)[0][place]
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(x * weight)]) for x in (words, mix(words + np.uint64(1)))]
                a, b = (mix(s[tokens[1:]] - s[tokens[:-1]] + n_words.astype(np.uint64)).view(np.int64) for s in sums)
                marks, first, _ = shingles(words, tokens, k)
                count = np.diff(first)
                some = np.flatnonzero(count)
                low = np.zeros((N, len(some)), np.uint16)
                for i in range(N if len(some) else 0):
                    low[i] = np.minimum.reduceat(((marks * _SEEDS[i]) >> np.uint64(32)).astype(np.uint32), first[:-1][some])
                raw = np.ascontiguousarray(low.T).tobytes()
                signature = np.full(len(part), None, object)
                signature[some] = [raw[2 * N * i : 2 * N * (i + 1)] for i in range(len(some))]
                columns = [batch.column(0).slice(at, len(part)), batch.column(2).slice(at, len(part)), pa.array(a), pa.array(b), pa.array(count, pa.int64()), pa.array(signature.tolist(), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SIGNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t")).mapInArrow(run, SIGNED)


def signatures(column: pa.ChunkedArray) -> np.ndarray:
    """A row of N values for each signature."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, N)


def tries(reps: DataFrame, depth: int) -> DataFrame:
    """(key, label, rep) for each representative and trie. ``key``: the trie's node at ``depth``; ``label``: the whole label, in an order of bytes that sorts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            label = signatures(batch.column(1)).reshape(n * TREES, DEEPEST)
            key = np.tile(np.arange(1, TREES + 1, dtype=np.uint64), n)
            for d in range(depth):
                key = mix(key + label[:, d])
            raw = label.astype(">u2").tobytes()
            size = 2 * DEEPEST
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array([raw[size * i : size * (i + 1)] for i in range(n * TREES)], pa.binary()), pa.array(np.repeat(batch.column(0).to_numpy(), TREES))], names=["key", "label", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "key long, label binary, rep long")


# ---- groups in blocks


def in_blocks(members: DataFrame, node: str) -> DataFrame:
    """Members of groups of ``blocks`` blocks, once for each pair of blocks that they are in: adds lo, hi and own."""
    n = F.col("blocks").cast("int")
    own = F.pmod(F.xxhash64(node), n).cast("int")
    rows = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "blocks")


def n_blocks(rows: Column, block: int, least: Column) -> Column:
    """Blocks of ``block`` rows, MOST_BLOCKS at most, but ``least`` at least."""
    return F.greatest(F.least(F.ceil(rows / block), F.lit(MOST_BLOCKS)), least)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 1 << 14) -> Iterator[pa.Table]:
    """Tables of sorted rows that don't cut a group; no more than ``most`` rows and one group."""
    held: list[pa.Table] = []
    for batch in batches:
        for a in range(0, batch.num_rows, most):
            part = pa.Table.from_batches([batch.slice(a, most)])
            last = [part.column(k)[-1] for k in keys]
            ends = np.ones(part.num_rows, bool)
            for k, v in zip(keys, last, strict=True):
                ends &= part.column(k).to_numpy() == v.as_py()
            cut = int(np.argmax(ends))  # here begins the last group, which may go on
            same = bool(held) and cut == 0 and all(held[-1].column(k)[-1] == v for k, v in zip(keys, last, strict=True))
            if not same and (held or cut):
                whole = pa.concat_tables([*held, part.slice(0, cut)])
                if whole.num_rows:
                    yield whole
                held = []
            held.append(part.slice(cut))
    if held:
        yield pa.concat_tables(held)


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def join_sets(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (the least place of each set) after the sets of each i and j are joined."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return root
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up


def join_alike(root: np.ndarray, starts: np.ndarray, sig: np.ndarray, least: int) -> np.ndarray:
    """Roots after the sets of rows in a run whose signatures agree at ``least`` places are joined.

    In turn the first, second, ... row of every run is compared with the rows of its run that come later and are in other sets. Runs that are one set drop out.
    """
    n = len(root)
    sizes = np.diff(np.append(starts, n))
    begin, turn = np.repeat(starts, sizes), 0
    rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(rows):
        rows = rows[rows > begin[rows] + turn]
        pivot = begin[rows] + turn
        apart = np.flatnonzero(root[rows] != root[pivot])
        for a in range(0, len(apart), 4096):
            x, y = rows[apart[a : a + 4096]], pivot[apart[a : a + 4096]]
            alike = (sig[x] == sig[y]).sum(1) >= least
            root = join_sets(root, x[alike], y[alike])
        turn += 1
        low, high = np.minimum.reduceat(root, starts), np.maximum.reduceat(root, starts)
        rows = rows[np.repeat(low != high, sizes)[rows]]
    return root


def candidate_edges(nodes: DataFrame, least: int, depth: int) -> DataFrame:
    """(u, v): an edge for each row of a node but the first of each set of candidates. Prefixes are shortened from DEEPEST to ``depth`` values."""
    keys = ["key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            n = table.num_rows
            rep, sig = table.column("rep").to_numpy(), signatures(table.column("sig"))
            label = np.frombuffer(b"".join(table.column("label").to_pylist()), ">u2").reshape(n, DEEPEST)
            node = np.zeros(n, bool)
            node[starts_of(table, keys)] = True
            root = np.arange(n)
            for d in range(DEEPEST, depth - 1, -1):
                cut = node.copy()
                cut[1:] |= (label[1:, :d] != label[:-1, :d]).any(1)
                root = join_alike(root, np.flatnonzero(cut), sig, least)
            u, v = rep[root], rep
            there = u != v
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)[there]), pa.array(np.maximum(u, v)[there])], names=["u", "v"])

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.repartition(n, *keys).sortWithinPartitions(*keys, "label", "rep")
    return dealt.select(*keys, "label", "rep", "sig").mapInArrow(run, "u long, v long")


def stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the components of those given, hardly more than the nodes: each v and its other neighbours are tied to its least one.

    The neighbours are leaders of sets, few and shared by many nodes; a node has one for each task that it was in.
    """
    once = edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    near = once.groupBy("v").agg(F.min("u").alias("u"), F.collect_set("u").alias("all"))
    return near.select("u", F.explode(F.concat(F.array("v"), "all")).alias("v")).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge: the least node of its component, by least neighbours and jumps.

    Nodes with over 1/500 of the edges send their labels by broadcast, so that no task gets all edges of a hub.
    """
    once = staged(stars(edges), "stars")
    both = staged(once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    hubs = staged(heavy_keys(staged(both.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "degrees"), ["v"]).select("v"), "hubs")
    others = both.join(F.broadcast(hubs), "v", "left_anti")
    of_hubs = both.join(F.broadcast(hubs), "v", "left_semi")
    labels = staged(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels")
    while True:
        sent = labels.withColumnRenamed("node", "v")
        seen = others.join(sent, "v").unionByName(of_hubs.join(F.broadcast(sent.join(F.broadcast(hubs), "v")), "v"))
        near = seen.groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", "label", F.least("label", "near").alias("new"))
        ends = labels.select(F.col("node").alias("new"), F.col("label").alias("end"))
        least = F.least("new", F.coalesce("end", "new"))
        labels = staged(step.join(ends, "new", "left").select("node", least.alias("label"), (least < F.col("label")).alias("moved")), "labels")
        if not labels.agg(F.bool_or("moved")).first()[0]:
            return labels.select("node", "label")


# ---- exact


def with_sets(rows: DataFrame, k: int) -> DataFrame:
    """The shingle set (sorted, different, 64 bits each) instead of the text."""
    schema = "comp long, blocks long, rep long, copies long, n int, marks binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column(4)):
                words, tokens = word_hashes(part)
                marks, first, _ = shingles(words, tokens, k)
                sets = [np.unique(marks[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, len(part)) for i in range(4)), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())], names=[x.split()[0] for x in schema.split(", ")])

    return rows.select("comp", "blocks", "rep", "copies", "text").mapInArrow(run, schema)


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right``."""
    if len(left) == 1 and len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    sides = [np.concatenate(x) for x in (left, right)]
    if left is right:
        found, times = np.unique(sides[0], return_counts=True)
        common = found[times > 1]
    else:
        common = np.intersect1d(np.unique(sides[0]), np.unique(sides[1]), assume_unique=True)
    owners, columns = [], []
    for sets, marks in zip((left, right), sides, strict=True):
        at = np.minimum(np.searchsorted(common, marks), max(len(common) - 1, 0))
        there = np.flatnonzero(common[at] == marks) if len(common) else at[:0]
        order = there[np.argsort(at[there], kind="stable")]
        owners.append(np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order])
        columns.append(at[order])
    total = np.zeros((len(left), len(right)))
    for a in range(0, len(common), 8192):
        parts = []
        for sets, owner, column in zip((left, right), owners, columns, strict=True):
            x, y = np.searchsorted(column, [a, a + 8192])
            part = np.zeros((len(sets), min(8192, len(common) - a)), np.float32)
            part[owner[x:y], column[x:y] - a] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    if left is right:
        total[np.arange(len(left)), np.arange(len(left))] = [len(x) for x in left]
    return total.astype(np.int64)


def slices(size: np.ndarray, first: int) -> list[tuple[int, int]]:
    """Ranges of rows from ``first`` on, of at most SLICE_ROWS rows and SLICE_VOLUME elements (or one row)."""
    out, begin, held = [], 0, 0
    for k, n in enumerate(size.tolist()):
        if k > begin and (k - begin >= SLICE_ROWS or held + n > SLICE_VOLUME):
            out.append((first + begin, first + k))
            begin, held = k, 0
        held += n
    return [*out, (first + begin, first + len(size))] if len(size) else out


def links(families: DataFrame, similarity: float) -> DataFrame:
    """(rep, links, root) in each family and pair of blocks: linked documents, copies included, and the least representative linked with."""
    least, keys = Fraction(similarity).limit_denominator(10_000), ["comp", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, 512):
            rep, own, size, copies = (table.column(c).to_numpy() for c in ("rep", "own", "n", "copies"))
            size, n = size.astype(np.int64), table.num_rows
            lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in table.column("marks").chunks for x in c]
            number, root, starts = np.zeros(n, np.int64), np.arange(n), starts_of(table, keys)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
                if lo[a] == hi[a]:
                    own_slices = slices(size[a:b], a)
                    pairs = [(x, y) for k, x in enumerate(own_slices) for y in own_slices[k:]]
                else:
                    cut = a + int(np.searchsorted(own[a:b], hi[a]))
                    pairs = [(x, y) for x in slices(size[a:cut], a) for y in slices(size[cut:b], cut)]
                for (p, q), (r, t) in pairs:
                    left = sets[p:q]
                    both = shared(left, left if p == r else sets[r:t])
                    union = size[p:q, None] + size[None, r:t] - both
                    linked = (both * least.denominator >= union * least.numerator) & (rep[p:q, None] != rep[None, r:t])
                    number[p:q] += linked @ copies[r:t]
                    if p != r:
                        number[r:t] += linked.T @ copies[p:q]
                    i, j = np.nonzero(linked)
                    root = join_sets(root, i + p, j + r)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(number), pa.array(rep[root])], names=["rep", "links", "root"])

    n = int(families.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by range, so that no task gets two of the largest pairs of blocks by chance
    dealt = families.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "own", "rep")
    return dealt.select(*keys, "own", "rep", "copies", "n", "marks").mapInArrow(run, "rep long, links long, root long")


# ---- the join


def with_blocks(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` with the ``blocks`` of their key; keys without a group go. Frequent keys (``n`` rows) by broadcast."""
    hot = F.broadcast(heavy_keys(groups, [key]).drop("n"))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(groups.drop("n"), key))


def families(reps: DataFrame, *, similarity: float, recall: float, block: int) -> DataFrame:
    """(rep, comp): the family of each representative that has candidates, named by its least member."""
    depth = prefix_length(similarity, recall)
    rows, n = tries(reps, depth), F.count(F.lit(1))
    nodes = staged(rows.groupBy("key").agg(n.alias("n")).filter("n > 1").withColumn("blocks", n_blocks(F.col("n"), 2 * block, F.ceil(F.col("n") / NODE_ROWS))), "nodes")
    mates = with_blocks(rows, nodes, "key").join(reps.select("rep", "sig"), "rep")
    edges = staged(candidate_edges(in_blocks(mates, "rep"), least_agreement(similarity), depth), "edges")
    return components(edges).select(F.col("node").alias("rep"), F.col("label").alias("comp"))


def jaccard_classes(docs: DataFrame, *, words: int = 5, similarity: float = 0.8, recall: float = 0.999, block: int = 256) -> DataFrame:
    """A row for each document: doc_id, class_id (least doc_id of its class), n_links (documents linked with it, copies included) and copy_of."""
    sigs = staged(signed(docs.select("doc_id", "text"), words), "signatures")
    usable = sigs.filter("n > 0 and doc_id is not null")
    one = F.min_by(F.struct("doc_id", "t", "n", "sig"), "doc_id").alias("r")
    reps = staged(usable.groupBy("a", "b").agg(one, F.count(F.lit(1)).alias("copies")).select("a", "b", "copies", F.col("r.doc_id").alias("rep"), "r.t", "r.n", "r.sig"), "representatives")
    comps = staged(families(reps, similarity=similarity, recall=recall, block=block).join(reps.select("rep", "t", "n", "copies"), "rep"), "members")
    groups = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("volume"))
    groups = staged(groups.select("comp", "n", n_blocks(F.col("n"), block, F.ceil(F.col("volume") / VOLUME)).alias("blocks")), "families")
    members = with_blocks(comps.drop("n"), groups, "comp")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.xxhash64("text").alias("t"), "text")
    sets = staged(with_sets(texts.join(members, ["rep", "t"]), words), "sets")
    found = staged(links(in_blocks(sets, "rep"), similarity), "links")
    classes = components(found.select(F.col("root").alias("u"), F.col("rep").alias("v")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    both = reps.select("a", "b", "rep", "copies").join(counts, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    result = staged(both.select("a", "b", F.col("rep").alias("copy_of"), F.coalesce("label", "rep").alias("class_id"), n_links.alias("n_links"), F.col("copies").alias("n")), "classes")
    hot = F.broadcast(heavy_keys(result, ["a", "b"]).drop("n"))
    known = usable.join(hot, ["a", "b"]).unionByName(usable.join(hot, ["a", "b"], "left_anti").join(result.drop("n"), ["a", "b"]), allowMissingColumns=False)
    lone = sigs.filter("n = 0 or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("copy_of"))
    return known.select("doc_id", "class_id", "n_links", "copy_of").unionByName(lone)


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its class; rows of null doc_id stay."""
    classes = jaccard_classes(docs, **settings)
    others = classes.filter("doc_id <> class_id").select(F.col("doc_id").alias("__lf_other")).distinct()
    return docs.join(others, F.col("doc_id").cast("long") == F.col("__lf_other"), "left_anti")

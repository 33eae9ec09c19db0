"""Operator 4: n-gram Jaccard join by chosen paths.

Texts are sets of shingles of five words (lower case; a text of one to four words is one shingle).
Equal sets are collapsed first: one number stands for them. Each set has ``COORDS`` min-hash
coordinates, that is, tokens sampled alike from all sets. A run starts with all sets in one node;
a node picks ``BRANCH`` coordinates by a hash of its own path, and a set goes to one
child per coordinate, named after its token there. Children of at most ``LEAF``
sets are leaves; larger ones are split again, up to ``DEPTH`` times, unless a child would hold
half of the node: such sets are alike and the node is a leaf. Two sets of similarity s share
a leaf of a run with probability q(0) = 1, q(d) = 1 - (1 - s q(d-1))^BRANCH at least; runs are repeated until
1 - (1 - q(DEPTH))^runs reaches the target recall.

Leaves are compared by brute force on 8-bit sketches of all coordinates, with a margin of five standard
deviations; a leaf of many sets is compared in pairs of blocks of bounded size. The links of a block are kept
as a spanning forest, those between two blocks as a forest over the trees of either. Each connected component of these candidates is then
verified once on its whole shingle sets, all pairs in blocks, counted where they
are made and never written out: exact links per set and a spanning forest of the true links. So links
are found also between sets that shared no leaf, and copies never multiply rows.

Defined results: a text without words (null, empty) is alone, without links; a null id takes no part (null class, no links);
rows that share an id share a class, though links are those of each row's own text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix, once, shuffle_parts, text_slices, window_hashes, word_keys, word_spans
from tessera.llm.groups import components, local_roots, sorted_groups

SHINGLE = 5
COORDS = 64
BRANCH = 3
DEPTH = 3
LEAF = 1024
BLOCK = 256
_rng = np.random.default_rng(5)
_SALT = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64)
_ODD = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64) | np.uint64(1)


def runs_needed(similarity: float, target: float) -> int:
    """Runs after which a pair at the threshold has shared a leaf with probability ``target``."""
    q = 1.0
    for _ in range(DEPTH):
        q = 1 - (1 - similarity * q) ** BRANCH
    return max(1, math.ceil(math.log(1 - target) / math.log(1 - q)))


def sketch_margin(similarity: float) -> int:
    """Fewest equal sketch bytes of a pair at the threshold, five standard deviations below the mean."""
    return math.floor(COORDS * similarity - 5 * math.sqrt(COORDS * similarity * (1 - similarity)))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slice, row after row (with repeats), and each row's range."""
    starts, ends, first = word_spans(data, offsets)
    words = word_keys(data, starts, ends)
    grams, at = window_hashes(words, first, SHINGLE)
    count = np.diff(first)
    bounds = np.searchsorted(at, first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if not len(short):
        return grams, bounds
    whole = np.zeros(len(short), np.uint64)
    for k, r in enumerate(short):
        g, _ = window_hashes(words[first[r]:first[r + 1]], np.array([0, count[r]]), int(count[r]))
        whole[k] = g[0] + np.uint64(count[r])
    grams = np.insert(grams, bounds[short], whole)
    extra = np.zeros(len(count), np.int64)
    extra[short] = 1
    return grams, bounds + np.concatenate([[0], np.cumsum(extra)])


def _signature_batches(batches, roots: list[list[int]]):
    for b in batches:
        n_rows = b.num_rows
        size = np.zeros(n_rows, np.int64)
        key = np.zeros((2, n_rows), np.uint64)
        low = np.zeros((COORDS, n_rows), np.uint64)
        for i, j, data, offsets in text_slices(b.column(1)):
            grams, bounds = shingle_hashes(data, offsets)
            some = np.flatnonzero(np.diff(bounds)) + i
            at = bounds[:-1][some - i]
            for r in some:
                u = np.unique(grams[bounds[r - i]:bounds[r - i + 1]])
                size[r] = len(u)
                key[0, r] = mix(u).sum()
                key[1, r] = mix(u * np.uint64(0xD6E8FEB86659FD93)).sum()
            if len(some):
                for c in range(COORDS):
                    low[c, some] = np.minimum.reduceat((grams ^ _SALT[c]) * _ODD[c], at)
        token = mix(low)
        sketch = np.ascontiguousarray((token & np.uint64(255)).astype(np.uint8).T)
        nodes = np.stack([mix(token[c] + np.uint64(1 + run * 1000 + c)) for run, cs in enumerate(roots) for c in cs], 1)
        width = nodes.shape[1]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(size), pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)),
             pa.ListArray.from_arrays(np.arange(n_rows + 1, dtype=np.int32) * width,
                                      pa.array(nodes.reshape(-1).view(np.int64))),
             pa.array([s.tobytes() for s in sketch], pa.binary()), b.column(2)],
            ["id", "size", "k1", "k2", "nodes", "sketch", "print"])


def signatures(docs: DataFrame, runs: int) -> DataFrame:
    """(id, size, k1, k2, nodes, sketch, print) of (id, text, print): the set's size and key, its children of the roots."""
    order = np.random.default_rng(17).permutation(COORDS)
    roots = [[int(order[(r * BRANCH + j) % COORDS]) for j in range(BRANCH)] for r in range(runs)]
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(lambda it: _signature_batches(it, roots),
                           f"id {kind}, size long, k1 long, k2 long, nodes array<long>, sketch binary, print long")


def _forest(reps: np.ndarray, linked: np.ndarray, mine: np.ndarray, one_block: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges (set, least set of its tree). Of two blocks, only those that join trees of either."""
    if one_block:
        root = reps[local_roots(linked)]
        tied = root != reps
        return reps[tied], root[tied]
    tree = local_roots(linked & (mine[:, None] == mine[None]))
    parts, member = np.unique(tree, return_inverse=True)
    between = np.zeros((len(parts), len(parts)), bool)
    x, y = np.nonzero(linked & (mine[:, None] != mine[None]))
    between[member[x], member[y]] = True
    root = local_roots(between)
    tied = root != np.arange(len(parts))
    return reps[parts[tied]], reps[parts[root[tied]]]


def _leaf_links(batches, margin: int):
    """Forest edges (a, b) of each pair of blocks of a leaf."""
    for t in sorted_groups(batches, 3):
        reps, mine = t.column("rep").to_numpy(), t.column("mine").to_numpy()
        sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(reps), COORDS)
        order = np.argsort(reps, kind="stable")
        reps, mine, sk = reps[order], mine[order], sk[order]
        near = np.zeros((len(reps), len(reps)), bool)
        for i in range(0, len(reps), 64):
            near[i:i + 64] = (sk[i:i + 64, None] == sk[None]).sum(2, dtype=np.int16) >= margin
        a, b = _forest(reps, near, mine, t.column("p")[0] == t.column("q")[0])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _in_blocks(rows: DataFrame, key: str, item: str, size: str, block: int) -> DataFrame:
    """Each row once per pair of blocks of its group that it belongs to: (key, p, q, ..., mine)."""
    blocks = F.ceil(F.col(size) / block).cast("long")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64(item), blocks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return rows.withColumn("p", F.least("mine", "other")).withColumn("q", F.greatest("mine", "other")).drop("other")


def _leaves(level: DataFrame, sketches: DataFrame) -> DataFrame:
    """(node, rep, count) of the leaves under the nodes (rep, node)."""
    sizes = level.groupBy("node").count().where("count > 1")
    sized = once(level.join(sizes, "node").select("node", "rep", "count"))
    leaves = sized.where(F.col("count") <= LEAF)
    rest = sized.where(F.col("count") > LEAF)
    for depth in range(2, DEPTH + 1):
        if rest.isEmpty():
            return leaves
        coords = F.array(*(F.pmod(F.xxhash64("node", F.lit(j)), F.lit(COORDS)).cast("int") for j in range(BRANCH)))
        below = (rest.join(sketches, "rep").withColumn("c", F.explode(coords))
                 .select("rep", F.expr("xxhash64(node, c, substring(sketch, c + 1, 1))").alias("child"),
                         F.col("node").alias("parent"), F.col("count").alias("of")))
        sizes = below.groupBy("child", "parent", "of").count()
        stuck = once(sizes.where(F.col("count") * 2 >= F.col("of")).select(F.col("parent").alias("node")).distinct())
        leaves = leaves.unionByName(rest.join(stuck, "node", "left_semi"))
        split = below.join(stuck, F.col("parent") == stuck.node, "left_anti").join(
            sizes.where("count > 1").select("child", "count"), "child")
        split = once(split.select(F.col("child").alias("node"), "rep", "count").distinct())
        leaves = leaves.unionByName(split.where(F.col("count") <= LEAF))
        rest = split.where(F.col("count") > LEAF)
    return leaves.unionByName(rest)


def candidate_links(sets: DataFrame, similarity: float) -> DataFrame:
    """Forest edges (a, b) of the sets (rep, nodes, sketch) whose sketches agree in a leaf of some run."""
    sketches, margin = sets.select("rep", "sketch"), sketch_margin(similarity)
    leaves = _leaves(sets.select("rep", F.explode("nodes").alias("node")), sketches)
    rows = _in_blocks(leaves, "node", "rep", "count", LEAF).join(sketches, "rep")
    rows = (rows.select("node", "p", "q", "rep", "mine", "sketch")
            .repartition(shuffle_parts(sets), "node", "p", "q").sortWithinPartitions("node", "p", "q"))
    return once(rows.mapInArrow(lambda it: _leaf_links(it, margin), "a long, b long"))


def _set_batches(batches):
    for b in batches:
        out = []
        for _, _, data, offsets in text_slices(b.column(b.schema.get_field_index("text"))):
            grams, bounds = shingle_hashes(data, offsets)
            out += [np.unique(grams[x:y]).tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
        keep = [i for i, n in enumerate(b.schema.names) if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(out, pa.binary())],
                                         [*(b.schema.names[i] for i in keep), "grams"])


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from tokens that more than one set has."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    token, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[inverse] > 1
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[inverse[shared]]
    total = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [c, c + width])
        part = np.zeros((n, min(width, int(column[-1]) + 1 - c)), np.float32)
        part[owner[i:j], column[i:j] - c] = 1
        total += part @ part.T
    return total


def _verify(batches, similarity: float):
    """Per group: (rep, weight of the sets it links to) with b null, and forest edges with n null."""
    for t in sorted_groups(batches, 3):
        reps, weight = t.column("rep").to_numpy(), t.column("weight").to_numpy()
        mine = t.column("mine").to_numpy()
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
        order = np.argsort(reps, kind="stable")
        reps, weight, mine = reps[order], weight[order], mine[order]
        sets = [sets[i] for i in order]
        size = np.array([len(s) for s in sets], np.float32)
        both = _intersections(sets)
        linked = both >= similarity * (size[:, None] + size[None] - both) - 1e-3
        np.fill_diagonal(linked, False)
        a, b = _forest(reps, linked, mine, p == q)
        # links inside a block are counted where it meets itself
        links = (linked if p == q else linked & (mine[:, None] != mine[None])) @ weight
        hit = np.flatnonzero(links)
        if len(hit):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([reps[hit], a])),
                 pa.array([None] * len(hit) + b.tolist(), pa.int64()),
                 pa.array(links[hit].tolist() + [None] * len(a), pa.int64())], ["a", "b", "n"])


def _print(text) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.lower(text))


def _least_ids(groups: DataFrame, tree: DataFrame) -> DataFrame:
    """(rep, root, id) of the sets in the classes of ``tree``: the least id of the class."""
    members = tree.select(F.col("a").alias("rep"), F.col("b").alias("root")) \
        .unionByName(tree.select(F.col("b").alias("rep"), F.col("b").alias("root")).distinct())
    least = members.join(groups.select("rep", "least"), "rep").groupBy("root").agg(F.min("least").alias("id"))
    return members.join(least, "root").select("rep", "root", "id")


def _shared_ids(some: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Edges (a, b) between the sets of each id that has several; None without such ids."""
    key = F.struct("k1", "k2")
    again = once(some.groupBy("id").agg(F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high").select("id"))
    if again.isEmpty():
        return None
    own = once(some.join(again, "id").select("id", "k1", "k2").distinct().join(groups.select("k1", "k2", "rep"), ["k1", "k2"]).select("id", "rep"))
    first = own.groupBy("id").agg(F.min("rep").alias("b"))
    return own.join(first, "id").where("rep <> b").select(F.col("rep").alias("a"), "b")


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, recall: float) -> DataFrame:
    """(id, print, root, least, class_id, n_links) of every row: ``root`` names the class of its text and ``least``
    is the least id there; ``class_id`` is that of the classes that shared ids join."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.lower(text_col).alias("text"), _print(text_col).alias("print"))
    runs = runs_needed(similarity, recall)
    rows = once(signatures(docs, runs))
    some = rows.where("size > 0 AND id IS NOT NULL")
    groups = some.groupBy("k1", "k2").agg(F.min(F.struct("id", "print")).alias("first"), F.count(F.lit(1)).alias("weight"))
    groups = once(groups.select("k1", "k2", F.col("first.id").alias("least"), F.col("first.print").alias("seal"), "weight",
                                F.monotonically_increasing_id().alias("rep")))
    heads = groups.withColumnsRenamed({"k1": "g1", "k2": "g2"})
    sets = some.join(heads, F.expr("id = least AND print = seal AND k1 = g1 AND k2 = g2")) \
        .select("rep", "weight", "least", "seal", "nodes", "sketch").dropDuplicates(["rep"])
    sets = once(sets)
    tree = components(candidate_links(sets, similarity))
    members = tree.select(F.col("a").alias("rep"), F.col("b").alias("comp")) \
        .unionByName(tree.select(F.col("b").alias("rep"), F.col("b").alias("comp")).distinct())
    sizes = members.groupBy("comp").count()
    members = members.join(sizes, "comp").join(sets.select("rep", "weight", "least", "seal"), "rep")
    texts = docs.join(members, F.expr("id = least AND print = seal")).dropDuplicates(["least", "seal", "rep"])
    kinds = "rep long, comp long, count long, weight long, grams binary"
    grams = texts.select("rep", "comp", "count", "weight", "text").mapInArrow(_set_batches, kinds)
    blocks = _in_blocks(grams, "comp", "rep", "count", BLOCK).select("comp", "p", "q", "rep", "weight", "mine", "grams")
    blocks = blocks.repartition(shuffle_parts(docs), "comp", "p", "q").sortWithinPartitions("comp", "p", "q")
    found = once(blocks.mapInArrow(lambda it: _verify(it, similarity), "a long, b long, n long"))
    links = found.where("n IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    edges = found.where("b IS NOT NULL").select("a", "b")
    per_set = groups.join(links, "rep", "left").join(_least_ids(groups, components(edges)), "rep", "left").select(
        "k1", "k2", "rep", F.coalesce("root", "rep").alias("root"), F.coalesce("id", "least").alias("least"),
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    shared = _shared_ids(some, groups)
    if shared is None:
        per_set = per_set.drop("rep").withColumn("class_id", F.col("least"))
    else:
        joined = _least_ids(groups, components(edges.unionByName(shared))).select("rep", F.col("id").alias("class_id"))
        per_set = per_set.join(joined, "rep", "left").drop("rep").withColumn("class_id", F.coalesce("class_id", "least"))
    nothing = F.lit(0).cast("long")
    return (rows.select("id", "print", "size", F.when(F.col("id").isNotNull(), F.col("k1")).alias("k1"), "k2")
            .join(per_set, ["k1", "k2"], "left")
            .select("id", "print", F.when(F.col("size") > 0, F.col("root")).alias("root"),
                    *(F.when(F.col("size") > 0, F.col(c)).otherwise(F.col("id")).alias(c) for c in ("least", "class_id")),
                    F.when(F.col("size") > 0, F.coalesce("n_links", nothing)).otherwise(nothing).alias("n_links")))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 similarity: float = 0.8, recall: float = 0.99999) -> DataFrame:
    """(id, class_id, n_links) of every row: the least id of its class, and the rows it is linked to."""
    found = _classes(docs, id_col, text_col, similarity, recall)
    return found.select(F.col("id").alias(id_col), "class_id", "n_links")


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8,
                  recall: float = 0.99999) -> DataFrame:
    """The rows of ``docs`` without those whose text's class has a smaller id; of the rows that repeat an id in a
    class one stays. Unlike texts of one id are in classes of their own here, so each is judged by its own text.

    Rows with a null id all stay.
    """
    found = once(_classes(docs, id_col, text_col, similarity, recall).where(F.col("id").isNotNull())
                 .select(F.col("id").alias("i"), F.col("print").alias("p"), "root", "least"))
    row = (F.col(id_col).cast("long") == F.col("i")) & (_print(text_col) == F.col("p"))
    left = docs.join(found.where("least <> i").select("i", "p").distinct(), row, "left_anti")
    again = once(found.where("least = i").groupBy("i", "root").count().where("count > 1").select("i").distinct())
    if again.isEmpty():
        return left.select(docs.columns)
    same = F.col(id_col).cast("long") == F.col("i")
    single = left.join(again, same, "left_anti").select(docs.columns)
    roots = found.join(again, "i", "left_semi").select("i", "p", "root").distinct()
    return single.unionByName(left.join(roots, row).dropDuplicates(["i", "root"]).select(docs.columns))

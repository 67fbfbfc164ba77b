"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

A text is the set of its runs of five successive words (all its words, if it has fewer). Distinct texts
get a path of ``max_depth`` minimum hashes in each of ``trees`` prefix tries. Texts without a partner at the
shortest prefix that the target could ever need (at which a pair at the threshold itself meets with
probability ``recall``) leave at once; the tries of the others are kept. The rounds start at whole paths and
shorten matched prefixes level by level, at the nodes of a trie that branch there: pairs that meet for the
first time are verified. After each round the links found tell how many are missed: a text whose least
similar link has similarity s meets such a partner with probability 1 - (1 - s^depth)^trees, and a text
counts as many times as the inverse says. Rounds end when that estimate of the recall reaches the target,
at the shortest prefix at the latest.

A pair is verified at one place. Places are connected groups of candidates, whose blocks of texts are
compared block by block; where a group is only chained together, so that this would send more texts, its
shared prefixes are places of their own, the large ones split into blocks too, and a pair belongs to the
first tree in which it meets. Intersections come from products of sparse incidence matrices, so that each
pair is decided exactly. No row is made for a pair; blocks return counts of links, the least similar link
and the ties of a spanning forest.

Defined results: copies of a text count as one text, whose links they share; a null text or one without
a word has no link and forms a class with its copies only; a null or repeated id changes nothing. The
class id is the smallest id in the class (null if all are, when class_key still tells classes apart). Only
the named columns are used, so that others never clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obswatch.llm.common import components, drop_written, grouped, runs, settle, ship, sieve, sifted, table, written

WORDS, THRESHOLD = 5, 0.8
TREES, MAX_DEPTH, RECALL = 24, 8, 0.9995
#: Texts, and about as many bytes, in a block of verification.
BLOCK, BLOCK_BYTES = 256, 32 << 20
#: Similarities are counted in so many steps for each hundredth.
STEPS = 1

_ODD = np.uint64(0x9E3779B97F4A7C15)


def shortest_depth(threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, max_depth at most, at which even pairs at the threshold itself meet as often as asked."""
    depth = max_depth
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed shingle sets; remembers the hashes of words, of a bounded number of them."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        h = _mix(h)
        k = min(self.words, len(words))
        out = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
        for i in range(k):
            out = _mix(out * _ODD + h[i : len(h) - k + 1 + i])
        return np.unique(out)


def paths(shingles: np.ndarray, trees: int, depth: int, seeds: np.ndarray) -> np.ndarray:
    """The path in each tree: depth minimum hashes of four bytes."""
    low = np.full(trees * depth, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    for a in range(0, len(shingles), 512):
        x = shingles[a : a + 512, None] * seeds[0] + seeds[1]
        np.minimum(low, x.min(0), out=low)
    return (_mix(low) >> np.uint64(32)).astype(">u4")


def _seeds(n: int) -> np.ndarray:
    draw = np.random.default_rng(77)
    return np.stack([draw.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, n, np.uint64)])


def signed(docs: DataFrame, key: str, text: str, trees: int, depth: int) -> DataFrame:
    """key, node (md5 of the text), its bytes and its paths, of every row; no paths without a word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        shingle, seeds, names = Shingler(), _seeds(trees * depth), ["key", "node", "size", "paths"]
        for b in batches:
            texts = b.column(3).to_pylist()
            for x, y in runs(texts):
                sets = [shingle(t) for t in texts[x:y]]
                found = [paths(s, trees, depth, seeds).tobytes() for s in sets if len(s)]
                many = trees * len(found)
                flat = pa.Array.from_buffers(pa.binary(), many, [None, pa.py_buffer(np.arange(0, 4 * depth * many + 1, 4 * depth, dtype=np.int32)), pa.py_buffer(b"".join(found))])
                at = np.concatenate([[0], np.cumsum([trees * (len(s) > 0) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(x, y - x) for i in range(3)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat)], names=names)

    rows = docs.select(F.col(key).alias("key"), _node(text).alias("node"), F.coalesce(F.octet_length(text), F.lit(0)).alias("size"), F.col(text).alias("text"))
    return rows.mapInArrow(task, f"key {docs.schema[key].dataType.simpleString()}, node string, size int, paths array<binary>")


def _node(text: str):
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets; wanted says which cells matter."""
    out = np.zeros((len(left), len(right)), np.int32)
    rows, cols = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
    if not len(rows):
        return out
    if wanted.sum() * 8 < len(rows) * len(cols):  # few pairs, far apart
        for i, j in zip(*np.nonzero(wanted), strict=True):
            small, large = sorted((left[i], right[j]), key=len)
            at = np.searchsorted(large, small)
            at[at == len(large)] = 0
            out[i, j] = int((large[at] == small).sum())
        return out
    a, b = np.concatenate([left[i] for i in rows]), np.concatenate([right[j] for j in cols])
    both = np.intersect1d(a, b)
    of_a, of_b = np.repeat(np.arange(len(rows)), [len(left[i]) for i in rows]), np.repeat(np.arange(len(cols)), [len(right[j]) for j in cols])
    at_a, at_b = np.searchsorted(both, a), np.searchsorted(both, b)
    ok_a = at_a < len(both)
    ok_a[ok_a] = both[at_a[ok_a]] == a[ok_a]
    ok_b = at_b < len(both)
    ok_b[ok_b] = both[at_b[ok_b]] == b[ok_b]
    at_a, of_a, at_b, of_b = at_a[ok_a], of_a[ok_a], at_b[ok_b], of_b[ok_b]
    total = np.zeros((len(rows), len(cols)), np.float32)
    step = 8192
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    at_a, of_a, at_b, of_b = at_a[order_a], of_a[order_a], at_b[order_b], of_b[order_b]
    for c in range(0, len(both), step):
        (p, q), (r, s) = np.searchsorted(at_a, [c, c + step]), np.searchsorted(at_b, [c, c + step])
        width = min(step, len(both) - c)
        x, y = np.zeros((len(rows), width), np.float32), np.zeros((len(cols), width), np.float32)
        x[of_a[p:q], at_a[p:q] - c] = 1
        y[of_b[r:s], at_b[r:s] - c] = 1
        total += x @ y.T
    out[np.ix_(rows, cols)] = total.astype(np.int32)
    return out


def _share(left: np.ndarray, right: np.ndarray, trees: range) -> np.ndarray:
    out = np.zeros((len(left), len(right)), bool)
    for t in trees:
        out |= left[:, t, None] == right[None, :, t]
    return out


def _similar(left: tuple, right: tuple, threshold: float, same: bool, tree: int) -> np.ndarray:
    """Similarities of the pairs of two blocks (shingle sets, labels, labels one level down) that are to be
    decided here and reach the threshold; 0 elsewhere."""
    every = range(left[1].shape[1])
    if tree < 0:
        wanted = _share(left[1], right[1], every)
    else:  # all meet in this tree; those that meet in an earlier one are decided there
        wanted = ~_share(left[1], right[1], every[:tree])
    if left[2].size:
        wanted &= ~_share(left[2], right[2], every)
    size_a, size_b = np.array([len(s) for s in left[0]]), np.array([len(s) for s in right[0]])
    wanted &= np.minimum.outer(size_a, size_b) >= threshold * np.maximum.outer(size_a, size_b) - 1e-9
    if same:
        wanted &= ~np.eye(len(wanted), dtype=bool)
    common = _overlaps(left[0], right[0], wanted)
    union = size_a[:, None] + size_b[None, :] - common
    return np.where(wanted & (common * 1.0 >= threshold * union - 1e-9), common / np.maximum(union, 1), 0.0)


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((int(i), int(j)))
    return kept


def verify(dealt: DataFrame, threshold: float) -> DataFrame:
    """From rows (place, tree, i, j, side, node, labels, deeper, text), one place and block pair each: (node, links, least, tie).

    Rows with a tie say that two nodes are linked; the others count links of a node and have its least similarity.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        shingle = Shingler()
        for (_, tree, i, j), data in grouped(batches, ["place", "tree", "i", "j"]):
            blocks = {}
            for side in (i,) if i == j else (i, j):
                at = {n: x for x, (n, b) in enumerate(zip(data["node"], data["side"], strict=True)) if b == side}
                if at:
                    names = sorted(at)
                    labels, deeper = (np.array([data[c][at[n]] for n in names], np.int64).reshape(len(names), -1) for c in ("labels", "deeper"))
                    blocks[side] = ([shingle(data["text"][at[n]]) for n in names], labels, deeper, names)
            if i not in blocks or j not in blocks:
                continue
            a, b = blocks[i], blocks[j]
            near = _similar(a, b, threshold, i == j, tree)
            hit = near > 0
            links, least = Counter(), {}
            for names, axis in ((a[3], 1), (b[3], 0))[: 1 if i == j else 2]:
                for n, c, s in zip(names, hit.sum(axis), np.where(hit, near, 2.0).min(axis), strict=True):
                    if c:
                        links[n], least[n] = int(c), float(s)
            shift = 0 if i == j else len(a[3])
            pairs = np.argwhere(np.triu(hit) if i == j else hit) + [0, shift]
            names = a[3] + (b[3] if i != j else [])
            ties = [sorted((names[x], names[y])) for x, y in _forest(pairs, len(names))]
            nodes = [*links, *(x for x, _ in ties)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.string()), pa.array([*links.values(), *[0] * len(ties)], pa.int64()), pa.array([least.get(n) if k < len(links) else None for k, n in enumerate(nodes)], pa.float64()), pa.array([None] * len(links) + [y for _, y in ties], pa.string())],
                names=["node", "links", "least", "tie"],
            )

    return dealt.mapInArrow(task, FOUND)


FOUND = "node string, links long, least double, tie string"


def _labels(depth: int) -> Column:
    """One label for each tree: its number and the first levels of the path."""
    return F.transform("paths", lambda p, i: F.xxhash64(i, F.substring(p, 1, 4 * depth)))


def _blocks(n: Column, size: Column, block: int) -> Column:
    return F.ceil(F.greatest(n / block, size / BLOCK_BYTES, F.lit(1))).cast("int")


def meetings(forest: DataFrame, depth: int, whole: int, block: int) -> DataFrame:
    """Where the texts of the forest that share a prefix of this length, but not in that tree a longer one, are
    compared: rows (place, tree, i, j, side, node); tree is -1 where a place is a connected group."""
    each = forest.select("place", "node", "size", F.posexplode(_labels(depth)).alias("tree", "label"), _labels(depth + 1).alias("deeper")).withColumn("deep", F.expr("deeper[tree]")).drop("deeper")
    branches = F.lit(True) if depth == whole else F.min("deep") != F.max("deep")
    groups = each.groupBy("label").agg(F.first("place").alias("place"), F.first("tree").alias("tree"), F.count("*").alias("n"), F.sum("size").alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("print"), branches.alias("branches"))
    groups = groups.where("n > 1 and branches").withColumn("blocks", _blocks(F.col("n"), F.col("bytes"), block)).drop("branches", "bytes")
    groups = written(groups)
    # prefixes of the same texts: one of them will do
    first = groups.groupBy("place", "n", "print").agg(F.min(F.struct("tree", "label", "blocks")).alias("g")).select("place", "n", "g.*")
    active = written(each.join(groups.select("label"), "label", "left_semi").select("place", "node", "size").distinct())
    chained = first.groupBy("place").agg(F.sum(F.col("n") * F.col("blocks")).alias("sent"))
    sizes = active.groupBy("place").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).withColumn("blocks", _blocks(F.col("n"), F.col("bytes"), block)).join(chained, "place")
    sizes = written(sizes.withColumn("apart", F.col("sent") < F.col("n") * F.col("blocks")).select("place", "blocks", "apart"))
    together = active.join(sizes.where("not apart").select("place", "blocks"), "place").select(F.col("place"), F.lit(-1).alias("tree"), "node", "blocks")
    own = first.join(sizes.where("apart").select("place"), "place", "left_semi").select("label", "blocks")
    apart = each.join(own, "label").select(F.col("label").cast("string").alias("place"), "tree", "node", "blocks")
    spots = together.unionByName(apart).withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # every pair of blocks is one group; a text goes to as many groups as its place has blocks
    spots = spots.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spots.select("place", "tree", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node")


def recall_estimate(least: dict[int, int], depth: int, trees: int) -> float:
    """The share of texts whose least similar link was to be met, from counts of texts by that similarity's step."""
    found = sum(least.values())
    asked = sum(n / max(1e-9, 1 - (1 - min(1.0, step / (100 * STEPS)) ** depth) ** trees) for step, n in least.items())
    return found / asked if found else 1.0


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """For every row: key, node, class_key (a node that names the class), class_id and n_links, the number of other texts it is linked to."""
    floor = shortest_depth(threshold, trees, max_depth, recall)
    rows = written(signed(docs, key, text, trees, max_depth))
    short = rows.select("node", F.explode(_labels(floor)).alias("label")).withColumn("h", F.xxhash64("node"))
    shared = written(short.groupBy("label").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("label"))
    # ties to the head of each shared prefix; connected, they are the places
    some = sieve(shared, "label")
    met = written(sifted(short, "label", some).join(shared, "label").select("label", "node").distinct())
    heads = written(met.groupBy("label").agg(F.min("node").alias("head")))
    places = written(components(met.join(heads, "label").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))))
    texts = docs.select(_node(text).alias("node"), F.coalesce(F.octet_length(text), F.lit(0)).alias("size"), F.col(text).alias("text"))
    placed = sieve(places, "node")
    texts = written(sifted(texts, "node", placed).join(places.select("node"), "node", "left_semi").dropDuplicates(["node"]))
    lanes = sifted(rows, "node", placed).join(places.select("node"), "node", "left_semi").groupBy("node").agg(F.first("paths").alias("paths"))
    forest = written(texts.select("node", "size").join(places.select("node", F.col("root").alias("place")), "node").join(lanes, "node"))
    done = [some, placed, shared, met, heads, places, texts, forest]
    found = rows.sparkSession.createDataFrame([], FOUND)
    for depth in range(max_depth, floor - 1, -1):
        spots = meetings(forest, depth, max_depth, block)
        sides = forest.select("node", _labels(depth).alias("labels"), (_labels(depth + 1) if depth < max_depth else F.array().cast("array<long>")).alias("deeper"))
        dealt = spots.join(sides, "node").join(texts.select("node", "text"), "node").select("place", "tree", "i", "j", "side", "node", "labels", "deeper", "text")
        more = written(verify(dealt.repartition("place", "tree", "i", "j").sortWithinPartitions("place", "tree", "i", "j"), threshold))
        done.append(more)
        found = found.unionByName(more)
        lows = found.where("tie is null").groupBy("node").agg(F.min("least").alias("least"))
        steps = {r["step"]: r["n"] for r in lows.groupBy(F.floor(F.col("least") * 100 * STEPS + 1e-6).alias("step")).agg(F.count("*").alias("n")).collect()}  # a hundred rows at most
        if recall_estimate(steps, depth, trees) >= recall:
            break
    links = written(found.where("tie is null").groupBy("node").agg(F.sum("links").alias("n_links")))
    roots = components(found.where("tie is not null").select(F.col("node").alias("a"), F.col("tie").alias("b")))
    for x in done:
        drop_written(x)
    return _classes(rows, roots, links)


def _classes(rows: DataFrame, roots: DataFrame, links: DataFrame) -> DataFrame:
    """Each row's class id. Copies and classes are summed up before they meet the rows again."""
    firsts = rows.groupBy("node").agg(F.min("key").alias("first"))
    per_node = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = per_node.groupBy("root").agg(F.min("first").alias("class_id"))
    facts = written(per_node.join(ids, "root").join(links, "node", "left").select("node", F.col("root").alias("class_key"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return rows.select("key", "node").join(facts, "node")  # both from files, so that a text of many copies can be split


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return join(docs).select(F.col("key").alias("doc_id"), "class_id", "n_links", "class_key")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: that with the smallest id, of equals the smallest md5 of the text.

    Rows that repeat that id with the same text are one document, of which one row stays. Null and empty
    texts are a class of their own; an empty table stays empty; columns of any name pass through unchanged.
    """
    ship(spark)
    found = written(join(docs).select("key", "node", "class_key", "class_id"))
    keep = found.where("key <=> class_id").groupBy("class_key").agg(F.min("node").alias("node"), F.first("key").alias("key")).select("key", "node")
    gone = written(found.join(keep, found["key"].eqNullSafe(keep["key"]) & (found["node"] == keep["node"]), "left_anti").select(F.col("key").alias("gone_key"), F.col("node").alias("gone_node")).distinct())
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("key"), _node("text").alias("node"))
    # texts that surely stay aren't shuffled
    left = sieve(gone, "gone_node")
    doubtful = sifted(packed, "node", left)
    kept = doubtful.join(gone, doubtful["key"].eqNullSafe(gone["gone_key"]) & (doubtful["node"] == gone["gone_node"]), "left_anti").unionByName(sifted(packed, "node", left, through=False))
    if not found.groupBy("key", "node").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["key", "node"])
    return kept.select("row.*")

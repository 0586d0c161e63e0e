"""Near-duplicates by ProbMinHash signatures, banding and exact verification.

Words are lower-cased runs of letters, digits and underscores; shingles are five
words (all words of a shorter text), weighted by their count. Two texts are
near-duplicates if the probability Jaccard similarity of their weighted shingles
is at least 0.8 (for sets of shingles that is the Jaccard similarity).

1. One narrow pass computes a 128-bit key of the word sequence and the ProbMinHash
   signature: every shingle is a Poisson process with its weight as rate; its
   arrivals fall on random registers, and a register keeps the shingle with the
   earliest. A text's shingles are dropped once they arrive after its latest
   register (early termination). All texts of a batch run at once.
2. Texts with equal words collapse to one node. Bands of registers make buckets.
   In each bucket every node is paired with the bucket's hub, so pairs grow with
   the members, not with their square. The hub is the node with the largest sum of
   its buckets' sizes: an original shares more buckets with its edited copies than
   these share with each other.
3. Pairs are verified on the texts themselves. Links make components.
4. A bucket of three or more nodes that still lie in different components may hide
   links between members that its hub does not resemble. Such buckets are compared
   in blocks of bounded size: a task holds the shingles of two blocks, compares a
   node with all nodes of other components at once, and returns only links that
   join components. No pair is ever a row.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Memo, kept, renamed, sliced, staged, table, without_ids

WORDS = re.compile(r"\w+")
SHINGLE, REGISTERS, ROWS, SIMILARITY = 5, 120, 5, 0.8
BATCH_SHINGLES, BLOCK, CHUNK = 200_000, 512, 256


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hash(w: str) -> int:
    return int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Shingler:
    """Weighted shingles of texts; word hashes are memoised."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.hashes = size, Memo(word_hash, 150_000)

    def words(self, text: str | None) -> np.ndarray:
        w = WORDS.findall((text or "").lower())
        return np.fromiter(map(self.hashes.__getitem__, w), np.uint64, len(w))

    def shingles(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes, ascending, and their counts."""
        k = min(self.size, len(words))
        if not k:
            return words, np.zeros(0)
        h = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[j : len(words) - k + 1 + j])
        u, n = np.unique(h, return_counts=True)
        return u, n.astype(float)


def shingler(size: int = SHINGLE) -> Shingler:
    return kept(("shingler", size), lambda: Shingler(size))


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (n × m) of n sets; ``owner`` names each element's."""
    first, sig = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    active, at, latest, turn = np.arange(len(elements)), np.zeros(len(elements)), np.full(n, np.inf), 0
    while len(active):
        e = elements[active]
        draw = mixed(e + np.uint64((0x632BE59BD9B4E019 * (2 * turn + 1)) & 0xFFFFFFFFFFFFFFFF))
        u = ((draw >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        at[active] -= np.log(u) / weights[active]
        stay = at[active] < latest[owner[active]]
        active, e = active[stay], e[stay]
        if not len(active):
            break
        slot = owner[active] * m + (mixed(e ^ np.uint64((0xD1342543DE82EF95 * (turn + 1)) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(m)).astype(np.int64)
        t = at[active]
        np.minimum.at(first, slot, t)
        won = first[slot] == t
        sig[slot[won]] = e[won]
        latest, turn = first.reshape(n, m).max(axis=1), turn + 1
    return sig.reshape(n, m)


def probability_jaccard(a, b) -> float:
    """Exact, of two (ascending hashes, weights) pairs; two empty ones: 0."""
    (ha, wa), (hb, wb) = a, b
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    xa, xb = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - xa.sum(), wb.sum() - xb.sum()
    if (xa == 1).all() and (xb == 1).all():
        return len(both) / (len(both) + only_a + only_b)
    pairs, n = np.unique(np.stack([xa, xb]), axis=1, return_counts=True)
    total = 0.0
    for (p, q), k in zip(pairs.T, n):
        total += k / (np.maximum(pairs[0] / p, pairs[1] / q) @ n + only_a / p + only_b / q)
    return float(total)


def sign(docs: DataFrame, m: int = REGISTERS, rows: int = ROWS) -> DataFrame:
    """doc_id, node (key of the word sequence; null without words), bands."""

    def run(batches):
        sh = shingler()
        for b in sliced(batches, 1):
            ids, texts = b.column(0), b.column(1)
            start = 0
            while start < len(ids):
                keys, parts, total, k = [], [], 0, start
                while k < len(ids) and total < BATCH_SHINGLES and k - start < 1000:
                    w = sh.words(texts[k].as_py())
                    keys.append(hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None)
                    parts.append(sh.shingles(w))
                    total += len(parts[-1][0])
                    k += 1
                n = k - start
                owner = np.repeat(np.arange(n), [len(p[0]) for p in parts])
                sig = signatures(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), owner, n, m)
                band = np.zeros((n, m // rows), np.uint64)
                for j in range(rows):
                    band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, j::rows][:, : m // rows])
                band = mixed(band + np.arange(m // rows, dtype=np.uint64)).view(np.int64)
                flat = pa.array(band.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * (m // rows), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([ids.slice(start, n), pa.array(keys, pa.binary()), lists], ["doc_id", "node", "bands"])
                start = k

    src = docs.select("doc_id", docs["text"].cast("string"))
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, node binary, bands array<long>")


def node_texts(need: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``need``. ``nodes`` names a document of each; a
    repeated id may have other texts, which are told apart by the node key."""
    need = staged(need.distinct().join(nodes.select("node", F.col("rep").alias("__rep")), "node"), "near-need")
    texts = docs.select(F.col("doc_id").alias("__id"), docs["text"].cast("string").alias("__text"))
    ids = need.select("__rep").distinct()

    def run(batches):
        sh = shingler()
        for b in batches:
            keys, seen = [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = sh.words(t)
                keys.append(k)
                seen.append(hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None)
            same = pa.array([a == s for a, s in zip(keys, seen)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["node", "text"]).filter(same)

    found = texts.join(ids, texts["__id"].eqNullSafe(ids["__rep"]), "left_semi")
    found = need.join(found, need["__rep"].eqNullSafe(found["__id"])).select("node", F.col("__text").alias("text"))
    return found.mapInArrow(run, "node binary, text string").groupBy("node").agg(F.min("text").alias("text"))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar enough.

    The b of one a are dealt into chunks of about ``CHUNK``; a's text goes to each
    chunk once, before its members, and its shingles are kept while these pass.
    """
    one = staged(node_texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), nodes, docs), "near-texts")
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    dealt = staged(pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk")), "near-dealt")
    members = dealt.join(one, dealt["b"] == one["node"]).select("a", "chunk", "b", "text")
    heads = dealt.select("a", "chunk").distinct()
    heads = heads.join(one, heads["a"] == one["node"]).select("a", "chunk", F.lit(None).cast("binary").alias("b"), "text")

    def compare(batches):
        sh, held = shingler(), None
        for whole in batches:
            for b in sliced([whole], 3):
                keep = []
                for member, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                    got = sh.shingles(sh.words(text))
                    if member is None:
                        held = got
                    keep.append(member is not None and probability_jaccard(held, got) >= least)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # nulls sort first, so a head stands before its members
    rows = heads.union(members).repartition("a", "chunk").sortWithinPartitions("a", "chunk", "b")
    return rows.mapInArrow(compare, "a binary, b binary")


def block_links(table: pa.Table, least: float = SIMILARITY) -> pa.Table:
    """Links that join components within one group of rows (node, root, block, own,
    hashes, counts); with two blocks, only between these."""
    nodes, root, block = table["node"].to_pylist(), table["root"].to_pylist(), table["block"].to_pylist()
    sets = [(np.frombuffer(h, np.uint64), np.frombuffer(c, np.float32).astype(float)) for h, c in zip(table["hashes"].to_pylist(), table["counts"].to_pylist())]
    size = np.array([len(h) for h, _ in sets])
    unit = np.array([(c == 1).all() for _, c in sets])
    names, flat = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    share = np.concatenate([c / c.sum() for _, c in sets])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    ids = {r: k for k, r in enumerate(dict.fromkeys(root))}
    comp = np.array([ids[r] for r in root])
    part, two = np.array([b == block[0] for b in block]), len(set(block)) > 1
    own: list[tuple] = []
    hit, p = np.zeros(len(names), bool), np.zeros(len(names))
    most = np.bincount(comp).argmax()
    for i in np.flatnonzero(comp != most) if not two else range(len(nodes)):
        if two and comp[i] == most and (comp == most).all():
            break
        other = (comp != comp[i]) & ((part != part[i]) if two else True)
        if not other.any():
            continue
        mine = flat[starts[i] : starts[i] + size[i]]
        hit[mine], p[mine] = True, share[starts[i] : starts[i] + size[i]]
        both = np.add.reduceat(hit[flat].astype(np.int64), starts)
        jaccard = both / (size + size[i] - both)
        bound = np.add.reduceat(np.minimum(p[flat], share), starts)  # never below the similarity
        hit[mine], p[mine] = False, 0.0
        sure = unit & unit[i]
        for j in np.flatnonzero(other & np.where(sure, jaccard >= least, bound >= least - 1e-9)):
            if comp[j] == comp[i] or not sure[j] and probability_jaccard(sets[i], sets[j]) < least:
                continue
            own.append((nodes[i], nodes[j]))
            comp[comp == comp[j]] = comp[i]
    return pa.table({"a": pa.array([x[0] for x in own], pa.binary()), "b": pa.array([x[1] for x in own], pa.binary())})


def torn_links(rest: DataFrame, nodes: DataFrame, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links in buckets (band, node, root, size) whose nodes lie in different components."""

    def sets(batches):
        sh = shingler()
        for b in batches:
            got = [sh.shingles(sh.words(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([h.tobytes() for h, _ in got], pa.binary()), pa.array([c.astype(np.float32).tobytes() for _, c in got], pa.binary())], ["node", "hashes", "counts"])

    held = staged(node_texts(rest.select("node"), nodes, docs).mapInArrow(sets, "node binary, hashes binary, counts binary"), "near-sets")
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), n.cast("long")).cast("int")
    cells = rest.select("band", "node", "root", mine.alias("block"), F.explode(F.sequence(F.lit(0), n - 1)).alias("__o")).select("band", "node", "root", "block", F.least("block", "__o").alias("i"), F.greatest("block", "__o").alias("j"))
    return cells.join(held, "node").groupBy("band", "i", "j").applyInArrow(lambda t: block_links(t, least), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node → smallest node of its component, by alternating large and small
    stars; the edges are written to the shared folder after each round."""
    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(down.select("u", F.col("m").alias("v"))).distinct()
        e = staged(small, "near-edges")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def classes(docs: DataFrame, least: float = SIMILARITY, m: int = REGISTERS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept.

    class_id is the smallest doc_id of the class, and that document is kept; of
    rows that repeat it, one. Texts without words (null, empty, punctuation)
    resemble nothing: they are classes of their own, kept, with their own id. A
    null id is larger than any other. Other columns are ignored.
    """
    signed = staged(sign(docs, m, rows), "near-signed")
    some = signed.where("node is not null")
    nodes = staged(some.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands")), "near-nodes")
    reps = nodes.select("node", "rep")
    member = nodes.select("node", F.explode("bands").alias("band"))
    sized = member.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = staged(member.join(sized, "band"), "near-buckets")
    score = buckets.groupBy("node").agg(F.sum("size").alias("score"))
    scored = staged(buckets.join(score, "node"), "near-scored")
    hubs = scored.groupBy("band").agg(F.max(F.struct("score", "node")).alias("top")).select("band", F.col("top.node").alias("hub"))
    pairs = staged(scored.join(hubs, "band").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
    links = staged(verified(pairs, reps, docs, least), "near-links")
    roots = components(links)
    wide = buckets.where("size > 2").join(roots, "node", "left").select("band", "node", "size", F.coalesce("root", "node").alias("root"))
    torn = wide.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band")
    wide = staged(wide.join(torn, "band"), "near-wide")
    # bands with the same members are compared once
    alike = wide.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h")).groupBy("n", "h").agg(F.min("band").alias("band"))
    rest = staged(wide.join(alike.select("band"), "band"), "near-rest")
    if rest.limit(1).count():
        again = staged(torn_links(rest, reps, docs, least), "near-links")
        if again.limit(1).count():
            roots = components(links.union(again))
    rooted = nodes.select("node", "rep", "n").join(roots, "node", "left").select("node", "rep", "n", F.coalesce("root", "node").alias("root"))
    sizes = rooted.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"))
    named = rooted.join(sizes, "root").select("node", "class_id", "class_size")
    out = some.select("doc_id", "node").join(named, "node").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
    alone = signed.where("node is null").select("node", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    twice = out.where("kept").groupBy("class_id").count().where("count > 1")
    if twice.limit(1).count():
        from pyspark.sql import Window

        nth = F.row_number().over(Window.partitionBy("class_id", "kept").orderBy("node"))
        out = out.where("not kept").unionByName(out.where("kept").withColumn("kept", nth == 1))
    return out.unionByName(alone).select("doc_id", "class_id", "class_size", "kept", "node")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`classes` keeps, with all their columns.

    Dropped documents are found by their id, and no text is shuffled, if no
    dropped row shares its id with a kept one; else by id and node key.
    """
    original, docs = docs.columns, renamed(docs, "doc_id", "text")
    marks = staged(classes(docs).select("doc_id", "node", "kept"), "near-marks")
    gone = staged(marks.where("not kept").select(F.col("doc_id").alias("__id"), F.col("node").alias("__node")).distinct(), "near-gone")
    ids = gone.select("__id").distinct()
    left = marks.where("kept").select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"))
    if not gone.where("__id is null").limit(1).count() and not left.join(ids, "__id", "left_semi").limit(1).count():
        return without_ids(docs, ids).select(*docs.columns).toDF(*original)
    tied = staged(left.where("__node is not null").join(gone, ["__id", "__node"], "left_semi"), "near-tied")
    at = docs.columns.index("text")

    def run(batches):
        sh = shingler()
        for b in sliced(batches, at):
            words = [sh.words(t) for t in b.column(at).to_pylist()]
            keys = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None for w in words]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], [*b.schema.names, "__key"])

    keyed = docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", __key binary")
    same = lambda other: keyed["doc_id"].eqNullSafe(other["__id"]) & (keyed["__key"] == other["__node"])
    rest = keyed.join(gone, same(gone), "left_anti")
    one = keyed.join(tied, same(tied), "left_semi").dropDuplicates(["doc_id", "__key"])
    return rest.unionByName(one).select(*docs.columns).toDF(*original)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).drop("node")


#: All pairs that share a shingle, so for small tables.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS words FROM documents),
s AS (
  SELECT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle, count(*) AS n
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0) GROUP BY ALL),
total AS (SELECT doc_id, sum(n) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS p, y.n AS q, count(*) AS k
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
alone AS (
  SELECT a, b, any_value(t.n) - sum(k * p) AS only_a, any_value(u.n) - sum(k * q) AS only_b
  FROM shared JOIN total t ON t.doc_id = a JOIN total u ON u.doc_id = b GROUP BY a, b),
terms AS (
  SELECT x.a, x.b, x.p, x.q, x.k, sum(y.k * greatest(y.p / x.p, y.q / x.q)) AS common
  FROM shared x JOIN shared y ON x.a = y.a AND x.b = y.b GROUP BY ALL),
links AS (
  SELECT terms.a, terms.b FROM terms JOIN alone ON terms.a = alone.a AND terms.b = alone.b
  GROUP BY terms.a, terms.b HAVING sum(k / (common + only_a / p + only_b / q)) >= 0.8),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size, a = min(b) AS kept FROM reach GROUP BY a
"""

QUERIES = {"op9_minhash": op9_minhash}
ORACLES = {"op9_minhash": ORACLE}

"""Exact deduplication by an extendible-hash index on shared files.

1. One narrow pass normalises each text (A-Z lower-cased), hashes it (SHA-256;
   its first 8 bytes are the index key) and writes to the shared folder one
   short row per document, and one *representative* with its text per distinct
   text and task window. Within the window texts are compared as such, so a hot
   group of copies shrinks to a row per window before anything is shuffled.
2. Representatives go to owner tasks by key range (the key's leading bits).
   An owner inserts them into an extendible-hash index: a directory of 2^depth
   slots points to buckets; a bucket with too many keys splits by its next bit,
   doubling the directory when it must. Within a bucket, entries of one key are
   chained, and a text joins an entry only if its bytes are equal.
3. The buckets are written to the shared folder. Documents find their entry by
   key; documents whose key has a chain of several texts find it by key and
   text. That second way is planned only if the index has such chains.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import freed, partitions_for, renamed, sliced, staged, table, without_ids

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
KEY_BITS, WINDOW_BYTES, BUCKET = 64, 32 << 20, 64


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER)


def key_of(sha: bytes, bits: int = KEY_BITS) -> int:
    """The leading ``bits`` of the hash as a signed 64-bit number."""
    return int.from_bytes((int.from_bytes(sha[:8], "big") >> 64 - bits << 64 - bits).to_bytes(8, "big"), "big", signed=True)


def larger(a, b):
    """Of two ids the larger; null is the smallest."""
    return b if a is None else a if b is None else max(a, b)


class Bucket:
    __slots__ = ("depth", "chains")

    def __init__(self, depth: int):
        self.depth = depth
        self.chains: dict[int, list[list]] = {}


class ExtendibleIndex:
    """key → chain of [text, largest id, rows with it, rows], in buckets.

    The directory is addressed by the leading ``depth`` bits after the first
    ``skip`` ones, which all keys of an owner's range may share.
    """

    def __init__(self, capacity: int = BUCKET, skip: int = 0):
        self.capacity, self.skip, self.depth = capacity, skip, 0
        self.directory = [Bucket(0)]
        self.splits = 0

    def _slot(self, key: int, depth: int) -> int:
        return ((key & (1 << 64) - 1) << self.skip & (1 << 64) - 1) >> 64 - depth if depth else 0

    def insert(self, key: int, text: bytes, top, n_top: int, n: int) -> None:
        bucket = self.directory[self._slot(key, self.depth)]
        chain = bucket.chains.setdefault(key, [])
        for entry in chain:
            if entry[0] == text:
                best = larger(entry[1], top)
                entry[2] = entry[2] * (entry[1] == best) + n_top * (top == best)
                entry[1], entry[3] = best, entry[3] + n
                return
        chain.append([text, top, n_top, n])
        while len(bucket.chains) > self.capacity and bucket.depth < 64 - self.skip:
            self._split(bucket)
            bucket = self.directory[self._slot(key, self.depth)]

    def _split(self, bucket: Bucket) -> None:
        if bucket.depth == self.depth:
            self.directory = [b for b in self.directory for _ in (0, 1)]
            self.depth += 1
        self.splits += 1
        low, high = Bucket(bucket.depth + 1), Bucket(bucket.depth + 1)
        for key, chain in bucket.chains.items():
            (high if self._slot(key, bucket.depth + 1) & 1 else low).chains[key] = chain
        some = next(iter(bucket.chains))
        span = 1 << self.depth - bucket.depth
        start = self._slot(some, bucket.depth) * span
        self.directory[start : start + span] = [low] * (span // 2) + [high] * (span // 2)

    def buckets(self):
        """(first slot, bucket), each bucket once."""
        last = None
        for slot, b in enumerate(self.directory):
            if b is not last:
                yield slot, b
            last = b


def _rows(docs: DataFrame, owners: int, bits: int) -> DataFrame:
    """Documents (text null) and representatives (text and counts given)."""

    def run(batches):
        freed()
        names = ["doc_id", "sha", "key", "owner", "n_top", "n", "text", "rep"]
        held: dict[bytes, list] = {}
        size = 0

        def flush():
            cols = list(zip(*((v[0], v[1], key_of(v[1], bits), int.from_bytes(v[1][:8], "big") * owners >> 64, v[2], v[3], t, True) for t, v in held.items()))) or [()] * 8
            types = [id_type, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        id_type = None
        for b in sliced(batches, 1):
            id_type = b.schema.field(0).type
            ids, shas = b.column(0).to_pylist(), []
            for i, t in zip(ids, b.column(1).to_pylist()):
                t = normalised(t)
                got = held.get(t)
                if got is None:
                    held[t] = got = [i, hashlib.sha256(t).digest(), 1, 1]
                    size += len(t) + 200
                else:
                    best = larger(got[0], i)
                    got[2] = got[2] * (got[0] == best) + (i == best)
                    got[0], got[3] = best, got[3] + 1
                shas.append(got[1])
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shas, pa.binary()), pa.array([key_of(s, bits) for s in shas], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array([False] * n)], names)
            if size > WINDOW_BYTES:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()

    src = docs.select("doc_id", docs["text"].cast("string"))
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, sha binary, key long, owner long, n_top long, n long, text binary, rep boolean")


def build_index(reps: DataFrame, owners: int, bucket: int = BUCKET) -> DataFrame:
    """The index as rows: owner, slot, depth (of the bucket), key, chain (place in
    it), chains (its length), keep_id, n_top, n, and the text where chains > 1."""

    def run(batches):
        freed()
        own: dict[int, ExtendibleIndex] = {}
        id_type = pa.int64()
        skip = max(0, (owners - 1).bit_length() - 1)
        for b in batches:
            id_type = b.schema.field(0).type
            for i, key, owner, n_top, n, text in zip(*(c.to_pylist() for c in b.columns)):
                if owner not in own:
                    own[owner] = ExtendibleIndex(bucket, 0 if owners & owners - 1 else skip)
                own[owner].insert(key, text, i, n_top, n)
        for owner, index in own.items():
            rows = [(owner, slot, bkt.depth, key, k, len(chain), e[1], e[2], e[3], e[0] if len(chain) > 1 else None) for slot, bkt in index.buckets() for key, chain in bkt.chains.items() for k, e in enumerate(chain)]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), id_type, pa.int64(), pa.int64(), pa.binary()]
            names = ["owner", "slot", "depth", "key", "chain", "chains", "keep_id", "n_top", "n", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    src = reps.select("doc_id", "key", "owner", "n_top", "n", "text").repartition(owners, "owner")
    return src.mapInArrow(run, f"owner long, slot long, depth int, key long, chain int, chains int, keep_id {src.dtypes[0][1]}, n_top long, n long, text binary")


def dedup(docs: DataFrame, key_bits: int = KEY_BITS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 and the index key.

    Null texts count as empty; a null id is smaller than any other. Of rows that
    repeat both text and the largest id, one (any: they do not differ) is kept.
    Other columns are ignored; no rows give no rows.
    """
    owners = partitions_for(docs)
    rows = staged(_rows(docs, owners, key_bits), "dedup-rows", "rep")
    index = staged(build_index(rows.where("rep"), owners, bucket), "dedup-index")
    each = rows.where("not rep").select("doc_id", "sha", "key")
    entry = ["key", "keep_id", "n_top", F.col("n").alias("group_size")]
    found = each.join(index.where("chains = 1").select(*entry), "key")
    ties = index.where("n_top > 1").limit(1).count() > 0
    chained = index.where("chains > 1")
    if chained.limit(1).count():
        again = _texts(docs, key_bits).join(chained.select(*entry, "text"), ["key", "text"]).select(found.columns)
        found = found.unionByName(again)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if ties:
        from pyspark.sql import Window

        nth = F.row_number().over(Window.partitionBy("sha", "doc_id").orderBy("key"))
        single = found.where(~kept | (F.col("n_top") <= 1)).withColumn("kept", kept)
        several = found.where(kept & (F.col("n_top") > 1)).withColumn("kept", nth == 1)
        found = single.unionByName(several)
    else:
        found = found.withColumn("kept", kept)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), "key")


def _texts(docs: DataFrame, bits: int) -> DataFrame:
    def run(batches):
        for b in batches:
            texts = [normalised(t) for t in b.column(1).to_pylist()]
            shas = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shas, pa.binary()), pa.array([key_of(s, bits) for s in shas], pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "sha", "key", "text"])

    src = docs.select("doc_id", docs["text"].cast("string"))
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, sha binary, key long, text binary")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`dedup` keeps, with all their columns.

    Dropped documents are found by their id, and no text is shuffled again, if
    no dropped row shares its id with a kept one; else by id and text hash.
    Where rows that do not differ in either tie for a group, one of them stays.
    """
    original, docs = docs.columns, renamed(docs, "doc_id", "text")
    marks = staged(dedup(docs).select("doc_id", "kept", "text_sha256"), "dedup-marks")
    gone = staged(marks.where("not kept").select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha")).distinct(), "dedup-dropped")
    ids = gone.select("__id").distinct()
    kept = marks.where("kept").select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"))
    if not gone.where("__id is null").limit(1).count() and not kept.join(ids, "__id", "left_semi").limit(1).count():
        return without_ids(docs, ids).select(*docs.columns).toDF(*original)
    tied = staged(gone.join(kept, (gone["__id"].eqNullSafe(kept["__id"])) & (gone["__sha"] == kept["__sha"]), "left_semi"), "dedup-tied")
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        for b in sliced(batches, at):
            shas = [hashlib.sha256(normalised(t)).digest() for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shas, pa.binary())], [*b.schema.names, "__sha"])

    hashed = docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", __sha binary")
    same = lambda other: (hashed["doc_id"].eqNullSafe(other["__id"])) & (hashed["__sha"] == other["__sha"])
    out = hashed.join(gone.hint("shuffle_hash"), same(gone), "left_anti").select(*names)
    if tied.limit(1).count():
        out = out.unionByName(hashed.join(tied, same(tied), "left_semi").dropDuplicates(["doc_id", "__sha"]).select(*names))
    return out.toDF(*original)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

QUERIES = {"op3_exact_dedup": op3_exact_dedup}
ORACLES = {"op3_exact_dedup": ORACLE}

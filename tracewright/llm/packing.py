"""Packing of documents into token windows by minimum bin slack.

One pass encodes each text, adds the end token, cuts the ids into full windows
and a rest, and writes the pieces (without texts) to the shared folder. The
number of pieces of each length is at most ``capacity`` numbers, so the plan is
made on the driver from that histogram, whatever the size of the corpus:

* take the longest remaining length, and by a bitset subset-sum dynamic
  programme the multiset of the other remaining lengths that brings the window
  closest to its capacity; each length counts in binary multiples, so that the
  counts are backtracked from the layers of bitsets;
* use that pattern as often as the counts allow, and go on.

Every pattern leaves at least one length with fewer pieces than it takes of it,
so the patterns number at most the sum of capacity/length. A piece finds its
window by its rank among the pieces of its length; ranks are sums of per-task
counts, so no task sees all pieces of a length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from ._common import kept, sliced, staged, table

CAPACITY, END = 2048, 1


def id_coder(path: str) -> bpe.WordCoder:
    """Packed ids of each word; one coder a process."""
    return kept(("bpe-ids", path), lambda: bpe.WordCoder(path, bpe.pack_ids, 128 << 20))


def cut(lists, tail: bytes, step: int):
    """The bytes of a document in steps, while its stream goes on."""
    held = bytearray()
    for words in lists:
        held += b"".join(words)
        while len(held) >= step:
            yield bytes(held[:step])
            del held[:step]
    held += tail
    for start in range(0, len(held), step):
        yield bytes(held[start : start + step])


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None) -> DataFrame:
    """The pieces of each document, before packing: part and nth tell the task
    that made a piece and its number among that task's pieces of its length."""
    path = path or bpe.default_path()

    def run(batches):
        coder = id_coder(path)
        tail, step = bpe.pack_ids([end]), 4 * capacity
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in sliced(batches, 1):
            rows: list[list] = [[], [], [], [], [], []]
            for i, lists in enumerate(coder.texts(b.column(1).to_pylist())):
                made = [(len(x) // 4, zlib.crc32(x)) for x in cut(lists, tail, step)]
                total = sum(n for n, _ in made)
                for k, (n, crc) in enumerate(made):
                    for col, v in zip(rows, (i, k * capacity, n, crc, total, seen[n])):
                        col.append(v)
                    seen[n] += 1
            cols = [pa.array(c, pa.int64()) for c in rows]
            yield pa.RecordBatch.from_arrays([b.column(0).take(cols[0]), *cols[1:5], pa.array([part] * len(cols[0]), pa.int32()), cols[5]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])

    src = docs.select("doc_id", docs["text"].cast("string"))
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long")


def fill(counts: dict[int, int], target: int) -> dict[int, int]:
    """The multiset within ``counts`` whose sum is the largest up to ``target``."""
    reach, mask, layers = 1, (1 << (target + 1)) - 1, []
    goal = 1 << target
    for n in sorted((n for n in counts if n <= target), reverse=True):
        left, k = min(counts[n], target // n), 1
        while left > 0 and not reach & goal:
            k = min(k, left)
            layers.append((n, k, reach))
            reach |= (reach << (n * k)) & mask
            left, k = left - k, 2 * k
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, {}
    for n, k, before in reversed(layers):
        if not before >> at & 1:
            used[n] = used.get(n, 0) + k
            at -= n * k
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, pattern) pairs that use up the histogram; pattern: length → count."""
    left, out = {n: c for n, c in histogram.items() if c > 0}, []
    while left:
        first = max(left)
        rest = dict(left)
        rest[first] -= 1
        if not rest[first]:
            del rest[first]
        pattern = fill(rest, capacity - first) if first < capacity else {}
        pattern[first] = pattern.get(first, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        out.append((times, pattern))
        for n, k in pattern.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return out


def segments(planned) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, pieces a sequence, offset)."""
    rows, rank, sequence = [], {}, 0
    for times, pattern in planned:
        offset = 0
        for n in sorted(pattern, reverse=True):
            k = pattern[n]
            rows.append((n, rank.get(n, 0), sequence, k, offset))
            rank[n] = rank.get(n, 0) + times * k
            offset += n * k
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, capacity: int = CAPACITY, end: int = END, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A null or empty text is the end token alone. Rows that repeat an id are
    documents of their own; null ids are kept as null. Without rows there are no
    pieces. Only ``doc_id`` and ``text`` are read.
    """
    made = staged(pieces(docs, capacity, end, path), "pieces")
    by_part = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # at most `capacity` rows
    seg = segments(plan({r[0]: r[1] for r in made.groupBy("length").agg(F.count(F.lit(1))).collect()}, capacity))

    def place(batches):
        keys = (seg[:, 0] << 48) + seg[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            s = seg[at]
            j = rank - s[:, 1]
            cols = [pa.array(s[:, 2] + j // s[:, 3]), pa.array(s[:, 4] + j % s[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranked = made.join(base, ["length", "part"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, f"doc_id {ranked.dtypes[0][1]}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op10_packing": op10_packing}
ORACLES: dict[str, str] = {}

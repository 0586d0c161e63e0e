"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of one fixed public vocabulary
(a sentencepiece model's lower-case pieces). A word's probability is the sum
over all its segmentations into pieces, by the forward algorithm; no piece
crosses a word, so a text's probability is the product over its words. The words
of a slice of texts that are new go through the algorithm side by side; their
vectors of log probabilities are kept, within a bound in bytes. Pieces are
looked up by a 64-bit polynomial hash of their letters.

The piece probabilities are fitted by expectation-maximisation (forward-backward
expected counts) on word counts of a bounded sample of labelled texts; there a
run of more than 64 letters counts as several words.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import kept, sliced, table

LETTERS = re.compile(r"[^\W\d_]+")
RUNS = re.compile(r"[^\W\d_]{1,64}")
#: Labelled texts a language used for fitting, at most about this many.
FIT_ROWS = 120
ROUNDS, SMOOTH, UNKNOWN, LONGEST = 2, 0.05, 1e-9, 12
#: A factor for each letter that keeps sums over 64 letters within a float.
LIFT = 1e4
BASE = 0x9E3779B97F4A7C15


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[str]:
    """Lower-case pieces of letters, with or without the mark of a word's start."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return sorted({p for p in pieces if 0 < len(p) <= LONGEST and p == p.lower() and LETTERS.fullmatch(p.removeprefix("▁") or "x")})


def crc(doc_id) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def held_out(col):
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model:
    """Languages, and piece → probabilities in the languages' order."""

    def __init__(self, langs: list[str], probs: dict[str, tuple[float, ...]]):
        self.langs, self.probs = langs, probs
        self.longest = max(map(len, probs), default=1)
        self.powers = [pow(BASE, k, 1 << 64) for k in range(self.longest + 1)]
        found = {self._hash(p): v for p, v in probs.items()}
        self.keys = np.array(sorted(found), np.uint64)
        self.values = np.array([*(found[k] for k in self.keys.tolist()), (0.0,) * len(langs)], float).reshape(len(found) + 1, len(langs))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * BASE + ord(c)) & (1 << 64) - 1
        return h

    def _values(self, hashes: np.ndarray) -> np.ndarray:
        """Probabilities of the pieces with these hashes; of no piece, 0."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return self.values[np.where(self.keys[at] == hashes, at, len(self.keys))]

    def words(self, words: list[str]) -> np.ndarray:
        """``word`` of many words at once, a row each."""
        out = np.zeros((len(words), len(self.langs)))
        order, cells, at = sorted(range(len(words)), key=lambda k: -len(words[k])), 1 << 20, 0
        while at < len(order) and len(words[order[at]]) > 64:
            out[order[at]] = self.word(words[order[at]])
            at += 1
        while at < len(order):
            wide = len(words[order[at]]) + 2
            some = order[at : at + max(1, cells // (wide * max(1, len(self.langs))))]
            out[some] = self._side_by_side([words[k] for k in some])
            at += len(some)
        return out

    def _side_by_side(self, words: list[str]) -> np.ndarray:
        """Words of up to 64 letters, the longest first."""
        n, L, longest = len(words), len(self.langs), self.longest
        ends = np.array([len(w) + 1 for w in words])
        width = int(ends[0])
        codes = np.zeros((n, width), np.uint64)
        codes[:, 0] = ord("▁")
        codes[:, 1:][np.arange(width - 1) < ends[:, None] - 1] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        prefix = np.zeros((n, width + 1), np.uint64)
        for k in range(width):
            prefix[:, k + 1] = prefix[:, k] * np.uint64(BASE) + codes[:, k]
        alpha, logs, out = np.ones((width + 1, n, L)), np.zeros((n, L)), np.zeros((n, L))
        for i in range(1, width + 1):
            rows = int(np.searchsorted(-ends, -i, side="right"))  # those that reach i
            now = UNKNOWN * alpha[i - 1, :rows]
            for d in range(1, min(longest, i) + 1):
                hashes = prefix[:rows, i] - prefix[:rows, i - d] * np.uint64(self.powers[d])
                now += alpha[i - d, :rows] * self._values(hashes)
            alpha[i, :rows] = now
            if i % 16 == 0:
                logs[:rows] += np.log(now)
                alpha[max(0, i - longest) : i, :rows] /= now
                alpha[i, :rows] = 1.0
            done = slice(int(np.searchsorted(-ends, -i, side="left")), rows)  # those that end here
            out[done] = logs[done] + np.log(alpha[i, done])
        return out

    def word(self, word: str) -> list[float]:
        """Log probability of a word in each language, by the forward sums,
        scaled along the way so that long words don't underflow."""
        s, n, L = "▁" + word, len(word) + 1, len(self.langs)
        alpha: list[list[float] | None] = [[1.0] * L] + [None] * n
        logs = [0.0] * L
        get, longest = self.probs.get, self.longest
        for i in range(1, n + 1):
            now = [UNKNOWN * x for x in alpha[i - 1]]
            for j in range(max(0, i - longest), i):
                p = get(s[j:i])
                if p is not None:
                    now = [a + b * c for a, b, c in zip(now, alpha[j], p)]
            alpha[i] = now
            if i % 16 == 0:
                for k in range(L):
                    logs[k] += math.log(now[k])
                    for x in alpha[max(0, i - longest) : i]:
                        x[k] /= now[k]
                    now[k] = 1.0
        return [a + math.log(b) for a, b in zip(logs, alpha[n])]


def fit_language(words: dict[str, int], pieces: set[str], rounds: int = ROUNDS) -> dict[str, float]:
    """Piece probabilities by EM from word counts of one language."""
    longest = max(map(len, pieces), default=1)
    edges = []
    for w, c in words.items():
        s = "▁" + w
        edges.append((len(s), c, [(j, i, s[j:i]) for i in range(1, len(s) + 1) for j in range(max(0, i - longest), i) if s[j:i] in pieces]))
    count: dict[str, float] = defaultdict(float)
    for _, c, es in edges:
        for j, i, p in es:
            count[p] += c * (i - j) ** 2  # longer pieces explain more of a word
    for _ in range(rounds):
        total = sum(count.values()) + SMOOTH * len(pieces)
        prob = {p: (count.get(p, 0.0) + SMOOTH) / total * LIFT ** len(p) for p in pieces}
        count = defaultdict(float)
        for n, c, es in edges:
            f, b = [1.0] + [0.0] * n, [0.0] * n + [1.0]
            at = 0
            for i in range(1, n + 1):
                f[i] = UNKNOWN * LIFT * f[i - 1]
                while at < len(es) and es[at][1] == i:
                    f[i] += f[es[at][0]] * prob[es[at][2]]
                    at += 1
            done = n
            for j, i, p in reversed(es):
                while done > i:
                    done -= 1
                    b[done] += UNKNOWN * LIFT * b[done + 1]
                b[j] += prob[p] * b[i]
            for j, i, p in es:
                count[p] += c * f[j] * prob[p] * b[i] / f[n]
    total = sum(count.values()) + SMOOTH * len(pieces)
    return {p: (count.get(p, 0.0) + SMOOTH) / total for p in pieces}


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, path: str | None = None) -> Model:
    """Learns from text and non-null lang of rows outside the held-out fifth.

    About ``fit_rows`` texts a language are used, chosen by a hash of doc_id;
    what reaches the driver is their word counts, bounded by that parameter.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r[0]: r[1] for r in train.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {})
    rate = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, fit_rows / n)))])
    share = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    chosen = train.where(share < rate[F.col("lang")]).select("lang", F.col("text").cast("string").alias("text"))

    def words(batches):
        counts: Counter = Counter()
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts.update((lang, w) for w in RUNS.findall((t or "").lower()))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())], ["lang", "word", "n"])

    table_ = chosen.mapInArrow(words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    pieces, langs = set(vocabulary(path or default_path())), sorted(sizes)
    pieces |= {c for w in table_["word"] for c in w} | {"▁"}
    by = {lang: dict(zip(g["word"].tolist(), g["n"].tolist())) for lang, g in table_.groupby("lang")}
    fitted = [fit_language(by.get(lang, {}), pieces) for lang in langs]
    least = [1.5 * min(f.values(), default=0.0) for f in fitted]
    used = {p for f, low in zip(fitted, least) for p, x in f.items() if x > low}
    return Model(langs, {p: tuple(f[p] for f in fitted) for p in sorted(used)})


def word_lists(text: str | None, piece: int = 1 << 20):
    """The words of a text, lower-cased, in lists of those of about ``piece``
    characters; a list ends between words."""
    if not text or len(text) <= piece:
        yield LETTERS.findall(text.lower()) if text else []
        return
    found = (m[0].lower() for m in LETTERS.finditer(text))
    while part := [x for w in islice(found, piece // 4) for x in LETTERS.findall(w)]:
        yield part


class Scorer:
    """Language and posterior of whole texts; words are rows of one matrix, which
    holds about ``limit`` bytes with the words, or else one slice's."""

    def __init__(self, model: Model, limit: int = 48 << 20):
        self.model = model
        self.limit = max(1000, limit // (8 * max(1, len(model.langs)) + 200))
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((1, max(1, len(model.langs))))

    def learn(self, words: set[str]) -> None:
        fresh = words.difference(self.rows)
        if len(self.rows) + len(fresh) > self.limit:
            self.rows, fresh = {}, words
        fresh, n = list(fresh), len(self.rows)
        if n + len(fresh) > len(self.matrix):
            self.matrix = np.concatenate([self.matrix[:n], np.zeros((max(n + 2 * len(fresh), 1024) - n, self.matrix.shape[1]))])
        self.matrix[n : n + len(fresh)] = self.model.words(fresh)
        self.rows.update(zip(fresh, range(n, n + len(fresh))))

    def texts(self, texts) -> list[tuple[str, float]]:
        """``und`` and 0 for texts without letters, or if nothing was learned."""
        if not self.model.langs:
            return [("und", 0.0)] * len(texts)
        totals, some, group, size = np.zeros((len(texts), len(self.model.langs))), [False] * len(texts), [], 0
        for k, t in enumerate(texts):
            for words in word_lists(t):
                some[k] |= bool(words)
                group.append((k, words))
                size += len(words)
                if size > 200_000:
                    self._add(totals, group)
                    group, size = [], 0
        self._add(totals, group)
        best = totals.argmax(axis=1)
        score = 1.0 / np.exp(np.clip(totals - totals.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
        return [(self.model.langs[b], float(x)) if s else ("und", 0.0) for b, x, s in zip(best.tolist(), score.tolist(), some)]

    def _add(self, totals, group) -> None:
        self.learn({w for _, words in group for w in words})
        row = self.rows.__getitem__
        for k, words in group:
            if words:
                totals[k] += self.matrix[np.fromiter(map(row, words), np.int64, len(words))].sum(axis=0)


def scorer_of(value) -> Scorer:
    """This process's scorer of a model; a worker's later tasks find its words."""
    return kept(("langid", value[0]), lambda: Scorer(Model(*value[1:])))


def _shared(docs: DataFrame, model: Model):
    """The model for all tasks; its size is bounded by vocabulary and languages."""
    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model.langs, model.probs))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score`` (names it already has
    are replaced). Predictions use nothing but the text."""
    shared = _shared(docs, model)
    docs = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    at = docs.columns.index("text")

    def run(batches):
        scorer = scorer_of(shared.value)
        for b in sliced(batches, at):
            got = scorer.texts(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], [*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", lang_pred string, score double")


def keep_certain(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose text has a learned language with a score of at
    least ``least``; if nothing was learned, those with a letter. Every column
    goes through Python once and comes back unchanged."""
    shared, at = _shared(docs, model), docs.columns.index("text")

    def run(batches):
        scorer = scorer_of(shared.value)
        for b in sliced(batches, at):
            texts = b.column(at).to_pylist()
            if scorer.model.langs:
                mask = [lang != "und" and score >= least for lang, score in scorer.texts(texts)]
            else:
                mask = [bool(t and LETTERS.search(t)) for t in texts]
            yield b.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS, path: str | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 for null texts and texts without letters, and for all
    if no row is labelled. A null doc_id is never held out and never learned
    from. Repeated rows get equal results; further columns are ignored.
    """
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    got = predict(src.select("doc_id", "text"), fit(src, fit_rows, path))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {"op8_langid": op8_langid}
ORACLES: dict[str, str] = {}

"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

The encoder reads a text in pieces of any size. Normalised text is split into
words (the tokenizer's pre-tokens), and merges never cross a word. Inside a
word the merge list has a *sufficient lookahead*: the number of symbols right
of a position that can still change which token ends there. It is computed
once from the merge list (:func:`sufficient_lookahead`). The encoder keeps a
window of a few lookaheads, merges it by rank, and emits each token that ends
a full lookahead before the window's end: later input cannot change it. So
its state is bounded, however long a word or text is.

The decoder is a state machine over token ids. ``surface`` joins the tokens'
own strings by blanks (a tokenizer file without a decoder does that); ``text``
turns byte symbols back into bytes, word ends into blanks, and emits
characters as soon as their UTF-8 bytes are complete.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import json
import os
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ._common import kept, sliced, table

SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


def unassigned() -> str:
    """A character class of the code points that Python's Unicode does not know:
    other versions may, so their classes are the tokenizer library's to tell."""
    out, start = [], None
    for c in range(0x110001):
        gap = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if gap and start is None:
            start = c
        elif not gap and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "[" + "".join(out) + "]"


def sufficient_lookahead(merges: list[tuple[str, str]], size) -> int:
    """Symbols right of a token's end that can still decide about that token.

    A token ``q`` is lost to a merge ``(q, c)`` only if ``c`` has come about
    before that merge's turn. That depends on what follows ``c``, on what
    follows the parts on its right edge before they were merged, and so on,
    always by merges of a smaller rank. The longest such chain bounds the
    lookahead. ``size(token)`` is a token's length in symbols.
    """
    rank = {a + b: r for r, (a, b) in enumerate(merges)}
    right = {a + b: b for a, b in merges}
    ranks: dict[str, list[int]] = {}  # of merges with this left part, growing
    reach: dict[str, list[int]] = {}  # the largest reach of those so far

    def lost(token: str, before: int) -> int:
        k = bisect.bisect_left(ranks.get(token, ()), before)
        return reach[token][k - 1] if k else 0

    most = 0
    for r, (q, c) in enumerate(merges):
        part, before, far = c, r, 0
        while True:
            far = max(far, lost(part, before))
            if part not in right:
                break
            before, part = min(before, rank[part]), right[part]
        far += size(c)
        rs, fs = ranks.setdefault(q, []), reach.setdefault(q, [])
        rs.append(r)
        fs.append(max(far, fs[-1] if fs else 0))
        most = max(most, far)
    return most + 1  # one more symbol tells whether the word ends


NONE = 1 << 30  # no rank
SHIFT = 20  # bits of a token id in a pair's key


class BpeModel:
    """Merge ranks and word splitting of a tokenizer file, on token ids.

    Taken from the file: vocabulary, merges, the word-end suffix and the added
    tokens. The normaliser is NFC, white space to one blank, lower case. A
    byte's symbol is the id of its one-symbol token.
    """

    _loaded: dict[str, "BpeModel"] = {}

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(t[flag] for t in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that strip, need word bounds or are normalised are not supported")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        length = lambda t: len(t.removesuffix(self.suffix)) if self.suffix else len(t)
        self.surface = [""] * (1 + max([*vocab.values(), *self.added.values()]))
        self.size = [0] * len(self.surface)  # of a token, in symbols
        for t, i in [*vocab.items(), *self.added.items()]:
            self.surface[i], self.size[i] = t, length(t)
        self.pairs = {vocab[a] << SHIFT | vocab[b]: r for r, (a, b) in enumerate(merges)}  # rank of a pair
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.ranks = np.array([self.pairs[k] for k in self.keys.tolist()], np.int32)
        self.lookahead = sufficient_lookahead(merges, length)
        self.window = max(4 * self.lookahead, 256)
        self.symbols = byte_symbols()
        self.octet = {c: b for b, c in enumerate(self.symbols)}
        self.inner = np.array([vocab[x] for x in self.symbols], np.int64)
        self.final = np.array([vocab[x + self.suffix] for x in self.symbols], np.int64)
        self.path, self.library = path, None
        self.split_any = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^%s\p{L}\p{N}]+" % SPACE, regex.V1)
        # the same for texts in which \w, \d and \s mean the classes above
        self.split_latin = re.compile(r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\w\s]|_)+")
        self.doubtful = re.compile(unassigned())
        self.beyond = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u02ff]")
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.special_start = os.path.commonprefix(list(self.added))
        self.blank_end = re.compile(f"(?s:.*)(?=[{SPACE}])")
        self.inside = re.compile("(?s:.*)(?<![A-Za-z'|])[A-Za-z]+(?=[A-Za-z]{20})")

    @classmethod
    def load(cls, path: str) -> "BpeModel":
        """One model per process and path."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def words(self, text: str) -> list[str]:
        """The words of a text; white space only parts them, so it need not be
        collapsed first."""
        beyond = self.beyond.search(text)
        if beyond and self.doubtful.search(text):
            return self._library_words(text)
        # character by character, so without the rule for a final sigma
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self.split_any if beyond or self.beyond.search(text) else self.split_latin).findall(text)

    def parts(self, text: str) -> list[list[str] | int]:
        """Lists of words, and the ids of added tokens between them."""
        if not self.added or self.special_start not in text:
            return [self.words(text)]
        found = self.specials.split(text)
        return [self.added[x] if k % 2 else self.words(x) for k, x in enumerate(found)]

    def _library_words(self, text: str) -> list[str]:
        """The words of a text with code points unknown here."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, ids: list[int]) -> list[int]:
        """Merge by rank, the leftmost of equal ranks first."""
        rank, made, s = self.pairs.get, self.made, ids
        while len(s) > 1:
            pairs = [rank(a << SHIFT | b, NONE) for a, b in zip(s, s[1:])]
            best = min(pairs)
            if best == NONE:
                break
            new, k, out, n = int(made[best]), 0, [], len(s)
            while k < n:
                if k < n - 1 and pairs[k] == best:
                    out.append(new)
                    k += 2
                else:
                    out.append(s[k])
                    k += 1
            s = out
        return s

    def word_ids(self, word: str) -> list[int]:
        t = Transducer(self)
        return t.feed(word) + t.finish()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where((left < 0) | (right < 0), -1, left << SHIFT | right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE).astype(np.int32)

    def many_word_ids(self, words: list[str]) -> list[list[int]]:
        """``word_ids`` of many words at once. Words of at most 64 bytes, which is
        within the transducer's first window, are merged side by side."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list = [None] * len(raw)
        for least, most in ((1, 12), (13, 24), (25, 64)):
            of = [k for k, r in enumerate(raw) if least <= len(r) <= most]
            if of:
                for k, ids in zip(of, self._merged_rows([raw[k] for k in of], most)):
                    out[k] = ids
        return [self.word_ids(w) if ids is None else ids for w, ids in zip(words, out)]

    def _merged_rows(self, raw: list[bytes], width: int) -> list[list[int]]:
        """One word a row, its symbols a chain between two empty cells; each round
        merges the leftmost pair of the least rank in every row that has one."""
        n, step, size = len(raw), width + 2, np.array([len(r) for r in raw])
        octets, last = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - 1
        symbols = self.inner[octets]
        symbols[last] = self.final[octets[last]]
        column = np.arange(step)
        alive = ((column > 0) & (column <= size[:, None])).ravel()
        ids = np.full(n * step, -1, np.int64)
        ids[alive] = symbols
        after, before = np.arange(1, n * step + 1), np.arange(-1, n * step - 1)
        rank = np.full(n * step, NONE, np.int32)
        rank[alive] = self._rank(symbols, ids[after[alive]])
        rows = np.arange(n)
        while len(rows):
            part = rank.reshape(n, step)[rows]
            at = part.argmin(axis=1)
            best = part[np.arange(len(rows)), at]
            some = best < NONE
            rows, best = rows[some], best[some]
            p = rows * step + at[some]
            q, new = after[p], self.made[best]
            left, right = before[p], after[q]
            ids[p], alive[q], rank[q] = new, False, NONE
            after[p], before[right] = right, p
            rank[p] = self._rank(new, ids[right])
            rank[left] = self._rank(ids[left], new)
        tokens, ends = ids[alive].tolist(), np.cumsum(alive.reshape(n, step).sum(axis=1)).tolist()
        return [tokens[a:b] for a, b in zip([0, *ends], ends)]


class Transducer:
    """One word in pieces to token ids, with a window of bounded length."""

    def __init__(self, model: BpeModel):
        self.model, self.window, self.last = model, [], 0

    def feed(self, piece: str) -> list[int]:
        m, out = self.model, []
        for start in range(0, len(piece), m.window):
            octets = piece[start : start + m.window].encode("utf-8", "surrogatepass")
            self.window += m.inner[np.frombuffer(octets, np.uint8)].tolist()
            self.last = octets[-1]
            if len(self.window) > m.window + m.lookahead:
                done, safe = 0, len(self.window) - m.lookahead
                for i in m.merge(list(self.window)):
                    if done + m.size[i] > safe:
                        break
                    done += m.size[i]
                    out.append(i)
                del self.window[:done]
        return out

    def finish(self) -> list[int]:
        out = []
        if self.window:
            self.window[-1] = int(self.model.final[self.last])
            out = self.model.merge(self.window)
        self.window = []
        return out


class WordCoder:
    """Words to what ``render(ids)`` makes of their token ids.

    What was made is kept in two generations of about ``limit`` bytes each: when
    the young one is full it becomes the old one, so words in use stay.
    """

    def __init__(self, path: str, render, limit: int = 64 << 20):
        self.model, self.render, self.limit = BpeModel.load(path), render, limit
        self.young, self.old, self.bytes = {}, {}, 0
        self.added = {i: render([i]) for i in self.model.added.values()}

    def learn(self, words) -> None:
        """Makes sure that ``young`` has these words."""
        if self.bytes > self.limit:
            self.old, self.young, self.bytes = self.young, {}, 0
        young, old = self.young, self.old
        lost = set(words).difference(young)
        fresh = [w for w in lost if w not in old]
        for w in lost.difference(fresh):
            young[w] = old[w]
        for w, ids in zip(fresh, self.model.many_word_ids(fresh)):
            young[w] = self.render(ids)
        self.bytes += sum([300 + 8 * len(w) for w in lost])

    def rendered(self, parts) -> list:
        """Of words and added tokens that ``parts`` of a text gave."""
        get = self.young.__getitem__
        if len(parts) == 1:
            return list(map(get, parts[0]))
        return [x for p in parts for x in ([self.added[p]] if isinstance(p, int) else map(get, p))]

    def of(self, text: str) -> list:
        parts = self.model.parts(text)
        self.learn(w for p in parts if not isinstance(p, int) for w in p)
        return self.rendered(parts)

    def texts(self, texts, piece: int = 1 << 18):
        """For each text an iterator of lists of rendered words, to be used up
        before the next. Texts of up to ``piece`` characters in all are done at
        once; longer ones go through the stream encoder in pieces."""
        group: list[list] = []
        size = 0
        for t in texts:
            t = t or ""
            if group and size + len(t) > piece:
                yield from self._group(group)
                group, size = [], 0
            if len(t) > piece:
                yield self._long(t, piece)
            else:
                group.append(self.model.parts(t))
                size += len(t)
        yield from self._group(group)

    def _group(self, group):
        self.learn(set().union(*(p for parts in group for p in parts if not isinstance(p, int))))
        for parts in group:
            yield iter((self.rendered(parts),))

    def _long(self, text: str, piece: int):
        encoder = RenderedStream(self)
        for start in range(0, len(text), piece):
            yield encoder.feed(text[start : start + piece])
        yield encoder.finish()


class RenderedStream:
    """Text in pieces to rendered words; ``feed`` returns what is stable so far.

    Text is held back from the last place across which neither normalising nor
    word splitting looks: white space, or else, in a run longer than ``hold``,
    a place between two ASCII letters, where the word goes on in the transducer,
    which renders its tokens in parts. So the state is bounded by ``hold`` and
    a piece, but for runs of that length without white space and without two
    ASCII letters in a row.
    """

    def __init__(self, coder: WordCoder, hold: int = 1 << 12):
        self.coder, self.model, self.hold, self.held = coder, coder.model, hold, ""
        self.open: Transducer | None = None

    def _tokens(self, ids: list[int]) -> list:
        return [self.coder.render(ids)] if ids else []

    def _close(self) -> list:
        out = self._tokens(self.open.finish()) if self.open else []
        self.open = None
        return out

    def _part(self, text: str, more: bool) -> list:
        """``text`` rendered; with ``more``, its last word goes on after it."""
        parts, out, last = self.model.parts(text), [], None
        if self.open and isinstance(parts[0], list) and parts[0] and parts[0][0][0].isalpha() and text[0].isalpha():
            out += self._tokens(self.open.feed(parts[0].pop(0)))
            if more and parts == [[]]:
                return out
        if text:
            out += self._close()
        if more and isinstance(parts[-1], list) and parts[-1]:
            last = parts[-1].pop()
        self.coder.learn(w for p in parts if not isinstance(p, int) for w in p)
        out += self.coder.rendered(parts)
        if last is not None:
            self.open = Transducer(self.model)
            out += self._tokens(self.open.feed(last))
        return out

    def feed(self, piece: str) -> list:
        self.held += piece
        m, more = self.model.blank_end.match(self.held), False
        if not (m and m.end()) and len(self.held) > self.hold:
            m, more = self.model.inside.match(self.held), True
        cut = m.end() if m else 0
        if not cut:
            return []
        ready, self.held = self.held[:cut], self.held[cut:]
        return self._part(ready, more)

    def finish(self) -> list:
        ready, self.held = self.held, ""
        return self._part(ready, False) + self._close()


class StreamEncoder(RenderedStream):
    """Text in pieces to token ids."""

    def __init__(self, model: BpeModel, hold: int = 1 << 12):
        super().__init__(WordCoder(model.path, list), hold)

    def feed(self, piece: str) -> list[int]:
        return [i for w in super().feed(piece) for i in w]

    def finish(self) -> list[int]:
        return [i for w in super().finish() for i in w]


class StreamDecoder:
    """Token ids to text, incrementally (see the module's docstring)."""

    def __init__(self, model: BpeModel, mode: str = "surface"):
        self.model, self.mode = model, mode
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.reset()

    def reset(self) -> None:
        self.first, self.blank = True, False
        self.utf8.reset()

    def feed(self, ids) -> str:
        out = []
        if self.mode == "surface" and ids:
            out = [self.model.surface[i] for i in ids]
            if not self.first:
                out[0] = " " + out[0]
            self.first = False
            return " ".join(out)
        for i in ids:
            token = self.model.surface[i]
            if self.blank:
                out.append(" ")
                self.blank = False
            if token in self.model.added:
                out.append(self.utf8.decode(b"", True) + token)
                self.utf8.reset()
                self.blank = True
                continue
            ends = bool(self.model.suffix) and token.endswith(self.model.suffix)
            body = token[: -len(self.model.suffix)] if ends else token
            out.append(self.utf8.decode(bytes(self.model.octet[c] for c in body), ends))
            self.blank = ends
        return "".join(out)

    def finish(self) -> str:
        return "" if self.mode == "surface" else self.utf8.decode(b"", True)


def encode(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """Columns ``id_col`` and ``ids`` (array of int), one row per row of ``docs``.

    A null or empty text has no ids; ids of repeated or null keys are kept as
    they are; an empty table gives no rows. Other columns are ignored.
    """
    path = path or default_path()

    def run(batches):
        coder = WordCoder(path, list)
        for b in sliced(batches, 1):
            ids = [[i for words in lists for w in words for i in w] for lists in coder.texts(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    src = docs.select(docs[id_col], docs[text_col].cast("string"))
    return src.mapInArrow(run, f"`{id_col}` {src.dtypes[0][1]}, ids array<int>")


def decode(encoded: DataFrame, mode: str = "surface", id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """Columns ``id_col`` and ``text`` from ``ids``; null ids give an empty text."""
    path = path or default_path()

    def run(batches):
        model = BpeModel.load(path)
        for b in batches:
            texts = []
            for ids in b.column(1).to_pylist():
                d = StreamDecoder(model, mode)
                texts.append(d.feed(ids or ()) + d.finish())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    src = encoded.select(encoded[id_col], encoded["ids"])
    return src.mapInArrow(run, f"`{id_col}` {src.dtypes[0][1]}, text string")


def digest_coder(path: str) -> WordCoder:
    """Ids in decimal and decoded text of each word; one coder a process, so
    that a worker's later tasks find its words. Decoding to surfaces depends on
    nothing before a word, so the decoder's output of a word can be kept."""

    def make():
        decoder = StreamDecoder(BpeModel.load(path))

        def render(ids):
            decoder.reset()
            return " ".join(map(str, ids)).encode(), decoder.feed(ids).encode("utf-8", "replace")

        return WordCoder(path, render)

    return kept(("bpe-digests", path), make)


def digests(lists) -> tuple[int, str, str]:
    """Tokens, SHA-256 of the ids in decimal and of the decoded text, taken in
    while the stream goes on."""
    n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
    for words in lists:
        if not words:
            continue
        if n:
            ids.update(b" ")
            decoded.update(b" ")
        part = b" ".join([w[0] for w in words])
        n += part.count(b" ") + 1
        ids.update(part)
        decoded.update(b" ".join([w[1] for w in words]))
    return n, ids.hexdigest(), decoded.hexdigest()


def roundtrip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    One narrow pass without a shuffle. A null text counts as empty: no tokens,
    digests of nothing. Rows that repeat an id or a text get a row each, null
    ids stay null, an empty table gives no rows, further columns are ignored.
    Long texts are encoded, decoded and hashed in pieces.
    """
    path = path or default_path()

    def run(batches):
        coder = digest_coder(path)
        for b in sliced(batches, 1):
            got = [digests(lists) for lists in coder.texts(b.column(1).to_pylist())]
            cols = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select("doc_id", docs["text"].cast("string"))
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roundtrip_digests(table(spark, sf_dir, "documents"))


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


QUERIES = {"op1_bpe": op1_bpe}
ORACLES: dict[str, str] = {}

"""The corpus pipeline, stage by stage and as a whole."""

import random
import re
import zlib
from collections import Counter, defaultdict
from math import exp

import corpus_pipeline as cp
from tracewright.llm import bpe, langid
from tracewright.llm._common import staged

from .test_operators import library, odd_docs, prose  # noqa: F401


def test_odd_tables_pass_every_stage(spark):
    df, _ = odd_docs(spark)
    for name, stage in cp.STAGES[:-1]:
        for docs in (df, df.limit(0)):
            out = stage(spark, docs, "unused")
            assert out.columns == df.columns, name
            out.collect()


def test_dedup_stages_keep_one(spark):
    df, rows = odd_docs(spark)
    left = cp.exact_duplicates(spark, df, "unused").collect()
    assert len(left) == len({(r[1] or "").lower() for r in rows})
    texts = [prose(1, 90), prose(1, 90) + " end", prose(2, 90)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, "unused").collect()) == [0, 2]


def test_run(spark, tmp_path):
    r = random.Random(3)
    voc = {"en": "the and of with they said when people river house which".split(), "de": "der und von mit sie sagte wenn leute fluss haus welche".split()}
    rows = [(k, " ".join(r.choice(voc[lang]) for _ in range(80)) + f" mail x{k}@example.com", lang, "s", 0) for k in range(60) for lang in [("en", "de")[k % 2]]]
    rows += [(100, rows[0][1], "en", "s", 0), (101, None, None, "s", 0), (102, "12 34", None, "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    ids = {g.doc_id for g in got}
    assert 100 in ids and not ids & {0, 101, 102} and len(ids) >= 55
    assert all(g.offset + g.length <= 2048 for g in got)


def certain(model, text, least):
    """By the forward sums of one word at a time."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    sums = [sum(x) for x in zip(*map(model.word, words))]
    return bool(words) and 1 / sum(exp(max(-700.0, s - max(sums))) for s in sums) >= least


def shingles(text):
    w = re.findall(r"\w+", (text or "").lower())
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if k else Counter()


def similarity(a, b):
    """Probability Jaccard, term by term."""
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys())


def test_every_stage_against_brute_force(spark, library):  # noqa: F811
    r = random.Random(8)
    voc = {"en": "the and of with they said when people river house which after".split(), "de": "der und von mit sie sagte wenn leute fluss haus welche nach".split()}
    texts = [" ".join(r.choice(voc[("en", "de")[k % 2]]) for _ in range(70)) + f" mail u{k % 9}@example.com and more" for k in range(50)]
    texts += [texts[3], texts[4].upper(), texts[5].replace("mail", "post"), texts[6] + " at the end", None, "", "12 34", "the der", texts[7] * 60]
    rows = [(k, t, ("en", "de")[k % 2] if k < 50 else None, "s", len(t or "")) for k, t in enumerate(texts)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model, stages = langid.fit(docs), dict(cp.STAGES)

    def after(name):
        nonlocal docs
        before = {x.doc_id: x.text for x in docs.collect()}
        docs = staged(stages[name](spark, docs, "unused"), "test-stage")
        return before, {x.doc_id: x.text for x in docs.collect()}

    before, left = after("language")
    assert left == {k: t for k, t in before.items() if certain(model, t, cp.LEAST_SCORE)}

    before, left = after("exact_duplicates")
    last = {re.sub("[A-Z]", lambda m: m[0].lower(), t): k for k, t in sorted(before.items())}
    assert left == {k: before[k] for k in last.values()}

    before, left = after("near_duplicates")
    sets, root = {k: shingles(t) for k, t in before.items()}, {k: k for k in before}
    for a in sorted(before):
        for b in sorted(before):
            if a < b and root[a] != root[b] and similarity(sets[a], sets[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert left == {k: before[k] for k in set(root.values())}

    before, left = after("privacy")
    assert left.keys() == before.keys()
    mail, new = re.compile(r"(?i)u\d@example\.com"), defaultdict(set)
    for k, t in before.items():
        kept = mail.split(t)
        got = re.fullmatch("(.*?)".join(map(re.escape, kept)), left[k], re.DOTALL)
        for old, now in zip(mail.findall(t), got.groups()):
            assert re.fullmatch(r"[^@\s]+@[^@\s]+\.\w+", now) and now.lower() != old.lower()
            new[old.lower()].add(now.lower())
    assert all(len(x) == 1 for x in new.values()) and len(set.union(*new.values())) == len(new)
    assert {x.doc_id: x.n_chars for x in docs.collect()} == {k: len(t) for k, t in left.items()}

    pieces = defaultdict(list)
    for g in stages["packing"](spark, docs, "unused").collect():
        pieces[g.doc_id].append(g)
    assert pieces.keys() == left.keys()
    for k, t in left.items():
        ids, at = library.encode(t, add_special_tokens=False).ids + [1], 0
        for g in sorted(pieces[k], key=lambda g: g.start):
            assert g.start == at and g.ids_crc32 == zlib.crc32(bpe.pack_ids(ids[at : at + g.length]))
            at += g.length
        assert at == len(ids)

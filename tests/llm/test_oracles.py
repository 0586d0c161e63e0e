"""Queries with SQL against that SQL, on a table of odd and repeated rows."""

import random

import duckdb
import pytest

from tracewright.llm import queries

from .test_operators import prose


def odd_texts():
    r = random.Random(9)
    texts = [None, "", " \n\t", "one", "five words are just enough", "FIVE words are just enough", "# $ % & | < > *" * 4, "NAÏVE ÀÉ Ω " * 9, "wow! " * 12, "日本語 テキスト です " * 8, "1 2 3 4 5 6 7 8 9 10 11 12", "x" * 400 + " y" * 12, "a b c\x0bd\x1ce " * 7]
    for k in range(8):
        lines = [prose(100 + k, 9) for _ in range(3)]
        texts += ["\n".join([*lines, *lines[: k % 4], ""]), prose(200 + k, 90), " ".join([*prose(200 + k, 90).split()[:-3], "other", "end", "words"])]
    for k in range(40):  # copies with edits, alike ones too
        w = prose(300 + k % 5, 70).split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"edit{r.randrange(9)}"
        texts.append(" ".join(w))
    texts += [prose(7, 30) * 3 + " " + prose(8, 40), prose(7, 30) * 4 + " " + prose(8, 40), prose(1, 6000)]
    return texts


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, tmp_path, name):
    texts = odd_texts()
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(k, f"http://h/{k % 7}", t) for k, t in enumerate(texts + texts[:9])]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, str(tmp_path)).select(*want.columns)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)

"""Licence headers against dense vectors, and what is and is no licence."""

import math
from collections import Counter

import pytest

from tracewright.llm import licenses

NOTICES = {
    "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This file is part of Foo. Foo is licensed under the GNU General Public License version 3": "GPL-3.0", "All rights reserved.": "Proprietary", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "SPDX-License-Identifier: ISC": "ISC", "Redistribution and use in source and binary forms, with or without modification, are permitted": "BSD-2-Clause",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "MIT",
}
OTHERS = [
    "This restaurant holds a license to serve food under the city rules.", "You need a fishing license and a permission to copy this.", "SPDX-License-Identifier: BSL-1.0",
    "Driver license office open Monday", "The public domain is large", "Her licence was taken away in 2019.", "", None, "copyright",
]


def test_notices_and_counter_examples():
    m = licenses.Matcher()
    for text, name in NOTICES.items():
        got = m.file(text)
        assert got[0] == name and got[1] >= licenses.LEAST, (text, got)
    for text in OTHERS:
        assert m.file(text)[1] < licenses.LEAST, (text, m.file(text))


@pytest.mark.parametrize("text", [*NOTICES, *OTHERS[:6], "mit mit gpl license zebra"])
def test_cosine_equals_dense_vectors(text):
    m = licenses.Matcher()
    texts = [*licenses.TEMPLATES.items(), *((k, f.format(n)) for k, n in licenses.NAMES.items() for f in licenses.FORMS)]
    counts = lambda t: Counter(licenses.TOKEN.findall(t.lower()))
    df = Counter(w for _, t in texts for w in counts(t))
    weight = lambda w: math.log((1 + len(texts)) / (1 + df[w])) + 1
    words = sorted(set(df) | set(counts(text)))
    vector = lambda t: [counts(t)[w] * weight(w) for w in words]
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    best = max(cos(vector(text), vector(t)) for _, t in texts)
    assert m.cosine(text)[1] == pytest.approx(best)


def test_inheritance_against_brute_force(spark):
    """Deep paths, directories without files of their own, ties and repeated rows."""
    rows = [(1, "a/LICENSE", "MIT License"), (2, "a/b/c/d/x.py", "code"), (3, "a/b/COPYING", "Licensed under the Apache License, Version 2.0"), (4, "a/b/c/y.py", None), (4, "a/b/c/y.py", None),
        (5, "z.py", ""), (6, "a/e/LICENSE", "Her licence"), (7, "a/e/q", "x"), (8, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0"), (9, "ab/x", "")]
    got = licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()
    m, given = licenses.Matcher(), {}
    for _, path, text in rows:
        name, sim, _ = m.file(text)
        if licenses.FILES.search(path) and sim >= licenses.LEAST:
            given[path.rpartition("/")[0]] = name

    def inherited(path):
        while "/" in path:
            path = path.rpartition("/")[0]
            if path in given:
                return given[path]
        return given.get("")

    assert len(got) == len(rows)
    for g in got:
        own = m.file(next(t for i, p, t in rows if (i, p) == (g.id, g.path)))
        assert g.licence == (own[0] if own[1] >= licenses.LEAST else inherited(g.path)), g

"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by path.

Sentences of a file that speak of licences or copyright (anywhere in the whole
text) are its headers; they are compared with templates, a licence's notice and
short forms of its name, by the cosine of sparse TF-IDF vectors over words, whose
document frequencies come from the template set. Words that no template has weigh
most and count in a header's norm. The best match at or above ``least``, which lies
between the notices and the counter-examples of the tests, is the file's own
licence; an SPDX identifier decides alone, and one that is unknown here is no
licence. The texts are read once: what was found in them is written to the shared
folder. A file named like a licence file speaks for its directory. Files without a licence
of their own inherit from the nearest ancestor directory that has one: distinct
directories are resolved first (their ancestors joined with the speaking
directories by path), and files are joined to the resolved directories.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import sliced, staged, table

TEMPLATES = {
    "MIT": "released under the mit license permission is hereby granted free of charge to any person obtaining a copy of this software",
    "Apache-2.0": "licensed under the apache license version 2.0 you may not use this file except in compliance with the license",
    "GPL-3.0": "this work is licensed under the gnu general public license version 3 free software foundation either version 3 of the license",
    "GPL-2.0": "this program is licensed under the gnu general public license version 2 free software foundation either version 2 of the license",
    "LGPL-3.0": "licensed under the gnu lesser general public license version 3 this library is free software",
    "AGPL-3.0": "licensed under the gnu affero general public license version 3 network use is distribution",
    "BSD-3-Clause": "bsd 3 clause license redistribution and use in source and binary forms with or without modification are permitted neither the name",
    "BSD-2-Clause": "bsd 2 clause license redistribution and use in source and binary forms with or without modification are permitted",
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license version 2.0",
    "ISC": "isc license permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "CC-BY-4.0": "licensed under cc by 4.0 creative commons attribution 4.0 international",
    "CC-BY-SA-4.0": "licensed under cc by sa 4.0 creative commons attribution share alike 4.0 international",
    "CC-BY-NC-4.0": "licensed under cc by nc 4.0 creative commons attribution non commercial 4.0 international",
    "CC0-1.0": "cc0 1.0 universal creative commons public domain dedication waived all copyright",
    "Unlicense": "the unlicense this is free and unencumbered software released into the public domain",
    "Proprietary": "copyright all rights reserved confidential proprietary unauthorized copying is prohibited",
}
#: What licences are called in short headers ("Released under the MIT License.").
NAMES = {
    "MIT": "mit license", "Apache-2.0": "apache license version 2.0", "GPL-3.0": "gnu general public license version 3", "GPL-2.0": "gnu general public license version 2",
    "LGPL-3.0": "gnu lesser general public license version 3", "AGPL-3.0": "gnu affero general public license version 3", "BSD-3-Clause": "bsd 3 clause license", "BSD-2-Clause": "bsd 2 clause license",
    "MPL-2.0": "mozilla public license version 2.0", "ISC": "isc license", "CC-BY-4.0": "cc by 4.0", "CC-BY-SA-4.0": "cc by sa 4.0", "CC-BY-NC-4.0": "cc by nc 4.0", "CC0-1.0": "cc0 1.0", "Unlicense": "unlicense",
}
FORMS = ("{}", "licensed under the {}", "this work is released under the {}")
HEADER = re.compile(r"\b(?:licen[sc]e[ds]?|unlicense|copyright|spdx-license-identifier|all rights reserved|permission is hereby granted|redistribution and use|public domain)\b", re.I)
SENTENCE = re.compile(r"(?<=[.!?;])\s+(?=\S)")
TOKEN = re.compile(r"[a-z]+|\d+(?:\.\d+)*")
SPDX = re.compile(r"spdx-license-identifier:\s*([\w.+-]+)", re.I)
FILES = re.compile(r"(?:^|/)(?:licen[sc]e|copying|unlicense|notice)(?:[.-][^/]*)?$", re.I)
LEAST = 0.5


class Matcher:
    def __init__(self, templates: dict[str, str] = TEMPLATES, names: dict[str, str] = NAMES):
        texts = [*templates.items(), *((k, form.format(n)) for k, n in names.items() for form in FORMS)]
        docs = [(k, Counter(TOKEN.findall(v.lower()))) for k, v in texts]
        df = Counter(t for _, c in docs for t in c)
        self.idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
        self.unseen = math.log(1 + len(docs)) + 1
        self.names, self.licences = {k.lower(): k for k in templates}, [k for k, _ in docs]
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for j, (_, c) in enumerate(docs):
            norm = self._norm(c)
            for t, n in c.items():
                self.postings.setdefault(t, []).append((j, n * self.idf[t] / norm))

    def _norm(self, counts: Counter) -> float:
        return math.sqrt(sum((n * self.idf.get(t, self.unseen)) ** 2 for t, n in counts.items()))

    def cosine(self, text: str) -> tuple[str | None, float]:
        """Licence of the template closest to one header, and its cosine; ties by
        name."""
        got = Counter(TOKEN.findall(text.lower()))
        norm, score = self._norm(got), {}
        for t, n in got.items():
            for j, w in self.postings.get(t, ()):
                score[j] = score.get(j, 0.0) + n * self.idf[t] / norm * w
        if not score:
            return None, 0.0
        best = min(score, key=lambda j: (-round(score[j], 9), self.licences[j]))
        return self.licences[best], score[best]

    def file(self, text: str | None) -> tuple[str | None, float, int]:
        """Licence, similarity and number of headers of a whole text."""
        best, top, n, text, end = None, 0.0, 0, text or "", -1
        for m in HEADER.finditer(text):
            if m.start() < end:
                continue  # in a line that has been done
            end = text.find("\n", m.end())
            end = len(text) if end < 0 else end
            for s in SENTENCE.split(text[text.rfind("\n", 0, m.start()) + 1 : end]):
                if not HEADER.search(s):
                    continue
                n += 1
                if x := SPDX.search(s):
                    name = self.names.get(x[1].lower())
                    sim = 1.0 if name else 0.0
                else:
                    name, sim = self.cosine(s)
                if name and (sim > top or sim == top and name < best):
                    best, top = name, sim
        return best, top, n


def scan(files: DataFrame, least: float = LEAST) -> DataFrame:
    """Of rows (id, path, text): id, path, own, similarity, headers, licence, source.

    ``source`` is ``own``, ``inherited`` or ``none``. Null and empty texts have no
    headers; files with a null path inherit nothing; of licence files in one
    directory the most similar speaks, then the smallest name. Ids, repeated
    ones too, pass unchanged; further columns are ignored.
    """

    def run(batches):
        m = Matcher()
        for b in sliced(batches, 2):
            got = [m.file(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0] if g[1] >= least else None for g in got], pa.string()), pa.array([round(g[1], 6) for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int64())], ["id", "path", "own", "similarity", "headers"])

    src = files.select("id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    own = src.mapInArrow(run, f"id {src.dtypes[0][1]}, path string, own string, similarity double, headers long")
    own = staged(own, "licence-scan").withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    speaks = own.where(F.col("own").isNotNull() & F.col("path").rlike("(?i)" + FILES.pattern)).groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "own")).alias("best")).select(F.col("dir").alias("above"), F.col("best.own").alias("given"))
    parts = F.split("dir", "/")
    dirs = own.where("path is not null").select("dir").distinct()
    chain = dirs.select("dir", F.posexplode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("depth", "above"))
    resolved = chain.join(speaks, "above").groupBy("dir").agg(F.max(F.struct("depth", "given")).alias("near")).select("dir", F.col("near.given").alias("given"))
    out = own.join(resolved, "dir", "left")
    return out.select("id", "path", "own", "similarity", "headers", F.coalesce("own", "given").alias("licence"), F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("source"))


def document_files(docs: DataFrame) -> DataFrame:
    """``documents`` as files: a tree source/thousand/hundred; the first document of
    a hundred is its directory's LICENSE, that of a thousand the one above."""
    i = F.col("doc_id")
    big, mid = F.floor(i / 1000).cast("string"), F.floor(i / 100).cast("string")
    src = F.coalesce(F.col("source").cast("string"), F.lit("none"))
    path = F.when(i % 1000 < 20, F.concat_ws("/", src, big, F.lit("LICENSE"))).when(i % 100 < 20, F.concat_ws("/", src, big, mid, F.lit("LICENSE"))).otherwise(F.concat_ws("/", src, big, mid, i.cast("string")))
    return docs.select(i.alias("id"), path.alias("path"), "text")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(document_files(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


QUERIES = {"op6_licenses": op6_licenses}
ORACLES: dict[str, str] = {}

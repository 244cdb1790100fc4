"""Licence scans by a positional rare-token index, in DataFrame operations only.

Every template has a mandatory key phrase, whose words must stand as they are, and
may have further words, of which a share may differ. One pass over the texts keeps of each document which licence words it
has, and its words only if it has all those of some key phrase. Inverse document frequencies come from all documents. Of the templates that a document
can hold, it is then searched for each key phrase's word of the highest IDF: the word's postings say where in which template it
stands, so each of its positions in the document, less that place, is where the template would start. There the
template's words are compared place by place, key phrase first. As the key phrase must match whole, its
rarest word finds every match. Templates are data, not part of the plan: it stays the same however many there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import LOWER, UPPER, Shared, ascii_lower, text_of

#: ASCII letters and digits and all characters beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the contract and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further templates as (label, text, key phrase in it).
TEMPLATES = [
    ("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nd", "cc by nd", "cc by nd"),
    ("mpl", "mozilla public license", "mozilla public license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "copy modify and or distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("mit-whole", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", "merge publish distribute sublicense and or sell copies of the software"),
    ("isc-whole", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software", "with or without fee is hereby granted"),
    ("bsd-whole", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistributions of source code must retain the above copyright notice"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions", "to alter it and redistribute it freely"),
    ("unlicense-whole", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "publish use compile sell or distribute this software"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "you may not use this file except in compliance with the license"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "person or organization obtaining a copy of the software and accompanying documentation"),
]
#: Share of a template's words that must stand at their places.
SHARE = 0.75


def _templates() -> list[dict]:
    rows = [(label, phrase, phrase, True) for phrase, label in BASE.items()] + [(*t, False) for t in TEMPLATES]
    out = []
    for label, text, key, base in rows:
        words, own = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        out.append({"label": label, "words": words, "key": own, "at": at, "base": base, "least": math.ceil(SHARE * len(words))})
    return out


def document_frequency(rows: DataFrame) -> dict[str, int]:
    """Documents that have each licence word, of rows (present: distinct words of a fixed, small vocabulary); one row a word reaches the driver."""
    found = rows.select(F.explode("present").alias("w"))
    return {r.w: r.n for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}


def _texts(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _index(templates: list[dict], df: dict[str, int]) -> Column:
    """The templates as an array, each with the word of its key phrase that has the highest IDF, and the place of that word in it.

    All words have the same number of documents over them, so the one in the fewest documents has the highest IDF.
    """
    out = []
    for t in templates:
        rare = min(range(len(t["key"])), key=lambda i: (df.get(t["key"][i], 0), i))
        fields = {"label": F.lit(t["label"]), "base": F.lit(t["base"]), "words": _texts(t["words"]), "key": _texts(t["key"]), "at": F.lit(t["at"]), "least": F.lit(t["least"]), "rare": F.lit(t["key"][rare]), "shift": F.lit(t["at"] + rare)}
        out.append(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return F.array(*out)


def _matches(t: Column, hits: Column, words: Column) -> Column:
    """(start, n) of each place, counted from 0, where the template starts, n the words that stand as in it; ascending."""
    starts = F.transform(F.filter(hits, lambda h: h.w == t.rare), lambda h: h.i - t["shift"])
    starts = F.filter(starts, lambda s: (s >= 0) & (F.slice(words, s + t["at"] + 1, F.size(t.key)) == t.key))
    same = lambda s: F.aggregate(F.zip_with(t.words, F.slice(words, s + 1, F.size(t.words)), lambda a, b: a.eqNullSafe(b).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.filter(F.transform(starts, lambda s: F.struct(s.alias("start"), same(s).alias("n"))), lambda m: m.n >= t.least)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, found.

    found lists each template with its starts. score is the share of matched words of the best template, 0 without any.
    Null and empty texts have no words, null places and empty labels. Words are compared after lower-casing A-Z.
    The same start counts once for each phrase that stands there. Repeated rows are scanned alike. An empty table gives an empty result;
    other columns are not read. The longest text costs its own words only: no row leaves its task.
    """
    shared, templates = Shared(docs.sparkSession, "license"), _templates()
    keys = F.array(*[_texts(k) for k in sorted({tuple(t["key"]) for t in templates})])
    vocabulary = _texts(sorted({w for t in templates for w in t["key"]}))
    rows = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(ascii_lower(text_of(text_col)), F.lit(LICENSE_WORD), F.lit(0)).alias("words"))
    rows = rows.select("id", F.size("words").cast("long").alias("n_words"), F.array_intersect(vocabulary, "words").alias("present"), "words")
    able = F.exists(keys, lambda k: F.size(F.array_except(k, "present")) == 0)
    rows = shared.save(rows.withColumn("words", F.when(able, F.col("words"))), "words")

    df = document_frequency(rows)
    rare = sorted({min(t["key"], key=lambda w: (df.get(w, 0), t["key"].index(w))) for t in templates})
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h.w.isin(*rare))
    rows = rows.withColumn("hits", hits)
    of_each = F.transform(_index(templates, df), lambda t: F.struct(t.label.alias("label"), t.base.alias("base"), F.size(t.words).alias("size"), _matches(t, F.col("hits"), F.col("words")).alias("m")))
    rows = rows.withColumn("found", F.when(F.col("words").isNotNull(), F.filter(of_each, lambda t: F.size(t.m) > 0)))
    base = F.filter("found", lambda t: t.base)
    rows = rows.withColumn("places", F.flatten(F.transform(base, lambda t: F.transform(t.m, lambda m: m.start))))
    labels = lambda found: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda t: t.label))), ","), F.lit(""))
    score = F.array_max(F.transform("found", lambda t: F.array_max(F.transform(t.m, lambda m: m.n / t["size"]))))
    return rows.select(
        "id",
        "n_words",
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.coalesce(F.transform("found", lambda t: F.struct(t.label.alias("label"), F.transform(t.m, lambda m: m.start).alias("starts"))), F.array().cast("array<struct<label:string,starts:array<int>>>")).alias("found"),
    )


def duckdb_sql() -> str:
    """The same result by brute force: every template is tried at every word of every document."""
    tries, least = [], []
    for t in _templates():
        key = " AND ".join(f"w[s + {t['at'] + i + 1}] = '{x}'" for i, x in enumerate(t["key"]))
        listed = "[" + ", ".join(f"'{x}'" for x in t["words"]) + "]"
        count = f"len(list_filter(range({len(t['words'])}), lambda j: w[s + j + 1] = {listed}[j + 1]))" if t["words"] != t["key"] else str(len(t["words"]))
        starts = f"list_filter(range(len(w)), lambda s: {key} AND {count} >= {t['least']})"
        best = f"list_max(list_transform({starts}, lambda s: ({count}) / {len(t['words'])}::DOUBLE))"
        tries.append((t["label"], t["base"], starts))
        least.append(best)
    names = [f"t{i}" for i in range(len(tries))]
    columns = ",\n".join(f"{starts} AS {n}" for n, (_, _, starts) in zip(names, tries, strict=True))
    base = [n for n, (_, is_base, _) in zip(names, tries, strict=True) if is_base]
    places = "flatten([" + ", ".join(base) + "])"
    label = lambda which: "coalesce(array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN len({n}) > 0 THEN '{x}' END" for n, (x, b, _) in zip(names, tries, strict=True) if which(b)) + "], lambda x: x IS NOT NULL))), ','), '')"
    return f"""
        WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LICENSE_WORD}') AS w FROM documents),
        found AS (SELECT doc_id, w, {columns}, coalesce(list_max([{", ".join(least)}]), 0) AS score FROM words)
        SELECT doc_id, len(w)::BIGINT AS n_words, len({places})::BIGINT AS n_base, list_min({places})::BIGINT AS first_word, list_max({places})::BIGINT AS last_word,
               {label(lambda b: b)} AS base_labels, {label(lambda b: True)} AS labels, score::DOUBLE AS score
        FROM found
    """

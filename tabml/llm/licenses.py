"""Licence scan by a positional index of rare licence words, in built-in functions only.

Templates are licence statements, short references and whole notices. Word
frequencies over all documents give every template word its inverse document
frequency. A template can only stand where its mandatory key phrases do, so the
index holds one posting of each: the position of the highest-idf word of its
key phrases. A file looks up those of its words that are in the index; a
posting fixes where the template would start, the places of the key phrases'
words are intersected with the file's at those relative positions, and a
template counts if enough of its idf mass, one of its rarest words included,
stands in place. Ordinary files hold no word of the index and go no further.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words: runs of digits, lower-case letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Verbatim word runs that must stand in place; (start in the template, number of words).
    keys: tuple[tuple[int, int], ...]


def template(label: str, text: str, *keys: str) -> Template:
    words = text.split()
    spans = []
    for key in keys:
        k = key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(k)] == k)
        spans.append((at, len(k)))
    return Template(label, text, tuple(spans))


# Public licence statements, as their words read.
TEMPLATES = (
    template("cc-by", "cc by", "cc by"),
    template("gpl", "general public license", "general public license"),
    template("reserved", "all rights reserved", "all rights reserved"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    template("mit", "released under the mit license", "mit license"),
    template("mit", "licensed under the mit license", "mit license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("lgpl-2.1", "licensed under the gnu lesser general public license version 2 1", "lesser general public license version 2 1"),
    template("lgpl-3.0", "licensed under the gnu lesser general public license version 3", "lesser general public license version 3"),
    template("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero general public license"),
    template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    template("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    template("cc0-1.0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "for any purpose with or without fee"),
    template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
             "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
             "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all "
             "copies or substantial portions of the software", "permission is hereby granted free of charge", "without limitation the rights to use copy modify merge publish distribute sublicense"),
    template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
             "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
             "without warranties or conditions of any kind either express or implied", "apache license version 2", "except in compliance with the license"),
    template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must "
             "reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
             "redistributions of source code must retain the above copyright notice", "redistributions in binary form must reproduce the above copyright notice"),
    template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
             "specific prior written permission", "endorse or promote products derived from this software"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
             "permission notice appear in all copies", "for any purpose with or without fee is hereby granted"),
    template("gpl-2.0", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either "
             "version 2 of the license or at your option any later version", "gnu general public license", "version 2 of the license"),
    template("gpl-3.0", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either "
             "version 3 of the license or at your option any later version", "gnu general public license", "version 3 of the license"),
    template("lgpl-2.1", "free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either "
             "version 2 1 of the license or at your option any later version", "gnu lesser general public license", "version 2 1 of the license"),
    template("lgpl-3.0", "free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either "
             "version 3 of the license or at your option any later version", "gnu lesser general public license", "version 3 of the license"),
    template("agpl-3.0", "free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either "
             "version 3 of the license or at your option any later version", "gnu affero general public license", "version 3 of the license"),
    template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
             "mozilla public license v 2 0", "if a copy of the mpl was not distributed"),
    template("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial "
             "or non commercial and by any means", "either in source code form or as a compiled binary"),
    template("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the "
             "following restrictions", "alter it and redistribute it freely"),
    template("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license "
             "the software to use reproduce display distribute execute and transmit the software", "any person or organization obtaining a copy of the software and accompanying documentation"),
    template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    template("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike 4 0"),
    template("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial 4 0"),
)


def words_of(text: Column) -> Column:
    """The words of a whole text (null: empty) with A-Z lower-cased."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is translate() but for letters beyond ASCII, which are word characters either way; of those, only the
    # Kelvin sign and the dotted capital I turn into ASCII letters
    low = F.when(text.rlike("[Kİ]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def document_frequencies(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """Documents that hold each vocabulary word, and under "" the number of all: one row per word at the driver."""
    known = F.array(*map(F.lit, sorted(vocabulary)))
    each = words.select(F.explode(F.array_append(F.array_intersect("words", known), F.lit(""))).alias("w"))
    return {r.w: r.n for r in each.groupBy("w").agg(F.count("*").alias("n")).collect()}


def _strings(values: Sequence[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _starts(phrase: str) -> str:
    """SQL for the word positions where a phrase stands."""
    same = " AND ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
    return f"filter(sequence(0, size(words) - 1), i -> {same})"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[Template] = TEMPLATES, base: dict[str, str] = BASE, rare: int = 3, least: float = 0.6) -> DataFrame:
    """Licence labels of every whole text.

    Returns doc_id, n_words, n_base (places of all base phrases), first_word
    and last_word (smallest and largest of their starts, else null),
    base_labels, labels (those and the templates'; distinct, sorted,
    comma-joined), score (0 to 1: the largest share of a template's idf mass
    in place among those that count; 0 without any) and matches (label, start
    word and share of each). ``rare``: a template counts where one of that many of its
    highest-idf words stands; ``least``:
    share that counts. A null text is empty: no words, no labels. A null id
    stays null; repeated rows come back as often as given.
    """
    words = docs.select(docs[id_col].cast("long").alias("doc_id"), words_of(docs[text_col]).alias("words"))
    bodies = [t.text.split() for t in templates]
    n = document_frequencies(words, sorted({w for b in bodies for w in b}))
    idf = {w: math.log((1 + n.get("", 0)) / (1 + n.get(w, 0))) + 1e-3 for b in bodies for w in b}
    rarest = lambda of: min(of, key=lambda w: (n.get(w, 0), w))
    # word -> (template, position): every match of the template has that word there
    postings: dict[str, list[tuple[int, int]]] = {}
    some = []
    for k, (t, b) in enumerate(zip(templates, bodies, strict=True)):
        keys = [i for at, size in t.keys for i in range(at, at + size)]
        word = rarest(b[i] for i in keys)
        postings.setdefault(word, []).append((k, next(i for i in keys if b[i] == word)))
        top = sorted(set(b), key=lambda w: (-idf[w], w))[:rare]
        some.append([i for i, w in enumerate(b) if w in top])
    looked = sorted({*postings, *(rarest(p.split()) for p in base)})

    places = {p: f"IF(array_contains(words, '{rarest(p.split())}'), {_starts(p)}, array())" for p in base}
    hits = words.withColumn("hit", F.arrays_overlap("words", F.array(*map(F.lit, looked))))
    for k, (_, sql) in enumerate(places.items()):
        hits = hits.withColumn(f"base_{k}", F.expr(f"IF(hit, CAST({sql} AS array<int>), CAST(array() AS array<int>))"))

    # postings of a word, as template number and position in the template
    lookup = " ".join(f"WHEN '{w}' THEN array({', '.join(f'named_struct("t", {t}, "at", {i})' for t, i in sorted(p))})" for w, p in sorted(postings.items()))
    inside = ", ".join(f"'{w}'" for w in sorted(postings))
    found = (
        "filter(transform(words, (x, i) -> IF(x IN (" + inside + "), named_struct('x', x, 'i', i), NULL)), o -> o IS NOT NULL)"
    )
    starts = f"flatten(transform({found}, o -> transform(CASE o.x {lookup} END, p -> named_struct('t', p.t, 'd', o.i - p.at))))"
    hits = hits.withColumn("starts", F.expr(f"IF(hit, {starts}, CAST(array() AS array<struct<t:int,d:int>>))"))

    table = "array(" + ", ".join(
        f"named_struct('label', '{t.label}', 'words', {_strings(b)}, 'idf', array({', '.join(f'{idf[w]!r}D' for w in b)}), 'mass', {sum(idf[w] for w in b)!r}D, "
        f"'keys', array({', '.join(str(i) for at, size in t.keys for i in range(at, at + size))}), 'some', array({', '.join(map(str, r))}))"
        for t, b, r in zip(templates, bodies, some, strict=True)
    ) + ")"
    # key phrases first: exact and cheap; a start before the text finds no words there
    at = "IF(c.d + {0} < 0, NULL, get(words, c.d + {0}))"
    same = f"k -> {at.format('k')} <=> element_at(element_at(templates, c.t + 1).words, k + 1)"
    kept = f"filter(starts, c -> forall(element_at(templates, c.t + 1).keys, {same}) AND exists(element_at(templates, c.t + 1).some, {same}))"
    share = (
        "aggregate(sequence(0, size(element_at(templates, c.t + 1).words) - 1), 0D, (s, j) -> s + "
        f"IF({at.format('j')} <=> element_at(element_at(templates, c.t + 1).words, j + 1), element_at(element_at(templates, c.t + 1).idf, j + 1), 0D)) / element_at(templates, c.t + 1).mass"
    )
    matches = f"array_distinct(filter(transform({kept}, c -> named_struct('label', element_at(templates, c.t + 1).label, 'start', c.d, 'share', least(1D, {share}))), m -> m.share >= {least}D))"
    hits = hits.withColumn("templates", F.expr(table))
    hits = hits.withColumn("matches", F.expr(f"IF(size(starts) > 0, {matches}, CAST(array() AS array<struct<label:string,start:int,share:double>>))"))

    all_starts = F.concat(*[F.col(f"base_{k}") for k in range(len(base))])
    base_labels = F.array_compact(F.array(*[F.when(F.size(f"base_{k}") > 0, F.lit(label)) for k, label in enumerate(base.values())]))
    hits = hits.withColumn("places", all_starts).withColumn("named", base_labels)
    return hits.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("named", F.transform("matches", lambda m: m["label"])))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
        "matches",
    )

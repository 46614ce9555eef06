"""Licence scans with a positional index of rare words.

Licence notices are templates: a label, a text, and phrases that must be there. Their words
are weighed by how many documents of the corpus hold them. Of each file the rarest licence
words are taken; a template that shares enough of its own rarest words with them is looked
up: each place of a shared word proposes where the notice would begin (its place less the
word's place in the template), and a beginning that several of these words agree on is
kept. There, the mandatory phrases are checked, and the share of the template's words found
is the score.

Everything is an expression of the row's own words, without a shuffle; only the counts of
licence words, as many as the templates have words, come from an aggregation.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import bound_to, free_name

#: Words are runs of anything but ASCII characters other than digits and a-z (fixed value).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Licence words looked at in a file; a template's rarest words; how many must agree.
FILE_WORDS = 32
TEMPLATE_WORDS = 5
AGREE = 3
#: Words before and after a notice in which its phrases may stand.
SLACK = 4


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Each of these must be there.
    phrases: tuple[str, ...]


# Phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Public licence notices, without names and years.
TEMPLATES = (
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ("permission is hereby granted free of charge", "sublicense")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache license", "version 2")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2")),
    Template("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", ("gnu general public license", "version 2")),
    Template("gpl-2", "This work is licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ("gnu general public license", "version 3")),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", ("gnu affero general public license",)),
    Template("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", ("redistribution and use in source and binary forms", "must retain the above copyright notice")),
    Template("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ("endorse or promote products derived from this software",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ("for any purpose with or without fee is hereby granted",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", ("mozilla public license", "v 2")),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain.", ("unencumbered software released into the public domain",)),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", ("provided as is without any express or implied warranty", "held liable for any damages")),
    Template("boost", "Distributed under the Boost Software License, Version 1.0.", ("boost software license",)),
    Template("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", ("eclipse public license",)),
)


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def file_words(text: Column) -> Column:
    """The words of a whole text, A-Z in lower case; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _word_list(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def document_counts(files: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """How many files hold each word of the templates: one number for each of these words."""
    known = sorted({w for t in templates for w in words_of(t.text)})
    if not known:
        return {}
    held = files.select(F.explode(F.array_intersect(_word_list(known), file_words(F.col(text_col)))).alias("word"))
    return dict.fromkeys(known, 0) | {r.word: r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _index(templates: tuple[Template, ...], counts: dict[str, int]) -> tuple[list[str], Column]:
    """Licence words from the rarest on, and the templates with the places of their rarest words."""
    by_rarity = sorted(counts, key=lambda w: (counts[w], w))
    rows = []
    for t in templates:
        words = words_of(t.text)
        rare = sorted(set(words), key=lambda w: (counts[w], w))[:TEMPLATE_WORDS]
        rows.append({
            "label": t.label, "size": len(words), "words": sorted(set(words)), "need": min(AGREE, len(rare)),
            "rare": [{"word": w, "at": [i for i, x in enumerate(words) if x == w]} for w in rare],
            "phrases": [" " + " ".join(words_of(p)) + " " for p in t.phrases],
        })
    kind = (
        "array<struct<label:string,size:int,words:array<string>,need:int,"
        "rare:array<struct<word:string,at:array<int>>>,phrases:array<string>>>"
    )
    return by_rarity, F.from_json(F.lit(json.dumps(rows)), kind)


def _joined(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _found(words: Column, rare: Column, templates: Column) -> Column:
    """array<struct<label, share>>: the templates that stand in the file."""

    def shared(t: Column) -> Column:
        return F.filter(t["rare"], lambda r: F.array_contains(rare, r["word"]))

    def one(t: Column, places: Column) -> Column:
        def begins(r: Column) -> Column:
            mine = F.filter(places, lambda p: p["word"] == r["word"])
            return F.array_distinct(F.flatten(F.transform(mine, lambda p: F.transform(r["at"], lambda q: p["at"] - q))))

        def agreed(all_begins: Column) -> Column:
            more = F.filter(all_begins, lambda b, i: b == F.get(all_begins, i + t["need"] - 1))
            return F.array_distinct(more)

        def there(begin: Column) -> Column:
            start = F.greatest(begin - SLACK, F.lit(0))
            part = F.slice(words, start + 1, F.greatest(begin + t["size"] + SLACK - start, F.lit(0)))

            def share(p: Column) -> Column:
                whole = bound_to(_joined(p), lambda text: F.forall(t["phrases"], lambda x: text.contains(x)))
                known = F.size(F.array_intersect(t["words"], p)) / F.size(t["words"])
                return F.when(whole, known).otherwise(0.0)

            return bound_to(part, share)

        votes = F.array_sort(F.flatten(F.transform(shared(t), begins)))
        best = F.array_max(F.transform(bound_to(votes, agreed), there))
        return F.struct(t["label"].alias("label"), F.coalesce(best, F.lit(0.0)).alias("share"))

    def all_of(likely: Column) -> Column:
        wanted = F.array_distinct(F.flatten(F.transform(likely, lambda t: F.transform(shared(t), lambda r: r["word"]))))

        def looked_up(wanted: Column) -> Column:
            every = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
            places = F.filter(every, lambda p: F.array_contains(wanted, p["word"]))
            return bound_to(places, lambda places: F.filter(F.transform(likely, lambda t: one(t, places)), lambda x: x["share"] > 0))

        return F.when(F.size(likely) > 0, bound_to(wanted, looked_up))

    likely = F.filter(templates, lambda t: F.size(shared(t)) >= t["need"])
    none = F.array().cast("array<struct<label:string,share:double>>")
    return F.coalesce(bound_to(likely, all_of), none)


def _phrase_places(words: Column, phrases: tuple[tuple[str, str], ...]) -> Column:
    """array<struct<label, at>>: every place where a phrase's words stand one after the other."""

    def found(phrase: str, label: str) -> Column:
        parts = phrase.split(" ")
        here = lambda i: reduce(and_, [F.get(words, i + k) == w for k, w in enumerate(parts)])
        hits = F.filter(F.transform(words, lambda w, i: i), here)
        return F.transform(hits, lambda i: F.struct(F.lit(label).alias("label"), i.alias("at")))

    def of(joined: Column) -> Column:
        none = F.array().cast("array<struct<label:string,at:int>>")
        return F.concat(none, *[F.when(joined.contains(f" {p} "), found(p, label)).otherwise(none) for p, label in phrases])

    return bound_to(_joined(words), of)


def scan(
    files: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES, counts: dict[str, int] | None = None,
) -> DataFrame:
    """``files`` with ``n_words``, ``places``, ``notices``, ``labels`` and ``score`` (named anew if taken).

    ``places`` are all places of the phrases (label, word), ``notices`` the templates found
    (label, share of their words), ``labels`` both kinds' labels, sorted; ``score`` is 1 with
    a phrase, else the largest share, else 0. A null or empty text has no words, no labels
    and score 0; repeated rows stay. ``counts`` are those of ``document_counts`` and are
    taken from ``files`` by default; words equally rare go by the alphabet.
    """  # noqa: D205
    by_rarity, index = _index(templates, document_counts(files, text_col, templates) if counts is None else counts)
    out = {c: free_name(files, c) for c in ("n_words", "places", "notices", "labels", "score")}
    w, rare = free_name(files, "_words"), free_name(files, "_rare")
    rows = files.withColumn(w, file_words(F.col(text_col)))
    held = F.slice(F.array_intersect(_word_list(by_rarity), F.col(w)), 1, FILE_WORDS) if by_rarity else F.array().cast("array<string>")
    rows = rows.withColumn(rare, held)
    notices = bound_to(F.struct(F.col(w).alias("w"), F.col(rare).alias("r")), lambda x: _found(x["w"], x["r"], index))
    rows = rows.select(
        *files.columns, F.size(w).cast("long").alias(out["n_words"]),
        _phrase_places(F.col(w), phrases).alias(out["places"]), notices.alias(out["notices"]),
    )
    places, notices = F.col(out["places"]), F.col(out["notices"])
    labels = F.array_sort(F.array_distinct(F.concat(F.transform(places, lambda p: p["label"]), F.transform(notices, lambda n: n["label"]))))
    best = F.coalesce(F.array_max(F.transform(notices, lambda n: n["share"])), F.lit(0.0))
    return rows.withColumns({out["labels"]: labels, out["score"]: F.when(F.size(places) > 0, 1.0).otherwise(best)})

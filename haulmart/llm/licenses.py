"""License scans: MinHash bands over text windows find templates, shingles verify them.

A window is ``WINDOW`` consecutive five-word shingles; windows of a text overlap,
one begins at every shingle. Each of ``BANDS`` bands is one MinHash of the window,
the lowest of its shingle hashes under an exclusive-or with the band's mask. A
window that lies in a template as it does in the text has all bands in common
with it. A template of a single shingle shares a band with one of the two
windows around it but for three in twenty thousand, and each further shingle
makes a miss rarer. What is found is then verified: the share of the template's
distinct shingles that the text contains, compared as words. All of it is
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 5
WINDOW = 2
BANDS = 8
CONTAINED_PERCENT = 75
# Up to so many template windows the bands are looked up in literal arrays, else by a join.
LITERAL_WINDOWS = 5_000

# The wording of common license notices.
TEMPLATES = [
    ("CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0 line", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0 line", "Licensed under the Apache License, Version 2.0."),
    ("MIT line", "Released under the MIT License."),
    (
        "Apache-2.0 notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "MIT grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "BSD conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ),
    (
        "GPL notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation",
    ),
    (
        "MPL-2.0 notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "ISC grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
]


def mask(band: int) -> int:
    """A fixed 64-bit mask per band, signed: multiples of the golden ratio's fraction."""
    value = (band + 1) * 0x9E3779B97F4A7C15 % 2**64
    return value - 2**64 if value >= 2**63 else value


def words_of(text: str) -> str:
    """SQL: lower-case letters and digits of ASCII; everything else parts words."""
    return f"filter(split(regexp_replace(lower({text}), '[^a-z0-9]+', ' '), ' '), x -> x != '')"


def starts(items: str, size: int) -> str:
    """SQL: where runs of ``size`` items begin; fewer items are one run."""
    return f"if(size({items}) = 0, cast(array() as array<int>), sequence(0, greatest(size({items}) - {size}, 0)))"


def shingles(words: str) -> str:
    return f"transform({starts(words, WORDS)}, i -> array_join(slice({words}, i + 1, {WORDS}), ' '))"


def hashes(words: str) -> str:
    return f"transform({starts(words, WORDS)}, i -> xxhash64({', '.join(f'get({words}, i + {k})' for k in range(WORDS))}))"


def band(number: int, hashed: str) -> str:
    """The band's value of each window of shingle hashes."""
    turned = ", ".join(f"get({hashed}, i + {k}) ^ {mask(number)}L" for k in range(WINDOW))
    return f"transform({starts(hashed, WINDOW)}, i -> least({turned}))"


def over_hashes(text: str, body: str) -> str:
    """SQL: ``body`` over the shingle hashes ``h`` of the text.

    Words and hashes are bound as lambda variables. As columns of their own the
    optimizer would write them out at each of their uses, within inner loops.
    """
    return f"get(transform(array({words_of(text)}), w -> get(transform(array({hashes('w')}), h -> {body}), 0)), 0)"


def scan_licenses(
    docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, template, n_shingles, n_found, first_word`` for each template that a row's text contains.

    ``templates`` has ``template, text``; those of one name are told apart by text.
    A text contains a template if it has at least 75 percent of its distinct
    shingles; ``first_word`` is the place, from 0, of the first of them. A null text
    has no words and no templates, a template without words is never found. Rows
    equal in id and text count once. Extra columns are not read.
    """
    every = ", ".join(f"array_distinct({band(k, 'h')})" for k in range(BANDS))
    known = templates.select(
        "template",
        F.expr(f"array_distinct(get(transform(array({words_of('coalesce(text, \'\')')}), w -> {shingles('w')}), 0))").alias("_own"),
        F.expr(over_hashes("coalesce(text, '')", f"array({every})")).alias("_bands"),
    )
    keys = known.select("template", "_own", F.posexplode("_bands").alias("_band", "_values")).select(
        "template", "_own", "_band", F.explode("_values").alias("_value")
    )
    # The list of templates is a parameter; only what is made of it comes to the driver.
    listed = keys.select("_band", "_value").distinct().limit(BANDS * LITERAL_WINDOWS + 1).collect()
    few = len(listed) <= BANDS * LITERAL_WINDOWS
    hits = []
    for k in range(BANDS):
        values = band(k, "h")
        if few:
            own = sorted(row._value for row in listed if row._band == k)
            values = f"array_intersect({values}, cast(array({', '.join(f'{v}L' for v in own)}) as array<bigint>))"
        hits.append(f"transform(array_distinct({values}), v -> struct({k} as _band, v as _value))")
    text = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    # The outer form keeps the optimizer from working out the hits once more in a filter.
    hit = text.select(
        "doc_id", "_text", F.explode_outer(F.expr(over_hashes("_text", f"concat({', '.join(hits)})"))).alias("_hit")
    ).where(F.col("_hit").isNotNull())
    right = F.broadcast(keys) if few else keys
    joined = hit.join(right, (F.col("_hit._band") == keys["_band"]) & (F.col("_hit._value") == keys["_value"]))
    # Of one document the bands find a template many times; it is verified once. Rows equal in id
    # and text are one.
    once = joined.select("doc_id", "_text", "template", "_own").distinct()
    found = once.select(
        "doc_id",
        "template",
        "_own",
        F.expr(f"get(transform(array({words_of('_text')}), w -> {shingles('w')}), 0)").alias("_shingles"),
    )
    # Another explode for the same reason: the shingles are made once.
    counted = found.select(
        "doc_id",
        "template",
        F.size("_own").alias("n_shingles"),
        F.explode_outer(
            F.array(F.expr("array_sort(transform(array_intersect(_own, _shingles), s -> array_position(_shingles, s)))"))
        ).alias("_places"),
    )
    return counted.where(100 * F.size("_places") >= CONTAINED_PERCENT * F.col("n_shingles")).select(
        "doc_id",
        "template",
        "n_shingles",
        F.size("_places").alias("n_found"),
        (F.get("_places", F.lit(0)) - 1).cast("int").alias("first_word"),
    )

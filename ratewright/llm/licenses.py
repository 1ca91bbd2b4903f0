r"""Licence texts by the digest of their canonical form.

The canonical form of a text: lower case, copyright lines dropped, other spellings of the same word made one, everything
but letters and digits as one space. A whole text is a known licence where the digests are equal, which is a hash join.
The known texts are a table of the caller (``licence_id, text``); ``KNOWN`` holds whole standard texts (``licence_texts``)
with their common variants, and short public notices.

Everything is a column expression. Besides the whole text, each line is looked up by itself, since documents quote a notice as a line.

Null texts count as empty; a text without letters and digits has the digest of the empty text and is no licence. Known texts
with the same canonical form: the first id by name. Repeated rows are looked up each; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Public notices by licence.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Whole texts by licence, with the titles they may stand under and the line that ends the terms (a how-to may follow).
TEXTS = [
    ("Apache-2.0", "Apache-2.0", (), "END OF TERMS AND CONDITIONS"),
    ("BSD-2-Clause", "BSD-2-Clause", ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License"), None),
    ("BSD-3-Clause", "BSD-3-Clause", ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "BSD License", "New BSD License"), None),
    ("CC0-1.0", "CC0-1.0", (), None),
    ("GPL-2.0", "GPL-2", (), "END OF TERMS AND CONDITIONS"),
    ("GPL-3.0", "GPL-3", (), "END OF TERMS AND CONDITIONS"),
    ("ISC", "ISC", ("ISC License", "The ISC License", "ISC License (ISC)"), None),
    ("LGPL-2.1", "LGPL-2.1", (), "END OF TERMS AND CONDITIONS"),
    ("LGPL-3.0", "LGPL-3", (), None),
    ("MIT", "MIT", ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"), None),
    ("MPL-2.0", "MPL-2.0", (), None),
]


def _whole() -> list[tuple[str, str]]:
    """Each text under each title (where it has some, also with rights reserved), with and without what follows the terms, and with either scheme in its links."""
    found = []
    for licence, name, titles, end in TEXTS:
        text = (files("ratewright.llm") / "licence_texts" / f"{name}.txt").read_text("utf-8")
        bodies = [text]
        if end:
            terms = text[: text.index(end)]
            bodies += [terms, terms + end]
        for body in bodies:
            for linked in dict.fromkeys((body, body.replace("http://", "https://"), body.replace("https://", "http://"))):
                found += [(licence, f"{title}\n\n{line}\n\n{linked}") for title in ("", *titles) for line in (("", "All rights reserved.") if titles else ("",))]
    return found


KNOWN = NOTICES + _whole()
#: Other spellings of a word.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sublicence", "sublicense"), ("organisation", "organization"), ("authorised", "authorized"), ("whilst", "while"),
    ("favour", "favor"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("v", "version"),
]
_COPYRIGHT = r"^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*(?:[0-9]{4}|\(c\)|©|all rights reserved|by )[^\n]*$"


def canonical(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "(?md)" + _COPYRIGHT, " ")
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for other, usual in SPELLINGS:
        words = F.replace(words, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(words)


def canonical_sql(text: str) -> str:
    """The same as flat SQL."""
    words = f"' ' || trim(regexp_replace(regexp_replace(lower(coalesce({text}, '')), '(?m){_COPYRIGHT}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for other, usual in SPELLINGS:
        words = f"replace({words}, ' {other} ', ' {usual} ')"
    return f"trim({words})"


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence_id string, text string")


def digests(known: DataFrame) -> DataFrame:
    return (
        known.where(canonical(F.col("text")) != "")
        .groupBy(digest(F.col("text")).alias("digest"))
        .agg(F.min("licence_id").alias("licence_id"))
    )


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, digest, licence_id`` of every row; the licence is null where the whole text is none that is known."""
    own = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    return own.join(digests(known), "digest", "left").select("doc_id", "digest", "licence_id")


def scan_lines(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, licence_id, lines`` for every known notice that is a line of a text; repeated rows of an id are added up."""
    lines = docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return (
        lines.select("doc_id", digest(F.col("line")).alias("digest"))
        .join(digests(known), "digest")
        .groupBy("doc_id", "licence_id")
        .agg(F.count("*").alias("lines"))
    )

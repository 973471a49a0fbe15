"""Licence scans by known sentences and ordered rules, in DataFrame operations only.

A text is cut into sentences, each sentence is normalised, and an exact match with the
table of known sentences gives its identifier. The identifiers of a text, in order, form a
sequence that breaks where more than ``MAX_GAP`` unknown sentences lie between two known
ones. A licence is recognised where the sequence holds all identifiers of one of its rules
one after the other.

The known sentences and the rules are short fixed tables, so they are part of the plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Unknown sentences allowed between two sentences of a rule, such as list numbers.
MAX_GAP = 3

# Sentences of public licence texts and notices.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License."
    ),
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": (
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied."
    ),
    "apache-language": (
        "See the License for the specific language governing permissions and limitations under "
        "the License."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software."
    ),
    "mit-as-is": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-redistribute-2": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."
    ),
    "gpl-redistribute-3": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "mpl-subject": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "mpl-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "unlicense-release": (
        "This is free and unencumbered software released into the public domain."
    ),
}

# Licences, and the sentences that show them in this order.
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-grant", "apache-copy", "apache-as-is", "apache-language"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-as-is"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0-or-later", ["gpl-redistribute-2", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-redistribute-3", "gpl-warranty"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl-subject", "mpl-copy"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("Unlicense", ["unlicense-release"]),
]

#: Further sentences and rules, some made from the ones above.
MORE_SENTENCES = {
    "apache-copy-at": "You may obtain a copy of the License at",
    "apache-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache-url-s": "https://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-as-is": SENTENCES["apache-copy"] + " " + SENTENCES["apache-as-is"],
    "bsd-as-is": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "lgpl-redistribute-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version."
    ),
    "lgpl-redistribute-3": SENTENCES["gpl-redistribute-3"].replace("GNU", "GNU Lesser"),
    "lgpl-warranty": SENTENCES["gpl-warranty"].replace("program", "library"),
    "agpl-redistribute-3": SENTENCES["gpl-redistribute-3"].replace("GNU", "GNU Affero"),
}
MORE_RULES = [
    ("Apache-2.0", ["apache-grant", "apache-copy-at", url, "apache-as-is", "apache-language"])
    for url in ("apache-url", "apache-url-s")
] + [
    ("Apache-2.0", ["apache-grant", "apache-copy-as-is", "apache-language"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("LGPL-2.1-or-later", ["lgpl-redistribute-2.1", "lgpl-warranty"]),
    ("LGPL-3.0-or-later", ["lgpl-redistribute-3", "gpl-warranty"]),
    ("AGPL-3.0-or-later", ["agpl-redistribute-3", "gpl-warranty"]),
]

#: Where a text is cut: after a sentence end and white space, and at lines that are blank or
#: hold comment marks only.
SENTENCE_END = r"([.!?])[ \t\r\n]+"
CUT = "\x1e"
BLANK_COMMENT = r"\n[ \t\r*#/;%]*\n"


def pieces_of(text: str) -> list[str]:
    """A known sentence as texts are cut, so that each piece can be met."""
    return re.sub(SENTENCE_END, r"\1" + CUT, text).split(CUT)


def all_rules() -> list[tuple[str, list[str]]]:
    """The rules by identifiers of pieces; a sentence cut in several has ``name/number``."""
    return [
        (licence, [own for name in ids for own, _ in known_pieces(name)])
        for licence, ids in RULES + MORE_RULES
    ]


def known_pieces(name: str) -> list[tuple[str, str]]:
    """Identifier and text of each piece of a known sentence."""
    parts = pieces_of((SENTENCES | MORE_SENTENCES)[name])
    if len(parts) == 1:
        return [(name, parts[0])]
    return [(f"{name}/{number}", part) for number, part in enumerate(parts, 1)]


def normalised(sentence: Column) -> Column:
    """Lower case, single blanks, without what is neither letter nor digit at the ends."""
    lowered = F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " ")
    return F.trim(lowered)


def known_sentences(spark: SparkSession) -> DataFrame:
    """``sentence, sentence_id``: the normalised known sentences."""
    rows = [
        F.struct(F.lit(text).alias("full"), F.lit(name).alias("sentence_id"))
        for known in SENTENCES | MORE_SENTENCES
        for name, text in known_pieces(known)
    ]
    names = spark.range(1).select(F.inline(F.array(*rows)))
    return names.select(normalised(F.col("full")).alias("sentence"), "sentence_id")


def sentences(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, place, line, sentence``: normalised sentences, and lines inside.

    A sentence that runs over several lines is followed by its single lines, so that notices
    without a full stop and wrapped licence texts are both found.
    """
    cut = F.regexp_replace(
        F.regexp_replace("text", SENTENCE_END, "$1" + CUT), BLANK_COMMENT, CUT
    )
    with_lines = F.when(
        F.contains(F.col("whole"), F.lit("\n")),
        F.concat(F.array("whole"), F.split("whole", "\n")),
    ).otherwise(F.array("whole"))
    return (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("text_key"),
            F.posexplode(F.split(cut, CUT)).alias("place", "whole"),
        )
        .select("doc_id", "text_key", "place", F.posexplode(with_lines).alias("line", "sentence"))
        .withColumn("sentence", normalised(F.col("sentence")))
    )


def licences(documents: DataFrame) -> DataFrame:
    """One row for each document and licence recognised in it.

    Null and empty texts hold no licence, and documents without one give no row. Rows of
    one id and one text are scanned as one. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id, licence, sentence_ids`` (the document's known sentences in order,
    ``|`` where the sequence breaks).
    """
    spark = documents.sparkSession
    # The known sentences are a fixed table of some dozens of rows.
    known = F.broadcast(known_sentences(spark))
    found = sentences(documents.where("text is not null")).join(known, "sentence")
    entries = F.array_sort(F.collect_set(F.struct("place", "line", "sentence_id")))
    ordered = found.groupBy("doc_id", "text_key").agg(entries.alias("entries"))
    # Lines count only where their whole sentence is unknown.
    wholes = F.transform(
        F.filter("entries", lambda entry: entry["line"] == 0), lambda entry: entry["place"]
    )
    ordered = ordered.withColumn("wholes", wholes).withColumn(
        "entries",
        F.filter(
            "entries",
            lambda entry: (entry["line"] == 0)
            | ~F.array_contains(F.col("wholes"), entry["place"]),
        ),
    )
    sequence = F.aggregate(
        "entries",
        F.struct(F.lit(None).cast("int").alias("last"), F.lit(",").alias("ids")),
        lambda state, entry: F.struct(
            entry["place"].alias("last"),
            F.concat(
                state["ids"],
                F.when(entry["place"] - state["last"] > MAX_GAP + 1, F.lit("|,")).otherwise(
                    F.lit("")
                ),
                entry["sentence_id"],
                F.lit(","),
            ).alias("ids"),
        ),
    )["ids"]
    rules = F.array(
        *[
            F.struct(F.lit(name).alias("licence"), F.lit("," + ",".join(ids) + ",").alias("ids"))
            for name, ids in all_rules()
        ]
    )
    matched = F.transform(
        F.filter(rules, lambda rule: F.contains(F.col("sequence"), rule["ids"])),
        lambda rule: rule["licence"],
    )
    return ordered.select("doc_id", sequence.alias("sequence")).select(
        "doc_id",
        F.explode(F.array_distinct(matched)).alias("licence"),
        F.expr("trim(BOTH ',' FROM sequence)").alias("sentence_ids"),
    )


def oracle_sql() -> str:
    """The same scan in SQL, from the same fixed tables."""
    quoted = lambda value: "'" + value.replace("'", "''") + "'"
    known = ", ".join(
        f"({quoted(name)}, {quoted(text)})"
        for sentence in SENTENCES | MORE_SENTENCES
        for name, text in known_pieces(sentence)
    )
    rules = ", ".join(
        f"({number}, {quoted(name)}, {quoted(',' + ','.join(ids) + ',')})"
        for number, (name, ids) in enumerate(all_rules())
    )
    plain = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH known AS (
    SELECT sentence_id, {plain.format("full_text")} AS sentence
    FROM (VALUES {known}) AS t(sentence_id, full_text)
), rules AS (
    SELECT * FROM (VALUES {rules}) AS t(number, licence, ids)
), cut AS (
    SELECT doc_id, string_split(regexp_replace(regexp_replace(text,
        '{SENTENCE_END}', '\\1' || chr(30), 'g'), '{BLANK_COMMENT}', chr(30), 'g'), chr(30)) AS parts
    FROM documents WHERE text IS NOT NULL
), placed AS (
    SELECT doc_id, unnest(parts) AS whole, generate_subscripts(parts, 1) AS place FROM cut
), lines AS (
    SELECT doc_id, place, CASE WHEN contains(whole, chr(10))
        THEN list_concat([whole], string_split(whole, chr(10))) ELSE [whole] END AS parts
    FROM placed
), single AS (
    SELECT doc_id, place, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS line
    FROM lines
), met AS (
    SELECT doc_id, place, line, sentence_id,
           min(line) OVER (PARTITION BY doc_id, place) AS first_line
    FROM single JOIN known ON {plain.format("single.sentence")} = known.sentence
), found AS (
    SELECT doc_id, place, line, sentence_id, place - lag(place)
        OVER (PARTITION BY doc_id ORDER BY place, line) > {MAX_GAP + 1} AS apart
    FROM met WHERE line = 1 OR first_line > 1
), sequences AS (
    SELECT doc_id, ',' || string_agg(CASE WHEN apart THEN '|,' ELSE '' END || sentence_id || ',',
                                     '' ORDER BY place, line) AS ids
    FROM found GROUP BY doc_id
)
SELECT DISTINCT doc_id, licence, trim(sequences.ids, ',') AS sentence_ids
FROM sequences JOIN rules ON contains(sequences.ids, rules.ids)
"""

"""Licence recognition by sentence rules.

A text's sentences are normalised (ASCII, lower case, letters, digits and the
dots inside versions) and mapped to identifiers of known licence sentences;
the document's identifier sequence is then matched against ordered rules. A
rule that matches names its licence and uses its identifiers up; known
sentences no rule used are counted as left over.

Licence texts are often hard-wrapped, and notices often stand on lines without
a full stop, so each text is read three times: with line ends as blanks, with
line ends as sentence ends, and with line ends as blanks but paragraph ends
(lines without letters and digits, also in comments) and the ends of copyright
lines as sentence ends. The licences of all readings are joined.

Everything is a per-row expression: no shuffle, no Python. Texts without any
``ANCHORS`` word (every known sentence has one) skip the splitting.

Cases: null or empty text has no licence; repeated rows give one row each; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices.
SENTENCES: dict[str, list[str]] = {
    "ApacheNotice": ["Licensed under the Apache License, Version 2.0",
                     "This project is licensed under the Apache License, Version 2.0",
                     "Licensed under the Apache License 2.0"],
    "ApacheGrant": ['Licensed under the Apache License, Version 2.0 (the "License")',
                    'Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements'],
    "ApacheComply": ["you may not use this file except in compliance with the License"],
    "ApacheObtain": ["You may obtain a copy of the License at"],
    "ApacheBasis": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "ApacheSee": ["See the License for the specific language governing permissions and limitations under the License"],
    "MitNotice": ["Released under the MIT License", "Licensed under the MIT License",
                  "This project is licensed under the MIT License", "The MIT License (MIT)", "MIT License"],
    "MitGrant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'],
    "MitKeep": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "MitAsIs": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'],
    "IscGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "BsdGrant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BsdSource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "BsdBinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "BsdEndorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "BsdNotice": ["Licensed under the BSD License", "Released under the BSD License"],
    "Gpl3Notice": ["This work is licensed under the GNU General Public License, version 3",
                   "Licensed under the GNU General Public License, version 3",
                   "Licensed under the GNU General Public License v3.0"],
    "Gpl2Notice": ["This work is licensed under the GNU General Public License, version 2",
                   "Licensed under the GNU General Public License, version 2"],
    "GplFree3": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "GplFree2": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "GplHope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"],
    "GplCopy": ["You should have received a copy of the GNU General Public License along with this program"],
    "LgplNotice": ["Licensed under the GNU Lesser General Public License, version 3",
                   "This work is licensed under the GNU Lesser General Public License, version 3"],
    "AgplNotice": ["Licensed under the GNU Affero General Public License, version 3",
                   "This work is licensed under the GNU Affero General Public License, version 3"],
    "MplNotice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                  "Licensed under the Mozilla Public License, version 2.0"],
    "CcByNcNotice": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CcByNotice": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0",
                   "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CcBySaNotice": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "Cc0Notice": ["Licensed under CC0 1.0", "This work is released under the CC0 1.0 license"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "SpdxApache": ["SPDX-License-Identifier: Apache-2.0"],
    "SpdxMit": ["SPDX-License-Identifier: MIT"],
    "SpdxGpl3": ["SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
}

# Licence and the identifier sequence it needs, tried in this order.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["ApacheGrant", "ApacheComply", "ApacheObtain", "ApacheBasis", "ApacheSee"]),
    ("Apache-2.0", ["ApacheGrant", "ApacheComply"]),
    ("MIT", ["MitNotice", "MitGrant", "MitKeep", "MitAsIs"]),
    ("MIT", ["MitGrant", "MitKeep"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("GPL-3.0-or-later", ["GplFree3", "GplHope"]),
    ("GPL-2.0-or-later", ["GplFree2", "GplHope"]),
    ("GPL-3.0-or-later", ["GplFree3"]),
    ("GPL-2.0-or-later", ["GplFree2"]),
    ("ISC", ["IscGrant"]),
    ("AGPL-3.0", ["AgplNotice"]),
    ("LGPL-3.0", ["LgplNotice"]),
    ("GPL-3.0", ["Gpl3Notice"]),
    ("GPL-3.0", ["SpdxGpl3"]),
    ("GPL-2.0", ["Gpl2Notice"]),
    ("MPL-2.0", ["MplNotice"]),
    ("Apache-2.0", ["ApacheNotice"]),
    ("Apache-2.0", ["SpdxApache"]),
    ("MIT", ["MitNotice"]),
    ("MIT", ["SpdxMit"]),
    ("BSD", ["BsdNotice"]),
    ("CC-BY-NC-4.0", ["CcByNcNotice"]),
    ("CC-BY-SA-4.0", ["CcBySaNotice"]),
    ("CC-BY-4.0", ["CcByNotice"]),
    ("CC0-1.0", ["Cc0Notice"]),
    ("Unlicense", ["Unlicense"]),
]

ANCHORS = ["licen", "permission", "copyright", "redistribut", "warrant", "cc by", "cc0", "domain"]

#: Sentence ends: a stop before a blank or the end, a colon or semicolon before a line end.
BREAK = r"[.!?]+([\x20\x09-\x0D]|\z)|[:;][\x20\x09\x0D]*\n"
#: Paragraph ends and copyright lines (lower case) of the third reading.
PARAGRAPH = r"\n[^a-z0-9\n]*\n"
COPYRIGHT_LINE = (r"(?md)^[^a-z0-9\n]*(?:copyright[^a-z0-9\n]*(?:\(c\)|c\b|by\b|[0-9]{4})"
                  r"|\(c\)[^a-z0-9\n]*[0-9]{4})[^\n]*$")
CUT = "\x01"
JUNK = r"[^a-z0-9.+]+"
EDGE = r"^[ .]+|[ .]+$"


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier; one with an inner break is known by its longest part."""
    out: dict[str, str] = {}
    for name, sentences in SENTENCES.items():
        for s in sentences:
            parts = re.sub(BREAK.replace(r"\z", r"\Z"), CUT, s.lower()).split(CUT)
            normal = max((re.sub(EDGE, "", re.sub(JUNK, " ", p)) for p in parts), key=len)
            if out.setdefault(normal, name) != name or not any(a in normal for a in ANCHORS):
                raise ValueError(f"ambiguous or unanchored sentence: {normal}")
    return out


def rule_runs() -> list[tuple[str, str]]:
    """(licence, identifier run) in rule order; a run is ``<A><B>``."""
    return [(name, "".join(f"<{i}>" for i in ids)) for name, ids in RULES]


def _ids(text: Column, line_end: str, paragraphs: bool = False) -> Column:
    """Identifiers of the known sentences, in order, as ``<A><B>``."""
    known = F.create_map(*[F.lit(x) for kv in known_sentences().items() for x in kv])
    plain = F.lower(F.regexp_replace(text, r"[^\x00-\x7F]+", " "))
    if paragraphs:
        plain = F.regexp_replace(plain, COPYRIGHT_LINE, f"{CUT}$0{CUT}")
    ends = f"{BREAK}|{PARAGRAPH}" if paragraphs else BREAK
    cut = F.replace(F.regexp_replace(plain, ends, CUT), F.lit("\n"), F.lit(line_end))
    found = F.transform(F.split(cut, CUT, -1), lambda s: known[
        F.regexp_replace(F.regexp_replace(s, JUNK, " "), EDGE, "")])
    return F.array_join(F.transform(F.filter(found, lambda x: x.isNotNull()),
                                    lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")


def _match(ids: Column) -> Column:
    """(state, hits): the run after all rules, used parts cut to ``.``, and the licences named."""
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("run")) for n, r in rule_runs()])
    none = F.array().cast("array<string>")
    return F.aggregate(rules, F.struct(ids.alias("state"), none.alias("hits")), lambda acc, rule: F.struct(
        F.replace(acc["state"], rule["run"], F.lit(".")).alias("state"),
        F.when(F.contains(acc["state"], rule["run"]), F.concat(acc["hits"], F.array(rule["name"])))
        .otherwise(acc["hits"]).alias("hits")))


def _count(ids: Column) -> Column:
    return F.length(ids) - F.length(F.replace(ids, F.lit("<"), F.lit("")))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, licenses (comma-joined: those of the reading
    with line ends as blanks in rule order, then further ones of the others),
    sentence_ids of the reading that knows most sentences (the first on ties) and
    n_left_over, its known sentences that no rule used."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    maybe = F.col("_text").rlike("(?i)" + "|".join(ANCHORS))
    readings = ("_a", " ", False), ("_b", CUT, False), ("_c", " ", True)
    read = rows.select("doc_id", *[F.when(maybe, _ids(F.col("_text"), end, cut)).otherwise(F.lit("")).alias(c)
                                   for c, end, cut in readings])
    names = [c for c, *_ in readings]
    matched = read.select("doc_id", *names, *[
        F.when(F.col(c) != "", _match(F.col(c))).alias(c + "m") for c in names])
    hits = [F.coalesce(F.col(f"{c}m.hits"), F.array().cast("array<string>")) for c in names]
    ids, left = F.col("_a"), F.col("_am.state")
    for c in names[1:]:
        fuller = _count(F.col(c)) > _count(ids)
        ids, left = F.when(fuller, F.col(c)).otherwise(ids), F.when(fuller, F.col(f"{c}m.state")).otherwise(left)
    return matched.select(
        "doc_id", F.array_join(F.array_distinct(F.concat(*hits)), ",").alias("licenses"),
        ids.alias("sentence_ids"),
        F.coalesce(_count(left), F.lit(0)).cast("bigint").alias("n_left_over"))

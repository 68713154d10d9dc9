"""Licence rules on written-out notices."""

from __future__ import annotations

import pytest

from propgraph.llm import licenses

MIT = """MIT License

Copyright (c) 2024 A Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#     http://www.apache.org/licenses/LICENSE-2.0
"""
CASES = [
    ("Released under the MIT License.", "MIT", 0), ("prose\nReleased under the MIT License\nmore prose", "MIT", 0),
    ("Prose here! RELEASED UNDER  the mit license. More", "MIT", 0),
    ("Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0,CC-BY-NC-4.0", 0),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", 0),
    ("// SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0", 0),
    ("You may obtain a copy of the License at\n\nhttp", "", 1),
    ("It was released under the mit license long ago.", "", 0), ("", "", 0), (None, "", 0),
    ("é Licensed under CC0 1.0. é", "CC0-1.0", 0), ("word " * 50000 + ". Released under the MIT License.", "MIT", 0),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)],
                               "doc_id bigint, text string, licenses string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert [(got[i].licenses, got[i].n_left_over) for i in range(len(CASES))] == [c[1:] for c in CASES]


def test_full_texts_across_wrapped_lines(spark):
    df = spark.createDataFrame([(1, MIT), (2, APACHE.replace("# ", "")), (2, MIT), (None, "MIT License")],
                               "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0, r.licenses) for r in licenses.scan_licenses(df).collect()))
    assert got == [(0, "MIT"), (1, "MIT"), (2, "Apache-2.0"), (2, "MIT")]


def test_table_is_unambiguous_and_empty_input(spark):
    known = licenses.known_sentences()
    names = {i for _, ids in licenses.RULES for i in ids}
    assert names <= set(known.values())
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("bad", ["MIT license"])
def test_ambiguous_sentences_are_refused(monkeypatch, bad):
    monkeypatch.setitem(licenses.SENTENCES, "Other", [bad])
    with pytest.raises(ValueError):
        licenses.known_sentences()


MIT_BODY = MIT[MIT.index("Permission is"):] + """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
"""
ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
"""
BSD_BODY = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
GPL_BODY = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
BODIES = [(MIT_BODY, "MIT", "<MitGrant><MitKeep><MitAsIs>"), (ISC_BODY, "ISC", "<IscGrant>"),
          (BSD_BODY, "BSD-2-Clause", "<BsdGrant><BsdSource><BsdBinary>"),
          (GPL_BODY, "GPL-3.0-or-later", "<GplFree3><GplCopy>")]


@pytest.mark.parametrize("head", ["Copyright (c) 2020 X\n\n", "Copyright (C) 2019, A\nCopyright 2020 B\n",
                                  "A heading\n \t\n", "A heading\r\n\r\n"])
def test_texts_without_title_are_read_whole(spark, head):
    texts = [head + b for b, *_ in BODIES]
    texts += ["".join(f" * {line}".rstrip() + "\n" for line in x.splitlines()) for x in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.licenses, r.sentence_ids) for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(texts))] == [b[1:] for b in BODIES] * 2


def test_sentences_across_blank_lines_are_still_read(spark):
    df = spark.createDataFrame([(1, "Licensed under the\n\nMIT License.")], "doc_id bigint, text string")
    assert licenses.scan_licenses(df).first().licenses == "MIT"

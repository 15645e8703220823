"""The standard notices in their usual layouts, plain and in comments."""

import pytest

from hourtally.llm import licenses as lc

MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""

APACHE = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

BSD = """Copyright (c) 2020, The Authors.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""

BSD_3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""

NOTICES = {
    "MPL-2.0": (MPL, ["mpl.ref"]),
    "GPL-3.0-or-later": (GPL.format(3), ["gpl3.later", "gpl.hope", "gpl.see"]),
    "GPL-2.0-or-later": (GPL.format(2), ["gpl2.later", "gpl.hope", "gpl.see"]),
    "Apache-2.0": (APACHE, ["apache.use", "apache.copy", "apache.basis", "apache.see"]),
    "BSD-2-Clause": (BSD, ["bsd.use", "bsd.source", "bsd.binary"]),
    "BSD-3-Clause": (BSD + BSD_3, ["bsd.use", "bsd.source", "bsd.binary", "bsd.names"]),
    "MIT": (MIT, ["mit.grant", "mit.notice"]),
}


def marked(mark, text):
    return "\n".join((mark + line).rstrip() for line in text.split("\n"))


def one_word_a_line(text):
    """Every blank becomes a line end; paragraphs and the version number stay."""
    return "\n\n".join("\n".join(p.split()) for p in text.split("\n\n"))


LAYOUTS = {
    "plain": lambda t: t,
    "stars": lambda t: "/*\n" + marked(" * ", t) + "\n */\nint main() {}",
    "hashes": lambda t: marked("# ", t),
    "slashes": lambda t: marked("// ", t),
    "dashes": lambda t: marked("-- ", t),
    "indented": lambda t: marked("    ", t),
    "windows": lambda t: t.replace("\n", "\r\n"),
    "words": one_word_a_line,
    "starred words": lambda t: marked(" * ", one_word_a_line(t)),
}


def scanned(docs):
    return {r.doc_id: (r.sentences, r.licences) for r in lc.licence_scan(docs).collect()}


def test_standard_notices_in_all_layouts(corpus):
    cases = [(name, layout) for name in NOTICES for layout in LAYOUTS]
    got = scanned(corpus([(i, LAYOUTS[y](NOTICES[n][0])) for i, (n, y) in enumerate(cases)]))
    for i, (name, layout) in enumerate(cases):
        assert got.get(i) == (NOTICES[name][1], [name]), (name, layout)


def test_sentences_keep_their_ends(corpus):
    rows = [
        (1, "He said the code is licensed under the MIT license\n"),  # within a sentence
        (2, "Licensed under the MIT license\n\nReleased under the MIT license"),
        (3, "Licensed under the\n\nMIT license"),  # another paragraph
        (4, "Licensed under the. MIT license"),
        (5, "# Licensed under the\n#\n# MIT license"),
        (6, "Licensed under the MIT licenses"),
        (7, "This work is\nlicensed under the MIT license\nand others"),
        (8, "Licensed under CC BY 4.0\nLicensed under CC BY-SA 4.0!\n- Licensed under CC BY-NC 4.0"),
        (9, "the terms of the license v. " + "x " * 50_000 + "\n" * 50_000 + " " * 50_000 + "* " * 50_000),
    ]
    got = scanned(corpus(rows))
    assert set(got) == {2, 8}
    assert got[2][0] == ["mit.ref", "mit.ref"]
    assert got[8][1] == ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"]


@pytest.mark.parametrize("path", ["sf0.001", "sf0.01"])
def test_given_tables_have_what_the_sql_finds(spark, path):
    import duckdb

    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{path}/documents.parquet'")
    want = sorted(duck.sql(lc.OP8_SQL).fetchall())
    assert want and sorted(map(tuple, lc.op8_license_scan(spark, f"/root/testdata/{path}").collect())) == want


LGPL = GPL.replace("GNU General", "GNU Lesser General").replace("This program", "This library").replace("{}", "2.1")
AGPL = GPL.replace("GNU General", "GNU Affero General").replace("{}", "3")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""
BOOST = """//          Distributed under the Boost Software License, Version 1.0.
//    (See accompanying file LICENSE_1_0.txt)"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License v. 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/."""
ASF = """Licensed to the Apache Software Foundation (ASF) under one or more
contributor license agreements.  The ASF licenses this file to You under
the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License."""
BSD_OWNER = BSD + BSD_3.replace("copyright holder", "copyright owner")
MORE = [
    (LGPL, "LGPL-2.1-or-later"), (AGPL, "AGPL-3.0-or-later"), (ISC, "ISC"), (ZLIB, "Zlib"), (BOOST, "BSL-1.0"),
    (EPL, "EPL-2.0"), (ASF, "Apache-2.0"), (BSD_OWNER, "BSD-3-Clause"),
    *((f"{mark} SPDX-License-Identifier: {name}{end}", name) for mark, end in (("//", ""), ("/*", " */"), ("#", "\n"))
      for name in lc.SPDX),
]


def test_more_notices_plain_and_in_comments(spark):
    texts = [(i, t) for i, (t, _) in enumerate(MORE)]
    texts += [(1000 + i, "\n".join(f" * {line}" for line in t.split("\n"))) for i, (t, _) in enumerate(MORE[:8])]
    found = lc.licence_scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    got = {r.doc_id: r.licences for r in found}
    assert {i: got.get(i) for i, _ in texts} == {i: [MORE[i % 1000][1]] for i, _ in texts}


def test_every_sentence_has_a_marker_and_every_rule_can_win():
    assert all(any(m in s for m in lc.MARKERS) for s in lc.SENTENCES)
    assert {i for ids, _ in lc.RULES for i in ids} <= set(lc.SENTENCES.values())
    rules = [ids for ids, _ in lc.RULES]
    assert not [r for n, r in enumerate(rules) for before in rules[:n] if r[: len(before)] == before]


def test_empty_and_awkward_texts(spark, corpus, awkward):
    assert lc.licence_scan(corpus(awkward)).collect() == []
    assert lc.licence_scan(corpus(awkward).where("false")).collect() == []

"""Licence recognition: known sentences, then ordered rules over their sequence.

A text is cut into paragraphs at lines without letters and digits, and after ``.``, ``!`` or ``?``,
but not after the ``v.`` of a version number. A line that begins with a small letter or ``(``
continues the one before. Any other line end, also one before a comment mark, may end a sentence or
lie within one, so a known sentence is found however its lines are wrapped. Words are lower-case
letters a-z and digits, so comment marks made of other characters vanish. Sentences that
``SENTENCES`` knows become identifiers, the longer one where two begin alike, all others drop out,
and the identifiers of a text, in order, are matched against ``RULES`` from left to right: at each
place the first rule that fits wins and takes its sentences.

``OP8_SQL`` knows no sentences over wrapped lines that begin with other than a small letter or
``(``, and none with ``v.``: it finds what the query finds, except these.

All of it is column functions on whole texts, in one pass without a shuffle. Every known sentence
contains one of ``MARKERS``, so texts without any of them are passed over.

Defined results: texts without a known sentence, null and empty ones included, give no row; a text
whose known sentences fit no rule gives a row with no licence. Repeated rows, and rows without an
id, are each reported. A very long text is scanned whole. An empty table gives no rows; columns
other than id and text are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.tables import table

# Opening sentences and notices of public licences, normalised.
SENTENCES = {
    "released under the mit license": "mit.ref",
    "licensed under the mit license": "mit.ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit.grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit.notice",
    "licensed under the apache license version 2 0": "apache.ref",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache.use",
    "you may obtain a copy of the license at": "apache.copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache.basis",
    "see the license for the specific language governing permissions and limitations under the license": "apache.see",
    "this work is licensed under the gnu general public license version 3": "gpl3.ref",
    "this work is licensed under the gnu general public license version 2": "gpl2.ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3.later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2.later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl.hope",
    "see the gnu general public license for more details": "gpl.see",
    "licensed under cc by nc 4 0": "ccbync.ref",
    "licensed under cc by 4 0": "ccby.ref",
    "licensed under cc by sa 4 0": "ccbysa.ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby.ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa.ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync.ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd.use",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd.source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd.binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd.names",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl.ref",
    "this is free and unencumbered software released into the public domain": "unlicense.ref",
    "this project is licensed under the mit license": "mit.ref",
    "this software is released under the mit license": "mit.ref",
    "distributed under the mit license": "mit.ref",
    "this source code is licensed under the mit license found in the license file in the root directory of this source tree": "mit.ref",
    "licensed under the apache license 2 0": "apache.ref",
    "released under the apache license version 2 0": "apache.ref",
    "this project is licensed under the apache license 2 0": "apache.ref",
    "licensed to the apache software foundation asf under one or more contributor license agreements": "apache.asf",
    "the asf licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache.use",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2.ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation": "gpl3.ref",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21.later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3.later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3.later",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl.hope",
    "see the gnu lesser general public license for more details": "lgpl.see",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3.later",
    "see the gnu affero general public license for more details": "agpl.see",
    "neither the name of the copyright owner nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd.names",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd.advert",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd.grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc.basis",
    "this software is provided as is without any express or implied warranty": "zlib.basis",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib.liable",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib.grant",
    "distributed under the boost software license version 1 0": "boost.ref",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "boost.grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2.ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0": "epl2.ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl1.ref",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0.ref",
    "licensed under cc0 1 0": "cc0.ref",
    "licensed under cc by nd 4 0": "ccbynd.ref",
    "this work is licensed under a creative commons attribution noderivatives 4 0 international license": "ccbynd.ref",
    "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license": "ccbyncsa.ref",
    "licensed under cc by nc sa 4 0": "ccbyncsa.ref",
    "this work is licensed under a creative commons attribution 3 0 unported license": "ccby3.ref",
    "this work is licensed under a creative commons attribution sharealike 3 0 unported license": "ccbysa3.ref",
    "this work is marked with cc0 1 0 universal": "cc0.ref",
}
# Identifiers that files name after "SPDX-License-Identifier:".
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Apache-2.0 OR MIT", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0",
    "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT OR Apache-2.0", "MIT-0", "MPL-2.0",
    "MS-PL", "MulanPSL-2.0", "NCSA", "OFL-1.1", "PostgreSQL", "Python-2.0", "Unlicense", "UPL-1.0", "WTFPL",
    "Zlib", "ZPL-2.1",
)


def _spdx(name: str) -> tuple[str, str]:
    """The sentence that names it, and its identifier. Signs are no words: GPL-2.0+ reads as GPL-2.0."""
    words = " ".join(re.findall("[a-z0-9]+", name.lower()))
    return f"spdx license identifier {words}", f"spdx.{words.replace(' ', '-')}"


SPDX_SENTENCES = dict(_spdx(name) for name in SPDX)
SENTENCES |= SPDX_SENTENCES
# Sequences of sentences and the licence that they make up, the first that fits wins.
RULES = (
    (("mit.grant", "mit.notice"), "MIT"),
    (("mit.grant",), "MIT"),
    (("mit.ref",), "MIT"),
    (("apache.use", "apache.copy", "apache.basis", "apache.see"), "Apache-2.0"),
    (("apache.use", "apache.copy"), "Apache-2.0"),
    (("apache.use",), "Apache-2.0"),
    (("apache.ref",), "Apache-2.0"),
    (("gpl3.later", "gpl.hope", "gpl.see"), "GPL-3.0-or-later"),
    (("gpl3.later",), "GPL-3.0-or-later"),
    (("gpl2.later", "gpl.hope", "gpl.see"), "GPL-2.0-or-later"),
    (("gpl2.later",), "GPL-2.0-or-later"),
    (("gpl3.ref",), "GPL-3.0-only"),
    (("gpl2.ref",), "GPL-2.0-only"),
    (("bsd.use", "bsd.source", "bsd.binary", "bsd.advert", "bsd.names"), "BSD-4-Clause"),
    (("bsd.use", "bsd.source", "bsd.binary", "bsd.advert"), "BSD-4-Clause"),
    (("bsd.use", "bsd.source", "bsd.binary", "bsd.names"), "BSD-3-Clause"),
    (("bsd.use", "bsd.source", "bsd.binary"), "BSD-2-Clause"),
    (("ccbync.ref",), "CC-BY-NC-4.0"),
    (("ccbysa.ref",), "CC-BY-SA-4.0"),
    (("ccby.ref",), "CC-BY-4.0"),
    (("mpl.ref",), "MPL-2.0"),
    (("unlicense.ref",), "Unlicense"),
    (("apache.asf", "apache.use", "apache.copy", "apache.basis", "apache.see"), "Apache-2.0"),
    (("apache.asf", "apache.use"), "Apache-2.0"),
    (("lgpl21.later", "lgpl.hope", "lgpl.see"), "LGPL-2.1-or-later"),
    (("lgpl21.later",), "LGPL-2.1-or-later"),
    (("lgpl3.later", "lgpl.hope", "lgpl.see"), "LGPL-3.0-or-later"),
    (("lgpl3.later", "gpl.hope", "lgpl.see"), "LGPL-3.0-or-later"),
    (("lgpl3.later",), "LGPL-3.0-or-later"),
    (("agpl3.later", "gpl.hope", "agpl.see"), "AGPL-3.0-or-later"),
    (("agpl3.later",), "AGPL-3.0-or-later"),
    (("isc.grant", "isc.basis"), "ISC"),
    (("isc.grant",), "ISC"),
    (("0bsd.grant",), "0BSD"),
    (("zlib.basis", "zlib.liable", "zlib.grant"), "Zlib"),
    (("zlib.grant",), "Zlib"),
    (("boost.ref",), "BSL-1.0"),
    (("boost.grant",), "BSL-1.0"),
    (("epl2.ref",), "EPL-2.0"),
    (("epl1.ref",), "EPL-1.0"),
    (("cc0.ref",), "CC0-1.0"),
    (("ccbynd.ref",), "CC-BY-ND-4.0"),
    (("ccbyncsa.ref",), "CC-BY-NC-SA-4.0"),
    (("ccby3.ref",), "CC-BY-3.0"),
    (("ccbysa3.ref",), "CC-BY-SA-3.0"),
    *(((_spdx(name)[1],), name) for name in SPDX),
)
MARKERS = ("licen", "cc0", "liable", "advertising", "permission", "copyright", "redistribut", "warrant", "public domain")

# Of OP8_SQL.
_WRAP = r"\n[ \t]*([a-z(])"
_END = r"([.!?])[ \t\n\f\r]+"

# Of the query: two line ends separate paragraphs, a single one is a place where a sentence may end.
_BLANK = r"\n[ \t\n\f\r]*\n"
_CONTINUED = r"(?<!\n)\n[ \t]*([a-z(])"
_STOP = r"([.!?])(?!(?<=\b[vV]\.)[^A-Za-z0-9]{1,99}[0-9])[ \t\n\f\r]+"


def _key(ids: tuple[str, ...]) -> str:
    return "".join(f"<{i}>" for i in ids)


_KNOWN = "|".join(s.replace(" ", "[ \n]") for s in sorted(SENTENCES, key=len, reverse=True))
_PATTERN = "|".join(_key(ids).replace(".", r"\.") for ids, _ in RULES)


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def licence_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentences, licences`` for each row of ``docs(doc_id, text)`` with a known sentence:
    the identifiers in order, and the licences of the rules that fit, in order."""
    known, licence = _literal_map(SENTENCES), _literal_map({_key(i): name for i, name in RULES})
    joined = F.regexp_replace(F.regexp_replace("text", _BLANK, "\n\n"), _CONTINUED, " $1")
    lines = F.lower(F.regexp_replace(joined, _STOP, "$1\n\n"))
    plain = F.trim(F.regexp_replace(F.regexp_replace(lines, "[^a-z0-9\n]+", " "), " ?\n ?", "\n"))
    met = F.regexp_extract_all(plain, F.lit(f"(?<![a-z0-9 ])({_KNOWN})(?![a-z0-9 ])"))

    def identifier(sentence: Column) -> Column:
        return F.element_at(known, F.translate(sentence, "\n", " "))

    found = (
        docs.where(F.lower("text").rlike("|".join(MARKERS)))
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.transform(met, identifier).alias("sentences"),
        )
        .where(F.size("sentences") > 0)
    )
    sequence = F.concat_ws("", F.transform("sentences", lambda i: F.concat(F.lit("<"), i, F.lit(">"))))
    matches = F.regexp_extract_all(sequence, F.lit(f"({_PATTERN})"))
    return found.withColumn("licences", F.transform(matches, lambda m: F.element_at(licence, m)))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licence_scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.concat_ws(" ", "sentences").alias("sentences"),
        F.concat_ws(" ", "licences").alias("licences"),
    )


def _sql_map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) + "}"


OP8_SQL = f"""
  WITH lines AS (
    SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(
             text, '{_WRAP}', ' \\1', 'g'), '{_END}', E'\\\\1\\n', 'g'), E'\\n')) AS line,
           generate_subscripts(string_split(regexp_replace(regexp_replace(
             text, '{_WRAP}', ' \\1', 'g'), '{_END}', E'\\\\1\\n', 'g'), E'\\n'), 1) AS pos
    FROM documents),
  known AS (
    SELECT doc_id, pos, {_sql_map(SENTENCES)}[
             trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g'))] AS id
    FROM lines),
  found AS (
    SELECT doc_id, count(*) AS n_sentences, string_agg(id, ' ' ORDER BY pos) AS sentences,
           string_agg('<' || id || '>', '' ORDER BY pos) AS sequence
    FROM known WHERE id IS NOT NULL GROUP BY doc_id)
  SELECT doc_id, n_sentences, sentences,
         array_to_string(list_transform(regexp_extract_all(sequence, '{_PATTERN}'),
           lambda m: {_sql_map({_key(i): name for i, name in RULES})}[m]), ' ') AS licences
  FROM found"""

"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences (after . ! ? ; : and white space); sentences are
normalised (lower case, everything but letters and digits to single blanks,
"licence" to "license"), so comment marks, quotes and line breaks inside a
sentence do not matter. A sentence gets the identifiers of all known
licence sentences it holds, in order of position (where two overlap, that of the
one listed first below), others none: GNU notices join the grant and the version
by a comma. The identifiers of a document, in order, are then matched against the licence
rules, also in order: a rule is a sequence of identifiers, its matches are
consumed, and later rules see the rest. So a full MIT text is one licence and
not three hints, and a header that names the licence counts by itself.

Everything is row-local: no shuffle, no Python. Texts without any cue word of
the known sentences are passed by with one pattern.

Defined results: one row per input row; NULL and empty texts, and texts without
known sentences, have empty strings and n_sentences 0; repeated licences are
listed once, by name; ids that no rule used are listed in ``unmatched`` in
order of appearance; an empty table gives no rows; further columns of the input
are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences (or their invariable part) of public
# licence texts and customary notices, more specific ones first.
SENTENCES = [
    ("Apache2Grant", "licensed under the apache license version 2 0 the license"),
    ("Apache2Short", "licensed under the apache license version 2 0"),
    ("Apache2Use", "you may not use this file except in compliance with the license"),
    ("Apache2Copy", "you may obtain a copy of the license at"),
    ("Apache2Warranty", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("Apache2See", "see the license for the specific language governing permissions and limitations under the license"),
    ("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("MitNotice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("MitShort", "released under the mit license"),
    ("MitShort", "licensed under the mit license"),
    ("MitShort", "distributed under the mit license"),
    ("AsIsWarranty", "the software is provided as is without warranty of any kind"),
    ("IscGrant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("IscWarranty", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("BsdGrant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BsdSource", "redistributions of source code must retain the above copyright notice"),
    ("BsdBinary", "redistributions in binary form must reproduce the above copyright notice"),
    ("BsdEndorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BsdWarranty", "any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("BsdShort", "licensed under the bsd license"),
    ("Gpl3Short", "licensed under the gnu general public license version 3"),
    ("Gpl2Short", "licensed under the gnu general public license version 2"),
    ("Lgpl3Short", "licensed under the gnu lesser general public license version 3"),
    ("Agpl3Short", "licensed under the gnu affero general public license version 3"),
    ("LgplGrant", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("AgplGrant", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("GplGrant", "under the terms of the gnu general public license as published by the free software foundation"),
    ("GnuVersion3", "either version 3 of the license or at your option any later version"),
    ("GnuVersion21", "either version 2 1 of the license or at your option any later version"),
    ("GnuVersion2", "either version 2 of the license or at your option any later version"),
    ("GnuWarranty", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("GnuCopy", "you should have received a copy of the gnu"),
    ("Mpl2Grant", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("CcByNcSa4", "licensed under cc by nc sa 4 0"),
    ("CcByNcNd4", "licensed under cc by nc nd 4 0"),
    ("CcByNc4", "licensed under cc by nc 4 0"),
    ("CcBySa4", "licensed under cc by sa 4 0"),
    ("CcByNd4", "licensed under cc by nd 4 0"),
    ("CcBy4", "licensed under cc by 4 0"),
    ("CcBySaLong", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("CcByNcLong", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("CcByLong", "licensed under a creative commons attribution 4 0 international license"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
    ("PublicDomain", "released into the public domain"),
    ("Cc0Dedication", "dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("Cc0Short", "licensed under cc0 1 0"),
    ("ZlibWarranty", "this software is provided as is without any express or implied warranty"),
    ("ZlibGrant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
                  "it and redistribute it freely"),
    ("Epl2Grant", "made available under the terms of the eclipse public license 2 0"),
    ("Epl2Grant", "made available under the terms of the eclipse public license v2 0"),
    ("AllRights", "all rights reserved"),
]

# Licence names of SPDX identifier lines, longer ones before their beginnings.
SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-SA-4.0", "CC-BY-4.0", "EPL-2.0", "MPL-2.0",
        "AGPL-3.0-or-later", "AGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-3.0-only", "LGPL-2.1-or-later", "LGPL-2.1-only",
        "GPL-3.0-or-later", "GPL-3.0-only", "GPL-2.0-or-later", "GPL-2.0-only", "Artistic-2.0", "BSL-1.0"]
SENTENCES += [(f"Spdx{''.join(c for c in n if c.isalnum())}", f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', n.lower())}") for n in SPDX]

# Licence rules, tried in this order.
RULES = [
    ("BSD-3-Clause", ["AllRights", "BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "BsdWarranty"]),
    ("BSD-3-Clause", ["AllRights", "BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["AllRights", "BsdGrant", "BsdSource", "BsdBinary", "BsdWarranty"]),
    ("BSD-2-Clause", ["AllRights", "BsdGrant", "BsdSource", "BsdBinary"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "BsdWarranty"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdWarranty"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("MIT", ["MitGrant", "MitNotice", "AsIsWarranty"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("ISC", ["IscGrant", "IscWarranty"]),
    ("Apache-2.0", ["Apache2Grant", "Apache2Use", "Apache2Copy", "Apache2Warranty", "Apache2See"]),
    ("Apache-2.0", ["Apache2Grant", "Apache2Use", "Apache2Copy"]),
    ("AGPL-3.0-or-later", ["AgplGrant", "GnuVersion3", "GnuWarranty", "GnuCopy"]),
    ("AGPL-3.0-or-later", ["AgplGrant", "GnuVersion3"]),
    ("LGPL-3.0-or-later", ["LgplGrant", "GnuVersion3", "GnuWarranty", "GnuCopy"]),
    ("LGPL-3.0-or-later", ["LgplGrant", "GnuVersion3"]),
    ("LGPL-2.1-or-later", ["LgplGrant", "GnuVersion21", "GnuWarranty", "GnuCopy"]),
    ("LGPL-2.1-or-later", ["LgplGrant", "GnuVersion21"]),
    ("GPL-3.0-or-later", ["GplGrant", "GnuVersion3", "GnuWarranty", "GnuCopy"]),
    ("GPL-3.0-or-later", ["GplGrant", "GnuVersion3"]),
    ("GPL-2.0-or-later", ["GplGrant", "GnuVersion2", "GnuWarranty", "GnuCopy"]),
    ("GPL-2.0-or-later", ["GplGrant", "GnuVersion2"]),
    ("Apache-2.0", ["Apache2Grant"]),
    ("Apache-2.0", ["Apache2Short"]),
    ("MIT", ["MitShort"]),
    ("ISC", ["IscGrant"]),
    ("BSD", ["BsdShort"]),
    ("GPL-3.0", ["Gpl3Short"]),
    ("GPL-2.0", ["Gpl2Short"]),
    ("LGPL-3.0", ["Lgpl3Short"]),
    ("AGPL-3.0", ["Agpl3Short"]),
    ("MPL-2.0", ["Mpl2Grant"]),
    ("CC-BY-NC-SA-4.0", ["CcByNcSa4"]),
    ("CC-BY-NC-ND-4.0", ["CcByNcNd4"]),
    ("CC-BY-NC-4.0", ["CcByNc4"]),
    ("CC-BY-SA-4.0", ["CcBySa4"]),
    ("CC-BY-ND-4.0", ["CcByNd4"]),
    ("CC-BY-4.0", ["CcBy4"]),
    ("CC-BY-SA-4.0", ["CcBySaLong"]),
    ("CC-BY-NC-4.0", ["CcByNcLong"]),
    ("CC-BY-4.0", ["CcByLong"]),
    ("Unlicense", ["Unlicense"]),
    ("Public-Domain", ["PublicDomain"]),
    ("CC0-1.0", ["Cc0Dedication"]),
    ("CC0-1.0", ["Cc0Short"]),
    ("Zlib", ["ZlibWarranty", "ZlibGrant"]),
    ("Zlib", ["ZlibGrant"]),
    ("EPL-2.0", ["Epl2Grant"]),
    *[(n, [f"Spdx{''.join(c for c in n if c.isalnum())}"]) for n in SPDX],
    ("Proprietary", ["AllRights"]),
]

#: Every known sentence holds one of these words.
CUES = ["licen", "permission", "redistribut", "warrant", "copyright", "endorse", "domain", "gnu", "reserved", "cc0"]
#: The colon of an SPDX line ends no sentence.
_SPDX_LINE = r"(?i)(SPDX-License-Identifier):[\x20\x09]*"
_CUE = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in CUES)


def _mark(name: str) -> str:
    return f",{name},"


def sentence_ids(plain: Column) -> Column:
    """Identifiers of the normalised sentences of a text (cut by \\x01), in order
    of position; those a sentence repeats once. What a known sentence covers
    is not matched again by a later one."""
    text = F.concat(F.lit(" "), F.replace(plain, F.lit("\x01"), F.lit(" \x01 ")), F.lit(" "))
    for name, known in SENTENCES:
        text = F.replace(text, F.lit(f" {known} "), F.lit(f" \x02{name} "))
    return F.flatten(F.transform(F.split(text, "\x01"), lambda s: F.array_distinct(
        F.transform(F.filter(F.split(s, " "), lambda x: x.startswith("\x02")), lambda x: F.substring(x, 2, 200)))))


def scan(docs: DataFrame, id_col: str = "doc_id", column: str = "text") -> DataFrame:
    """id_col, sentence_ids, licenses, unmatched (comma-joined), n_sentences."""
    text = F.coalesce(F.col(column), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(
        F.regexp_replace(text, _SPDX_LINE, "$1 "), r"([.!?;:])[\x20\x09-\x0D]+", "$1\u0001")), "[^a-z0-9\u0001]+", " "), "licence", "license")
    ids = F.when(text.rlike(_CUE), sentence_ids(plain)).otherwise(F.array().cast("array<string>"))
    # one generated row each: a border that keeps the scan from being evaluated for every use of its result
    found = docs.select(F.col(id_col).alias("_id"), F.explode(F.array(ids)).alias("ids"))
    marks = F.array_join(F.transform("ids", lambda x: F.concat(F.lit(","), x, F.lit(","))), "")
    for name, sequence in RULES:
        marks = F.replace(marks, F.lit("".join(map(_mark, sequence))), F.lit(_mark(f"={name}")))
    left = found.select("_id", "ids", F.explode(F.array(F.filter(F.split(marks, ","), lambda x: x != ""))).alias("left"))
    named = F.filter("left", lambda x: x.startswith("="))
    return left.select(F.col("_id").alias(id_col), F.array_join("ids", ",").alias("sentence_ids"),
                       F.array_join(F.array_sort(F.array_distinct(F.transform(named, lambda x: F.substring(x, 2, 200)))), ",")
                       .alias("licenses"),
                       F.array_join(F.filter("left", lambda x: ~x.startswith("=")), ",").alias("unmatched"),
                       F.size("ids").cast("long").alias("n_sentences"))


def duckdb_sql(source: str = "documents") -> str:
    """The same scan as DuckDB SQL."""
    marked = "' ' || replace(t, chr(1), ' ' || chr(1) || ' ') || ' '"
    for name, known in SENTENCES:
        marked = f"replace({marked}, ' {known} ', ' ' || chr(2) || '{name} ')"
    marks = "array_to_string(list_transform(ids, lambda x: ',' || x || ','), '')"
    for name, sequence in RULES:
        marks = f"replace({marks}, '{''.join(map(_mark, sequence))}', '{_mark('=' + name)}')"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {source}),
p AS (SELECT doc_id, replace(regexp_replace(lower(regexp_replace(regexp_replace(t, '{_SPDX_LINE}', '\1 ', 'g'),
        '([.!?;:])[\x20\x09-\x0D]+', '\1' || chr(1), 'g')), '[^a-z0-9\x01]+', ' ', 'g'), 'licence', 'license') AS t,
        regexp_matches(t, '{_CUE}') AS cue FROM d),
m AS (SELECT doc_id, CASE WHEN cue THEN list_transform(string_split({marked}, chr(1)), lambda s: list_transform(
        list_filter(string_split(s, ' '), lambda x: starts_with(x, chr(2))), lambda x: x[2:])) ELSE [] END AS found FROM p),
i AS (SELECT doc_id, flatten(list_transform(found, lambda f: list_filter(f, lambda x, k: list_position(f, x) = k))) AS ids FROM m),
l AS (SELECT doc_id, ids, list_filter(string_split({marks}, ','), lambda x: x <> '') AS rest FROM i)
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct(list_transform(list_filter(rest, lambda x: x[1] = '='), lambda x: x[2:]))), ',') AS licenses,
  array_to_string(list_filter(rest, lambda x: x[1] <> '='), ',') AS unmatched, len(ids) AS n_sentences FROM l"""

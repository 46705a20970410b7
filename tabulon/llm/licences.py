"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences in three ways: at line ends; at sentence ends with lines run together; and at both, where
known sentences may run over any number of neighbouring fragments. The last finds notices as they are published, wrapped
over lines, behind comment signs, with colons and semicolons inside, next to a line without a full stop. Normalised
sentences (lower case, letters and digits only) that are known give the text three sequences of sentence numbers. Rules are sequences of sentences that make up a licence or its
notice; they are tried in order, longer ones before the shorter ones they contain, and a match uses up its sentences.

Only texts with one of the ``ANCHORS`` are cut up; every known sentence has one. A text stays one row, so nothing is
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences of public licences and notices, normalised, by name.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-notice-3": "this project is licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-2": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-2": "licensed under the apache license version 2 0 the license",
    "apache-title": "apache license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-law": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl-grant-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-grant-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl-grant-3": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0": "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-short": "licensed under cc by 4 0",
    "cc-by-sa-short": "licensed under cc by sa 4 0",
    "cc-by-nc-short": "licensed under cc by nc 4 0",
    "cc-by-nd-short": "licensed under cc by nd 4 0",
    "cc-by-nc-sa-short": "licensed under cc by nc sa 4 0",
    "reserved": "all rights reserved",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "agpl-grant-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-grant-2-1": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "epl-notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "cddl-notice": "the contents of this file are subject to the terms of the common development and distribution license the license",
    "bsl-notice": "distributed under the boost software license version 1 0",
    "artistic-notice": "this library is free software you can redistribute it and or modify it under the same terms as perl itself",
}
#: Fixed values: (licence, sentences in order), tried in this order.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache-notice-2", "apache-use", "apache-copy", "apache-law", "apache-see")),
    ("Apache-2.0", ("apache-notice-2", "apache-use")),
    ("GPL-3.0-or-later", ("gpl-grant-3", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl-grant-3",)),
    ("GPL-2.0-or-later", ("gpl-grant-2", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-grant-2",)),
    ("LGPL-3.0-or-later", ("lgpl-grant-3",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-notice",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-notice-3",)),
    ("Apache-2.0", ("apache-notice-2",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("CC-BY-4.0", ("cc-by-short",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-short",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-short",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-short",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-2",)),
    ("Apache-2.0", ("apache-title",)),
    ("proprietary", ("reserved",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("0BSD", ("0bsd-grant", "isc-warranty")),
    ("0BSD", ("0bsd-grant",)),
    ("AGPL-3.0-or-later", ("agpl-grant-3",)),
    ("LGPL-2.1-or-later", ("lgpl-grant-2-1",)),
    ("EPL-2.0", ("epl-notice",)),
    ("CDDL", ("cddl-notice",)),
    ("BSL-1.0", ("bsl-notice",)),
    ("Artistic-1.0-Perl", ("artistic-notice",)),
)
#: Parts of words of which every known sentence has one.
ANCHORS = ("licen", "permission", "copyright", "warrant", "redistribut", "rights reserved", "public domain", "free software")
_NAMES = list(SENTENCES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where sentences end: a line end; or a sentence mark before white space.
CUTS = (r"[\n\r]+", r"[.!?:;]+[\x20\x09-\x0D]+")
#: Where fragments end: at any of these, and a sentence mark at the end of a text.
ENDS = r"(?:[.!?:;]++(?:[\x20\x09-\x0D]|$)|[\n\r])[\x20\x09-\x0D]*+"
#: A known sentence from the start of a fragment to the end of one, longer ones first.
JOINED = r"(?<=\|)(?:" + "|".join(s.replace(" ", "[ |]") for s in sorted(SENTENCES.values(), key=len, reverse=True)) + r")(?=\|)"


def _known(text: Column, cuts: str) -> Column:
    """The numbers, from 1, of the known sentences of a lower-case text, in order."""
    normal = F.transform(F.split(text, cuts, -1), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    numbers = F.transform(normal, lambda s: F.array_position(F.lit(list(SENTENCES.values())), s))
    return F.filter(numbers, lambda n: n > 0)


def _joined(text: Column) -> Column:
    """The numbers of the known sentences of a lower-case text that are made up of whole neighbouring fragments."""
    plain = F.regexp_replace(text, r"[^a-z0-9.!?:;\x20\x09-\x0D]+", " ")
    plain = F.regexp_replace(F.regexp_replace(plain, ENDS, "|"), "[^a-z0-9|]+", " ")
    plain = F.regexp_replace(F.concat(F.lit("|"), plain, F.lit("|")), r"\x20?\|[\x20|]*+", "|")
    return F.transform(F.regexp_extract_all(plain, F.lit(JOINED), F.lit(0)), lambda s: F.array_position(F.lit(list(SENTENCES.values())), F.translate(s, "|", " ")))


def _coded(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda n: F.concat(F.lit("<"), n.cast("string"), F.lit(">"))), "")


def _pattern(names: tuple[str, ...]) -> str:
    return "".join(f"<{_NAMES.index(n) + 1}>" for n in names)


def _matched(coded: Column) -> Column:
    """The numbers, from 0, of the rules that match a sequence, each after those before it took their sentences."""
    rules = F.array(*(F.struct(F.lit(k).alias("no"), F.lit(_pattern(names)).alias("p")) for k, (_, names) in enumerate(RULES)))
    start = F.struct(coded.alias("left"), F.array().cast("array<int>").alias("found"))

    def step(a: Column, r: Column) -> Column:
        has = a["left"].contains(r["p"])
        return F.struct(F.when(has, F.replace(a["left"], r["p"], F.lit("|"))).otherwise(a["left"]).alias("left"), F.when(has, F.concat(a["found"], F.array(r["no"]))).otherwise(a["found"]).alias("found"))

    return F.aggregate(rules, start, step, lambda a: a["found"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sentences, sentences, rules, licences) for every row of ``docs``.

    n_sentences counts the known sentences of the cut that knows most (the first of these, if equal); sentences names
    them in order; rules lists the rules that match any cut, from 0, in order; licences lists their licences, each once.
    Lists are joined by commas and empty where nothing is known, as for null and empty texts. Rows are independent:
    repeated rows give repeated results, no rows give none.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER).alias("text"))
    may = F.col("text").rlike("|".join(ANCHORS))
    none = F.array().cast("array<bigint>")
    own = own.select("doc_id", *(F.when(may, _known(F.col("text"), c)).otherwise(none).alias(f"by_{k}") for k, c in enumerate(CUTS)), F.when(may, _joined(F.col("text"))).otherwise(none).alias("by_2"))
    own = own.withColumn("rules", F.array_sort(F.array_distinct(F.concat(*(F.when(F.size(f"by_{k}") > 0, _matched(_coded(F.col(f"by_{k}")))).otherwise(F.array().cast("array<int>")) for k in range(3))))))
    more = F.when(F.size("by_1") > F.size("by_0"), F.col("by_1")).otherwise(F.col("by_0"))
    more = F.when(F.size("by_2") > F.size(more), F.col("by_2")).otherwise(more)
    names = F.array_join(F.transform(more, lambda n: F.get(F.lit(_NAMES), (n - 1).cast("int"))), ",")
    licences = F.array_join(F.array_distinct(F.transform("rules", lambda r: F.get(F.lit([x for x, _ in RULES]), r))), ",")
    return own.select("doc_id", F.size(more).cast("long").alias("n_sentences"), names.alias("sentences"), F.array_join(F.transform("rules", lambda r: r.cast("string")), ",").alias("rules"), licences.alias("licences"))


def _sql() -> str:
    listed = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    steps, last = [], "c"
    for k, (_, names) in enumerate(RULES):
        p = _pattern(names)
        parts = ", ".join(f"replace(s{j}, '{p}', '|') AS s{j}, CASE WHEN contains(s{j}, '{p}') THEN list_append(f{j}, {k}) ELSE f{j} END AS f{j}" for j in range(2))
        steps.append(f"r{k} AS (SELECT doc_id, k0, k1, {parts} FROM {last})")
        last = f"r{k}"
    known = [
        f"list_filter(list_transform(string_split_regex(t, '{c}'), lambda s: list_position({listed(SENTENCES.values())}, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))), lambda n: n > 0)"
        for c in CUTS
    ]
    coded = lambda j: f"list_aggregate(list_transform(k{j}, lambda n: '<' || n || '>'), 'string_agg', '')"
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
e AS (SELECT doc_id, CASE WHEN regexp_matches(t, '{'|'.join(ANCHORS)}') THEN t ELSE '' END AS t FROM d),
b AS (SELECT doc_id, {known[0]} AS k0, {known[1]} AS k1 FROM e),
c AS (SELECT doc_id, k0, k1, coalesce({coded(0)}, '') AS s0, coalesce({coded(1)}, '') AS s1, []::INT[] AS f0, []::INT[] AS f1 FROM b),
{', '.join(steps)},
f AS (SELECT doc_id, CASE WHEN len(k1) > len(k0) THEN k1 ELSE k0 END AS k, list_sort(list_distinct(list_concat(f0, f1))) AS r FROM {last})
SELECT doc_id, CAST(len(k) AS BIGINT) AS n_sentences,
       coalesce(list_aggregate(list_transform(k, lambda n: ({listed(_NAMES)})[n]), 'string_agg', ','), '') AS sentences,
       coalesce(list_aggregate(list_transform(r, lambda n: CAST(n AS VARCHAR)), 'string_agg', ','), '') AS rules,
       coalesce((SELECT string_agg(l, ',' ORDER BY p) FROM (SELECT l, min(p) AS p FROM (
         SELECT unnest(list_transform(r, lambda n: ({listed(x for x, _ in RULES)})[n + 1])) AS l, generate_subscripts(r, 1) AS p) GROUP BY l)), '') AS licences
FROM f"""


#: ``scan`` over the table documents.
SQL = _sql()

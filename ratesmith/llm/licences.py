"""License scans by sentence rules (operator 1).

A text is cut into sentences, each sentence is normalised and mapped to the identifier of a
known licence sentence, and the sequence of identifiers is matched against ordered rules: the
first rules are the longest and most specific, and what a rule has matched is not matched again.

Sentences end at . ! ? ; or : before white space, at blank lines, and before a line that
starts like a licence; other line breaks are spaces, so hard-wrapped licence texts are whole.
Normalised: lower-case (A-Z), runs of other characters than a-z and 0-9 as one space, "licence"
as "license"; a sentence starting with "copyright" is a copyright notice whatever follows.
A sentence that is not known separates what is before it from what is after it; list markers
("1.", "(a)", "*") and empty sentences are none, so numbered conditions follow each other.

Defined cases: a null or empty text has no sentences and no licences; a repeated licence is
reported once; rows are scanned one by one, so repeated rows, null ids and other columns do no
harm; known sentences that no rule uses up are reported as left over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Identifiers of licence sentences and their normalised text.
SENTENCES = (
    ("apache2-short", "licensed under the apache license version 2 0"),
    ("apache2-the-license", "licensed under the apache license version 2 0 the license"),
    ("apache2-compliance", "you may not use this file except in compliance with the license"),
    ("apache2-obtain", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache2-as-is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache2-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit-short", "released under the mit license"),
    ("mit-licensed", "licensed under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-as-is", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc-liability", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-liability", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"),
    ("bsd-loss", "loss of use data or profits"),
    ("bsd-cause", "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("bsd3-short", "licensed under the bsd 3 clause license"),
    ("bsd2-short", "licensed under the bsd 2 clause license"),
    ("gpl3-work", "this work is licensed under the gnu general public license version 3"),
    ("gpl3-short", "licensed under the gnu general public license version 3"),
    ("gpl2-short", "licensed under the gnu general public license version 2"),
    ("gpl-free", "this program is free software"),
    ("gpl2-later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl3-later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-implied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-see", "see the gnu general public license for more details"),
    ("agpl3-later", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-see", "see the gnu affero general public license for more details"),
    ("agpl3-short", "licensed under the gnu affero general public license version 3"),
    ("lgpl-free", "this library is free software"),
    ("lgpl21-later", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3-later", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-hope", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl-see", "see the gnu lesser general public license for more details"),
    ("lgpl-short", "licensed under the gnu lesser general public license version 3"),
    ("mpl2-subject", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl2-short", "licensed under the mozilla public license version 2 0"),
    ("epl2-materials", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("epl2-short", "licensed under the eclipse public license version 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc0-short", "licensed under cc0 1 0"),
    ("unlicense-domain", "this is free and unencumbered software released into the public domain"),
    ("spdx-mit", "spdx license identifier mit"),
    ("spdx-apache2", "spdx license identifier apache 2 0"),
    ("spdx-gpl3", "spdx license identifier gpl 3 0 only"),
    ("spdx-bsd3", "spdx license identifier bsd 3 clause"),
    ("spdx-bsd2", "spdx license identifier bsd 2 clause"),
    ("spdx-isc", "spdx license identifier isc"),
    ("spdx-agpl3", "spdx license identifier agpl 3 0 or later"),
    ("spdx-mpl2", "spdx license identifier mpl 2 0"),
    ("spdx-epl2", "spdx license identifier epl 2 0"),
    ("all-rights", "all rights reserved"),
    ("copyright", "copyright"),
)
# Ordered rules (licence, sequence of sentence identifiers).
RULES = (
    ("Apache-2.0", ("apache2-the-license", "apache2-compliance", "apache2-obtain", "apache2-as-is", "apache2-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability", "bsd-loss", "bsd-cause")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability", "bsd-loss", "bsd-cause")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-later", "gpl-hope", "gpl-implied", "agpl-see")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-later", "lgpl-hope", "gpl-implied", "lgpl-see")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-later", "lgpl-hope", "gpl-implied", "lgpl-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later", "gpl-hope", "gpl-implied", "gpl-see")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-later")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-later")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-later")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache2-the-license",)),
    ("Apache-2.0", ("apache2-short",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-licensed",)),
    ("BSD-3-Clause", ("bsd3-short",)),
    ("BSD-2-Clause", ("bsd2-short",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("GPL-2.0-only", ("gpl2-short",)),
    ("AGPL-3.0-only", ("agpl3-short",)),
    ("LGPL-3.0-only", ("lgpl-short",)),
    ("EPL-2.0", ("epl2-materials",)),
    ("EPL-2.0", ("epl2-short",)),
    ("MPL-2.0", ("mpl2-subject",)),
    ("MPL-2.0", ("mpl2-short",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
    ("CC0-1.0", ("cc0-short",)),
    ("Unlicense", ("unlicense-domain",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("spdx-apache2",)),
    ("GPL-3.0-only", ("spdx-gpl3",)),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("BSD-2-Clause", ("spdx-bsd2",)),
    ("ISC", ("spdx-isc",)),
    ("AGPL-3.0-or-later", ("spdx-agpl3",)),
    ("MPL-2.0", ("spdx-mpl2",)),
    ("EPL-2.0", ("spdx-epl2",)),
    ("All-rights-reserved", ("copyright", "all-rights")),
    ("All-rights-reserved", ("all-rights",)),
)
#: Every known sentence holds one of these, so a text that, normalised as a whole, has none needs no closer look.
CUES = ("licen[cs]", "copyright", "permi[ts]", "warrant", "redistribut", "rights reserved", "public domain", "free software", "above",
        "consequential damages", "loss of use", "business interruption")
#: A line that starts like this starts a sentence.
OPENINGS = ("Licensed", "Released", "This", "Copyright", "SPDX", "Permission", "Redistribution", "All rights", "THE SOFTWARE", "You may", "Unless")
UNKNOWN, MARK = "<->", "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (pattern, replacement with its group as \1) that puts a mark between sentences, in order.
BREAKS = (
    (r"([.!?;:])[ \t\n\x0B\f\r]+", r"\1" + MARK),
    (r"\n[ \t\x0B\f\r]*\n", MARK),
    (r"\n([^A-Za-z0-9\n]*(?:" + "|".join(OPENINGS) + r"))", MARK + r"\1"),
)

#: A normalised sentence that is only a list marker, or empty.
MARKER = r"^(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})?$"
#: A list marker at the start of a sentence that no break follows: "1) ", "(a) ", "o ".
MARKED = r"^[^A-Za-z0-9]*(?:(?:[0-9]{1,2}|[A-Za-z]|[ivxIVX]{1,4})\)|o)[ \t\n\x0B\f\r]+"


def _sentences(text: Column) -> Column:
    for pattern, put in BREAKS:
        text = F.regexp_replace(text, pattern, put.replace("\\1", "$1"))
    return F.transform(F.split(text, MARK, -1), lambda s: F.regexp_replace(s, MARKED, ""))


def _normalised(sentence: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.translate(sentence, _UPPER, _LOWER), "[^a-z0-9]+", " "))
    plain = F.replace(plain, F.lit("licence"), F.lit("license"))
    return F.when(plain.startswith("copyright "), "copyright").otherwise(plain)


def scan_licences(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_sentences (known ones), licences (comma-joined, in rule order) and left_over identifiers."""
    known = F.create_map(*[F.lit(x) for name, text in SENTENCES for x in (text, f"<{name}>")])
    text = F.coalesce(F.col("text"), F.lit(""))
    cue = F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+", " ").rlike("|".join(CUES))
    plain = F.filter(F.transform(_sentences(text), _normalised), lambda s: ~s.rlike(MARKER))
    named = F.transform(plain, lambda s: F.element_at(known, s))
    out = documents.select("doc_id", F.when(cue, named).otherwise(F.array().cast("array<string>")).alias("named"))
    out = out.select("doc_id", F.size(F.filter("named", lambda x: x.isNotNull())).cast("long").alias("n_sentences"),
                     F.array_join("named", "", UNKNOWN).alias("rest"))
    out = out.withColumn("found", F.array().cast("array<string>"))
    # one projection per rule: each sees what the earlier ones left
    for licence, sequence in RULES:
        pattern = "".join(f"<{s}>" for s in sequence)
        out = out.withColumns({"found": F.when(F.contains(F.col("rest"), F.lit(pattern)), F.array_union("found", F.array(F.lit(licence)))).otherwise(F.col("found")),
                               "rest": F.replace(F.col("rest"), F.lit(pattern), F.lit(UNKNOWN))})
    left = F.col("rest")
    for old, new in ((UNKNOWN, ""), ("<copyright>", ""), ("><", ","), ("<", ""), (">", "")):
        left = F.replace(left, F.lit(old), F.lit(new))
    return out.select("doc_id", "n_sentences", F.array_join("found", ",").alias("licences"),
                      left.alias("left_over"))


def duckdb_sql() -> str:
    """The same scan as DuckDB SQL over the view ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    marked = "coalesce(text, '')"
    for pattern, put in BREAKS:
        marked = f"regexp_replace({marked}, {quote(pattern.replace(chr(92) + 'x0B', chr(92) + 'v'))}, {quote(put)}, 'g')"
    rows = ", ".join(f"({quote(t)}, {quote('<' + n + '>')})" for n, t in SENTENCES)
    steps, before = [], "named"
    for i, (licence, sequence) in enumerate(RULES):
        pattern = quote("".join(f"<{s}>" for s in sequence))
        steps.append(f"r{i} AS (SELECT doc_id, n_sentences, CASE WHEN contains(rest, {pattern}) AND NOT list_contains(found, {quote(licence)}) "
                     f"THEN list_append(found, {quote(licence)}) ELSE found END AS found, replace(rest, {pattern}, '<->') AS rest FROM {before})")
        before = f"r{i}"
    return f"""
WITH known(sentence, name) AS (VALUES {rows}),
cut AS (
  SELECT doc_id, generate_subscripts(s, 1) AS pos, unnest(s) AS sentence
  FROM (SELECT doc_id, string_split({marked}, chr(1)) AS s FROM documents)),
plain AS (
  SELECT doc_id, pos, replace(trim(regexp_replace(translate(regexp_replace(sentence, {quote(MARKED.replace(chr(92) + 'x0B', chr(92) + 'v'))}, ''),
                                                            '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), 'licence', 'license') AS p
  FROM cut),
named AS (
  SELECT doc_id, count(name) AS n_sentences, CAST([] AS VARCHAR[]) AS found,
         coalesce(string_agg(coalesce(name, '<->'), '' ORDER BY pos) FILTER (NOT regexp_matches(p, {quote(MARKER)})), '') AS rest
  FROM plain LEFT JOIN known ON sentence = CASE WHEN p LIKE 'copyright %' THEN 'copyright' ELSE p END
  GROUP BY doc_id),
{", ".join(steps)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, array_to_string(found, ',') AS licences,
       replace(replace(replace(replace(replace(rest, '<->', ''), '<copyright>', ''), '><', ','), '<', ''), '>', '') AS left_over
FROM {before}
"""

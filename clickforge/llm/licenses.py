"""Licences by sentence rules.

A text is cut into sentences; each is normalised (comment leaders dropped, white space collapsed, lower case)
and mapped to the identifiers of the known licence sentences it holds, by their places (one sentence of a standard
header often names the terms and the version). The identifiers of a document, in order, are matched
against ordered rules; what a rule matches is consumed, so a longer rule wins over the shorter ones after it.
All in DataFrame expressions over one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values. A text without any of these holds no licence sentence: each is within one word, so that no line
#: break, repeated blank or comment leader can stand inside, and a "cc" stands before white space.
STEMS = ["licen", "copyright", "permission", "warrant", "redistribut", "endorse", "domain", "reserved", "cc0"]
CC = r"cc[ \t\r\n]"
#: The words by which the SQL twin picks texts (it misses phrases that are wrapped).
KEYWORDS = ["licen", "copyright", "permission", "warrant", "redistribut", "public domain", "all rights reserved", "cc by", "cc0"]

#: Identifier and pattern of known licence sentences. The last stands only for a sentence without any other.
SENTENCES = [
    ("apache-2-name", r"licensed under the apache license,? (version )?2(\.0)?"),
    ("apache-copy", r"you may obtain a copy of the license at"),
    ("apache-as-is", r"distributed under the license is distributed on an .?as is.? basis"),
    ("apache-terms", r"you may not use this file except in compliance with the license"),
    ("apache-see", r"see the license for the specific language governing permissions"),
    ("mit-name", r"(released|licensed|distributed|available) under (the )?(terms of the )?mit license"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included"),
    ("as-is-warranty", r"the software is provided .?as is.?,? without warranty of any kind"),
    ("bsd-name", r"(released|licensed|distributed|available) under (the )?(terms of the )?(new |simplified |[23]-clause )?bsd license"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"neither the name of .* may be used to endorse or promote products"),
    ("bsd-warranty", r"this software is provided by the .* .?as is.? and any express or implied warranties"),
    ("agpl-terms", r"under the terms of (version 3 of )?the gnu affero general public license"),
    ("lgpl-terms", r"under the terms of (version [0-9.]+ of )?the gnu (lesser|library) general public license"),
    ("gpl-terms", r"under the terms of (version [0-9.]+ of )?the gnu general public license"),
    ("agpl-3-name", r"gnu affero general public license,? (version |v)3"),
    ("lgpl-3-name", r"gnu lesser general public license,? (version |v)3"),
    ("lgpl-21-name", r"gnu lesser general public license,? (version |v)2\.1"),
    ("lgpl-2-name", r"gnu (lesser|library) general public license,? (version |v)2(\.0)?([^.0-9]|\.?$)"),
    ("gpl-3-name", r"gnu general public license,? (version |v)3"),
    ("gpl-2-name", r"gnu general public license,? (version |v)2"),
    ("version-3", r"(either |under the terms of )version 3 of the (gnu [a-z ]*)?license"),
    ("version-21", r"(either |under the terms of )version 2\.1 of the (gnu [a-z ]*)?license"),
    ("version-2", r"(either |under the terms of )version 2(\.0)? of the (gnu [a-z ]*)?license"),
    ("agpl-copy", r"you should have received a copy of the gnu affero general public license"),
    ("lgpl-copy", r"you should have received a copy of the gnu (lesser|library) general public license"),
    ("gpl-copy", r"you should have received a copy of the gnu general public license"),
    ("gpl-warranty", r"without even the implied warranty of merchantability or fitness"),
    ("gpl-see", r"see the gnu (lesser |library |affero )?general public license for more details"),
    ("mpl-2-name", r"mozilla public license,? (version |v\.? ?)?2\.0"),
    ("epl-2-name", r"eclipse public license( -)?,? (version |v\.? ?)?2\.0"),
    ("epl-1-name", r"eclipse public license( -)?,? (version |v\.? ?)?1\.0"),
    ("mpl-2-header", r"this source code form is subject to the terms of the mozilla public license"),
    ("isc-grant", r"permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("cc-by-nc-sa-4", r"cc by-nc-sa 4\.0"),
    ("cc-by-nc-nd-4", r"cc by-nc-nd 4\.0"),
    ("cc-by-nc-4", r"cc by-nc 4\.0"),
    ("cc-by-sa-4", r"cc by-sa 4\.0"),
    ("cc-by-nd-4", r"cc by-nd 4\.0"),
    ("cc-by-4", r"cc by 4\.0"),
    ("cc0", r"(^|[^a-z0-9])cc0([^a-z0-9]|$)"),
    ("public-domain", r"(released|dedicated|placed) (in)?to the public domain"),
    ("spdx-mit", r"spdx-license-identifier: mit"),
    ("spdx-apache-2", r"spdx-license-identifier: apache-2\.0"),
    ("spdx-gpl-3", r"spdx-license-identifier: gpl-3\.0"),
    ("spdx-gpl-2", r"spdx-license-identifier: gpl-2\.0"),
    ("spdx-bsd-3", r"spdx-license-identifier: bsd-3-clause"),
    ("spdx-bsd-2", r"spdx-license-identifier: bsd-2-clause"),
    ("rights-reserved", r"all rights reserved"),
    ("copyright", r"copyright (\(c\)|©|[0-9]{4})"),
    ("other-licence", r"licen[sc]ed under|under the terms of .* licen[sc]e"),
]

#: A notice of rights before a licence's own grant belongs to it.
_RIGHTS = "(copyright,)*(rights-reserved,)?"
_REST = "(gpl-warranty,)?(gpl-see,)?"

#: Ordered rules over the sequence of identifiers (each followed by a comma).
RULES = [
    ("Apache-2.0", _RIGHTS + r"apache-2-name,(apache-terms,)?(apache-copy,)?(apache-as-is,)?(apache-see,)?"),
    ("Apache-2.0", r"apache-terms,apache-copy,(apache-as-is,)?(apache-see,)?"),
    ("Apache-2.0", r"spdx-apache-2,"),
    ("MIT", _RIGHTS + r"mit-grant,mit-notice,(as-is-warranty,)?"),
    ("MIT", r"(mit-name|spdx-mit),"),
    ("BSD-3-Clause", _RIGHTS + r"bsd-grant,bsd-source,bsd-binary,bsd-endorse,(bsd-warranty,)?"),
    ("BSD-3-Clause", r"spdx-bsd-3,"),
    ("BSD-2-Clause", _RIGHTS + r"bsd-grant,bsd-source,bsd-binary,(bsd-warranty,)?"),
    ("BSD-2-Clause", r"spdx-bsd-2,"),
    ("BSD", r"bsd-name,"),
    ("AGPL-3.0", r"agpl-terms,(version-3,|agpl-3-name,)*" + _REST + r"(agpl-copy,)?"),
    ("AGPL-3.0", r"agpl-3-name,"),
    ("LGPL-3.0", r"lgpl-terms,(version-3,|lgpl-3-name,)+" + _REST + r"(gpl-copy,)?(lgpl-copy,)?"),
    ("LGPL-3.0", r"lgpl-3-name,"),
    ("LGPL-2.1", r"lgpl-terms,(version-21,|lgpl-21-name,)+" + _REST + r"(lgpl-copy,)?"),
    ("LGPL-2.1", r"lgpl-21-name,"),
    ("LGPL-2.0", r"lgpl-terms,(version-2,|lgpl-2-name,)+" + _REST + r"(lgpl-copy,)?"),
    ("LGPL-2.0", r"lgpl-2-name,"),
    ("LGPL", r"lgpl-terms," + _REST + r"(lgpl-copy,)?"),
    ("GPL-3.0", r"gpl-terms,(version-3,|gpl-3-name,)+" + _REST + r"(gpl-copy,)?"),
    ("GPL-3.0", r"(gpl-3-name|spdx-gpl-3),"),
    ("GPL-2.0", r"gpl-terms,(version-2,|gpl-2-name,)+" + _REST + r"(gpl-copy,)?"),
    ("GPL-2.0", r"(gpl-2-name|spdx-gpl-2),"),
    ("GPL", r"gpl-terms," + _REST + r"(gpl-copy,)?"),
    ("EPL-2.0", r"epl-2-name,"),
    ("EPL-1.0", r"epl-1-name,"),
    ("MPL-2.0", r"mpl-2-header,(mpl-2-name,)?"),
    ("MPL-2.0", r"mpl-2-name,"),
    ("ISC", _RIGHTS + r"isc-grant,(as-is-warranty,)?"),
    ("CC-BY-NC-SA-4.0", r"cc-by-nc-sa-4,"),
    ("CC-BY-NC-ND-4.0", r"cc-by-nc-nd-4,"),
    ("CC-BY-NC-4.0", r"cc-by-nc-4,"),
    ("CC-BY-SA-4.0", r"cc-by-sa-4,"),
    ("CC-BY-ND-4.0", r"cc-by-nd-4,"),
    ("CC-BY-4.0", r"cc-by-4,"),
    ("CC0-1.0", r"cc0,"),
    ("public-domain", r"public-domain,"),
    ("proprietary", r"(copyright,)?rights-reserved,"),
]

LEADER = r"(?m)^[ \t]*(//+|/\*+|\*+/?|#+|;+|--+)[ \t]*"
SENTENCE_END = r"([.!?;])[ \t\r\n]+|\n[ \t\r]*\n"


def sentences_of(text: Column) -> Column:
    """Normalised sentences: cut after . ! ? ; before white space, and at blank lines."""
    clean = F.regexp_replace(F.regexp_replace(text, LEADER, ""), SENTENCE_END, "$1\u0001")
    return F.split(F.lower(F.regexp_replace(clean, r"[ \t\r\n]+", " ")), "\u0001")


def sentence_ids(sentence: Column) -> Column:
    """Identifiers of the licence sentences within a sentence, by their places, ties in the order of SENTENCES."""
    *known, (other, pattern) = SENTENCES
    found = F.array_sort(F.array_compact(F.array(*[
        F.when(sentence.rlike(p), F.struct(F.regexp_instr(sentence, F.lit(p)).alias("at"), F.lit(k).alias("k"), F.lit(name).alias("name")))
        for k, (name, p) in enumerate(known)])))
    names = F.transform(found, lambda x: x["name"])
    none = F.when(sentence.rlike(pattern), F.array(F.lit(other))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(names) > 0, names).otherwise(none)


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``licence``: sentences (identifiers in order), names (licences by rule, each
    once), unmatched (identifiers that no rule consumed).

    A null or empty text, or one without a licence sentence, has empty arrays and 0. Repeated rows get equal
    results; other columns pass through (a column named ``licence`` is replaced).
    """
    df = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "licence"]).alias("_row"),
                     F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_t"))
    low = F.lower("_t")
    any_word = low.rlike(CC)
    for k in STEMS:
        any_word = any_word | low.contains(k)
    found = F.flatten(F.transform(sentences_of(F.col("_t")), sentence_ids))
    df = df.withColumn("_ids", F.when(any_word, found).otherwise(F.array().cast("array<string>")))
    some = F.size("_ids") > 0
    df = df.withColumn("_left0", F.when(some, F.concat(F.array_join("_ids", ","), F.lit(","))).otherwise(F.lit("")))
    hits = []
    for k, (name, pattern) in enumerate(RULES):
        whole = f"(^|,){pattern}"
        hits.append(F.when((F.col(f"_left{k}") != "") & F.col(f"_left{k}").rlike(whole), F.lit(name)))
        df = df.withColumn(f"_left{k + 1}", F.when(F.col(f"_left{k}") != "", F.regexp_replace(F.col(f"_left{k}"), whole, "$1")).otherwise(F.lit("")))
    left = F.col(f"_left{len(RULES)}")
    names = F.when(some, F.array_distinct(F.array_compact(F.array(*hits)))).otherwise(F.array().cast("array<string>"))
    unmatched = (F.length(left) - F.length(F.replace(left, F.lit(","), F.lit("")))).cast("long")
    told = F.struct(F.col("_ids").alias("sentences"), names.alias("names"), unmatched.alias("unmatched"))
    # an array of one: a filter on the result stays above it and is not expanded into all these expressions
    return df.select("_row", F.explode(F.array(told)).alias("_licence")).select("_row.*", F.col("_licence").alias("licence"))

"""Licence scans: known licence sentences, then ordered rules over their identifiers.

A text is cut into sentences twice, once with every line end as a break and
once with line ends as spaces (notices are wrapped at any width).  Sentences
are normalised and looked up; the identifiers found, in order, are matched
against the rules from the most to the least specific.  A rule whose
identifiers follow each other somewhere claims them, and the next rules see the
rest.  Identifiers that no rule claims are reported as loose.

One projection over the text, all SQL functions, no shuffle.  A text without
any of the ``MARKS`` holds no known sentence (each has one) and is passed over;
marks lie inside one word, so how a notice is wrapped does not hide them.

Rules: NULL and empty texts give empty results; repeated rows each give their
own row; a licence found in both cuttings or several times is listed once, in
rule order; an empty table gives no rows; clashing column names give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.llm.common import without

# Normalised sentences of public licence texts and notices, and the licences they spell.
SENTENCES: dict[str, str] = {
    "licensed under the apache license version 2 0": "ApacheRef",
    "licensed under the apache license version 2 0 the license": "ApacheRef",
    "this project is licensed under the apache license version 2 0": "ApacheRef",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheWarranty",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this project is licensed under the mit license": "MITRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITWarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITLiability",
    "this work is licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 3": "GPL3Ref",
    "this work is licensed under the gnu general public license version 2": "GPL2Ref",
    "licensed under the gnu general public license version 2": "GPL2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2Later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21Later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLWarranty",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLWarranty",
    "see the gnu general public license for more details": "GPLSee",
    "see the gnu lesser general public license for more details": "GPLSee",
    "you should have received a copy of the gnu general public license along with this program": "GPLCopy",
    "you should have received a copy of the gnu lesser general public license along with this library": "GPLCopy",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDWarranty",
    "licensed under the bsd 3 clause license": "BSD3Ref",
    "licensed under the bsd 2 clause license": "BSD2Ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2Ref",
    "licensed under the mozilla public license version 2 0": "MPL2Ref",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "MPL2Copy",
    "licensed under cc by 4 0": "CCBY4Ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4Ref",
    "licensed under cc by sa 4 0": "CCBYSA4Ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CCBYSA4Ref",
    "licensed under cc by nc 4 0": "CCBYNC4Ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "CCBYNC4Ref",
    "this is free and unencumbered software released into the public domain": "UnlicenseRef",
    "released into the public domain under the cc0 1 0 license": "CC0Ref",
    "all rights reserved": "AllRights",
}

# Ordered rules, the most specific first: licence, and the identifiers that follow each other.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["ApacheRef", "ApacheUse", "ApacheCopy", "ApacheWarranty", "ApacheSee"]),
    ("MIT", ["MITGrant", "MITNotice", "MITWarranty", "MITLiability"]),
    ("BSD-3-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse", "BSDWarranty"]),
    ("BSD-2-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDWarranty"]),
    ("GPL-3.0-or-later", ["GPL3Later", "GPLWarranty", "GPLSee", "GPLCopy"]),
    ("GPL-2.0-or-later", ["GPL2Later", "GPLWarranty", "GPLSee", "GPLCopy"]),
    ("LGPL-2.1-or-later", ["LGPL21Later", "GPLWarranty", "GPLSee", "GPLCopy"]),
    ("MPL-2.0", ["MPL2Ref", "MPL2Copy"]),
    ("ISC", ["ISCGrant"]),
    ("MIT", ["MITGrant", "MITNotice"]),
    ("GPL-3.0-or-later", ["GPL3Later"]),
    ("GPL-2.0-or-later", ["GPL2Later"]),
    ("LGPL-2.1-or-later", ["LGPL21Later"]),
    ("Apache-2.0", ["ApacheRef"]),
    ("MIT", ["MITRef"]),
    ("GPL-3.0-only", ["GPL3Ref"]),
    ("GPL-2.0-only", ["GPL2Ref"]),
    ("BSD-3-Clause", ["BSD3Ref"]),
    ("BSD-2-Clause", ["BSD2Ref"]),
    ("MPL-2.0", ["MPL2Ref"]),
    ("CC-BY-4.0", ["CCBY4Ref"]),
    ("CC-BY-SA-4.0", ["CCBYSA4Ref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4Ref"]),
    ("Unlicense", ["UnlicenseRef"]),
    ("CC0-1.0", ["CC0Ref"]),
]

#: In lower case, every known sentence holds one of these. The text is not normalised yet: none may hold a space.
MARKS = ("licens", "licenc", "warrant", "redistribut", "permission", "copyright", "liable", "unencumbered", "reserved", "mpl")

#: Sentence ends: a full stop, question or exclamation mark before white space or the end; a semicolon or colon likewise.
END = r"[.!?;:]+(?:\s+|$)"


def _identifiers(text: Column, breaks: str) -> Column:
    """The known sentences' identifiers in order, each with a space before and behind."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    clean = lambda s: F.trim(F.regexp_replace(F.replace(F.lower(s), F.lit("licence"), F.lit("license")), "[^a-z0-9]+", " "))
    named = F.transform(F.split(text, breaks), lambda s: F.element_at(known, clean(s)))
    return F.concat(F.lit(" "), F.array_join(F.filter(named, lambda x: x.isNotNull()), "  "), F.lit(" "))


def _ruled(identifiers: Column) -> Column:
    """struct(rest, found): rules applied in order, each to what the ones before have left."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(" " + "  ".join(ids) + " ").alias("ids")) for name, ids in RULES])
    start = F.struct(identifiers.alias("rest"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        claimed = F.struct(
            F.replace(state["rest"], rule["ids"], F.lit(" | ")).alias("rest"), F.array_append(state["found"], rule["name"]).alias("found")
        )
        return F.when(F.contains(state["rest"], rule["ids"]), claimed).otherwise(state)

    return F.aggregate(rules, start, apply)


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids``, ``licenses`` and ``loose_ids`` (arrays of strings, never NULL).

    ``sentence_ids`` lists the identifiers of the cutting that found more of
    them (of the one by lines where both found as many).
    """
    names = ["sentence_ids", "licenses", "loose_ids"]
    kept = without(docs, names)
    text = F.col(text_col)
    marked = F.coalesce(F.lower(text).rlike("|".join(MARKS)), F.lit(False))
    none = F.lit(" ")
    # F.when keeps texts without a mark from being cut at all
    by_line = F.when(marked, _identifiers(text, r"[\r\n]+|" + END)).otherwise(none)
    by_text = F.when(marked, _identifiers(F.regexp_replace(text, r"\s+", " "), END)).otherwise(none)
    words = lambda c: F.filter(F.split(c, "[ |]+"), lambda x: x != "")
    cut = kept.withColumns({"_line": by_line, "_text": by_text})
    cut = cut.withColumns({"_ruled_line": _ruled(F.col("_line")), "_ruled_text": _ruled(F.col("_text"))})
    longer = F.size(words("_text")) > F.size(words("_line"))
    order = F.array(*[F.lit(x) for x in dict.fromkeys(name for name, _ in RULES)])
    both = F.concat(F.col("_ruled_line.found"), F.col("_ruled_text.found"))
    return cut.withColumns(
        {
            "sentence_ids": words(F.when(longer, F.col("_text")).otherwise(F.col("_line"))),
            "licenses": F.filter(order, lambda x: F.array_contains(both, x)),
            "loose_ids": words(F.when(longer, F.col("_ruled_text.rest")).otherwise(F.col("_ruled_line.rest"))),
        }
    ).drop("_line", "_text", "_ruled_line", "_ruled_text")

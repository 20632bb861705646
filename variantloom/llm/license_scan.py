"""Licence scan: normalised sentences become identifiers, identifier sequences become licences.

A text is cut into segments at line ends, after sentence marks and after the mark of
a list item; a known sentence may be wrapped over any number of them.  Segments are
normalised (lower case, everything but letters and digits is one blank, so
comment marks and punctuation vanish) and looked up in the sentence table.  The
sequence of identifiers, with a bar for each unknown segment but a list mark, is then
rewritten by the ordered rules: the first rule that finds its sequence consumes
it.  What no rule consumes is reported as unresolved.

All of it is one projection of built-in expressions.  Both tables are fixed and
small; they are literals, nothing is broadcast or shuffled.  A null or empty
text has no sentence; every input row gives one row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import indexes, let

# The mark of a list item at the begin of a line, and a segment that is nothing else.
LIST_MARK = "(?md)^([^A-Za-z0-9\\n]*+(?:[0-9]{1,3}|[A-Za-z]|[ivxIVX]{1,5})[.):\\]]+)[ \\t]+"
MARK_ONLY = "^(?:[0-9]{1,3}|[a-z]|[ivx]{1,5})$"

# Sentences of widely used licence notices, as published.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("ApacheNotice", "Licensed under the Apache License, Version 2.0"),
    ("ApacheHeader", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("ApacheObey", "you may not use this file except in compliance with the License"),
    ("ApacheObey", "You may not use this file except in compliance with the License"),
    ("ApacheCopyAt", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("ApacheCopyAt", "You may obtain a copy of the License at"),
    ("ApacheUrl", "http://www.apache.org/licenses/LICENSE-2.0"),
    ("ApacheAsIs", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License"),
    ("MitNotice", "Released under the MIT License"),
    ("MitNotice", "Licensed under the MIT License"),
    ("MitNotice", "This project is licensed under the MIT License"),
    ("MitNotice", "This software is released under the MIT License"),
    ("MitTitle", "The MIT License (MIT)"),
    ("MitTitle", "MIT License"),
    ("MitGrant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'),
    ("MitKeep", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MitAsIs", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'),
    ("GplNotice3", "This work is licensed under the GNU General Public License, version 3"),
    ("GplNotice3", "Licensed under the GNU General Public License, version 3"),
    ("GplNotice3", "This program is licensed under the GNU General Public License v3.0"),
    ("GplNotice2", "Licensed under the GNU General Public License, version 2"),
    ("GplNotice2", "This work is licensed under the GNU General Public License, version 2"),
    ("GplGrant3Later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GplGrant2Later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GplGrant2Only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("LgplGrant3Later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LgplGrant21Later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("AgplGrant3Later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GnuHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("GnuHope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("GplSee", "See the GNU General Public License for more details"),
    ("LgplSee", "See the GNU Lesser General Public License for more details"),
    ("AgplSee", "See the GNU Affero General Public License for more details"),
    ("GplReceived", "You should have received a copy of the GNU General Public License along with this program"),
    ("BsdGrant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BsdSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BsdBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BsdEndorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BsdNotice", "Licensed under the BSD License"),
    ("Bsd3Notice", "Licensed under the BSD 3-Clause License"),
    ("Bsd2Notice", "Licensed under the BSD 2-Clause License"),
    ("IscGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("MplForm", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MplCopy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("EplNotice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("CcByNc4", "Licensed under CC BY-NC 4.0"),
    ("CcBy4", "Licensed under CC BY 4.0"),
    ("CcBySa4", "Licensed under CC BY-SA 4.0"),
    ("CcByNc4", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CcBy4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CcBySa4", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("UnlicenseDomain", "This is free and unencumbered software released into the public domain"),
    ("PublicDomain", "This work is released into the public domain"),
    ("AllRights", "All rights reserved"),
)

# Ordered: a longer sequence stands before the shorter ones it contains.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("ApacheHeader", "ApacheObey", "ApacheCopyAt", "ApacheUrl", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheHeader", "ApacheObey", "ApacheCopyAt", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheHeader", "ApacheObey", "ApacheCopyAt")),
    ("MIT", ("MitTitle", "MitGrant", "MitKeep", "MitAsIs")),
    ("MIT", ("MitGrant", "MitKeep", "MitAsIs")),
    ("MIT", ("MitGrant", "MitKeep")),
    ("GPL-3.0-or-later", ("GplGrant3Later", "GnuHope", "GplSee", "GplReceived")),
    ("GPL-3.0-or-later", ("GplGrant3Later", "GnuHope", "GplSee")),
    ("GPL-2.0-or-later", ("GplGrant2Later", "GnuHope", "GplSee")),
    ("GPL-2.0-only", ("GplGrant2Only", "GnuHope", "GplSee")),
    ("LGPL-3.0-or-later", ("LgplGrant3Later", "GnuHope", "LgplSee")),
    ("LGPL-2.1-or-later", ("LgplGrant21Later", "GnuHope", "LgplSee")),
    ("AGPL-3.0-or-later", ("AgplGrant3Later", "GnuHope", "AgplSee")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("MPL-2.0", ("MplForm", "MplCopy")),
    ("Apache-2.0", ("ApacheHeader",)),
    ("Apache-2.0", ("ApacheNotice",)),
    ("MIT", ("MitNotice",)),
    ("MIT", ("MitGrant",)),
    ("GPL-3.0-only", ("GplNotice3",)),
    ("GPL-2.0-only", ("GplNotice2",)),
    ("GPL-3.0-or-later", ("GplGrant3Later",)),
    ("GPL-2.0-or-later", ("GplGrant2Later",)),
    ("GPL-2.0-only", ("GplGrant2Only",)),
    ("LGPL-3.0-or-later", ("LgplGrant3Later",)),
    ("LGPL-2.1-or-later", ("LgplGrant21Later",)),
    ("AGPL-3.0-or-later", ("AgplGrant3Later",)),
    ("BSD-3-Clause", ("Bsd3Notice",)),
    ("BSD-2-Clause", ("Bsd2Notice",)),
    ("BSD", ("BsdNotice",)),
    ("ISC", ("IscGrant",)),
    ("MPL-2.0", ("MplForm",)),
    ("EPL-2.0", ("EplNotice",)),
    ("CC-BY-NC-4.0", ("CcByNc4",)),
    ("CC-BY-SA-4.0", ("CcBySa4",)),
    ("CC-BY-4.0", ("CcBy4",)),
    ("Unlicense", ("UnlicenseDomain",)),
    ("Public-Domain", ("PublicDomain",)),
)

# Every known sentence has one of these inside a word, where no line end or comment mark
# can part it; a text without any is not cut at all.
CUES = ("licens", "licenc", "copyright", "permi", "warrant", "redistribut", "mpl", "derived", "domain", "reserved")


def normal_text(sentence: str) -> str:
    """The form in which sentences are compared."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).replace("licence", "license").strip()


def _normal(text: Column) -> Column:
    return F.trim(F.replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), F.lit("licence"), F.lit("license")))


def sentence_sequence(text: Column, sentences: tuple[tuple[str, str], ...] = SENTENCES) -> Column:
    """Identifiers as ``<A><B>``, with ``|`` for each unknown segment between that is no list mark."""
    names = {normal_text(s): name for name, s in sentences}
    known = F.create_map(*(F.lit(x) for item in names.items() for x in item))
    begins = sorted({" ".join(w[:k]) for w in (s.split(" ") for s in names) for k in range(1, len(w) + 1)})
    longest, most_words = max(map(len, names)), max(len(s.split(" ")) for s in names)
    # Segments are joined by line ends here: a sentence ends where a segment does.
    wrapped = "^(?:" + "|".join(s.replace(" ", "[ \n]") for s in sorted(names, key=len, reverse=True)) + ")(?=\n|\\z)"
    cut = F.split(F.regexp_replace(F.regexp_replace(text, LIST_MARK, "$1\n"), "([.!?:;])[ \\t]+", "$1\n"), "\n")

    def at(segments: Column, i: Column) -> Column:
        """The longest known sentence that begins at segment i, with the segments it spans."""
        ahead = F.array_join(F.transform(F.slice(segments, i + 1, F.lit(most_words)), lambda s: F.left(s, F.lit(longest + 1))), "\n")
        found = F.when(F.get(segments, i).isin(begins), F.regexp_extract(ahead, wrapped, 0)).otherwise("")
        return let(
            found,
            lambda m: F.struct(
                F.try_element_at(known, F.translate(m, "\n", " ")).alias("name"),
                (F.length(m) - F.length(F.replace(m, F.lit("\n"))) + 1).alias("k"),
                F.get(segments, i).rlike(MARK_ONLY).alias("listed"),
            ),
        )

    def fold(state: Column, item: Column) -> Column:
        covered = state.getField("reach") > item.getField("i")
        mark = F.when(covered | (item.getField("name").isNull() & item.getField("listed")), "").when(item.getField("name").isNull(), "|").otherwise(F.concat(F.lit("<"), item.getField("name"), F.lit(">")))
        reach = F.when(item.getField("name").isNull(), state.getField("reach")).otherwise(F.greatest(state.getField("reach"), item.getField("i") + item.getField("k")))
        return F.struct(reach.alias("reach"), F.concat(state.getField("marks"), mark).alias("marks"))

    def marks(segments: Column) -> Column:
        items = F.transform(indexes(F.size(segments)), lambda i: let(at(segments, i), lambda m: F.struct(i.alias("i"), m.getField("name").alias("name"), m.getField("k").alias("k"), m.getField("listed").alias("listed"))))
        return F.aggregate(items, F.struct(F.lit(0).alias("reach"), F.lit("").alias("marks")), fold, lambda s: s.getField("marks"))

    return let(F.filter(F.transform(cut, _normal), lambda s: s != ""), marks)


def apply_rules(marks: Column, rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES) -> Column:
    """Rewrite identifier sequences by the rules, in their order, as ``{licence}``."""
    for name, sequence in rules:
        marks = F.replace(marks, F.lit("".join(f"<{x}>" for x in sequence)), F.lit(f"{{{name}}}"))
    return marks


def scan(docs: DataFrame, text: str = "text", column: str = "license") -> DataFrame:
    """``docs`` with a struct: sentences and licences in text order, unresolved sentences."""
    body = F.coalesce(docs[text], F.lit(""))
    low = F.lower(body)
    cue = F.lit(False)
    for word in CUES:
        cue = cue | low.contains(word)

    def result(marks: Column) -> Column:
        return let(
            apply_rules(marks),
            lambda out: F.struct(
                F.regexp_extract_all(marks, F.lit("<([^>]*)>"), 1).alias("sentences"),
                F.array_distinct(F.regexp_extract_all(out, F.lit("\\{([^}]*)\\}"), 1)).alias("licenses"),
                F.regexp_extract_all(out, F.lit("<([^>]*)>"), 1).alias("unresolved"),
            ),
        )

    return docs.withColumn(column, result(F.when(cue, sentence_sequence(body)).otherwise("")))

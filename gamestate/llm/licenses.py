"""License scans by sentence rules, in DataFrame functions alone.

A text is normalised and cut into sentences, which end at . ! ? ; and : before a space or the end. Known licence sentences
become identifiers, and ordered rules match runs of identifiers: a rule that matches gives its licence and uses its
identifiers up. A statement of several sentences, such as a notice whose version follows a semicolon, needs all of them in
order, so versions are kept apart. A sentence must equal a known one wholly: a negated one is unknown. Sentences that say
"... under <names>" and SPDX lines may name several licences, joined by "or" and "and"; each name is an identifier.

Sentences are looked for in the lines of a text, in the text with its lines joined, so wrapped sentences count, and in its
paragraphs with their lines joined, where blank lines and copyright lines end a sentence. Of the two joined forms the one
with more identifiers leads, the paragraphs if equal; identifiers that only the other or the lines have come after, and no
rule spans the two parts.

Defined results: a null, empty or blank text has no sentences and no licence; repeated rows repeat; columns besides
doc_id and text are not looked at. A text of any length is cut up whole, within one row. Of rules that could use the same
identifiers the first in order does. Exceptions that an SPDX line adds to a licence don't change its name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences as their licences and notices state them, after the identifiers of their parts.
SENTENCES = [
    ("ApacheContents", "The contents of this file are subject to the Apache License, Version 2.0"),
    ("ApacheTitle", "Apache License, Version 2.0, January 2004"),
    ("ApacheTitle", "Apache License, Version 2.0, January 2004 http"),
    ("ApacheMayNot", "you may not use this file except in compliance with the License"),
    ("ApacheCopy", "You may obtain a copy of the License at"),
    ("ApacheCopy", "You may obtain a copy of the License at http"),
    ("ApacheAsIs", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License"),
    ("MitTitle", "The MIT License (MIT)"),
    ("MitTitle", "MIT License"),
    ("MitTitle", "The MIT License"),
    ("MitGrant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MitNotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MitNotice", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software"),
    ("AsIsMit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("MitLiable", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("BsdGrant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BsdSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BsdBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BsdAdvert", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("BsdNoEndorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BsdAsIs", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
    ("BsdLiable BsdLoss", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS"),
    ("IscGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("IscGrant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ZeroBsdGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("IscAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"),
    ("ZlibAsIs", "This software is provided 'as-is', without any express or implied warranty"),
    ("ZlibGrant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BoostGrant", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"),
    ("BoostTitle", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("GplTitle2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GplTitle3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LgplTitle2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LgplTitle3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AgplTitle3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Mpl2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Mpl2", "The contents of this file are subject to the Mozilla Public License, v. 2.0"),
    ("Mpl2Title", "Mozilla Public License Version 2.0"),
    ("Mpl1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")"),
    ("Mpl1.1", "The contents of this file are subject to the Mozilla Public License, v. 1.1"),
    ("Mpl1.1", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1"),
    ("MplObtain", "If a copy of the MPL was not distributed with this file, You can obtain one at https"),
    ("Epl2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Epl2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0"),
    ("Epl1", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("UnlicenseAnyone", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("Wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004"),
    ("Cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("Cc0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("AllRights", "All rights reserved, no license is granted"),
]

#: Families of the GNU licences, their versions and the things they speak of.
GNU = [
    ("Gpl", "GPL", "GNU General Public License", ("2", "3"), ("gpl", "gnu gpl")),
    ("Lgpl", "LGPL", "GNU Lesser General Public License", ("2.1", "3"), ("lgpl", "gnu lgpl", "gnu lesser gpl")),
    ("Agpl", "AGPL", "GNU Affero General Public License", ("3",), ("agpl", "gnu agpl", "gnu affero gpl")),
    ("LibGpl", "LGPL", "GNU Library General Public License", ("2",), ("library gpl", "gnu library gpl")),
]
THINGS = ("program", "library", "software", "file")
OPTION = "either version {} of the License, or (at your option) any later version"
TERMS = "you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation"

#: Names by which sentences refer to a licence, besides those of the GNU and Creative Commons families.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache License Version 2", "Apache Software License, Version 2.0"),
    "MIT": ("MIT License", "MIT", "MIT License (MIT)", "MIT/Expat License", "Expat License", "MIT-style License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL v2.0"),
    "MPL-1.1": ("Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1", "MPL v1.1"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL 2.0"),
    "EPL-1.0": ("Eclipse Public License, version 1.0", "Eclipse Public License 1.0", "EPL 1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "Unlicense": ("Unlicense",),
    "WTFPL": ("WTFPL",),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic License, Version 2.0", "Artistic 2.0"),
    "Artistic-1.0": ("Artistic License 1.0", "Artistic License, Version 1.0", "Artistic 1.0", "Artistic License"),
    "EUPL-1.2": ("European Union Public License, Version 1.2", "European Union Public License 1.2", "EUPL 1.2", "EUPL v1.2", "EUPL, Version 1.2"),
    "EUPL-1.1": ("European Union Public License, Version 1.1", "European Union Public License 1.1", "EUPL 1.1", "EUPL v1.1", "EUPL, Version 1.1"),
    "PSF-2.0": ("Python Software Foundation License Version 2", "Python Software Foundation License", "PSF License Agreement", "PSF License", "PSF License Version 2"),
}
CC_PARTS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-NC-SA", "BY-ND", "BY-NC-ND")
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")

#: Ordered rules: the licence and the run of identifiers that states it. Longer runs come first; RULES_ALL adds the families and names.
RULES = [
    ("Apache-2.0", ["Apache-2.0.name", "ApacheMayNot", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["Apache-2.0.name", "ApacheMayNot", "ApacheCopy"]),
    ("Apache-2.0", ["ApacheContents"]),
    ("Apache-2.0", ["ApacheTitle"]),
    ("BSD-4-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAdvert"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdNoEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("MIT", ["MitTitle", "MitGrant", "MitNotice", "AsIsMit", "MitLiable"]),
    ("MIT", ["MitGrant", "MitNotice", "AsIsMit", "MitLiable"]),
    ("MIT", ["MitTitle", "MitGrant", "MitNotice", "AsIsMit"]),
    ("MIT", ["MitGrant", "MitNotice", "AsIsMit"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("MIT", ["MitTitle"]),
    ("ISC", ["IscGrant"]),
    ("0BSD", ["ZeroBsdGrant", "IscAsIs"]),
    ("Zlib", ["ZlibAsIs", "ZlibGrant"]),
    ("BSL-1.0", ["BoostTitle", "BoostGrant"]),
    ("BSL-1.0", ["BoostGrant"]),
    ("GPL-3.0-only", ["GplTitle3"]),
    ("GPL-2.0-only", ["GplTitle2"]),
    ("LGPL-2.1-only", ["LgplTitle2.1"]),
    ("LGPL-3.0-only", ["LgplTitle3"]),
    ("AGPL-3.0-only", ["AgplTitle3"]),
    ("MPL-2.0", ["Mpl2", "MplObtain"]),
    ("MPL-2.0", ["Mpl2"]),
    ("MPL-2.0", ["Mpl2Title"]),
    ("MPL-1.1", ["Mpl1.1", "ApacheMayNot", "ApacheCopy"]),
    ("MPL-1.1", ["Mpl1.1"]),
    ("EPL-2.0", ["Epl2"]),
    ("EPL-1.0", ["Epl1"]),
    ("Unlicense", ["Unlicense", "UnlicenseAnyone"]),
    ("Unlicense", ["Unlicense"]),
    ("WTFPL", ["Wtfpl"]),
    ("CC0-1.0", ["Cc0"]),
    ("All rights reserved", ["AllRights"]),
]

#: Stems without any character of _NOISE. Every known sentence has one, and neither wrapping nor normalising breaks one, so
#: a text without them needs no further look.
KEYS = "licen[cs]|copyright|permission|redistribut|warrant|software|publicly|liab|contribut|loss|copy|obtain|version|mpl|under|materials"
_SPELLED = ("licenc", "licens")
_NOISE = "[\\x20\\x09-\\x0D\"'\u201c\u201d\u2018\u2019`*#/<>()\\[\\]{}|_=,~-]+"
_LINE_NOISE = _NOISE.replace("\\x09-\\x0D", "\\x09\\x0B-\\x0D")
_ENDS = "[.!?;:]+(?:[ \\n]|$)|\\n"
_BLANK = "\\n" + _NOISE[:-1] + "*\\n"
_COPYRIGHT = "(?m)^(" + _LINE_NOISE[:-1] + "*copyright[ \\t]*(?:\\(c\\)|\u00a9|[0-9]{4})[^\\n]*)\\n"
#: v2, v. 2 and version 2 are the same.
_VERSION = "\\bv(?:er|ersion)?[.]? ?([0-9])"
_NAMED = "neither the names? of [^.!?;:]{1,100} nor the names of its contributors"
_HOLDER = "neither the name of the copyright holder nor the names of its contributors"
_LATER = " or (?:at your option )?(?:any )?(?:later|newer)(?: version)?"
_TAIL = "(?: the license| at your option)+$"
_SAYS = "^(?:(?:this|the|our) (?:project|work|software|program|library|file|code|source code|source|repository|package|module|document|documentation|text|content|article|page|dataset) is )?(?:also |dual |hereby )?(?:licensed|released|distributed|published|available|made available|provided|shared) under (?:the )?(?:terms of )?(?:either of |either |both )?(?:the |a |an )?"
_TAG = "spdx license identifier:"
_SPDX = "^spdx license identifier "
#: A line that names its licence after a word and a colon says the same as a sentence.
_FIELD = "(?m)^ ?license: ?"
_FIELD_SAYS = "licensed under "
#: What an SPDX line adds to a licence doesn't change its name.
_EXCEPTION = "( with [a-z0-9. ]{1,60}(?:exception|note|exemption)(?: [0-9.]{1,4})?)+"
#: Marks of quotes in texts that were pages.
_MARKS = "&(?:quot|apos|lt|gt|nbsp|#34|#39|#x27|#x22);"
_JOINED = " or (?:the )?| and (?:the )?"


def plain(sentence: str) -> str:
    """The normal form of one sentence without its end."""
    s = re.sub(_NOISE, " ", sentence.lower().replace(*_SPELLED))
    return re.sub("[.!?;:]+$", "", re.sub(_VERSION, r"version \1", s).strip()).strip()


def known() -> dict[str, str]:
    """Identifier of each known sentence in its normal form."""
    out: dict[str, str] = {}

    def add(name: str, sentence: str) -> None:
        parts = [p.strip() for p in re.split(_ENDS, plain(sentence)) if p.strip()]
        for n, p in zip(name.split(), parts, strict=True):
            out.setdefault(p, n)

    def named(licence: str, name: str) -> None:
        out.setdefault("under " + plain(name), f"{licence}.name")

    for name, s in SENTENCES:
        add(name, s)
    for x in THINGS:
        add("FreeSoftware", f"This {x} is free software")
        add("GplHope GplEven", f"This {x} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE")
    for short, spdx, full, versions, names in GNU:
        add(f"{short}Details", f"See the {full} for more details")
        add(f"{short}Free", TERMS.format(full))
        for v in versions:
            add(f"Version{v}OrLater", OPTION.format(v))
            add(f"Version{v}Only", f"version {v} of the License")
            add(f"{short}Free{v}", f"{TERMS.format(full)}, {OPTION.format(v)}")
            add(f"{short}Only{v}", f"{TERMS.format(full)}, version {v} of the License")
            licence = f"{spdx}-{_dotted(v)}"
            forms = [f"{n} {k}{w}" for n in (full.lower(), *names) for k in ("version ", "") for w in {v, _dotted(v)}]
            for form in [*forms, *(f"{n}v{w}" for n in names for w in (v, _dotted(v)))]:
                named(f"{licence}-only", form)
                named(f"{licence}-or-later", form + "+later")
                named(f"{licence}-or-later", form + "+")
    for licence, names in NAMES.items():
        for n in names:
            named(licence, n)
    for kind in CC_KINDS:
        words = "-".join(CC_PARTS[p] for p in kind.split("-"))
        for v in CC_VERSIONS:
            for n in (f"CC {kind} {v}", f"Creative Commons {kind} {v}", f"Creative Commons {words} {v} License", f"Creative Commons {words} {v} International License", f"Creative Commons {words} {v} International", f"Creative Commons {words} {v} Unported License"):
                named(f"CC-{kind}-{v}", n)
    for _, spdx, _, versions, _ in GNU:  # identifiers without an end, as older files have them
        for v in versions:
            out["under spdx " + plain(f"{spdx}-{_dotted(v)}")] = f"{spdx}-{_dotted(v)}-only.name"
            out["under spdx " + plain(f"{spdx}-{_dotted(v)}") + "+"] = f"{spdx}-{_dotted(v)}-or-later.name"
    for licence in _named_licences():
        out["under spdx " + plain(licence).replace(" or later", "+later")] = f"{licence}.name"
    return out


def _dotted(version: str) -> str:
    return version if "." in version else f"{version}.0"


def _named_licences() -> list[str]:
    gnu = [f"{spdx}-{_dotted(v)}{end}" for _, spdx, _, versions, _ in GNU for v in versions for end in ("-only", "-or-later")]
    return [*NAMES, *gnu, *[f"CC-{k}-{v}" for k in CC_KINDS for v in CC_VERSIONS]]


def rules() -> list[tuple[str, list[str]]]:
    """All rules in order; a GNU notice without a version gives the family alone."""
    later = [(f"{spdx}-{_dotted(v)}-or-later", run) for short, spdx, _, versions, _ in GNU for v in versions for run in ([f"{short}Free", f"Version{v}OrLater"], [f"{short}Free{v}"])]
    only = [(f"{spdx}-{_dotted(v)}-only", run) for short, spdx, _, versions, _ in GNU for v in versions for run in ([f"{short}Free", f"Version{v}Only"], [f"{short}Only{v}"])]
    bare = [(spdx, [f"{short}Free"]) for short, spdx, *_ in GNU]
    return [*RULES, *later, *only, *bare, *((licence, [f"{licence}.name"]) for licence in _named_licences())]


def _sentences(text: Column, joined: bool, paragraphs: bool = False) -> Column:
    low = F.replace(F.lower(text), F.lit(_SPELLED[0]), F.lit(_SPELLED[1]))
    if paragraphs:
        low = F.regexp_replace(F.regexp_replace(low, _COPYRIGHT, "$1\n\n"), _BLANK, " . ")
    clean = F.regexp_replace(F.regexp_replace(low, _MARKS, " "), _NOISE if joined else _LINE_NOISE, " ")
    clean = F.regexp_replace(F.replace(clean, F.lit(_TAG), F.lit(_TAG[:-1])), _FIELD, _FIELD_SAYS)
    clean = F.regexp_replace(F.regexp_replace(clean, _VERSION, "version $1"), _NAMED, _HOLDER)
    return F.transform(F.split(clean, _ENDS), lambda s: _stated(F.trim(s)))


def _stated(s: Column) -> Column:
    says, spdx = s.rlike(_SAYS), s.rlike(_SPDX)
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, _SAYS, ""), _SPDX, ""), _LATER, "+later"), _TAIL, "")
    bare = F.when(spdx, F.regexp_replace(bare, _EXCEPTION, "")).otherwise(bare)
    return F.when(says, F.concat(F.lit("under "), F.regexp_replace(bare, _JOINED, "\nunder "))).when(spdx, F.concat(F.lit("under spdx "), F.regexp_replace(bare, _JOINED, "\nunder spdx "))).otherwise(s)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_known, sentence_ids (known identifiers in order, joined by commas) and licenses (joined by |)."""
    table = F.create_map(*[F.lit(x) for pair in known().items() for x in pair])
    ordered = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("," + ",,".join(ids) + ",").alias("run")) for name, ids in rules()])
    none = F.array().cast("array<string>")

    def found(joined: bool, paragraphs: bool = False) -> Column:
        names = F.split(F.array_join(_sentences(F.col("text"), joined, paragraphs), "\n"), "\n")
        return F.filter(F.transform(names, lambda s: F.element_at(table, s)), lambda i: i.isNotNull())

    worth = F.coalesce(F.lower("text").rlike(KEYS), F.lit(False))
    cut = lambda c: F.when(worth, c).otherwise(none)
    cuts = docs.select("doc_id", cut(found(True, True)).alias("p"), cut(found(True)).alias("j"), cut(found(False)).alias("l"))
    by_paragraph = F.size("p") >= F.size("j")
    lead = F.when(by_paragraph, F.col("p")).otherwise(F.col("j"))
    rest = F.array_except(F.concat(F.when(by_paragraph, F.col("j")).otherwise(F.col("p")), "l"), lead)
    out = cuts.select("doc_id", lead.alias("lead"), rest.alias("rest"))
    marked = lambda c: F.array_join(F.transform(c, lambda i: F.concat(F.lit(","), i, F.lit(","))), "")
    start = F.struct(F.concat(marked("lead"), F.lit(";"), marked("rest")).alias("left"), none.alias("names"))

    def step(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["left"], rule["run"])
        left = F.when(hit, F.replace(acc["left"], rule["run"], F.lit(";"))).otherwise(acc["left"])
        names = F.when(hit, F.array_union(acc["names"], F.array(rule["name"]))).otherwise(acc["names"])
        return F.struct(left.alias("left"), names.alias("names"))

    ids = F.concat("lead", "rest")
    return out.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_known"),
        F.array_join(ids, ",").alias("sentence_ids"),
        F.when(F.size(ids) > 0, F.array_join(F.aggregate(ordered, start, step)["names"], "|")).otherwise("").alias("licenses"),
    )


def oracle() -> str:
    """The same in SQL, over the same sentences and rules."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def replaced(s: str, pattern: str, new: str) -> str:
        return f"regexp_replace({s}, {quoted(pattern)}, {quoted(new)}, 'g')"

    def ids(joined: bool, paragraphs: bool = False) -> str:
        s = f"replace(lower(text), '{_SPELLED[0]}', '{_SPELLED[1]}')"
        if paragraphs:
            s = replaced(replaced(s, _COPYRIGHT, "\\1\n\n"), _BLANK, " . ")
        s = replaced(replaced(s, _MARKS, " "), _NOISE if joined else _LINE_NOISE, " ")
        s = replaced(f"replace({s}, '{_TAG}', '{_TAG[:-1]}')", _FIELD, _FIELD_SAYS)
        s = replaced(replaced(s, _VERSION, "version \\1"), _NAMED, _HOLDER)
        bare = replaced(replaced(replaced(replaced("trim(s)", _SAYS, ""), _SPDX, ""), _LATER, "+later"), _TAIL, "")
        spdx = replaced(bare, _EXCEPTION, "")
        each = f"CASE WHEN regexp_matches(trim(s), {quoted(_SAYS)}) THEN 'under ' || {replaced(bare, _JOINED, chr(10) + 'under ')} WHEN regexp_matches(trim(s), {quoted(_SPDX)}) THEN 'under spdx ' || {replaced(spdx, _JOINED, chr(10) + 'under spdx ')} ELSE trim(s) END"
        split = f"list_transform(string_split_regex({s}, {quoted(_ENDS)}), lambda s: {each})"
        names = f"string_split(array_to_string({split}, chr(10)), chr(10))"
        return f"list_filter(list_transform({names}, lambda s: known[s]), lambda i: i IS NOT NULL)"

    table = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in known().items()) + "}"
    runs = [("," + ",,".join(r) + ",", name) for name, r in rules()]
    run_list = "[" + ", ".join(f"{{'run': {quoted(run)}, 'name': {quoted(name)}}}" for run, name in runs) + "]"
    worth = f"coalesce(regexp_matches(lower(text), '{KEYS}'), false)"
    sql = f"WITH t AS (SELECT doc_id, text, {table} AS known FROM documents)"
    for name, mode in (("p", (True, True)), ("j", (True,)), ("l", (False,))):
        sql += (", c AS (SELECT *, " if name == "p" else ", ") + f"CASE WHEN {worth} THEN {ids(*mode)} ELSE [] END AS {name}"
    sql += " FROM t), d AS (SELECT doc_id, CASE WHEN len(p) >= len(j) THEN p ELSE j END AS lead, CASE WHEN len(p) >= len(j) THEN j ELSE p END || l AS more FROM c)"
    # the first place of each, in order, as array_except keeps it
    sql += ", e AS (SELECT doc_id, lead, list_filter(more, lambda x, i: NOT list_contains(lead, x) AND list_position(more, x) = i) AS more FROM d)"
    marked = "array_to_string(list_transform({}, lambda i: ',' || i || ','), '')"
    sql += f", f AS (SELECT doc_id, lead || more AS ids, list_reduce(list_prepend({{'run': {marked.format('lead')} || ';' || {marked.format('more')}, 'name': ''}}, {run_list}), lambda acc, r: {{'run': replace(acc.run, r.run, ';'), 'name': CASE WHEN contains(acc.run, r.run) AND NOT contains('|' || acc.name || '|', '|' || r.name || '|') THEN acc.name || CASE WHEN acc.name = '' THEN '' ELSE '|' END || r.name ELSE acc.name END}}).name AS licenses FROM e)"
    return sql + " SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_known, array_to_string(ids, ',') AS sentence_ids, licenses FROM f"

"""Licence scans by sentence rules.

A text is cut into sentences at full stops, question and exclamation marks, semicolons and blank
lines; comment signs at line starts are dropped. The stop of an abbreviation ("v. 2.0", "e.g.") or
of a list number at a line start ends no sentence. A normalised sentence (lower case, words only)
that is a known licence sentence gets its identifier, and so does one that says that a work is
licensed (released, ...) under a licence of a known name; any other one gets none. Known sentences may
run over lines or share a line's end with other words only behind a stop. The sequence of
identifiers is then read from left to right: at each place the first rule in order whose
identifiers follow one another, with at most ``GAP`` unknown sentences between, is recognised and
the reading goes on behind it.

Null and empty texts hold no licence. Repeated rows are scanned row by row. Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GAP = 2

# Sentences of published licences and notices, by identifier.
SENTENCES = {
    "ReleasedMit": "Released under the MIT License",
    "LicensedMit": "Licensed under the MIT License",
    "MitGrant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                "this software and associated documentation files (the \"Software\"), to deal in "
                "the Software without restriction, including without limitation the rights to "
                "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
                "the Software, and to permit persons to whom the Software is furnished to do so, "
                "subject to the following conditions: The above copyright notice and this "
                "permission notice shall be included in all copies or substantial portions of the "
                "Software",
    "MitPermission": "Permission is hereby granted, free of charge, to any person obtaining a copy "
                     "of this software and associated documentation files (the \"Software\"), to "
                     "deal in the Software without restriction, including without limitation the "
                     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
                     "sell copies of the Software, and to permit persons to whom the Software is "
                     "furnished to do so, subject to the following conditions:",
    "MitNotice": "The above copyright notice and this permission notice shall be included in all "
                 "copies or substantial portions of the Software",
    "AsIsUpper": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
                 "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
                 "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "IscGrant": "Permission to use, copy, modify, and/or distribute this software for any purpose "
                "with or without fee is hereby granted, provided that the above copyright notice "
                "and this permission notice appear in all copies",
    "LicensedApache2": "Licensed under the Apache License, Version 2.0",
    "LicensedApache2The": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "ApacheComply": "you may not use this file except in compliance with the License",
    "ApacheUnless": "Unless required by applicable law or agreed to in writing, software "
                    "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "WorkGpl3": "This work is licensed under the GNU General Public License, version 3",
    "WorkGpl2": "This work is licensed under the GNU General Public License, version 2",
    "FreeSoftware": "This program is free software",
    "Gpl2Plus": "you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation",
    "Either2": "either version 2 of the License, or (at your option) any later version",
    "Either3": "either version 3 of the License, or (at your option) any later version",
    "LgplTerms": "you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation",
    "Either21": "either version 2.1 of the License, or (at your option) any later version",
    "AgplTerms": "you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation",
    "Mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BsdRedistribute": "Redistribution and use in source and binary forms, with or without "
                       "modification, are permitted provided that the following conditions are "
                       "met: Redistributions of source code must retain the above copyright "
                       "notice, this list of conditions and the following disclaimer",
    "BsdConditions": "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met:",
    "BsdSource": "Redistributions of source code must retain the above copyright notice, this list "
                 "of conditions and the following disclaimer",
    "BsdBinary": "Redistributions in binary form must reproduce the above copyright notice, this "
                 "list of conditions and the following disclaimer in the documentation and/or "
                 "other materials provided with the distribution",
    "BsdNames": "Neither the name of the copyright holder nor the names of its contributors may "
                "be used to endorse or promote products derived from this software without "
                "specific prior written permission",
    "UseBsd": "Use of this source code is governed by a BSD-style license that can be found in "
              "the LICENSE file",
    "CcBy4": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CcBySa4": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
               "International License",
    "CcBy3": "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    "Cc0": "To the extent possible under law, the author has waived all copyright and related or "
           "neighboring rights to this work",
    "Cc0Dedicated": "To the extent possible under law, the author(s) have dedicated all copyright "
                    "and related and neighboring rights to this software to the public domain "
                    "worldwide",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "PublicDomain": "This work is in the public domain",
    "Epl2": "This program and the accompanying materials are made available under the terms of "
            "the Eclipse Public License 2.0",
    "Epl2At": "This program and the accompanying materials are made available under the terms of "
              "the Eclipse Public License 2.0 which is available at "
              "https://www.eclipse.org/legal/epl-2.0/",
    "Epl2AtHttp": "This program and the accompanying materials are made available under the terms "
                  "of the Eclipse Public License 2.0 which is available at "
                  "http://www.eclipse.org/legal/epl-2.0",
    "Boost": "Distributed under the Boost Software License, Version 1.0",
    "AllRights": "All rights reserved",
}

# Ordered rules, a licence and the identifiers that follow one another.
RULES = [
    ("MIT", ["MitGrant", "AsIsUpper"]),
    ("MIT", ["MitGrant"]),
    ("MIT", ["MitPermission", "MitNotice", "AsIsUpper"]),
    ("MIT", ["MitPermission", "MitNotice"]),
    ("MIT", ["ReleasedMit"]),
    ("MIT", ["LicensedMit"]),
    ("ISC", ["IscGrant"]),
    ("Apache-2.0", ["LicensedApache2The", "ApacheComply", "ApacheUnless"]),
    ("Apache-2.0", ["LicensedApache2The", "ApacheComply"]),
    ("Apache-2.0", ["LicensedApache2The"]),
    ("Apache-2.0", ["LicensedApache2"]),
    ("GPL-3.0-or-later", ["FreeSoftware", "Gpl2Plus", "Either3"]),
    ("GPL-2.0-or-later", ["FreeSoftware", "Gpl2Plus", "Either2"]),
    ("LGPL-2.1-or-later", ["FreeSoftware", "LgplTerms", "Either21"]),
    ("LGPL-3.0-or-later", ["FreeSoftware", "LgplTerms", "Either3"]),
    ("AGPL-3.0-or-later", ["FreeSoftware", "AgplTerms", "Either3"]),
    ("GPL-3.0", ["WorkGpl3"]),
    ("GPL-2.0", ["WorkGpl2"]),
    ("MPL-2.0", ["Mpl2"]),
    ("BSD-3-Clause", ["BsdRedistribute", "BsdBinary", "BsdNames"]),
    ("BSD-3-Clause", ["BsdConditions", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD-2-Clause", ["BsdRedistribute", "BsdBinary"]),
    ("BSD-2-Clause", ["BsdConditions", "BsdSource", "BsdBinary"]),
    ("BSD", ["UseBsd"]),
    ("CC-BY-SA-4.0", ["CcBySa4"]),
    ("CC-BY-4.0", ["CcBy4"]),
    ("CC-BY-3.0", ["CcBy3"]),
    ("CC0-1.0", ["Cc0"]),
    ("CC0-1.0", ["Cc0Dedicated"]),
    ("Unlicense", ["Unlicense"]),
    ("Public-Domain", ["PublicDomain"]),
    ("EPL-2.0", ["Epl2"]),
    ("EPL-2.0", ["Epl2At"]),
    ("EPL-2.0", ["Epl2AtHttp"]),
    ("BSL-1.0", ["Boost"]),
    ("All-Rights-Reserved", ["AllRights"]),
]

# The notices of the GNU licences join their parts by a colon and a comma or by semicolons.
SENTENCES["FreeLibrary"] = "This library is free software"
for _terms, _either, _licence in (("Gpl2Plus", "Either3", "GPL-3.0-or-later"),
                                  ("Gpl2Plus", "Either2", "GPL-2.0-or-later"),
                                  ("LgplTerms", "Either21", "LGPL-2.1-or-later"),
                                  ("LgplTerms", "Either3", "LGPL-3.0-or-later"),
                                  ("AgplTerms", "Either3", "AGPL-3.0-or-later")):
    for _free in ("FreeSoftware", "FreeLibrary"):
        _parts = [_free, _terms, _either]
        for _cut in ([1, 1, 1], [1, 2], [2, 1], [3]):
            _at, _names = 0, []
            for _n in _cut:
                _names.append("+".join(_parts[_at:_at + _n]))
                SENTENCES[_names[-1]] = " ".join(SENTENCES[k] for k in _parts[_at:_at + _n])
                _at += _n
            if (_licence, _names) not in RULES:
                RULES.append((_licence, _names))

# Short forms of the Creative Commons licences, each version that was published.
for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _name = f"ShortCc {_kind} {_version}"
        SENTENCES[_name] = f"Licensed under CC {_kind} {_version}"
        SENTENCES[f"Work{_name}"] = f"This work is licensed under CC {_kind} {_version}"
        RULES += [(f"CC-{_kind}-{_version}", [_name]), (f"CC-{_kind}-{_version}", [f"Work{_name}"])]

# Identifiers of the licences that are looked for, and what notices call them.
NAMES = {
    "MIT": ["MIT"], "ISC": ["ISC"], "Zlib": ["zlib"], "0BSD": ["0BSD", "Zero-Clause BSD"],
    "Apache-2.0": ["Apache 2.0", "Apache 2", "Apache-2.0", "Apache License 2.0",
                   "Apache License, Version 2.0", "Apache Software License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause", "BSD-2-Clause", "2-Clause BSD", "Simplified BSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "BSD-3-Clause", "3-Clause BSD", "New BSD", "Modified BSD"],
    "MPL-2.0": ["MPL 2.0", "MPL-2.0", "Mozilla Public License 2.0",
                "Mozilla Public License, version 2.0"],
    "EPL-2.0": ["EPL 2.0", "EPL-2.0", "Eclipse Public License 2.0"],
    "BSL-1.0": ["Boost Software", "BSL-1.0", "Boost Software License 1.0"],
    "Unlicense": ["Unlicense"], "CC0-1.0": ["CC0", "CC0 1.0", "CC0-1.0"],
}
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License",
        "AGPL": "GNU Affero General Public License"}
for _short, _versions in (("GPL", ("2.0", "3.0")), ("LGPL", ("2.1", "3.0")), ("AGPL", ("3.0",))):
    for _version in _versions:
        _number, _long = _version.removesuffix(".0"), _GNU[_short]
        NAMES[f"{_short}-{_version}"] = [
            name for v in dict.fromkeys((_version, _number)) for name in (
                f"{_short}v{v}", f"{_short} v{v}", f"{_short} {v}", f"{_short}-{v}",
                f"GNU {_short}v{v}", f"GNU {_short} v{v}", f"GNU {_short} version {v}",
                f"{_long} v{v}", f"{_long} version {v}", f"{_long}, version {v}")]


def _add(licence: str, text: str, *others: str) -> None:
    """A rule for one sentence, or for sentences in a row."""
    names = []
    for sentence in (text, *others):
        names.append(f"{licence}: {sentence}")
        SENTENCES[names[-1]] = sentence
    RULES.append((licence, names))


# Identifiers behind SPDX's tag, with the GNU licences' own endings.
for _licence in (*NAMES, *(f"CC-{_kind}-{_version}" for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND",
                                                                 "BY-NC-SA", "BY-NC-ND")
                          for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"))):
    _add(_licence, f"SPDX-License-Identifier: {_licence}")
    if _licence.split("-")[0] in _GNU:
        for _end in ("only", "or-later"):
            _add(f"{_licence}-{_end}" if _end == "or-later" else _licence,
                 f"SPDX-License-Identifier: {_licence}-{_end}")
        _add(f"{_licence}-or-later", f"SPDX-License-Identifier: {_licence}+")

# Long forms of the Creative Commons licences.
for _kind, _words in (("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"),
                      ("BY-ND", "-NoDerivatives"), ("BY-ND", "-NoDerivs"),
                      ("BY-NC-SA", "-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "-NonCommercial-NoDerivatives"),
                      ("BY-NC-ND", "-NonCommercial-NoDerivs")):
    for _version, _place in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"),
                             ("2.0", "Generic"), ("1.0", "Generic")):
        for _the in ("a ", "the "):
            for _where in (f" {_place}", ""):
                _add(f"CC-{_kind}-{_version}", f"This work is licensed under {_the}Creative "
                     f"Commons Attribution{_words} {_version}{_where} License")

# The headings that the full texts begin with.
for _licence, *_heading in (
        ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"),
        ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE", "Version 2, June 1991"),
        ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"),
        ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE", "Version 2.1, February 1999"),
        ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE", "Version 3, 19 November 2007"),
        ("Apache-2.0", "Apache License", "Version 2.0, January 2004"),
        ("MPL-2.0", "Mozilla Public License Version 2.0"),
        ("EPL-2.0", "Eclipse Public License - v 2.0"),
        ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003")):
    _add(_licence, *_heading)
    if len(_heading) > 1:
        _add(_licence, " ".join(_heading))

# A notice with its tag behind it is one licence.
RULES = [rule for licence, names in RULES for rule in (
    [(licence, [*names, f"{licence}: SPDX-License-Identifier: {licence}"])]
    if f"{licence}: SPDX-License-Identifier: {licence}" in SENTENCES
    and not names[0].startswith(f"{licence}: SPDX") else []) + [(licence, names)]]

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
# "This project is licensed under the terms of the MIT license", "Released under GPLv3"
_NOTICE = re.compile(r"(?:(?:this|the) (?:[\w-]+ ){1,3}is )?(?:licensed|released|distributed|"
                     r"available) under (?:the terms of )?(?:the |an? )?(.+?)(?: licen[sc]e)?")
_SIGNS = re.compile(r"^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--)?[ \t]*"
                    r"(?:\((?:\d{1,2}|[a-z])\)[ \t]+|(?:\d{1,2}|[a-z])\)[ \t]+)?", re.M)
_NUMBER = re.compile(r"[ \t]*(?:\d{1,2}|[a-z])", re.I)
_NUMBERED = "|".join(rf"(?<=\b{a}\.)" for a in ("v", "ver", "vers", "no", "nr", "sec", "art"))
_STOP = re.compile(  # abbreviations before a number, and those that end no sentence, do not stop
    rf"[.?!;](?=\s|$)(?!(?:{_NUMBERED})\s+\d)(?<!\be\.g\.)(?<!\bi\.e\.)(?<!\bcf\.)(?<!\bvs\.)"
    r"|\n[ \t]*(?=\n)|\n", re.I)


def normalised(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


class Scanner:
    """Finds licences in a text with the given sentences, rules and names for notices."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, list[str]]],
                 names: dict[str, list[str]] | None = None):
        self.known = {normalised(text): name for name, text in sentences.items()}
        self.longest = max(map(len, self.known), default=0)
        self.first = {text.split(" ", 1)[0] for text in self.known}
        self.rules: dict[str, list] = {}
        for licence, ids in rules:
            self.rules.setdefault(ids[0], []).append((licence, ids))
        self.named = {}
        for licence, own in (names or {}).items():
            self.named |= {normalised(name): f"Under {licence}" for name in own}
            self.rules[f"Under {licence}"] = [(licence, [f"Under {licence}"])]
        if names:
            self.first |= {"this", "the", "licensed", "released", "distributed", "available"}

    def identifier(self, words: str) -> str | None:
        """Of a known sentence, or of a notice that names a known licence."""
        found = self.known.get(words)
        if found is None and self.named and " under " in words:
            notice = _NOTICE.fullmatch(words)
            if notice:
                name = notice[1]
                found = self.named.get(name) or self.named.get(
                    name.replace(" license", "").replace(" licence", ""))
        return found

    def identifiers(self, text: str) -> list[tuple[int, str]]:
        """(number of the sentence, identifier) of the known sentences in order.

        A line break is a stop only if the sentence it would end, or the one that would begin
        behind it, is known: pieces are joined over line breaks as long as that gives, or may
        still give, a known sentence. A number and a full stop at a line start are passed over
        where they begin a list item; they end a sentence only if that makes it a known one.
        """
        pieces = []  # (words, ends at a stop)
        numbers = set()  # pieces that may be a list number
        at, fresh = 0, True  # fresh: at a line start
        clean = _SIGNS.sub("", text)
        for match in _STOP.finditer(clean):
            words = normalised(clean[at:match.start()])
            hard = clean[match.start()] != "\n" or match.group() != "\n"
            if words or hard:
                if fresh and match.group() == "." and _NUMBER.fullmatch(clean, at, match.start()):
                    numbers.add(len(pieces))
                pieces.append((words, hard))
            at, fresh = match.end(), match.group()[0] == "\n"
        pieces.append((normalised(clean[at:]), True))
        out, i, number = [], 0, 0
        while i < len(pieces):
            if i in numbers:
                i += 1
                continue
            joined, hard = pieces[i]
            end, found = i, self.identifier(joined)
            if joined.split(" ", 1)[0] in self.first:
                j = i
                while not hard and j + 1 < len(pieces) and len(joined) < self.longest:
                    j += 1
                    joined = f"{joined} {pieces[j][0]}".strip()
                    hard = pieces[j][1]
                    name = self.identifier(joined)
                    if name:
                        end, found = j, name
            if found:
                out.append((number, found))
            i, number = end + 1, number + 1
        return out

    def licences(self, text: str) -> list[tuple[str, int]]:
        """(licence, number of its first sentence), in order."""
        found, out, i = self.identifiers(text), [], 0
        while i < len(found):
            for licence, names in self.rules.get(found[i][1], []):
                run = found[i:i + len(names)]
                if [name for _, name in run] == names and all(
                        b - a <= GAP + 1 for (a, _), (b, _) in zip(run, run[1:], strict=False)):
                    out.append((licence, found[i][0]))
                    i += len(names)
                    break
            else:
                i += 1
        return out


def scanned(text: Column, sentences: dict[str, str] | None = None,
            rules: list[tuple[str, list[str]]] | None = None,
            names: dict[str, list[str]] | None = None) -> Column:
    """array<struct(licence, sentence)> of the licences in each text, in order."""
    own = {"sentences": sentences, "rules": rules, "names": names}  # tables of the caller
    if sentences is None:
        own = {"sentences": SENTENCES, "rules": RULES, "names": NAMES}
    shared = SparkSession.active().sparkContext.broadcast(own)
    item = pa.list_(pa.struct([("licence", pa.string()), ("sentence", pa.int32())]))

    @F.arrow_udf("array<struct<licence:string,sentence:int>>")
    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = shared.value
        if "scanner" not in kept:
            kept["scanner"] = Scanner(kept["sentences"], kept["rules"], kept["names"])
        for part in parts:
            yield pa.array([[{"licence": a, "sentence": b} for a, b in
                             kept["scanner"].licences(v.as_py() or "")] for v in part], item)

    return scan(text)


def found(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, licence, first_sentence, times): a row for each licence of a document row.

    Sentences are numbered from 0. Documents without a licence have no row.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), scanned(F.col(text)).alias("hits"))
    names = F.array_distinct(F.col("hits.licence"))
    rows = rows.select("doc_id", "hits", F.explode(names).alias("licence"))
    own = F.filter("hits", lambda h: h["licence"] == F.col("licence"))
    return rows.select("doc_id", "licence", own[0]["sentence"].alias("first_sentence"),
                       F.size(own).alias("times"))

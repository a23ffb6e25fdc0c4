"""Language, quality and toxicity models, decontamination and licence scans."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayprints.llm import decontaminate, langid, licences, quality, toxicity
from tests.llm.conftest import EDGE

SYLLABLES = {"xx": "ka lo mi ra te ", "yy": "ßu ör zat gren pfl ", "zz": "да не по мо ", }


def speech(rnd, lang, words=40):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4)))
                    for _ in range(words)).capitalize() + "."


def corpus(spark, n=240):
    rnd = random.Random(5)
    rows = [(i, speech(rnd, lang), lang) for i in range(n) for lang in [rnd.choice("xyz") * 2]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def judged(df, model, train):
    """df with its language, the limits being those of the training rows."""
    limits = langid.limits(langid.scored(train, model))
    return langid.judged(langid.scored(df, model), limits)


def brute_entropy(texts, text):
    """Interpolated Kneser-Ney over dictionaries, as the module defines it."""
    from collections import Counter

    def grams(t):
        kept = []
        for c in t.lower():
            if c.isalpha():
                kept.append(c)
            elif kept and kept[-1] != " ":
                kept.append(" ")
        if kept and kept[-1] != " ":
            kept.append(" ")
        s = "   " + "".join(kept)
        return [s[i - 3:i + 1] for i in range(3, len(s))]

    counts = {4: Counter(g for t in texts for g in grams(t))}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    d, total, kinds = {}, {}, {}
    for n, c in counts.items():
        once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
        d[n] = max(0.1, once / (once + 2 * twice) if once + 2 * twice else 0.5)
        total[n], kinds[n] = Counter(), Counter()
        for g, v in c.items():
            total[n][g[:-1]] += v
            kinds[n][g[:-1]] += 1

    def p(g):
        n = len(g)
        if not n:
            return 1 / langid.ALPHABET
        if not total[n][g[:-1]]:
            return p(g[1:])
        return (max(counts[n][g] - d[n], 0) + d[n] * kinds[n][g[:-1]] * p(g[1:])) / total[n][g[:-1]]

    found = grams(text)
    return -sum(np.log(p(g)) for g in found) / len(found)


def test_language_models_are_kneser_ney(spark):
    train = corpus(spark)
    model = langid.train(train)
    rnd = random.Random(9)
    tests = [(i, speech(rnd, lang), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 4)]
    df = spark.createDataFrame(tests, "doc_id long, text string, lang string")
    rows = judged(df, model, train).select("text", "lang", "language.*").collect()
    own = {lang: [r["text"] for r in train.where(F.col("lang") == lang).collect()]
           for lang in SYLLABLES}
    for row in rows:
        assert row["lang_pred"] == row["lang"] and row["accepted"] and 0.5 < row["score"] <= 1
        assert abs(row["entropy"] - brute_entropy(own[row["lang"]], row["text"])) < 1e-4


def test_language_edge_cases(spark, docs, monkeypatch):
    train = corpus(spark).unionByName(spark.createDataFrame(
        [(900, None, "xx"), (901, "kalo", None), (902, "", "ww")], "doc_id long, text string, lang string"))
    model = langid.train(train)
    assert model.languages == ["xx", "yy", "zz"]  # a language without letters has no grams
    df = docs([*EDGE, (7, "12 !? 34"), (8, "ξενος λογος και αλλα " * 5), (10, "KA-lo5MI rate kalo")])
    whole = {r["text"]: r["language"] for r in judged(df, model, train).collect()}
    for nothing in (None, "", "  \n\t ", "12 !? 34"):
        assert whole[nothing]["lang_pred"] == "und" and whole[nothing]["score"] == 0
        assert not whole[nothing]["accepted"]
    assert not whole["ξενος λογος και αλλα " * 5]["accepted"]  # a language that was not learnt
    assert whole["KA-lo5MI rate kalo"]["lang_pred"] == "xx"
    monkeypatch.setattr(langid, "BLOCK", 7)  # the same in small blocks and language by language
    monkeypatch.setattr(langid, "LANGUAGES_A_PASS", 1)
    model = langid.train(train)
    assert len(model.blocks) == 3
    split = {r["text"]: r["language"] for r in langid.scored(
        df.where("length(text) < 1000 or text is null"), model).collect()}
    for text, s in split.items():
        assert s["lang_pred"] == whole[text]["lang_pred"] and s["n_chars"] == whole[text]["n_chars"]
        assert s["entropy"] is None or abs(s["entropy"] - whole[text]["entropy"]) < 1e-5
    none = judged(docs(EDGE), langid.train(train.limit(0)), train)
    assert {r["language"]["lang_pred"] for r in none.collect()} == {"und"}
    nothing = langid.identified(docs(EDGE).limit(0).withColumn("lang", F.lit("xx")), model)
    assert nothing.collect() == []
    twice = docs([(1, "kalo mirate"), (1, "kalo mirate"), (None, "kalo mirate")]).withColumns(
        {"lang": F.lit("xx"), "language": F.lit("clash"), "name": F.lit(1), "row": F.lit(2)})
    rows = langid.identified(twice, model).collect()
    assert [r["language"]["lang_pred"] for r in rows] == ["xx"] * 3
    assert {(r["name"], r["row"]) for r in rows} == {(1, 2)}


def test_letters_of_all_scripts_stay_apart(spark):
    letters = langid.Letters()
    texts = ["ab", "聎聏", "耍", "한국", "\U00020000\U00020001", "\U0001d4d0", "ǅ", " "]
    units = [np.concatenate(list(letters.blocks(t)) or [np.empty(0, np.uint64)]).tolist()
             for t in texts]
    assert len({tuple(u) for u in units}) == len(texts)
    wide = np.concatenate(list(letters.blocks(texts[4])))
    assert wide[3:-4].astype("<u2").tobytes().decode("utf-16-le") == texts[4]
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice("聎聏耍耎") for _ in range(60)), "han") for i in range(30)]
    rows += [(i, "".join(rnd.choice("ab") for _ in range(60)), "ab") for i in range(30)]
    rows += [(i, "".join(rnd.choice("\U00020000\U00020001\U00020002") for _ in range(60)), "wide")
             for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identified(df, langid.train(df)).collect()
    assert all(r["language"]["lang_pred"] == r["lang"] and r["language"]["accepted"] for r in got)


def test_quality_rules(spark, docs):
    rnd = random.Random(2)
    rows, marks = [], []
    for i in range(300):
        good = i % 3 > 0
        text = speech(rnd, "xx") if good else " | ".join(speech(rnd, "xx", 20).split())
        rows.append((i, text))
        marks.append((i, int(good), 0))
    labels = spark.createDataFrame([*marks, (301, None, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(docs(rows), labels, keep=F.col("doc_id") % 5 != 0)
    assert model["rules"] and all(len(rule) <= quality.DEPTH * 2 for rule, _ in model["rules"])
    got = quality.scored(docs(rows), model).where("doc_id % 5 = 0").collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in got)
    edge = quality.scored(docs(EDGE), model).collect()
    assert len(edge) == len(EDGE) and all(0 <= r["score"] <= 1 for r in edge)
    assert quality.scored(docs([]), model).collect() == []
    unlabelled = quality.train(docs(rows), labels.limit(0))
    assert {r["score"] for r in quality.scored(docs(EDGE), unlabelled).collect()} == {0.5}


def test_paths_of_a_tree():
    tree = """DecisionTree
  If (feature 0 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 1.0
   Else (feature 1 > 2.0)
    Predict: 0.0
  Else (feature 0 > 0.5)
   If (feature 0 <= 0.75)
    Predict: 0.0
   Else (feature 0 > 0.75)
    Predict: 1.0"""
    assert quality.paths(tree) == [
        ((0, "<=", 0.5),), ((0, "<=", 0.5), (1, "<=", 2.0)), ((0, "<=", 0.5), (1, ">", 2.0)),
        ((0, ">", 0.5),), ((0, "<=", 0.75), (0, ">", 0.5)), ((0, ">", 0.75),)]


def test_severity_grades(spark, docs):
    rnd = random.Random(4)
    rows, marks = [], []
    for i in range(400):
        text, bad = speech(rnd, "xx"), i % 4 == 0
        if bad:
            text += " grubl" + rnd.choice(["an", "ek", "ost"]) * (1 + i % 3)
        rows.append((i, text + (" vrakk" if bad and i % 8 == 0 else "")))
        marks.append((i, 1, int(bad)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.from_labels(docs(rows), labels, keep=F.col("doc_id") % 5 != 0)
    assert len(model["thresholds"]) == 2 and model["thresholds"][0] < model["thresholds"][1]
    got = toxicity.graded(docs(rows), model).collect()
    assert all((r["p_toxic"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got)
    assert all(0 <= r["severity"] <= 2 for r in got)
    unseen = toxicity.graded(docs([(1, "kalo grublwort mira"), (2, "kalo mira")]), model).collect()
    assert unseen[0]["severity"] > unseen[1]["severity"]
    edge = toxicity.graded(docs(EDGE), model).collect()
    assert len(edge) == len(EDGE) and all(r["p_toxic"] < 0.5 for r in edge)
    nothing = toxicity.from_labels(docs(rows), labels.limit(0))
    assert {r["severity"] for r in toxicity.graded(docs(EDGE), nothing).collect()} == {0.0}


def test_ordinal_fit_orders_grades_with_shared_weights():
    rows = [np.array([0])] * 40 + [np.array([1])] * 40 + [np.array([2])] * 40
    grade = np.repeat([0, 1, 2], 40)
    w, theta = toxicity.fit(rows, grade, np.ones(120), 3)
    assert w[0] < theta[0] < w[1] < theta[1] < w[2]


def smith_waterman(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if x == y else -1), table[i - 1, j] - 1,
                              table[i, j - 1] - 1)
    return int(table.max())


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(1, 25)) for _ in range(2))
        assert decontaminate.align(a, b)[0] == smith_waterman(a, b)


def test_copies_and_edited_copies_of_items(spark, docs, monkeypatch):
    rnd = random.Random(8)
    items = [(i, speech(rnd, rnd.choice(["xx", "yy"]), 30)) for i in range(12)]
    items.append((50, "too short"))
    benchmark = spark.createDataFrame([*items, (51, None)], "item_id long, text string")
    rows, want = [], set()
    for i in range(120):
        text = speech(rnd, "xx", 80)
        if i % 4 == 0:
            item, passage = items[rnd.randrange(12)]
            words = passage.split()
            if i % 8 == 0:  # an edited copy: a sixth of the words changed, added or removed
                for _ in range(5):
                    at = rnd.randrange(len(words))
                    words[at:at + 1] = rnd.choice([["new"], [], [words[at], "more"]])
            text += " " + " ".join(words).upper() + "! " + speech(rnd, "xx", 50)
            want.add((i, item))
        rows.append((i, text))
    found = decontaminate.contaminated(docs(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert all(abs(r["score"] - 1) < 1e-9 for r in found if r["doc_id"] % 8 == 4)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 400)  # several blocks, the same result
    again = decontaminate.contaminated(docs(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in again} == want
    kept = decontaminate.clean(docs(rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {d for d, _ in want}
    assert kept.columns == docs(rows).columns
    assert decontaminate.contaminated(docs(EDGE), benchmark).collect() == []
    assert decontaminate.contaminated(docs([]), benchmark).collect() == []
    assert decontaminate.clean(docs(EDGE), benchmark.limit(0)).count() == len(EDGE)


def test_licences(docs):
    mit = " * " + licences.SENTENCES["MitGrant"].replace(" this ", "\n * this ") + ".\n *\n * " \
        + licences.SENTENCES["AsIsUpper"] + "."
    rows = [(1, "Words before.\nReleased under the MIT License.\nAll rights reserved.\nmore"),
            (2, "no stop before\nLicensed under the Apache License, Version 2.0.\nAll\nrights reserved"),
            (3, mit), (4, "all RIGHTS   reserved; x. All rights reserved."),
            (5, "It says released under the MIT License, maybe."), (6, "This program is free software.")]
    got = {}
    for r in licences.found(docs([*rows, *EDGE])).collect():
        got.setdefault(r["doc_id"], {})[r["licence"]] = (r["first_sentence"], r["times"])
    assert got == {1: {"MIT": (1, 1), "All-Rights-Reserved": (2, 1)},
                   2: {"Apache-2.0": (1, 1), "All-Rights-Reserved": (2, 1)},
                   3: {"MIT": (0, 1)}, 4: {"All-Rights-Reserved": (0, 2)}}
    assert licences.found(docs([])).collect() == []


def test_rules_stand_in_order_and_bridge_small_gaps():
    scanner = licences.Scanner({"A": "a a", "B": "b b", "C": "c c"},
                               [("long", ["A", "B", "C"]), ("short", ["A", "B"]), ("one", ["B"])])
    assert scanner.licences("A a. x. B b. C c.") == [("long", 0)]
    assert scanner.licences("A a. B b. x. x. x. C c. B b.") == [("short", 0), ("one", 6)]
    assert scanner.licences("C c. A a.") == []


LICENCE_WORDS = (r"(?i)licen[sc]ed? |rights reserved|public domain|creative commons|\bcc[ -]by|"
                 r"\bgpl\b|redistribut")
UNKNOWN_NOTICES: set = set()  # sentences of the given documents that no rule names


def test_every_notice_of_the_documents_is_known(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = docs.select(F.explode(F.split("text", r"\n|(?<=[.?!;])\s")).alias("line"))
    notices = {r["line"].strip() for r in
               lines.where(F.col("line").rlike(LICENCE_WORDS)).distinct().collect()}
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES, licences.NAMES)
    assert "Licensed under CC BY-NC 4.0." in notices
    assert {n for n in notices if not scanner.licences(n)} == UNKNOWN_NOTICES


def test_short_creative_commons_notices():
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES, licences.NAMES)
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        assert scanner.licences(f"Words. Licensed under CC {kind} 4.0.\nMore.") == [
            (f"CC-{kind}-4.0", 1)]
    assert scanner.licences("Licensed under CC BY-NC 3.0.") == [("CC-BY-NC-3.0", 0)]
    assert scanner.licences("Licensed under CC BY-XX 4.0.") == []


GNU = """This {what} is free software{a} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{b} either version {v} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.
"""
BSD = """Copyright (c) 2020, Somebody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{a} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{gap}{b} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS".
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
PUBLISHED = [
    *[(name, GNU.format(what=what, kind=kind, v=v, a=a, b=b)) for name, what, kind, v, a, b in (
        ("GPL-3.0-or-later", "program", "", "3", ":", ","),
        ("GPL-2.0-or-later", "program", "", "2", ";", ";"),
        ("GPL-2.0-or-later", "program", "", "2", ":", ","),
        ("LGPL-2.1-or-later", "library", "Lesser ", "2.1", ";", ";"),
        ("LGPL-3.0-or-later", "program", "Lesser ", "3", ":", ","),
        ("LGPL-3.0-or-later", "library", "Lesser ", "3", ":", ";"),
        ("AGPL-3.0-or-later", "program", "Affero ", "3", ":", ","))],
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\n"
                "License, v. 2.0. If a copy of the MPL was not distributed with this\n"
                "file, You can obtain one at https://mozilla.org/MPL/2.0/.\n"),
    *[(name, BSD.format(a=a, b=b, gap=gap, third=third)) for a, b in (
        ("1.", "2."), ("(1)", "(2)"), ("a)", "b)"), ("*", "*"), ("-", "-")) for gap in ("", "\n")
      for name, third in (("BSD-2-Clause", ""), ("BSD-3-Clause", BSD_THIRD))],
    ("MIT", """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE.
"""),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\n"
            "purpose with or without fee is hereby granted, provided that the above\n"
            "copyright notice and this permission notice appear in all copies.\n\n"
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES."),
    ("Apache-2.0", """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""),
    ("EPL-2.0", "This program and the accompanying materials are made available under the\n"
                "terms of the Eclipse Public License 2.0 which is available at\n"
                "http://www.eclipse.org/legal/epl-2.0.\n\nSPDX-License-Identifier: EPL-2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made\n"
                "available under the terms of the Eclipse Public License 2.0\n"
                "which is available at https://www.eclipse.org/legal/epl-2.0/\n\n"
                "SPDX-License-Identifier: EPL-2.0"),
    ("BSL-1.0", "         Copyright Joe Coder 2004 - 2006.\n"
                "Distributed under the Boost Software License, Version 1.0.\n"
                "   (See accompanying file LICENSE_1_0.txt or copy at\n"
                "         https://www.boost.org/LICENSE_1_0.txt)"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright\n"
                "and related and neighboring rights to this software to the public domain\n"
                "worldwide. This software is distributed without any warranty."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\n"
                  "Anyone is free to copy, modify, publish this software."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License. To view a copy of this license, visit a page."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
]


def test_published_notices_are_found():
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES, licences.NAMES)
    for name, text in PUBLISHED:
        for sign in ("", " * ", "# ", "// "):
            notice = "".join(f"{sign}{line}\n" for line in text.split("\n"))
            assert [n for n, _ in scanner.licences(notice)] == [name], (name, notice)
    known = {"GPL-3.0", "GPL-2.0", "BSD", "Public-Domain", "All-Rights-Reserved"}  # one sentence
    short = {n for n, _ in licences.RULES if n.startswith("CC-")}  # see the test of short forms
    one = {n for n, names in licences.RULES if ": " in names[0]}  # tags and headings: next test
    assert {n for n, _ in licences.RULES} == known | short | one | {n for n, _ in PUBLISHED}


@pytest.mark.parametrize("text, licence", [
    ("SPDX-License-Identifier: MIT", "MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-only\nint x;", "GPL-2.0"),
    ("# SPDX-License-Identifier: GPL-3.0+\n", "GPL-3.0-or-later"),
    ("This project is licensed under the MIT License.", "MIT"),
    ("Words. This library is released under the terms of the Apache License, Version 2.0.",
     "Apache-2.0"),
    ("Licensed under the GPLv3.", "GPL-3.0"),
    ("The source code is available under the 3-Clause BSD\nlicense; see the file.", "BSD-3-Clause"),
    ("This work is licensed under the Creative Commons Attribution 4.0 International License.",
     "CC-BY-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 "
     "Unported License.", "CC-BY-NC-SA-3.0"),
    ("          GNU GENERAL PUBLIC LICENSE\n             Version 3, 29 June 2007\n\n Copyright",
     "GPL-3.0"),
    ("    Apache License\n    Version 2.0, January 2004\n    http://www.apache.org/licenses/\n",
     "Apache-2.0"),
    ("GNU Lesser General Public License\nVersion 2.1, February 1999\n", "LGPL-2.1"),
])
def test_tags_notices_and_headings(text, licence):
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES, licences.NAMES)
    assert [n for n, _ in scanner.licences(text)] == [licence]


@pytest.mark.parametrize("text", [
    "It is sold under the Apache trail.", "The house is available under the terms of the sale.",
    "This road is licensed under no rule.", "We spoke of the MIT license."])
def test_words_about_licences_are_no_notice(text):
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES, licences.NAMES)
    assert scanner.licences(text) == []


def test_abbreviations_and_list_numbers_end_no_sentence():
    scanner = licences.Scanner({"A": "see part v. 2 of a", "B": "b version 3", "C": "c c"},
                               [("a", ["A"]), ("b", ["B"]), ("c", ["C"])])
    assert scanner.licences("Words. See part v. 2 of a. 1. C c.") == [("a", 1), ("c", 3)]
    assert scanner.licences("B version\n3. C c.") == [("b", 0), ("c", 1)]  # a line break, no list
    assert scanner.licences("Words.\n1. C c.\n12. C c.") == [("c", 1), ("c", 2)]
    assert scanner.licences("Some Inc. C c. I said no. C c.") == [("c", 1), ("c", 3)]


def test_repeated_edited_copies_are_found_however_many(spark, docs):
    item = [f"w{i}" for i in range(20)]
    edited = ["new" if i in (5, 10, 15) else w for i, w in enumerate(item)]
    half, other = " ".join(item[:11]), " ".join(item[9:])
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for copies in (3, 5, 1000):
        for passage in (" ".join(edited), half):
            rows = [(i, f"before {passage} after it") for i in range(copies)]
            found = decontaminate.contaminated(docs([*rows, (-1, other)]), benchmark).collect()
            assert {r["doc_id"] for r in found} == {-1, *range(copies)}
    far = " ".join(item[:4]) + " x" * 60 + " " + " ".join(edited)  # a rarer seed elsewhere
    found = decontaminate.contaminated(docs([(1, far), *((2, " ".join(edited)),) * 50]), benchmark)
    assert found.count() == 51


def test_seeds_in_many_parts_change_nothing(monkeypatch):
    rnd = random.Random(3)
    block = [(i, [rnd.choice("abcdef") for _ in range(rnd.randrange(4, 20))]) for i in range(30)]
    judge = decontaminate.Judge(decontaminate.Index(block))
    texts = [" ".join(rnd.choice("abcdefg") for _ in range(80)) for _ in range(20)]
    whole = [judge.found(t, 0.5) for t in texts]
    assert any(whole)
    monkeypatch.setattr(decontaminate, "PAIRS", 7)
    assert [judge.found(t, 0.5) for t in texts] == whole
    monkeypatch.setattr(judge, "_holds", lambda *_: True)  # counting words loses nothing
    monkeypatch.setattr(judge, "_likely", lambda *_: np.ones(len(block), bool))
    assert [judge.found(t, 0.5) for t in texts] == whole


def test_short_and_unspaced_items(spark, docs):
    chinese, japanese = "中华人民共和国的首都是北京市。", "日本の首都は、東京です。"
    items = [(1, "Too short"), (2, "one, two; three"), (3, "Zebra"), (4, chinese), (5, japanese),
             (6, "two three"), (6, "北京"), (7, " .?! "), (8, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    edited = "中华人民共和国首都是北平市"
    rows = [(1, "this is TOO\nshort, I say"), (2, "one two three"), (3, "zebras; a zebra"),
            (4, f"他说{chinese}对不对"), (5, f"x{japanese}y"), (6, "too very short two, one three"),
            (7, edited), (8, "short too"), (9, "two"), (10, "")]
    found = decontaminate.contaminated(docs([*rows, *EDGE[:1]]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {
        (1, 1), (2, 2), (2, 6), (3, 3), (4, 4), (4, 6), (5, 5), (7, 4)}
    ends = {(r["doc_id"], r["item_id"]): r["end_word"] for r in found}
    assert ends[1, 1] == 4 and ends[2, 2] == 3 and ends[3, 3] == 3 and ends[2, 6] == 3
    assert all(r["score"] == 1 for r in found if r["doc_id"] != 7)
    only = spark.createDataFrame(items[:3], "item_id long, text string")
    kept = decontaminate.clean(docs(rows), only).collect()
    assert {r["doc_id"] for r in kept} == {4, 5, 6, 7, 8, 9, 10}


def test_words_of_unspaced_scripts_are_characters():
    assert decontaminate.words("Über 東京 2024年, ไทย한국어 𠀀𠀁x_1") == [
        "über", "東", "京", "2024", "年", "ไ", "ท", "ย", "한국어", "𠀀", "𠀁", "x_1"]
    assert decontaminate.words("plain words’ end") == ["plain", "words", "end"]


def test_grams_are_looked_up_exactly():
    rnd = np.random.default_rng(4)
    keys = np.unique(rnd.integers(0, 1 << 60, 300_000, dtype=np.uint64))
    keys = langid.by_hash(keys)
    rows = langid.Rows(keys)
    assert (rows.of(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rnd.integers(0, 1 << 60, 300_000, dtype=np.uint64), keys)
    assert (rows.of(others) == rows.absent).all()
    many = rnd.integers(0, 1 << 60, 1_500_000, dtype=np.uint64)  # once, more than all slots
    arrays = {("gram", 4): (np.unique(many), np.zeros(len(np.unique(many)), np.float32)),
              ("context", 0): (np.zeros(1, np.uint64), np.zeros(1, np.float32))}
    scorer = langid.Scorer({"arrays": {"xx": arrays}, "part": 0, "parts": 1})
    n, sums = scorer.sums("unseen grams borrow nothing")
    assert abs(sums["xx"][0] / n - np.log(langid.ALPHABET)) < 1e-4


def test_languages_in_parts_score_the_same(spark, monkeypatch):
    train = corpus(spark)
    rnd = random.Random(4)
    texts = [speech(rnd, lang, 30) for lang in SYLLABLES] + ["", "12", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")

    def scored():
        rows = langid.scored(df, langid.train(train)).orderBy("text").collect()
        return [r["language"] for r in rows]

    whole = scored()
    monkeypatch.setattr(langid, "PASS_BYTES", 1500)
    assert max(parts for _, _, parts in langid.train(train).blocks) > 2
    for one, other in zip(whole, scored(), strict=True):
        assert one["lang_pred"] == other["lang_pred"] and one["n_chars"] == other["n_chars"]
        assert one["entropy"] is None or abs(one["entropy"] - other["entropy"]) < 1e-6


def test_labelled_noise_does_not_make_noise_acceptable(spark):
    rnd = random.Random(12)

    def noise():
        return " ".join("".join(rnd.choice("bcdfghjkpqsvwxy") for _ in range(rnd.randrange(3, 9)))
                        for _ in range(30))

    train = corpus(spark).unionByName(spark.createDataFrame(
        [(1000 + i, noise(), "xx") for i in range(2)]
        + [(2000 + i, "ελα να δω τι κανεις", "few") for i in range(2)],
        "doc_id long, text string, lang string"))
    model = langid.train(train)
    limits = langid.limits(langid.scored(train, model))
    assert set(limits) == {"xx", "yy", "zz", None} and all(len(v) == 4 for v in limits.values())
    tests = [(noise(), False) for _ in range(10)] + [(speech(rnd, "xx"), True) for _ in range(10)]
    tests += [("ψξφ θβγ ζχπ ωσρ " * 4, False)]  # falls to the language of few texts
    rows = judged(spark.createDataFrame(tests, "text string, good boolean"), model, train).collect()
    assert all(r["language"]["accepted"] == r["good"] for r in rows), rows


def edited(rnd, words, share):
    """A copy in which about this share of the words is another one."""
    if isinstance(share, int):  # every share-th word
        return [f"e{rnd.getrandbits(40)}" if (i + 1) % share == 0 else w
                for i, w in enumerate(words)]
    return [f"e{rnd.getrandbits(40)}" if rnd.random() < share else w for w in words]


def test_edited_copies_equal_aligning_everything(spark):
    rnd = random.Random(21)
    stock = [f"w{i}" for i in range(400)]
    items = [(i, [rnd.choice(stock) for _ in range(rnd.randrange(15, 45))]) for i in range(25)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items],
                                      "item_id long, text string")
    docs, kind = [], {}
    for share in (0.1, 0.2, 0.25, 0.35, 0.5, 4, 3):
        for i, words in items:
            doc_id = len(docs)
            kind[doc_id] = share, i
            around = [rnd.choice(stock) for _ in range(60)]
            docs.append((doc_id, " ".join(around[:30] + edited(rnd, words, share) + around[30:])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"]
           for r in decontaminate.contaminated(df, benchmark).collect()}
    number = {}
    ids = {d: np.array([number.setdefault(w, len(number) + 1) for w in t.split()], np.uint64)
           for d, t in docs}
    own = {i: np.array([number.setdefault(w, len(number) + 1) for w in words], np.uint64)
           for i, words in items}
    want = {}
    for d, passage in ids.items():
        for i, item in own.items():
            share = decontaminate.align(item, passage)[0] / (2 * len(item))
            if share >= decontaminate.THRESHOLD:
                want[d, i] = share
    assert set(got) <= set(want)
    recall = {}
    for share in (0.1, 0.2, 0.25, 0.35, 0.5, 4, 3):
        due = [k for k in want if kind[k[0]][0] == share]
        recall[share] = sum(k in got for k in due) / max(1, len(due)), len(due)
    print("recall by share of edits:", recall)
    assert all(recall[share][0] >= 0.95 and recall[share][1] for share in (0.1, 0.2, 0.25, 4))
    assert all(recall[share][0] >= 0.95 for share in (0.35, 3))
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)

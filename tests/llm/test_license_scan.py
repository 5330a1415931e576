import random
import re

from pyspark.sql import functions as F

from visitwise.llm import license_scan as ls
from visitwise.llm.queries import QUERIES


def brute(text):
    """The scan by plain regular expressions over the words, without prefilters."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    joined = " " + " ".join(words) + " " if words else " "
    found = []
    for r in ls.rules():
        for m in re.finditer(r["pattern"], joined):
            start = joined[:m.start()].count(" ")
            found.append((start, start + m[0].count(" "), r))
    left = [(s, e, r) for s, e, r in found
            if not any((s2 <= s and e <= e2) and r2["priority"] >= r["priority"]
                       and (s2, -e2, -r2["priority"], r2["rule"]) < (s, -e, -r["priority"], r["rule"])
                       for s2, e2, r2 in found)]
    base = [(s, r["label"]) for s, e, r in found if r["base"]]
    return (len(words), len(base), min((s for s, _ in base), default=None), max((s for s, _ in base), default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted({r["label"] for *_, r in left} | {x for _, x in base})),
            len(left))


def check(df, rows, id_col="id"):
    out = sorted((tuple(r) for r in df.select(id_col, "n_words", "n_base", "first_word", "last_word", "base_labels",
                                              "labels", "n_found").collect()), key=str)
    assert out == sorted(((i, *brute(t)) for i, t in rows), key=str)


TEXTS = [None, "", " .,;\n", "Released under the MIT License. Again: under the MIT license, under the mit license",
         "Licensed under the Apache License, Version 2.0.", "apache license version 2", "Licensed under CC BY-NC 4.0.",
         "cc by nc sa 4.0 and cc by nc", "under\x00the\x7fmit\x60license", "under the mit licenses", "é under the mit license É",
         "SPDX-License-Identifier: GPL-3.0-only\nThis work is licensed under the GNU General Public License, version 3.",
         "GNU Lesser General Public License v2.1 or the GNU Affero General Public License version 3",
         "BSD 3-Clause License", "Simplified BSD", "licensed under the terms of the BSD license", "mit mit license",
         "distributed under the same terms as Perl itself", "KK under the mİt license", "boost software license 1.0",
         "word " * 30_000 + "under the MIT license", "under the mit license " * 300]


def test_matches_a_plain_scan(spark, make):
    rng = random.Random(4)
    pieces = [t for t in TEXTS if t and len(t) < 200] + ["and", "or", "the", "license", "licensed under", "2 0"]
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.sample(pieces, rng.randint(1, 6)))) for i in range(150)]
    rows += [(None, "cc by nc"), (7, "cc by nc")]
    df = make(rows)
    for c in ("row", "id", "joined", "hits", "words", "start", "label"):
        df = df.withColumn(c, F.lit("x"))
    check(ls.license_scan(df), rows)
    scores = [r["score"] for r in ls.license_scan(df).collect()]
    assert min(scores) == 0 and max(scores) == 1
    assert ls.license_scan(df.where("false")).count() == 0


def test_every_rule_passes_its_prefilters():
    """What a rule matches holds its keyword and one of the anchors."""
    assert len(ls.rules()) > 200
    for r in ls.rules():
        # one sample of the pattern: groups resolved to their first choice, optional parts left out
        sample = r["pattern"].replace("(?= )", "")
        for _ in range(10):
            sample = re.sub(r"\(\?:([^()]*)\)\?", "", sample)
            sample = re.sub(r"\(\?:([^()|]*)\|?[^()]*\)", r"\1", sample)
        sample = re.sub(r"\[(.)[^]]*\]\??", r"\1", re.sub(r"(?<=\w| )\?", "", sample)) + " "
        assert re.search(r["pattern"], sample), (r, sample)
        assert r["keyword"] in sample and any(a in sample for a in ls.ANCHORS), (r, sample)


KNOWN = {  # openings of licence texts, notices, package fields and identifiers
    "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2-or-later",
    "SPDX-License-Identifier: GPL-2.0-only": "gpl-2",
    "# SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1",
    "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl-2.1-or-later",
    "SPDX-License-Identifier: MPL-2.0": "mpl-2",
    "SPDX-License-Identifier: EPL-2.0": "epl-2",
    "SPDX-License-Identifier: CDDL-1.0": "cddl-1.0",
    "SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2,mit",
    "SPDX-License-Identifier: AGPL-3.0-or-later": "agpl-3-or-later",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    '"license": "MIT",': "mit",
    "license = \"BSD-2-Clause\"": "bsd-2-clause",
    "License: GPLv2 or later": "gpl-2-or-later",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:": "bsd",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software": "bsd-3-clause",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.": "isc",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\"": "bsd-0-clause",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
    "version.": "gpl-2-or-later",
    "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version "
    "2.1 of the License, or (at your option) any later version": "lgpl-2.1-or-later",
    "You may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n"
    "    http://www.apache.org/licenses/LICENSE-2.0": "apache-2",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license": "boost-1",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.": "zlib",
    "The GNU General Public License is a free, copyleft license for software and other kinds of works.": "gpl-3",
    "a clean text about permission and use in many forms": "",
}


def test_openings_and_identifiers_of_known_licences(spark, make):
    rows = list(enumerate(KNOWN))
    check(ls.license_scan(make(rows)), rows)
    got = {r["id"]: r["labels"] for r in ls.license_scan(make(rows)).collect()}
    assert {text: got[i] for i, text in rows} == KNOWN


def test_query_on_all_documents(spark, sf, documents):
    check(QUERIES["op3_license_scan"](spark, sf), list(documents.items()), "doc_id")


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op3_license_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

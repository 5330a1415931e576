"""License scan by ordered signature rules, on DataFrame functions only.

A text becomes its words, lower-cased and joined by single blanks. Rules are
regular expressions on that form, each with a label, a priority and a keyword:
a literal that every match holds. They are of three kinds: names as notices and
titles put them, SPDX identifiers, and sentences of the licences' own texts. Two
prefilters gate them: a document without
any of a few anchor strings is done after the scan; of the others a rule runs
only where its keyword stands. Overlapping detections are resolved by priority
and containment: one that lies inside another of at least its priority goes.

Everything up to the detections is one projection over the scan, without a
shuffle; what follows handles detections only.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import spill

# everything that is no word character: ASCII other than digits and letters
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# the base phrases and their labels
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# label, keyword, pattern of the name (words joined by blanks, without a
# closing "license"), whether the name alone is telling
_V = "(?:version |v ?)?"
NAMES = [
    ("mit", "mit", "mit", False),
    ("mit-0", "mit no attribution", "mit no attribution", True),
    ("mit-modern", "modern variant", "mit license modern variant", True),
    ("x11", "x11", "x11", False),
    ("expat", "expat", "expat", False),
    ("apache-1", "apache", rf"apache(?: software)?(?: license)? {_V}1 [01]", True),
    ("apache-2", "apache", rf"apache(?: software)?(?: license)? {_V}2(?: 0)?", True),
    ("apache", "apache", "apache(?: software)?", False),
    ("bsd-1-clause", "bsd", "bsd 1 clause", True),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|simplified bsd)", True),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|new bsd|modified bsd)", True),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|original bsd)", True),
    ("bsd-0-clause", "0bsd", "0bsd", True),
    ("bsd", "bsd", "bsd", False),
    ("isc", "isc", "isc", False),
    ("zlib", "zlib", "zlib(?: libpng)?", False),
    ("libpng", "libpng", "libpng", False),
    ("boost-1", "boost software", rf"boost software(?: license)? {_V}1 0", True),
    ("boost", "boost software", "boost software", False),
    ("gpl-1", "general public", rf"gnu general public license {_V}1(?: 0)?", True),
    ("gpl-2", "general public", rf"gnu general public license {_V}2(?: 0)?", True),
    ("gpl-2-or-later", "general public", rf"gnu general public license {_V}2(?: 0)? or(?: any)? later(?: version)?", True),
    ("gpl-3", "general public", rf"gnu general public license {_V}3(?: 0)?", True),
    ("gpl-3-or-later", "general public", rf"gnu general public license {_V}3(?: 0)? or(?: any)? later(?: version)?", True),
    ("gpl", "general public", "gnu general public", False),
    ("gpl-2-short", "gpl", r"gpl ?v?2(?: 0)?(?: only)?", False),
    ("gpl-2-or-later-short", "gpl", r"gpl ?v?2(?: 0)? or(?: any)? later(?: version)?", False),
    ("gpl-3-short", "gpl", r"gpl ?v?3(?: 0)?(?: only)?", False),
    ("gpl-3-or-later-short", "gpl", r"gpl ?v?3(?: 0)? or(?: any)? later(?: version)?", False),
    ("lgpl-2", "general public", rf"gnu (?:library|lesser) general public license {_V}2(?: 0)?", True),
    ("lgpl-2.1", "lesser general", rf"gnu lesser general public license {_V}2 1", True),
    ("lgpl-3", "lesser general", rf"gnu lesser general public license {_V}3(?: 0)?", True),
    ("lgpl", "lesser general", "gnu lesser general public", False),
    ("lgpl-2.1-short", "lgpl", r"lgpl ?v?2 1(?: only)?", False),
    ("lgpl-3-short", "lgpl", r"lgpl ?v?3(?: 0)?(?: only)?", False),
    ("lgpl-short", "lgpl", "lgpl(?: ?v?[23](?: [01])?)?", False),
    ("agpl-3", "affero general", rf"gnu affero general public license {_V}3(?: 0)?", True),
    ("agpl", "affero general", "gnu affero general public", False),
    ("agpl-short", "agpl", "agpl(?: ?v?3(?: 0)?)?", False),
    ("gfdl", "free documentation", rf"gnu free documentation(?: license {_V}1 [0-3])?", False),
    ("mpl-1.1", "mozilla public", rf"mozilla public license {_V}1 1", True),
    ("mpl-2", "mozilla public", rf"mozilla public license {_V}2(?: 0)?", True),
    ("mpl", "mozilla public", "mozilla public", False),
    ("epl-1", "eclipse public", rf"eclipse public license {_V}1(?: 0)?", True),
    ("epl-2", "eclipse public", rf"eclipse public license {_V}2(?: 0)?", True),
    ("epl", "eclipse public", "eclipse public", False),
    ("edl", "eclipse distribution", "eclipse distribution", False),
    ("cddl", "common development and distribution", "common development and distribution", False),
    ("cpl", "common public", "common public", False),
    ("eupl", "european union public", rf"european union public(?: licen[cs]e {_V}1 [0-2])?", False),
    ("artistic-1", "artistic license", rf"artistic license {_V}1 0", True),
    ("artistic-2", "artistic license", rf"artistic license {_V}2 0", True),
    ("perl", "same terms as perl", "same terms as perl(?: itself)?", True),
    ("python-2", "psf", rf"psf(?: license {_V}2)?", False),
    ("python-2", "python software", rf"python software foundation(?: license {_V}2)?", False),
    ("ruby", "ruby", "ruby", False),
    ("php-3", "php", rf"php(?: license {_V}3 01?)?", False),
    ("openssl", "openssl", "openssl", False),
    ("postgresql", "postgresql", "postgresql", False),
    ("sil-ofl", "open font", rf"(?:sil )?open font(?: license {_V}1 [01])?", False),
    ("wtfpl", "wtfpl", "wtfpl", True),
    ("unlicense", "unlicense", "unlicense", True),
    ("beerware", "beerware", "beerware", False),
    ("ms-pl", "microsoft public", "microsoft public", False),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", False),
    ("odbl", "open database", "open database", False),
    ("odc-by", "open data commons", "open data commons attribution", False),
    ("cc0", "cc0", "cc0(?: 1 0)?", True),
    ("cc-by", "cc by", "cc by(?: [1-4] [05])?", True),
    ("cc-by-sa", "cc by sa", "cc by sa(?: [1-4] [05])?", True),
    ("cc-by-nc", "cc by nc", "cc by nc(?: [1-4] [05])?", True),
    ("cc-by-nd", "cc by nd", "cc by nd(?: [1-4] [05])?", True),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa(?: [1-4] [05])?", True),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd(?: [1-4] [05])?", True),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?(?: international)?", False),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?(?: international)?", False),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?(?: international)?", False),
]

# SPDX identifiers and their labels
SPDX = {
    "MIT": "mit", "MIT-0": "mit-0", "X11": "x11", "ISC": "isc", "Zlib": "zlib", "Libpng": "libpng", "NCSA": "ncsa",
    "Apache-1.0": "apache-1", "Apache-1.1": "apache-1", "Apache-2.0": "apache-2", "BSL-1.0": "boost-1",
    "0BSD": "bsd-0-clause", "BSD-1-Clause": "bsd-1-clause", "BSD-2-Clause": "bsd-2-clause",
    "BSD-3-Clause": "bsd-3-clause", "BSD-4-Clause": "bsd-4-clause",
    "GPL-1.0": "gpl-1", "GPL-1.0-only": "gpl-1", "GPL-1.0-or-later": "gpl-1-or-later",
    "GPL-2.0": "gpl-2", "GPL-2.0-only": "gpl-2", "GPL-2.0-or-later": "gpl-2-or-later",
    "GPL-3.0": "gpl-3", "GPL-3.0-only": "gpl-3", "GPL-3.0-or-later": "gpl-3-or-later",
    "LGPL-2.0": "lgpl-2", "LGPL-2.0-only": "lgpl-2", "LGPL-2.0-or-later": "lgpl-2-or-later",
    "LGPL-2.1": "lgpl-2.1", "LGPL-2.1-only": "lgpl-2.1", "LGPL-2.1-or-later": "lgpl-2.1-or-later",
    "LGPL-3.0": "lgpl-3", "LGPL-3.0-only": "lgpl-3", "LGPL-3.0-or-later": "lgpl-3-or-later",
    "AGPL-3.0": "agpl-3", "AGPL-3.0-only": "agpl-3", "AGPL-3.0-or-later": "agpl-3-or-later",
    "GFDL-1.2-or-later": "gfdl", "GFDL-1.3-only": "gfdl", "GFDL-1.3-or-later": "gfdl",
    "MPL-1.0": "mpl-1.0", "MPL-1.1": "mpl-1.1", "MPL-2.0": "mpl-2", "EPL-1.0": "epl-1", "EPL-2.0": "epl-2",
    "CDDL-1.0": "cddl-1.0", "CDDL-1.1": "cddl-1.1", "CPL-1.0": "cpl-1.0", "EUPL-1.1": "eupl-1.1", "EUPL-1.2": "eupl-1.2",
    "Artistic-1.0": "artistic-1", "Artistic-2.0": "artistic-2", "PSF-2.0": "python-2", "Python-2.0": "python-2",
    "Ruby": "ruby", "PHP-3.0": "php-3", "PHP-3.01": "php-3", "OpenSSL": "openssl", "PostgreSQL": "postgresql",
    "OFL-1.0": "sil-ofl", "OFL-1.1": "sil-ofl", "WTFPL": "wtfpl", "Unlicense": "unlicense", "Beerware": "beerware",
    "MS-PL": "ms-pl", "MS-RL": "ms-rl", "ODbL-1.0": "odbl", "ODC-By-1.0": "odc-by", "AFL-3.0": "afl-3", "UPL-1.0": "upl-1.0",
    "BUSL-1.1": "busl-1.1", "SSPL-1.0": "sspl-1", "CC0-1.0": "cc0", "CC-BY-3.0": "cc-by", "CC-BY-4.0": "cc-by",
    "CC-BY-SA-3.0": "cc-by-sa", "CC-BY-SA-4.0": "cc-by-sa", "CC-BY-NC-4.0": "cc-by-nc", "CC-BY-ND-4.0": "cc-by-nd",
    "CC-BY-NC-SA-4.0": "cc-by-nc-sa", "CC-BY-NC-ND-4.0": "cc-by-nc-nd",
}
# how an identifier stands in a text: pattern, priority, confidence, only those with a digit
SPDX_FORMS = [
    ("spdx license identifier {id}", 3, 0.99, False),
    ("licen[cs]e {id}", 2, 0.8, False),       # a package's field: "license": "..."
    ("(?:or|and) {id}", 1, 0.6, True),        # the further parts of an expression
]

# sentences of the licences' own texts: label, keyword, pattern
_SOME = "(?: [^ ]+){1,12}"
SIGNATURES = [
    ("mit", "free of charge to any person obtaining",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("x11", "as contained in this notice",
     f"except as contained in this notice the names? of{_SOME} shall not be used in advertising or otherwise to promote the sale"),
    ("boost-1", "to any person or organization obtaining",
     "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "is hereby granted provided that",
     "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-0-clause", "with or without fee is hereby granted the software is",
     "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("postgresql", "without a written agreement is hereby granted",
     "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "endorse or promote products",
     f"neither the names? of{_SOME} nor the names of(?: its| their)? contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials mentioning",
     "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2", "for use reproduction and distribution 1 definitions",
     "terms and conditions for use reproduction and distribution 1 definitions"),
    ("apache-2", "except in compliance with the license you may obtain",
     "you may not use this file except in compliance with the license you may obtain a copy of the license at(?: http| https)? www apache org licenses license 2 0"),
    ("gpl-2", "take away your freedom to share and change it by contrast the gnu general",
     "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license"),
    ("gpl-3", "the gnu general public license is a free copyleft",
     "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3", "the gnu affero general public license is a free copyleft",
     "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-3", "incorporates the terms and conditions of version 3",
     "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("gpl-2-or-later", "either version 2 of the license or",
     "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3-or-later", "either version 3 of the license or",
     "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2-or-later", "either version 2 of the license or",
     "gnu (?:library|lesser) general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl-2.1-or-later", "either version 2 1 of the license or",
     "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3-or-later", "either version 3 of the license or",
     "gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3-or-later", "either version 3 of the license or",
     "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2", "as published by the free software foundation version 2",
     "gnu general public license(?: version 2)? as published by the free software foundation version 2 of the license"),
    ("mpl-2", "this source code form is subject",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "held liable for any damages arising",
     "without any express or implied warranty in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("unlicense", "free and unencumbered software",
     "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "what the fuck you want", "you just do what the fuck you want to"),
    ("cc0", "dedicated the work to the public domain",
     "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("beerware", "whatever you want with this stuff",
     "as long as you retain this notice you can do whatever you want with this stuff"),
    ("python-2", "making python available to licensee", "psf is making python available to licensee on an as is basis"),
    ("openssl", "openssl project for use in the openssl toolkit",
     "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("sil-ofl", "this font software is licensed under",
     "this font software is licensed under the sil open font license version 1 [01]"),
]

# how a name stands in a text: pattern, priority, confidence
NOTICES = [
    ("licensed under (?:the )?(?:terms of the )?{name}(?: licen[cs]e)?", 3, 0.95),
    ("(?:released|distributed|available|published|shared) under (?:the )?(?:terms of the )?{name} licen[cs]e", 3, 0.95),
    ("spdx license identifier {name}(?: licen[cs]e)?", 3, 0.99),
]
TITLE = ("{name} licen[cs]e", 2, 0.7)
ALONE = ("{name}", 1, 0.6)
FIELD = ("licen[cs]e {name}", 2, 0.7)

# a document without any of these holds no match of any rule
ANCHORS = ("licen", "cc by", "cc0", "wtfpl", "same terms as perl", "mit no attribution", "0bsd", "bsd", "apache", "boost software",
           "hereby granted", "source and binary forms", "endorse or promote products", "advertising materials mentioning",
           "as contained in this notice", "1 definitions", "held liable for any damages", "unencumbered software",
           "what the fuck you want", "dedicated the work to the public domain", "whatever you want with this stuff",
           "openssl toolkit",
           # the identifiers with a digit
           "mit 0", "bsl 1", "gpl 1", "gpl 2", "gpl 3", "gfdl 1", "mpl 1", "mpl 2", "epl 1", "epl 2", "cddl 1", "cpl 1", "eupl 1",
           "artistic 1", "artistic 2", "psf 2", "python 2 0", "php 3", "ofl 1", "odbl 1", "odc by 1", "afl 3", "upl 1", "busl 1", "sspl 1")


def rules() -> list[dict]:
    """Every rule: number, label, keyword, pattern (from the blank before the
    first word), priority, confidence, base. Base phrases come first."""
    out = [{"label": label, "keyword": phrase, "pattern": f" {phrase}(?= )", "priority": 3, "weight": 1.0,
            "base": True} for phrase, label in BASE.items()]
    for label, keyword, name, telling in NAMES:
        short = label.endswith("-short")
        for form, priority, weight in [*NOTICES, TITLE, *([ALONE] if telling else []), *([FIELD] if short else [])]:
            out.append({"label": label.removesuffix("-short"), "keyword": keyword,
                        "pattern": f" {form.format(name=name)}(?= )", "priority": priority, "weight": weight,
                        "base": False})
    for label, keyword, pattern in SIGNATURES:
        out.append({"label": label, "keyword": keyword, "pattern": f" {pattern}(?= )", "priority": 3, "weight": 0.98,
                    "base": False})
    for spdx, label in SPDX.items():
        words = " ".join(re.split(r"[-.]", spdx.lower()))
        for form, priority, weight, numbered in SPDX_FORMS:
            if not numbered or re.search(r" \d", words):
                out.append({"label": label, "keyword": words, "pattern": f" {form.format(id=words)}(?= )",
                            "priority": priority, "weight": weight, "base": False})
    return [{"rule": i, **r} for i, r in enumerate(out)]


def _spaces(col):
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score``, ``n_found``
    (detections left after suppression).

    Null, empty and wordless texts have no words and score 0. Rows that repeat
    an id are scanned as rows of their own. Extra columns are ignored; an empty
    table gives an empty result.
    """
    table = rules()
    listed = F.from_json(F.lit(json.dumps([{k: r[k] for k in ("rule", "keyword", "pattern")} for r in table])),
                         "array<struct<rule:int,keyword:string,pattern:string>>")
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # lower() also changes letters beyond A-Z, which moves no word boundary and
    # makes no letter of a phrase ("k" apart, which no base phrase has)
    words = F.trim(F.regexp_replace(F.lower(body), _SEPARATORS, " "))

    def places(rule):
        """(rule, number, words before since the last match, words of the match)"""
        around = F.split(F.col("joined"), rule["pattern"], -1)
        hits = F.regexp_extract_all(F.col("joined"), rule["pattern"], F.lit(0))
        return F.transform(hits, lambda hit, i: F.struct(
            rule["rule"].alias("rule"), i.alias("i"), _spaces(F.element_at(around, i + 1)).alias("gap"),
            _spaces(hit).alias("size")))

    gated = F.exists(F.array(*map(F.lit, ANCHORS)), lambda a: F.contains(F.col("joined"), a))
    hits = F.flatten(F.transform(F.filter(listed, lambda r: F.contains(F.col("joined"), r["keyword"])), places))
    none = F.array().cast("array<struct<rule:int,i:int,gap:int,size:int>>")
    scanned = spill(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), words.alias("words"))
        .select("row", "id", F.when(F.col("words") == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), "words", F.lit(" ")))
                .alias("joined"))
        .select("row", "id", (_spaces(F.col("joined")) - 1).cast("long").alias("n_words"),
                F.when(gated, hits).otherwise(none).alias("hits")), "scanned")

    spark = docs.sparkSession
    known = spark.createDataFrame([(r["rule"], r["label"], r["priority"], r["weight"], r["base"]) for r in table],
                                  "rule int, label string, priority int, weight double, base boolean")
    order = Window.partitionBy("row", "rule").orderBy("i")
    found = (scanned.select("row", F.explode("hits").alias("h")).select("row", "h.*")
             .withColumn("start", F.sum(F.col("gap") + F.col("size")).over(order) - F.col("size"))
             .withColumn("end", F.col("start") + F.col("size"))
             .join(F.broadcast(known), "rule"))  # a few hundred rows, fixed by the code
    before = (Window.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.coalesce(*[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before))
                         for p in (1, 2, 3)])
    left = (found.withColumn("inside", F.coalesce(reach >= F.col("end"), F.lit(False)))
            .where(~F.col("inside") | F.col("base")))
    base = F.col("base")
    joined = (left.groupBy("row").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("weight").alias("score"), F.sum((~F.col("inside")).cast("long")).alias("n_found")))
    zero = F.lit(0).cast("long")
    return (scanned.select("row", "id", "n_words").join(joined, "row", "left").select(
        "id", "n_words", F.coalesce("n_base", zero).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_found", zero).alias("n_found")))

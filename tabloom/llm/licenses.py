"""License scans by ordered signature rules.

A text is brought into one form: lower-case words (A-Z only are folded), parted by anything that is neither a digit, a letter
nor beyond ASCII. Each rule is a regular expression over these words, gated by a keyword that its matches must hold: a
rule's expression runs only on texts with its keyword. Rules are ordered by tier: base phrases, tags and addresses,
grants, names, hints. Detections are intervals of words; one that lies within another of the same or a better tier is
suppressed (of equal intervals, the earlier rule stays). Base phrases are of the best tier and always stay.

Only DataFrame functions run on the rows; nothing is shuffled, and a text stays in its row. Work on a text is linear in its
words for each rule whose keyword it has, and sorting for its detections.

Null and empty texts have no words, no detections, null places, empty labels and score 0. Every row gives one row.
The score is the confidence of the best tier that stays: 1, 0.95, 0.9, 0.7 or 0.3.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels, as asked for.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
CONFIDENCE = (1.0, 0.95, 0.9, 0.7, 0.3)

# Signatures, written over words with one space between them. A group is never capturing.
#: label: how its tag is written in an SPDX line (an expression), and how prose names it (an expression with its keyword).
_NAMED = (
    ("mit", "mit", "mit licen[cs]e", "mit"),
    ("apache-2", "apache 2 0", "apache (?:software )?licen[cs]e,?(?: v2| version 2| 2)(?: 0)?", "apache"),
    ("apache-1.1", "apache 1 1", "apache (?:software )?licen[cs]e(?: v1| version 1) 1", "apache"),
    ("gpl-2", "gpl 2 0(?: only| or later)?", "(?:gnu )?(?:general public licen[cs]e|gpl)(?: as published by the free software foundation)?(?: v2| version 2)(?: 0)?", "g"),
    ("gpl-3", "gpl 3 0(?: only| or later)?", "(?:gnu )?(?:general public licen[cs]e|gpl)(?: as published by the free software foundation)?(?: v3| version 3)(?: 0)?", "g"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: v2| version 2) 1", "l"),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: v3| version 3)(?: 0)?", "l"),
    ("agpl-3", "agpl 3 0(?: only| or later)?", "(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: v3| version 3)(?: 0)?", "a"),
    ("bsd-2-clause", "bsd 2 clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd) licen[cs]e", "bsd"),
    ("bsd-3-clause", "bsd 3 clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) licen[cs]e", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "(?:original bsd|bsd 4 clause|4 clause bsd) licen[cs]e", "bsd"),
    ("0bsd", "0bsd", "(?:zero clause bsd|0bsd|bsd zero clause) licen[cs]e", "bsd"),
    ("isc", "isc", "isc licen[cs]e", "isc"),
    ("mpl-1.1", "mpl 1 1", "(?:mozilla public licen[cs]e|mpl)(?: v1| version 1) 1", "m"),
    ("mpl-2", "mpl 2 0", "(?:mozilla public licen[cs]e|mpl)(?: v2| version 2| 2)(?: 0)?", "m"),
    ("epl-1", "epl 1 0", "eclipse public licen[cs]e(?: v1| version 1| v 1)(?: 0)?", "eclipse"),
    ("epl-2", "epl 2 0", "eclipse public licen[cs]e(?: v2| version 2| v 2)(?: 0)?", "eclipse"),
    ("edl-1", "edl 1 0", "eclipse distribution licen[cs]e", "eclipse"),
    ("cddl-1", "cddl 1 [01]", "common development and distribution licen[cs]e", "distribution"),
    ("cpl-1", "cpl 1 0", "common public licen[cs]e", "common  public"),
    ("ipl-1", "ipl 1 0", "ibm public licen[cs]e", "ibm"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("zlib", "zlib", "(?:zlib|zlib libpng) licen[cs]e", "zlib"),
    ("libpng", "libpng(?: 2 0)?", "(?:libpng|png reference library) licen[cs]e", "png"),
    ("bsl-1", "bsl 1 0", "boost software licen[cs]e", "boost"),
    ("wtfpl", "wtfpl", "(?:wtfpl|do what the fuck you want to public licen[cs]e)", "w"),
    ("artistic-1", "artistic 1 0(?: perl| cl8)?", "artistic licen[cs]e(?: v1| version 1| 1)(?: 0)?", "artistic"),
    ("artistic-2", "artistic 2 0", "artistic licen[cs]e(?: v2| version 2| 2)(?: 0)?", "artistic"),
    ("python-2", "(?:python 2 0|psf 2 0)", "(?:python software foundation|psf) licen[cs]e", "p"),
    ("ruby", "ruby", "ruby licen[cs]e", "ruby"),
    ("php-3", "php 3 01?", "php licen[cs]e", "php"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("openssl", "openssl", "openssl licen[cs]e", "openssl"),
    ("x11", "x11", "(?:x11|x consortium) licen[cs]e", "x"),
    ("icu", "icu", "icu licen[cs]e", "icu"),
    ("unicode", "unicode (?:dfs 201[56]|3 0|tou)", "unicode (?:terms of use|licen[cs]e agreement|licen[cs]e)", "unicode"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa (?:open source )?licen[cs]e", "ncsa"),
    ("ofl-1.1", "ofl 1 1", "(?:sil )?open font licen[cs]e", "font"),
    ("eupl-1.2", "eupl 1 2", "european union public licen[cs]e", "european"),
    ("cecill-2.1", "cecill (?:2 1|2 0|b|c)", "cecill(?: free software)? licen[cs]e", "cecill"),
    ("ms-pl", "ms pl", "microsoft public licen[cs]e", "microsoft"),
    ("ms-rl", "ms rl", "microsoft reciprocal licen[cs]e", "microsoft"),
    ("osl-3", "osl 3 0", "open software licen[cs]e", "open  software"),
    ("afl-3", "afl 3 0", "academic free licen[cs]e", "academic"),
    ("vim", "vim", "vim licen[cs]e", "vim"),
    ("curl", "curl", "curl licen[cs]e", "curl"),
    ("ftl", "ftl", "freetype (?:project )?licen[cs]e", "freetype"),
    ("json", "json", "json licen[cs]e", "json"),
    ("blueoak-1", "blueoak 1 0 0", "blue oak model licen[cs]e", "blue"),
    ("mulan-2", "mulanpsl 2 0", "mulan (?:permissive software|psl) licen[cs]e", "mulan"),
    ("upl-1", "upl 1 0", "universal permissive licen[cs]e", "universal"),
    ("sspl-1", "sspl 1 0", "server side public licen[cs]e", "server"),
    ("busl-1.1", "busl 1 1", "business source licen[cs]e", "business"),
    ("elastic-2", "elastic 2 0", "elastic licen[cs]e(?: v2| version 2| 2)(?: 0)?", "elastic"),
    ("polyform", "polyform [a-z]+ 1 0 0", "polyform [a-z]+ licen[cs]e", "polyform"),
    ("odbl-1", "odbl 1 0", "open (?:data commons open )?database licen[cs]e", "database"),
    ("odc-by-1", "odc by 1 0", "open data commons attribution licen[cs]e", "commons"),
    ("pddl-1", "pddl 1 0", "public domain dedication and licen[cs]e", "dedication"),
    ("gfdl-1.3", "gfdl 1 [123](?: only| or later)?", "(?:gnu )?free documentation licen[cs]e", "documentation"),
    ("openrail", "(?:creativeml |bigscience )?openrail m?", "(?:bigscience |creativeml )?open ?rail(?: m)? licen[cs]e", "rail"),
    ("llama", "llama[0-9 ]*", "llama [0-9 ]*community licen[cs]e", "llama"),
    ("cc0", "cc0 1 0", "(?:cc0(?: 1 0)?|creative commons zero)(?: universal| licen[cs]e)?", "c"),
    ("cc-by", "cc by [1-4] [05]", "(?:cc by(?: [1-4] [05])?|creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?) licen[cs]e", "c"),
    ("cc-by-sa", "cc by sa [1-4] [05]", "(?:cc by sa(?: [1-4] [05])?|creative commons attribution share ?alike)", "c"),
    ("cc-by-nd", "cc by nd [1-4] [05]", "(?:cc by nd(?: [1-4] [05])?|creative commons attribution no ?deriv(?:ative)?s)", "c"),
    ("cc-by-nc", "cc by nc [1-4] [05]", "creative commons attribution non ?commercial", "commons"),
    ("cc-by-nc-sa", "cc by nc sa [1-4] [05]", "(?:cc by nc sa(?: [1-4] [05])?|creative commons attribution non ?commercial share ?alike)", "c"),
    ("cc-by-nc-nd", "cc by nc nd [1-4] [05]", "(?:cc by nc nd(?: [1-4] [05])?|creative commons attribution non ?commercial no ?deriv(?:ative)?s)", "c"),
)
#: Web addresses: label, expression, keyword.
_ADDRESSES = (
    ("mit", "opensource org licen[cs]es mit", "opensource"), ("apache-2", "apache org licen[cs]es licen[cs]e 2 0", "apache"),
    ("gpl-2", "gnu org licen[cs]es (?:old licen[cs]es )?gpl 2 0", "gnu"), ("gpl-3", "gnu org licen[cs]es gpl(?: 3 0)?", "gnu"),
    ("lgpl-2.1", "gnu org licen[cs]es (?:old licen[cs]es )?lgpl 2 1", "gnu"), ("lgpl-3", "gnu org licen[cs]es lgpl(?: 3 0)?", "gnu"),
    ("agpl-3", "gnu org licen[cs]es agpl(?: 3 0)?", "gnu"), ("gfdl-1.3", "gnu org licen[cs]es fdl", "gnu"),
    ("bsd-2-clause", "opensource org licen[cs]es bsd 2 clause", "opensource"), ("bsd-3-clause", "opensource org licen[cs]es bsd 3 clause", "opensource"),
    ("isc", "opensource org licen[cs]es isc", "opensource"), ("mpl-2", "mozilla org (?:en us )?mpl 2 0", "mozilla"),
    ("epl-1", "eclipse org legal epl v10", "eclipse"), ("epl-2", "eclipse org (?:legal epl 2 0|legal epl v20)", "eclipse"),
    ("bsl-1", "boost org licen[cs]e 1 0", "boost"), ("unlicense", "unlicense org", "unlicense"), ("cc0", "creativecommons org publicdomain zero", "creativecommons"),
    ("public-domain", "creativecommons org publicdomain mark", "creativecommons"), ("cc-by", "creativecommons org licen[cs]es by [1-4]", "creativecommons"),
    ("cc-by-sa", "creativecommons org licen[cs]es by sa", "creativecommons"), ("cc-by-nd", "creativecommons org licen[cs]es by nd", "creativecommons"),
    ("cc-by-nc", "creativecommons org licen[cs]es by nc [1-4]", "creativecommons"), ("cc-by-nc-sa", "creativecommons org licen[cs]es by nc sa", "creativecommons"),
    ("cc-by-nc-nd", "creativecommons org licen[cs]es by nc nd", "creativecommons"), ("odbl-1", "opendatacommons org licen[cs]es odbl", "opendatacommons"),
    ("odc-by-1", "opendatacommons org licen[cs]es by", "opendatacommons"), ("ofl-1.1", "scripts sil org ofl", "sil"), ("wtfpl", "wtfpl net", "wtfpl"),
)
#: Sentences of the texts themselves: label, expression, keyword.
_SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby"),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "warranty"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "notice"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "without  fee"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "redistributions"),
    ("bsd-3-clause", "neither the name of .{1,80} nor the names of its contributors may be used to endorse", "endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising"),
    ("apache-2", "you may not use this file except in compliance with the licen[cs]e", "compliance"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the licen[cs]e", "applicable"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "redistribute"),
    ("gpl", "under the terms of the gnu general public licen[cs]e", "general  public"),
    ("gpl", "you should have received a copy of the gnu general public licen[cs]e", "general  public"),
    ("lgpl", "under the terms of the gnu (?:lesser|library) general public licen[cs]e", "general  public"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "redistribute"),
    ("agpl", "under the terms of the gnu affero general public licen[cs]e", "affero"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public licen[cs]e", "mozilla"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse", "eclipse"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining", "organization"),
    ("zlib", "this software is provided as is without any express or implied warranty", "warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies", "verbatim"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", "public  domain"),
    ("cc-by", "except where otherwise noted (?:this|content on this) (?:work|site|page) is licen[cs]ed under (?:a )?creative commons attribution", "noted"),
    ("cc", "this work is licen[cs]ed under (?:a|the) creative commons", "creative"),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution) (?:of this (?:file|material|document|work) )?is (?:strictly )?prohibited", "prohibited"),
    ("proprietary", "proprietary and confidential", "proprietary"),
    ("proprietary", "may not be reproduced (?:or )?(?:distributed |transmitted )?(?:in any form )?without (?:the )?(?:prior )?(?:written )?permission", "reproduced"),
    ("non-commercial", "for (?:personal and )?non ?commercial use only", "commercial"),
    ("research-only", "for (?:academic|research|educational)(?: and (?:academic|research|educational))? (?:use|purposes) only", "only"),
)
#: Hints: label, expression, keyword.
_HINTS = (
    ("gpl", "gnu general public licen[cs]e", "general  public"), ("lgpl", "gnu lesser general public licen[cs]e", "lesser"), ("bsd", "bsd licen[cs]e", "bsd"),
    ("mpl", "mozilla public licen[cs]e", "mozilla"), ("epl", "eclipse public licen[cs]e", "eclipse"), ("apache", "apache licen[cs]e", "apache"), ("cc", "creative commons", "creative"),
    ("public-domain", "public domain", "public  domain"), ("all-rights-reserved", "all rights reserved", "rights  reserved"), ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright"),
    ("copyright", "(?:19|20)[0-9][0-9] [a-z0-9 ]{1,40} all rights reserved", "rights  reserved"), ("open-source", "open source licen[cs]e", "open  source"),
    ("proprietary", "proprietary licen[cs]e", "proprietary"), ("commercial", "commercial licen[cs]e", "commercial"), ("dual", "dual licen[cs]ed", "dual"),
    ("unspecified", "(?:released|distributed|provided|published|available) under (?:an?|the) [a-z0-9 ]{1,40}? ?licen[cs]e", "under"),
)
_GRANT = "(?:licen[cs]ed|released|distributed|available|published|covered|provided|redistributed)(?: to you)? (?:under|by|with) (?:the )?(?:terms of )?(?:the )?"


def rules() -> list[tuple[int, str, str, str]]:
    """(tier, label, keyword, expression) in order. Keywords and expressions are over words that two spaces part."""
    grant = [(2, label, key, _GRANT + f"(?:{name})") for label, _, name, key in _NAMED]
    tag = [(1, label, "spdx", f"spdx licen[cs]e identifier {written}") for label, written, _, _ in _NAMED]
    metadata = [(1, label, "licen", f"licen[cs]e {written} (?:licen[cs]e)?") for label, written, _, _ in _NAMED if " " in written]
    name = [(3, label, key, name) for label, _, name, key in _NAMED]
    listed = ([(0, label, phrase, phrase) for phrase, label in BASE] + tag + [(1, *x[:1], x[2], x[1]) for x in _ADDRESSES] + metadata
              + [(2, *x[:1], x[2], x[1]) for x in _SENTENCES] + grant + name + [(4, *x[:1], x[2], x[1]) for x in _HINTS])
    wide = lambda text: text.replace("  ", " ").replace(" ?", "(?:  )?").replace(" ", "  ").replace("(?:    )?", "(?:  )?")
    return [(tier, label, wide(key), f" ({wide(expression.rstrip())}) ") for tier, label, key, expression in listed]


#: Words of which every rule's matches have one, so that other texts are done at once.
GATES = ("licen", "copyright", "spdx", "apache", "cc  by", "cc0", "creative", "permission", "redistribut", "public  domain", "warranty", "rights  reserved",
         "proprietary", "prohibited", "use  only", "purposes  only", "wtfpl", "unencumbered", "verbatim", "advertising", "reproduced", "endorse", "open  font", "sil  org", "gpl", " mpl ",
         "opendatacommons", "mozilla", "eclipse", "general  public", "gnu  org", "free  software", "terms  of  use")


def canonical(text: Column) -> Column:
    """Lower-case words with two spaces between them and one at either end."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  ")), F.lit(" "))


def _detections(words: Column, listed: Column) -> Column:
    """Intervals of words that the rules match: start, end, tier, rule and label."""
    begin, end = "\u0001", "\u0002"  # not in words
    empty = F.array().cast("array<struct<start:int,end:int,tier:int,rule:int,label:string>>")

    def of(rule: Column) -> Column:
        marked = F.regexp_replace(words, rule["expression"], F.lit(f" {begin}$1{end} "))
        one = F.split(F.trim(marked), "  ")
        places = F.transform(one, lambda w, i: F.struct(w.startswith(begin).alias("b"), w.endswith(end).alias("e"), i.alias("i")))
        starts = F.transform(F.filter(places, lambda p: p["b"]), lambda p: p["i"])
        ends = F.transform(F.filter(places, lambda p: p["e"]), lambda p: p["i"])
        both = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end"), rule["tier"].alias("tier"), rule["rule"].alias("rule"), rule["label"].alias("label")))
        return F.when(F.instr(marked, begin) > 0, both).otherwise(empty)

    keyed = F.filter(listed, lambda r: F.contains(words, r["keyword"]))
    return F.flatten(F.transform(keyed, of))


def _staying(found: Column) -> Column:
    """(labels, tier): of the detections, sorted by start and falling end, those that no earlier one of as good a tier holds."""
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), d["tier"].alias("tier"), d["rule"].alias("rule"), d["label"].alias("label"))))
    tiers = range(len(CONFIDENCE))
    begin = F.struct(F.array().cast("array<string>").alias("labels"), F.lit(len(CONFIDENCE)).alias("tier"), F.lit(0).alias("n"), F.array(*[F.lit(-1) for _ in tiers]).alias("reach"))

    def step(seen: Column, d: Column) -> Column:
        held = F.greatest(*[F.when(d["tier"] >= t, F.get(seen["reach"], F.lit(t))).otherwise(-1) for t in tiers]) >= -d["back"]
        fresh = F.when(held | F.array_contains(seen["labels"], d["label"]), seen["labels"]).otherwise(F.concat(seen["labels"], F.array(d["label"])))
        reach = F.transform(seen["reach"], lambda r, t: F.when(t == d["tier"], F.greatest(r, -d["back"])).otherwise(r))
        return F.struct(fresh.alias("labels"), F.when(held, seen["tier"]).otherwise(F.least(seen["tier"], d["tier"])).alias("tier"),
                        (seen["n"] + F.when(held, 0).otherwise(1)).alias("n"), reach.alias("reach"))

    return F.aggregate(ordered, begin, step)


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found of every whole text."""
    listed = F.array(*[F.struct(F.lit(tier).alias("tier"), F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(key).alias("keyword"), F.lit(expression).alias("expression"))
                       for i, (tier, label, key, expression) in enumerate(rules())])
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(F.col("words"), F.lit(word))
    words = df.select(F.col(id_col), canonical(F.col(text_col)).alias("words"))
    n_words = F.when(F.length("words") == 2, F.lit(0)).otherwise((F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit("")))) / 2)
    empty = F.array().cast("array<struct<start:int,end:int,tier:int,rule:int,label:string>>")
    found = words.select(id_col, n_words.cast("long").alias("n_words"), F.when(gate, _detections(F.col("words"), listed)).otherwise(empty).alias("found"))
    base = F.filter("found", lambda d: d["tier"] == 0)
    rated = found.select(id_col, "n_words", base.alias("base"), F.when(F.size("found") > 0, _staying(F.col("found"))).alias("stay"))
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rated.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform("base", lambda d: d["label"])).alias("base_labels"), F.coalesce(joined(F.col("stay.labels")), F.lit("")).alias("labels"),
        F.coalesce(F.get(F.array(*map(F.lit, CONFIDENCE)), F.col("stay.tier")), F.lit(0.0)).alias("score"), F.coalesce(F.col("stay.n"), F.lit(0)).cast("long").alias("n_found"))

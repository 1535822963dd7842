"""License scans of whole texts by ordered rules, in column expressions only.

A cheap search for keywords decides which texts are looked at at all, and which rules a text needs. Each rule is a regular
expression over the text's words. Of detections, one that lies in a longer one is suppressed, and of equal places the rule
of higher priority wins. Base phrases are rules whose detections always stay.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, before and after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x01"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds words each with a space in front; the words of ``keyword`` occur in every match, in this order."""

    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float
    base: bool = False


BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label: keyword, words of the license's name, words of its identifier.
NAMES: dict[str, tuple[str, str, str]] = {
    "mit": ("mit", "mit", "mit"),
    "apache-1.1": ("apache", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1"),
    "apache-2.0": ("apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0"),
    "gpl-1.0": ("general public", "(?:gnu )?general public license(?: version| v)? 1(?: 0)?", "gpl 1 0"),
    "gpl-2.0": ("general public", "(?:gnu )?general public license(?: version| v)? 2(?: 0)?", "gpl 2 0"),
    "gpl-3.0": ("general public", "(?:gnu )?general public license(?: version| v)? 3(?: 0)?", "gpl 3 0"),
    "lgpl-2.0": ("lesser general|library general", "(?:gnu )?(?:lesser general|library general) public license(?: version| v)? 2(?: 0)?", "lgpl 2 0"),
    "lgpl-2.1": ("lesser general", "(?:gnu )?lesser general public license(?: version| v)? 2 1", "lgpl 2 1"),
    "lgpl-3.0": ("lesser general", "(?:gnu )?lesser general public license(?: version| v)? 3(?: 0)?", "lgpl 3 0"),
    "agpl-3.0": ("affero", "(?:gnu )?affero general public license(?: version| v)? 3(?: 0)?", "agpl 3 0"),
    "gfdl-1.2": ("documentation license", "(?:gnu )?free documentation license(?: version| v)? 1 2", "gfdl 1 2"),
    "gfdl-1.3": ("documentation license", "(?:gnu )?free documentation license(?: version| v)? 1 3", "gfdl 1 3"),
    "bsd-2-clause": ("bsd", "(?:simplified bsd|bsd(?: license)? 2 clause|2 clause bsd)", "bsd 2 clause"),
    "bsd-3-clause": ("bsd", "(?:new bsd|modified bsd|revised bsd|bsd(?: license)? 3 clause|3 clause bsd)", "bsd 3 clause"),
    "bsd-4-clause": ("bsd", "(?:original bsd|bsd(?: license)? 4 clause|4 clause bsd)", "bsd 4 clause"),
    "mpl-1.1": ("mozilla", "mozilla public license(?: version| v)? 1 1", "mpl 1 1"),
    "mpl-2.0": ("mozilla", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    "epl-1.0": ("eclipse", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0"),
    "epl-2.0": ("eclipse", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0"),
    "cddl-1.0": ("distribution license", "common development and distribution license(?: version| v)? 1(?: 0)?", "cddl 1 0"),
    "cpl-1.0": ("common public", "common public license(?: version| v)? 1(?: 0)?", "cpl 1 0"),
    "artistic-1.0": ("artistic license", "artistic license(?: version| v)? 1(?: 0)?", "artistic 1 0"),
    "artistic-2.0": ("artistic license", "artistic license(?: version| v)? 2(?: 0)?", "artistic 2 0"),
    "isc": ("isc", "isc", "isc"),
    "zlib": ("zlib", "zlib", "zlib"),
    "bsl-1.0": ("boost", "boost software license(?: version| v)? 1(?: 0)?", "bsl 1 0"),
    "wtfpl": ("wtfpl", "wtfpl", "wtfpl"),
    "unlicense": ("unlicense", "(?:the )?unlicense", "unlicense"),
    "python-2.0": ("python", "python(?: software foundation)? license(?: version| v)? 2(?: 0)?", "psf 2 0"),
    "postgresql": ("postgresql", "postgresql", "postgresql"),
    "ofl-1.1": ("open font", "(?:sil )?open font license(?: version| v)? 1 1", "ofl 1 1"),
    "cc0-1.0": ("cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
}

#: Around a name or an identifier: words before, words after, which of the two, priority, confidence.
FORMS: list[tuple[str, str, str, int, float]] = [
    ("spdx license identifier ", "(?: only| or later)?", "id", 1, 1.0),
    ("(?:is |are )?(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?", "(?: license)?", "name", 2, 0.95),
    ("(?:subject to|under) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", " license", "name", 3, 0.9),
    ("license(?:d)?(?: is| type)? ", "", "id", 4, 0.8),
    ("(?:the )?", " license", "name", 5, 0.75),
    ("opensource org licenses ", "", "id", 2, 0.9),
    ("(?:see|read) (?:the )?", " licen(?:s|c)e(?: file| text)?", "name", 6, 0.7),
]


#: Sentences of license texts and of notices in files: label, a word that each match has, the words. Public texts.
TEXTS: list[tuple[str, str, str]] = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit-0", "sublicense", "deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("x11", "consortium", "the name of the x consortium shall not be used in advertising"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "hereby", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
    ("postgresql", "hereby", "without a written agreement is hereby granted provided that the above copyright notice"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-2-clause", "freebsd", "(?:the )?freebsd(?: project)?(?: copyright)? license"),
    ("bsd-3-clause", "endorse", "neither the name of (?:\\S+ ){1,12}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", "implied warranties", "this software is provided by the (?:copyright holders|regents|authors?)(?: and contributors)? as is and any express or implied warranties"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", "plainly", "altered source versions must be plainly marked as such"),
    ("bsl-1.0", "boost", "boost software license version 1 0 august 17th 2003"),
    ("bsl-1.0", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense", "for more information please refer to (?:https?|http) unlicense org"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("cc0-1.0", "cc0", "creative commons (?:legal code )?cc0 1 0 universal"),
    ("cc0-1.0", "neighboring", "has waived all copyright and related or neighboring rights"),
    ("public-domain", "public domain", "(?:is|are|been) (?:hereby )?(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache", "you may obtain a copy of the license at https? www apache org licenses license 2 0"),
    ("apache-2.0", "apache", "apache license version 2 0 january 2004"),
    ("apache-2.0", "apache", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", "warranties or conditions", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-1.1", "apache", "the apache software license version 1 1"),
    ("apache-1.1", "apache", "products derived from this software may not be called apache"),
    ("gpl", "gnu general", "(?:this program is free software )?you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2.0-or-later", "gnu general", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "gnu general", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0", "gnu general", "gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3.0", "gnu general", "gnu general public license version 3 as published by the free software foundation"),
    ("gpl-1.0", "gnu general", "gnu general public license version 1 february 1989"),
    ("gpl-2.0", "gnu general", "gnu general public license version 2 june 1991"),
    ("gpl-3.0", "gnu general", "gnu general public license version 3 29 june 2007"),
    ("gpl", "gnu general", "you should have received a copy of the gnu general public license along with"),
    ("gpl", "verbatim copies", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("lgpl-2.0", "gnu library", "gnu library general public license version 2 june 1991"),
    ("lgpl-2.1", "gnu lesser", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", "gnu lesser", "gnu lesser general public license version 3 29 june 2007"),
    ("lgpl", "gnu lesser", "under the terms of the gnu lesser general public license"),
    ("lgpl", "gnu library", "under the terms of the gnu library general public license"),
    ("lgpl", "gnu lesser", "you should have received a copy of the gnu lesser general public license along with"),
    ("agpl-3.0", "affero", "gnu affero general public license version 3 19 november 2007"),
    ("agpl", "affero", "under the terms of the gnu affero general public license"),
    ("agpl", "affero", "you should have received a copy of the gnu affero general public license along with"),
    ("gfdl", "documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "mozilla", "mozilla public license version 2 0"),
    ("mpl-2.0", "mozilla", "you can obtain one at https? mozilla org mpl 2 0"),
    ("epl-1.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("epl", "eclipse", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cddl-1.0", "distribution license", "subject to the terms of the common development and distribution license"),
    ("cpl-1.0", "common public", "the accompanying program is provided under the terms of this common public license"),
    ("artistic-2.0", "artistic", "the artistic license 2 0"),
    ("artistic", "semblance", "the copyright holder maintains some semblance of artistic control"),
    ("artistic", "artistic", "under the same terms as perl itself(?: or the artistic license)?"),
    ("python-2.0", "python", "python software foundation license version 2"),
    ("python-2.0", "psf", "this license agreement is between the python software foundation psf"),
    ("ofl-1.1", "font software", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "open font", "sil open font license version 1 1 26 february 2007"),
    ("eupl-1.2", "eupl", "licensed under the eupl(?: version| v)? 1 2"),
    ("eupl-1.1", "eupl", "licensed under the eupl(?: version| v)? 1 1"),
    ("ms-pl", "microsoft", "microsoft public license(?: ms pl)?"),
    ("ms-rl", "microsoft", "microsoft reciprocal license(?: ms rl)?"),
    ("ncsa", "illinois", "university of illinois(?: ncsa)? open source license"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("php-3.01", "php", "subject to version 3 01 of the php license"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("beerware", "beer", "you think this stuff is worth it you can buy me a beer"),
    ("blueoak-1.0.0", "blue oak", "blue oak model license(?: version)? 1 0 0"),
    ("sspl-1.0", "server side", "server side public license(?: version)? 1"),
    ("busl-1.1", "business source", "business source license(?: version)? 1 1"),
    ("elastic-2.0", "elastic license", "elastic license(?: version)? 2 0"),
    ("cc-by-4.0", "creativecommons", "creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "creativecommons", "creativecommons org licenses by 3 0"),
    ("cc-by-sa-4.0", "creativecommons", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "creativecommons", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", "creativecommons", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nd-4.0", "creativecommons", "creativecommons org licenses by nd 4 0"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("proprietary", "confidential and proprietary", "(?:this (?:software|document) is )?(?:the )?confidential and proprietary (?:information|property) of"),
    ("all-rights-reserved", "rights reserved", "all rights reserved"),
]
TEXT_PRIORITY, TEXT_CONFIDENCE = 1, 0.98


def creative_commons() -> dict[str, tuple[str, str, str]]:
    """The six licences of each version, from their parts."""
    words = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
    names = {}
    for parts in ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa"):
        for version in ("2 0", "3 0", "4 0"):
            spelled = " ".join(words[p] for p in parts.split())
            name = f"(?:cc {parts}|creative commons {parts}|creative commons {spelled})(?: {version})"
            names[f"cc-{parts.replace(' ', '-')}-{version.replace(' ', '.')}"] = ("cc|creative commons", name, f"cc {parts} {version}")
    return names


def rules() -> list[Rule]:
    """The rules in order of priority: base phrases, sentences of texts and notices, then every form with every license."""
    made = [Rule(label, phrase, f" {phrase}", 0, 0.6, base=True) for phrase, label in BASE.items()]
    for label, (keywords, name, identifier) in {**NAMES, **creative_commons()}.items():
        for before, after, kind, priority, confidence in FORMS:
            pattern = f" {before}{name if kind == 'name' else identifier}{after}"
            keyword = identifier.split()[0] if kind == "id" else keywords.split("|")[0]
            made.append(Rule(label, keyword, pattern, priority, confidence))
            if kind == "name":
                made += [Rule(label, other, pattern, priority, confidence) for other in keywords.split("|")[1:]]
    made += [Rule(label, word, f" {words}", TEXT_PRIORITY, TEXT_CONFIDENCE) for label, word, words in TEXTS]
    return sorted(made, key=lambda r: r.priority)


def words_in(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def word_count(text: Column) -> Column:
    """Words of a raw text, without an array of them."""
    spaced = F.trim(F.regexp_replace(text, BETWEEN, " "))
    return let(spaced, lambda words: F.when(words == "", F.lit(0)).otherwise(words_in(words) + 1)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


RULES_SCHEMA = "array<struct<keyword:string,rules:array<struct<label:string,pattern:string,priority:int,confidence:double,base:boolean>>>>"


def rule_array(chosen: list[Rule]) -> Column:
    """Rules by keyword, so that a keyword is looked for once: structs of keyword and rules. One constant for the plan."""
    fields = lambda r: {"label": r.label, "pattern": r.pattern + "(?= )", "priority": r.priority, "confidence": r.confidence, "base": r.base}
    groups = [{"keyword": k, "rules": [fields(r) for r in chosen if r.keyword == k]} for k in sorted({r.keyword for r in chosen})]
    return F.from_json(F.lit(json.dumps(groups)), RULES_SCHEMA)


def outside_groups(pattern: str) -> str:
    """What every match of the pattern contains, whatever its groups add."""
    while (less := re.sub(r"\(\?:[^()]*\)(?:[?*+]|\{[^}]*\})?", "\n", pattern)) != pattern:
        pattern = less
    return pattern


def may_match(text: Column, chosen: list[Rule]) -> Column:
    """Whether the raw text has the words that some rule needs. What stands between words plays no part, so nothing that a
    rule matches is passed over. A rule needs "licen" or "under" where every match of it has them; else, and besides
    "under", the words of its keyword. A keyword of one short word counts as a whole word only."""

    def any_keyword(low: Column, keywords: set[str]) -> Column:
        short = sorted(k for k in keywords if " " not in k and len(k) <= 3)
        alone = {k for k in keywords if " " not in k and k not in short}
        # a longer word is found with one that it contains, a phrase with a word of it that counts alone
        alone = {k for k in alone if not any(o != k and o in k for o in alone)}
        phrases = sorted({tuple(sorted(k.split(), key=lambda w: (-len(w), w))) for k in keywords if " " in k and not any(a in w for a in alone for w in k.split())})
        tests = [F.contains(low, F.lit(k)) for k in sorted(alone)]
        tests += [reduce(Column.__and__, [F.contains(low, F.lit(w)) for w in words]) for words in phrases]
        if short:
            inner = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"
            tests.append(low.rlike(f"(?<!{inner})(?:{'|'.join(short)})(?!{inner})"))
        return reduce(Column.__or__, tests, F.lit(False))

    always = {r: outside_groups(r.pattern) for r in chosen}
    rest = [r for r in chosen if "licen" not in always[r]]
    under = {r.keyword for r in rest if " under " in always[r]}
    other = {r.keyword for r in rest if " under " not in always[r]}

    def found(low: Column) -> Column:
        some = any_keyword(low, other) | (F.contains(low, F.lit("under")) & any_keyword(low, under))
        return (F.contains(low, F.lit("licen")) | some) if len(rest) < len(chosen) else some

    return let(F.lower(text), found)


def detections(text: Column, chosen: list[Rule]) -> Column:
    """All places of all rules in ``text`` as structs of first (word, from 0), last, label, priority, confidence, base,
    ordered by first, longest first, then priority."""
    normal = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), NOT_WORD, " ")), F.lit(" "))

    def of_rule(words: Column, rule: Column) -> Column:
        # a mark in front of every match cuts the text; the words of the parts before a match count up to it
        parts = F.split(F.regexp_replace(words, rule["pattern"], F.lit(MARK + "$0")), MARK)
        ends = F.aggregate(
            F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
            F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<int>").alias("all")),
            lambda state, part: F.struct((state["at"] + words_in(part)).alias("at"), F.concat(state["all"], F.array(state["at"] + words_in(part))).alias("all")),
            lambda state: state["all"],
        )
        found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
        return F.zip_with(
            ends,
            found,
            lambda at, match: F.struct(
                at.alias("first"), (-(at + words_in(match) - 1)).alias("minus_last"), rule["priority"].alias("priority"), rule["label"].alias("label"),
                rule["confidence"].alias("confidence"), rule["base"].alias("base"),
            ),
        )

    def of_text(words: Column) -> Column:
        groups = F.filter(rule_array(chosen), lambda g: F.contains(words, F.concat(F.lit(" "), g["keyword"], F.lit(" "))))
        needed = F.flatten(F.transform(groups, lambda g: g["rules"]))
        return F.array_sort(F.flatten(F.transform(needed, lambda r: of_rule(words, r))))

    return F.when(may_match(text, chosen), let(normal, of_text))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", chosen: list[Rule] | None = None) -> DataFrame:
    """Per document: key, n_words, detections (array of structs, see ``detections``; null if no keyword occurs)."""
    body = text_of(text)
    return docs.select(key, word_count(body).alias("n_words"), detections(body, rules() if chosen is None else chosen).alias("found"))


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels ('' and score 0). score is the best confidence of a detection that
    stands. Rows are looked at one by one, so repeated rows give repeated results; nothing is shuffled.
    """
    none = F.array().cast("array<struct<first:int,minus_last:int,priority:int,label:string,confidence:double,base:boolean>>")
    rows = scan(docs, key, text).withColumn("found", F.coalesce("found", none))
    base = F.filter("found", lambda d: d["base"])
    # places in order, longest first: one that ends no later than an earlier one lies in it
    standing = F.aggregate(
        "found",
        F.struct(F.lit(-1).alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score")),
        lambda state, d: F.when(d["base"] | (-d["minus_last"] > state["reach"]), F.struct(
            F.greatest(state["reach"], -d["minus_last"]).alias("reach"),
            F.array_union(state["labels"], F.array(d["label"])).alias("labels"),
            F.greatest(state["score"], d["confidence"]).alias("score"),
        )).otherwise(state),
    )
    rows = rows.select("*", base.alias("base"), standing.alias("standing"))
    names = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.transform("base", lambda d: d["first"].cast("long"))
    return rows.select(
        key,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(F.transform("base", lambda d: d["label"])).alias("base_labels"),
        names(F.col("standing.labels")).alias("labels"),
        F.col("standing.score").alias("score"),
    )

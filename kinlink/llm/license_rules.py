"""Operator 8, licence scans by sentence rules; DataFrame functions only.

A text is put in a normal form (lower case, letters and digits of ASCII with
single spaces between, marks for sentence ends and line ends) and searched
for known licence sentences, which gives a sequence of sentence identifiers
in the order of the text.  Ordered rules then match runs of identifiers: the
rules are tried from the first on, and identifiers that a rule has matched
are used up, so a full licence text is not also reported as the shorter
notices inside it.  "All rights reserved" is the rule of last resort: it stands
only where no other licence was found and the text refers to none.

Sentences end at ``. ! ? ; :`` before white space and at blank lines.  A
known sentence may begin at any sentence end or line end, after up to
``LEAD`` other words (but no ``not``, ``never`` or ``no``), and line ends
inside it are spaces, so wrapped texts and unpunctuated lines are found in
the same text.  Notices (``licensed under ...``) may go on; other sentences
end at a sentence end or line end.  Spellings (``licence``, ``v2``, verbs of
notices) and the holder's name of a BSD text, of any length, are normalised
away; SPDX expressions and notices that name several licences (``MIT or
Apache-2.0``) become one sentence a licence, however many they are.  A heading
(``The MIT License (MIT)``) counts where it is a whole line.

Every known sentence has one of a few stems in it, so texts without any of
them are not searched at all.

Defined results: null and empty texts, and texts without a known sentence,
have no identifiers and no licences.  Null and repeated ids are rows of
their own.  Repeated sentences are repeated identifiers; a licence is named
once.  Texts of any length are searched whole; no expression here
recurses on a text.  Other columns of the table are not read.  An empty table
gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences in normal form, and their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "licensed under the apache license version 2 0": "apache-notice",
    "licensed under the apache license version 2 0 the license": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-warranty",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "licensed under cc by 4 0": "cc-by-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-notice",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-notice",
    "all rights reserved": "all-rights-reserved",
}

#: Ordered rules: a licence, and the run of identifiers that names it.
RULES = [
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-notice", "apache-compliance", "apache-warranty"]),
    ("ISC", ["isc-grant"]),
    ("GPL-3.0-or-later", ["gpl3-grant"]),
    ("GPL-2.0-or-later", ["gpl2-grant"]),
    ("MIT", ["mit-notice"]),
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("Unlicense", ["unlicense-notice"]),
]
#: Tried after all others, and only in texts without a match of ``REFERS``.
LAST = ("Proprietary", ["all-rights-reserved"])
_W = "[ \\t\\n\\r]+"
REFERS = (f"(governed|covered){_W}by{_W}(the|an?|its){_W}[^.]*licen[cs]e|licen[cs]ed{_W}under|under{_W}the{_W}terms{_W}of|licen[cs]e{_W}file|"
          f"spdx-license-identifier|see{_W}(the{_W})?(accompanying{_W}|included{_W})?[^a-z0-9 ]?licen[cs]e")

#: Every known sentence has one of these in it.
STEMS = ("licen", "reserved", "permission", "permitted", "warrant", "copyright", "redistribut", "unencumbered")

SENTENCE_END = r"\n|[.!?;:][ \t\n\r]+"
WRAPPED_END = r"\n[ \t\r]*\n|[.!?;:][ \t\n\r]+"


# Sentences beyond the table above: the SQL for DuckDB does not know them.
SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "CC0-1.0", "Unlicense", "MPL-2.0",
        "EPL-1.0", "EPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"]
GNU = {"GPL-2.0": ("general", "2"), "GPL-3.0": ("general", "3"), "LGPL-2.0": ("library general", "2"), "LGPL-2.1": ("lesser general", "2 1"),
       "LGPL-3.0": ("lesser general", "3"), "AGPL-3.0": ("affero general", "3")}
NOTICES = {
    "MIT": ["mit license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache license version 2", "apache 2 0", "apache version 2", "apache software license version 2 0"],
    "BSD-3-Clause": ["bsd 3 clause", "3 clause bsd", "new bsd license", "modified bsd license"],
    "BSD-2-Clause": ["bsd 2 clause", "2 clause bsd", "simplified bsd license"],
    "ISC": ["isc license"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license 1 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0", "mpl version 2 0"],
    "CC0-1.0": ["cc0 1 0", "creative commons zero version 1 0", "creative commons cc0 1 0"],
    "CC-BY-SA-4.0": ["a creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["a creative commons attribution noncommercial 4 0 international license"],
    "Unlicense": ["unlicense"],
}
#: Known where the sentence or line ends after them.
BARE = {"MIT": "mit", "ISC": "isc", "Zlib": "zlib"}
HEADINGS = {
    "MIT": ["mit license", "mit license mit", "expat license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache license version 2 0 january 2004"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "bsd 3 clause new or revised license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "bsd 2 clause simplified license"],
    "ISC": ["isc license", "isc license isc"],
    "Zlib": ["zlib license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license version 1 0 august 17th 2003"],
    "MPL-2.0": ["mozilla public license version 2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v 2 0"],
}
ALONE = {
    "Zlib": ["the origin of this software must not be misrepresented"],
    "CC0-1.0": ["has waived all copyright and related or neighboring rights", "has dedicated all copyright and related and neighboring rights",
                "have dedicated all copyright and related and neighboring rights"],
}


def _more() -> dict[str, tuple[str, str]]:
    """Sentence in normal form: its identifier and its licence."""
    out = {}
    for name in SPDX:
        out["spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower())] = ("spdx-" + name.lower(), name)
    for name, (kind, version) in GNU.items():
        short, plain = name.split("-")[0].lower(), re.sub("[^a-z0-9]+", " ", name.lower())
        later = name + "-or-later"
        for end, what in (("", name), (" only", name), (" or later", later)):
            out[f"spdx license identifier {plain}{end}"] = ("spdx-" + what.lower(), what)
        free = f"you can redistribute it and or modify it under the terms of the gnu {kind} public license"
        by = "as published by the free software foundation"
        names = [f"gnu {kind} public license version {version}", f"gnu {short} version {version}", f"{short} version {version}",
                 f"{short}v{version}", f"gnu {short}v{version}"]
        if kind == "library general":
            names = names[:1]
        names += [f"{x} 0" for x in names if " " not in version]
        for option in ("", " only"):
            for x in names:
                out[f"licensed under the {x}{option}"] = (f"{name.lower()}-notice", name)
        for option in ("or later", "or any later version", "or at your option any later version", "or newer"):
            for x in names:
                out[f"licensed under the {x} {option}"] = (f"{later.lower()}-notice", later)
        out[f"{free} {by} version {version} of the license"] = (f"{name.lower()}-grant", name)
        out[f"{free} version {version} {by}"] = out[f"{free} version {version} only {by}"] = (f"{name.lower()}-grant", name)
        out[f"{free} {by} either version {version} of the license or at your option any later version"] = (f"{later.lower()}-grant", later)
    for table, lead in ((NOTICES, "licensed under the "), (ALONE, "")):
        for name, phrases in table.items():
            for x in phrases:
                out[lead + x] = (f"{name.lower()}-notice", name)
    for name, x in BARE.items():
        out["licensed under the " + x] = (f"{name.lower()}-notice", name)
    for name, phrases in HEADINGS.items():
        for x in phrases:
            out[f"T {x}"] = (f"{name.lower()}-heading", name)
    return out


#: Replaced one after the other in the normal form, in which `` H`` marks sentence ends and `` S`` line ends.
GAP = "(?: S)* "
SAME = [
    ("licence", "license"),
    (" v ?([0-9])", " version $1"),
    (f"(?:released|distributed|made{GAP}available|available|published|licensed){GAP}under{GAP}(?:the{GAP})?(?:terms{GAP}of{GAP}(?:the{GAP})?)?(?!license )"
     f"(?:(?:either|both){GAP}(?:of{GAP})?(?:the{GAP})?)?", "licensed under the "),
    # N stands for the words before a holder's name, so the search for its end stops at the next one
    (f"neither{GAP}the{GAP}names?{GAP}of ", "N "),
    (f"N [^N]+? n?or{GAP}the{GAP}names?{GAP}of{GAP}(?:its|their|his|her|any){GAP}contributors",
     "neither the name of the copyright holder nor the names of its contributors"),
    ("N ", "neither the name of "),
]


def _same(key: str) -> str:
    key = f" {key} "
    for old, new in SAME:
        key = re.sub(old, new.replace("$", "\\"), key)
    return key.strip()


MORE = _more()
# what the first table has goes first: one identifier a sentence
KNOWN = {_same(k): i for k, (i, _) in MORE.items()} | {_same(k): i for k, i in SENTENCES.items()}
#: Rules of the identifiers of ``MORE``, in the order of the tables.
MORE_RULES = list({i: (n, [i]) for i, n in MORE.values()}.values())
#: Every sentence of ``MORE``, as texts spell it, has one of these in it.
MORE_STEMS = (*STEMS, "licence", "gpl", "apache", "mpl", "bsd", "cc0", "cc by", "cc-by", "misrepresented", "general public", "under mit", "under the mit", "under isc",
              "under zlib")
LEAD = 12


def _lists() -> list[tuple[str, str]]:
    """Replacements in the normal form of texts that cut lists of licences into sentences, and mark headings."""
    named = {k.removeprefix("licensed under the ") for k in KNOWN if k.startswith("licensed under the ")}
    phrase = "(?:" + "|".join(x.replace(" ", GAP) for x in sorted(named, key=lambda x: (-len(x), x))) + ")"
    heading = "|".join(k[2:] for k in sorted(KNOWN, key=lambda k: (-len(k), k)) if k.startswith("T "))
    # \\G goes on where the last match ended, so lists have no greatest length
    return [("(spdx license identifier |\\G)([^HS]*?) (?:or|and) (?!later)", "$1$2 H spdx license identifier "),
            (f"(licensed{GAP}under{GAP}the{GAP}|\\G)({phrase}(?:{GAP}license)?){GAP}(?:and{GAP}or|or|and){GAP}(?:the{GAP})?(?={phrase} )",
             "$1$2 H licensed under the "),
            (f"(?<=[HS] )(?:the )?({heading})(?= [HS])", "T $1")]


def _pattern() -> str:
    """Known sentences as one expression, longer ones first; group 1 is the sentence."""
    def any_of(keys: list[str]) -> str:
        return "|".join(k.replace(" ", GAP) for k in sorted(keys, key=lambda k: (-len(k), k)))

    bare = {f"licensed under the {x}" for x in BARE.values()} | {k for k in KNOWN if k.startswith("T ")}
    notice = [k for k in KNOWN if k not in bare and ("licensed under the " in k or k in MORE and not k.startswith("spdx"))]
    spdx = [k for k in KNOWN if k.startswith("spdx")]
    rest = [k for k in KNOWN if k not in notice and k not in spdx]
    return (f"(?<=[HS] )(?:(?!(?:not|never|no) )[a-z0-9]+{GAP}){{0,{LEAD}}}?"
            f"((?:{any_of(rest)})(?= [HS])|(?:{any_of(spdx)})(?= (?:[HS]|with) )|(?:{any_of(notice)})(?= )(?! [0-9] ))")


def _identifiers(low: Column) -> Column:
    """Known identifiers of a lower-case text, in order."""
    known = F.create_map(*(F.lit(x) for pair in KNOWN.items() for x in pair))
    text = F.regexp_replace(low, "license-identifier:[ \\t]*", "license-identifier ")
    text = F.regexp_replace(text, "(gpl-[0-9.]+)[+]", "$1-or-later")
    text = F.regexp_replace(F.regexp_replace(text, WRAPPED_END, " H "), "\n", " S ")
    text = F.concat(F.lit("H "), F.regexp_replace(text, "[^a-z0-9HS]+", " "), F.lit(" H "))
    text = F.regexp_replace(text, " +", " ")
    for old, new in (*SAME, *_lists()):
        text = F.regexp_replace(text, old, new)
    return F.transform(F.regexp_extract_all(text, F.lit(_pattern()), F.lit(1)), lambda s: F.element_at(known, F.regexp_replace(s, "(?: S)+", "")))


def find_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licenses`` of every row (lists comma-joined)."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    stem = F.lit(False)
    for s in MORE_STEMS:
        stem = stem | F.col("low").contains(s)
    none = F.array().cast("array<string>")
    ids = low.select("doc_id", F.coalesce(F.when(stem, _identifiers(F.col("low"))), none).alias("ids"),
                     F.coalesce(F.when(F.col("low").contains("reserved"), F.col("low").rlike(REFERS)), F.lit(False)).alias("refers"))
    # the rules one after the other: what a rule matches is named and used up
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit("".join(f"<{i}>" for i in run)).alias("run")) for n, run in (*RULES, *MORE_RULES, LAST)))
    begin = F.struct(F.concat_ws("", F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("left"), none.alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        last = (rule["name"] == LAST[0]) & ((F.size(state["names"]) > 0) | F.col("refers"))
        return (F.when(F.contains(state["left"], rule["run"]) & ~last,
                       F.struct(F.replace(state["left"], rule["run"], F.lit("<>")).alias("left"),
                                F.array_append(state["names"], rule["name"]).alias("names"))).otherwise(state))

    matched = F.when(F.size("ids") > 0, F.aggregate(rules, begin, apply)["names"]).otherwise(none)
    order = F.array(*map(F.lit, dict.fromkeys(n for n, _ in (*RULES, LAST, *MORE_RULES))))
    return (ids.withColumn("names", matched)
            .select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.concat_ws(",", "ids").alias("sentence_ids"),
                    F.when(F.size("names") > 0, F.concat_ws(",", F.filter(order, lambda n: F.array_contains("names", n))))
                    .otherwise(F.lit("")).alias("licenses")))


def duckdb_sql() -> str:
    """The same over a table ``documents``, for DuckDB, as far as whole sentences of ``SENTENCES`` go (without ``MORE``)."""
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    keys, values = (", ".join(map(text, x)) for x in (SENTENCES.keys(), SENTENCES.values()))
    stems = " OR ".join(f"contains(low, {text(s)})" for s in STEMS)

    def identifiers(ends: str) -> str:
        normal = f"list_transform(string_split_regex(low, E'{ends.replace(chr(92), chr(92) * 2)}'), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))"
        return f"list_transform(list_filter({normal}, lambda s: list_contains([{keys}], s)), lambda s: ([{values}])[list_position([{keys}], s)])"

    steps, seen = [], "ids0"
    for k, (_, run) in enumerate((*RULES, LAST)):
        pattern = text("".join(f"<{i}>" for i in run))
        steps.append(f"ids{k + 1} AS (SELECT *, contains(s{k}, {pattern}) AS r{k}, replace(s{k}, {pattern}, '<>') AS s{k + 1} FROM {seen})")
        seen = f"ids{k + 1}"
    names = []
    for name in dict.fromkeys(n for n, _ in RULES):
        hit = " OR ".join(f"r{k}" for k, (n, _) in enumerate(RULES) if n == name)
        names.append(f"CASE WHEN {hit} THEN {text(name)} END")
    others = " OR ".join(f"r{k}" for k in range(len(RULES)))
    names.append(f"CASE WHEN r{len(RULES)} AND NOT ({others}) AND NOT refers THEN {text(LAST[0])} END")
    return f"""
        WITH low AS (SELECT doc_id, lower(text) AS low FROM documents),
        cut AS (SELECT doc_id, coalesce(regexp_matches(low, E{text(REFERS.replace(chr(92), chr(92) * 2))}), false) AS refers, CASE WHEN {stems} THEN {identifiers(SENTENCE_END)} END AS line,
                       CASE WHEN {stems} THEN {identifiers(WRAPPED_END)} END AS wrapped FROM low),
        ids0 AS (SELECT doc_id, refers, ids, coalesce(list_aggregate(list_transform(ids, lambda i: '<' || i || '>'), 'string_agg', ''), '') AS s0
                 FROM (SELECT doc_id, refers, coalesce(CASE WHEN len(wrapped) > len(line) THEN wrapped ELSE line END, []) AS ids FROM cut)),
        {", ".join(steps)}
        SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(list_aggregate(ids, 'string_agg', ','), '') AS sentence_ids,
               concat_ws(',', {", ".join(names)}) AS licenses
        FROM {seen}
    """

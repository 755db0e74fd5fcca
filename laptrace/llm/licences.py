"""Licence scan by sentence rules, in native expressions.

A text is cut into sentences, each is normalised, known sentences become identifiers, and the
identifiers of a text in order are matched against ordered rules of licences.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts, after normalisation.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but "
                    "not limited to the warranties of merchantability fitness for a particular purpose and "
                    "noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other "
                     "liability whether in an action of contract tort or otherwise arising from out of or in "
                     "connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                 "is hereby granted provided that the above copyright notice and this permission notice appear in "
                 "all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this "
                    "software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
                 "provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions "
                  "and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
                  "and the following disclaimer in the documentation and or other materials provided with the "
                  "distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license "
                    "is distributed on an as is basis without warranties or conditions of any kind either express or "
                    "implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-free": "this program is free software",
    "gpl2-later": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                  "published by the free software foundation either version 2 of the license or at your option any "
                  "later version",
    "gpl3-later": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                  "published by the free software foundation either version 3 of the license or at your option any "
                  "later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "rights": "all rights reserved",
}
# Names under which notices refer to licences, by SPDX identifier.
NAMES = {
    "MIT": ["mit license", "mit licence", "mit"],
    "ISC": ["isc license", "isc"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"],
    "GPL-2.0-only": ["gnu general public license version 2", "gpl version 2", "gplv2"],
    "GPL-3.0-only": ["gnu general public license version 3", "gpl version 3", "gplv3"],
    "LGPL-3.0-only": ["gnu lesser general public license version 3", "lgplv3"],
    "AGPL-3.0-only": ["gnu affero general public license version 3", "agplv3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "CC0-1.0": ["cc0 1 0", "creative commons zero v1 0 universal"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"],
}
#: The same sentences as public texts have them, with what a line break or a mark keeps together.
VERBATIM = {
    "notice:Apache-2.0": ["licensed under the apache license version 2 0 the license"],
    # in a block of comments no empty line parts the address from what follows
    "apache-basis": [f"{SENTENCES['apache-copy']} {scheme} www apache org licenses license 2 0 {SENTENCES['apache-basis']}"
                     for scheme in ("http", "https")],
    "gpl2-later": ["either version 2 of the license or at your option any later version"],
    "gpl3-later": ["either version 3 of the license or at your option any later version"],
    "mpl-copy": [f"{SENTENCES['mpl-copy']} {scheme} mozilla org mpl 2 0" for scheme in ("http", "https")],
}
NOTICES = ["licensed under {0}", "licensed under the {0}", "released under the {0}", "released under {0}",
           "distributed under the {0}", "published under the {0}", "available under the {0}",
           "this work is licensed under the {0}", "this work is licensed under {0}",
           "this work is licensed under a {0}", "this project is licensed under the {0}",
           "this software is licensed under the {0}", "this file is licensed under the {0}"]
#: Ordered rules: licence, name of the rule, identifiers that must follow one another, gaps allowed.
RULES = [
    ("MIT", "text", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("MIT", "grant", ["mit-grant", "mit-notice"]),
    ("ISC", "text", ["isc-grant", "isc-warranty"]),
    ("BSD-3-Clause", "text", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", "text", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", "header", ["notice:Apache-2.0", "apache-comply", "apache-basis", "apache-see"]),
    ("Apache-2.0", "short header", ["notice:Apache-2.0", "apache-comply"]),
    ("GPL-2.0-or-later", "header", ["gpl-free", "gpl2-later", "gpl-hope"]),
    ("GPL-3.0-or-later", "header", ["gpl-free", "gpl3-later", "gpl-hope"]),
    ("MPL-2.0", "header", ["mpl-form", "mpl-copy"]),
    ("Unlicense", "text", ["unlicense"]),
    *[(licence, "notice", [f"notice:{licence}"]) for licence in NAMES],
    ("proprietary", "notice", ["rights"]),
]
#: Licences that only rules over sentences name, and that an SPDX tag can name too.
TAGGED = ["GPL-2.0-or-later", "GPL-3.0-or-later", "Unlicense"]
TAG_RULES = [(licence, "notice", [f"notice:{licence}"]) for licence in TAGGED]
#: Every known sentence holds one of these parts of words, so texts without any need no closer look.
ANCHORS = "licen[sc]|permission|warrant|liab|distribut|released|published|available|software|domain|reserved|mpl"

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BOUNDARY, LETTERS = r"([.!?;:])[\t-\r ]+|\n[\t-\r ]*\n", r"[^\p{L}\p{N}]+"
#: The mark of a version ends no sentence; a tag is a sentence to the end of its line.
VERSION, TAG = r"\b([vV]\.)[\t-\r ]+(?=[0-9])", r"(?i)\bSPDX-License-Identifier:[\t ]*([^\n\r]*)"
#: What a tag becomes, and what parts the licences of its expression.
TAG_WORDS, TAG_PARTS = "spdx license identifier ", r"(?i)[() \t]+(?:or|and)[() \t]+"
TAG_REST = r"(?i)[ \t]with[ \t].*"


def sentences() -> dict[str, str]:
    """Identifier of every known sentence by its normalised text."""
    found = {text: name for name, text in SENTENCES.items()}
    for licence, names in NAMES.items():
        forms = [n.format(name) for n in NOTICES for name in names]
        found |= {form: f"notice:{licence}" for form in forms}
        spdx = re.sub(r"[^a-z0-9]+", " ", licence.lower()).strip()
        found[f"spdx license identifier {spdx}"] = f"notice:{licence}"
    assert all(re.search(ANCHORS, text) for text in found)
    return found


def verbatim() -> dict[str, str]:
    """The same with the sentences of public texts and the tags of all licences."""
    found = sentences() | {text: name for name, texts in VERBATIM.items() for text in texts}
    for licence in TAGGED:
        spdx = re.sub(r"[^a-z0-9]+", " ", licence.lower()).strip()
        found[f"{TAG_WORDS}{spdx}"] = f"notice:{licence}"
    assert all(re.search(ANCHORS, text) for text in found)
    return found


def rule_pattern(parts: list[str]) -> str:
    return "".join(rf",{p},(?:.*)" for p in parts).removesuffix("(?:.*)")


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWERED), LETTERS, " "))


def _tagged(sentence: Column) -> Column:
    """A sentence as an array; a tag as one sentence for each licence of its expression."""
    stated = F.substring(sentence, F.lit(len(TAG_WORDS) + 1), F.length(sentence))
    named = F.transform(F.split(stated, TAG_PARTS), lambda x: F.concat(
        F.lit(TAG_WORDS), F.regexp_replace(x, TAG_REST, "")))
    return F.when(F.startswith(sentence, F.lit(TAG_WORDS)), named).otherwise(F.array(sentence))


def known_sentences(text: Column) -> Column:
    """Identifiers of a text's known sentences in order.

    Sentences end behind a mark and blanks or at an empty line; a sentence over several lines is
    looked up as a whole and then line by line.  An SPDX tag is looked up before its colon can cut it, each
    licence of its expression by itself.
    """
    text = F.regexp_replace(text, VERSION, "$1")
    text = F.regexp_replace(text, TAG, f"\x01{TAG_WORDS}$1\x01")
    marked = F.regexp_replace(text, BOUNDARY, "$1\x01")
    whole = F.filter(F.split(marked, "\x01"), lambda s: F.translate(s, UPPER, LOWERED).rlike(ANCHORS))
    with_lines = F.flatten(F.transform(whole, lambda s: F.when(
        F.contains(s, F.lit("\n")), F.concat(F.array(s), F.split(s, "\n"))).otherwise(F.array(s))))
    with_lines = F.flatten(F.transform(with_lines, _tagged))
    table = F.create_map(*[F.lit(x) for pair in verbatim().items() for x in pair])
    return F.filter(F.transform(with_lines, lambda s: F.element_at(table, normalised(s))), lambda i: i.isNotNull())


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_known, sentence_ids, licences, rules for every row.

    ``sentence_ids`` are the known sentences in order; ``licences`` the licences whose rules match, in
    the order of the rules, and ``rules`` the first matching rule of each, all joined by commas.

    SPDX tags in their standard form ("SPDX-License-Identifier: MIT OR Apache-2.0") count as notices of their licences.

    Null, empty and unlicensed texts have 0 known sentences and empty strings; ids are passed on as
    they are, nulls and repeats included; other columns are not looked at; an empty table gives an
    empty result.  Row by row, no shuffle.
    """
    value = F.col("text")
    possible = F.coalesce(F.translate(value, UPPER, LOWERED).rlike(ANCHORS), F.lit(False))
    none = F.array().cast("array<string>")
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).select(
        "doc_id", F.when(possible, known_sentences(value)).otherwise(none).alias("ids"))
    # every identifier between commas of its own, so that rules meet whole identifiers
    line = F.concat_ws("", F.transform("ids", lambda i: F.concat(F.lit(","), i, F.lit(","))))
    listed = found.withColumn("line", line)
    hits = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(name).alias("rule"),
                              F.col("line").rlike(rule_pattern(parts)).alias("hit")) for licence, name, parts in RULES + TAG_RULES])
    matched = F.filter(hits, lambda r: r["hit"])
    first = F.filter(matched, lambda r, i: ~F.exists(
        F.slice(matched, F.lit(1), i), lambda e: e["licence"] == r["licence"]))
    out = listed.withColumn("matched", F.when(F.size("ids") > 0, first))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_known"), F.concat_ws(",", "ids").alias("sentence_ids"),
        F.coalesce(F.concat_ws(",", F.transform("matched", lambda r: r["licence"])), F.lit("")).alias("licences"),
        F.coalesce(F.concat_ws(",", F.transform("matched", lambda r: r["rule"])), F.lit("")).alias("rules"))


def scan_sql() -> str:
    """The same in DuckDB's SQL over ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(t)}, {quote(i)})" for t, i in verbatim().items())
    rules = ", ".join(f"({n}, {quote(licence)}, {quote(name)}, {quote(rule_pattern(parts))})"
                      for n, (licence, name, parts) in enumerate(RULES + TAG_RULES))
    lower = f"translate({{0}}, '{UPPER}', '{LOWERED}')"
    version = VERSION.replace("(?=[0-9])", "([0-9])")  # there is no looking ahead
    tidy = f"regexp_replace(text, '{version}', '\\1\\2', 'g')"
    tagged = f"regexp_replace({tidy}, '{TAG}', chr(1) || '{TAG_WORDS}\\1' || chr(1), 'g')"
    return f"""
with known(sentence, id) as (values {known}), rules(n, licence, name, pattern) as (values {rules}),
cut as (
    select doc_id, string_split(regexp_replace({tagged}, '{BOUNDARY}', '\\1' || chr(1), 'g'), chr(1)) as parts
    from documents where text is not null
), whole as (select doc_id, unnest(parts) as s, unnest(range(len(parts))) as i from cut),
lines as (
    select doc_id, i, 0 as j, s from whole
    union all
    select doc_id, i, unnest(range(1, len(string_split(s, chr(10))) + 1)) as j, unnest(string_split(s, chr(10))) as s
    from whole where contains(s, chr(10))
), stated as (
    select doc_id, i, j, case when starts_with(s, '{TAG_WORDS}')
      then list_transform(string_split_regex(substr(s, {len(TAG_WORDS) + 1}), '{TAG_PARTS}'),
                          lambda x: '{TAG_WORDS}' || regexp_replace(x, '{TAG_REST}', '', 'g'))
      else [s] end as forms from lines
), formed as (select doc_id, i, j, unnest(forms) as s, unnest(range(len(forms))) as part from stated
), found as (
    select doc_id, i, j, part, k.id from formed
    join known k on k.sentence = trim(regexp_replace({lower.format("s")}, '{LETTERS}', ' ', 'g'))
), listed as (
    select doc_id, count(*) as n_known, string_agg(id, ',' order by i, j, part) as ids,
           string_agg(',' || id || ',', '' order by i, j, part) as line
    from found group by doc_id
), matched as (
    select doc_id, n, licence, name, row_number() over (partition by doc_id, licence order by n) as place
    from listed, rules where regexp_matches(line, pattern)
), named as (
    select doc_id, string_agg(licence, ',' order by n) as licences, string_agg(name, ',' order by n) as rules
    from matched where place = 1 group by doc_id
)
select d.doc_id, coalesce(l.n_known, 0) as n_known, coalesce(l.ids, '') as sentence_ids,
       coalesce(m.licences, '') as licences, coalesce(m.rules, '') as rules
from documents d left join listed l on d.doc_id = l.doc_id left join named m on d.doc_id = m.doc_id
"""

"""Licence scans by sentence rules: a text's sentences are normalised and mapped to identifiers of known licence sentences;
the sequence of identifiers is then matched against ordered rules, the more specific first, each match using up its part.

A sentence may be wrapped over lines, with comment marks before them. Sentences that name a licence ("this project is licensed
under the X") and tags are made from a table of names by rule. The SQL has the same table, but for the longest wordings, and
compares single lines; on texts whose licence sentences stand on one line each, both find the same.

Everything happens inside the row with built-in functions: no shuffle, and the tables of sentences and rules are fixed.

Edge cases: null and blank texts have no sentences and no licence; empty tables give no rows; texts of any length are read whole. The same licence named twice is counted twice. Sentences
between two identifiers that are not known licence sentences do not break a sequence. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common

# Known licence sentences in normal form (lower case, letters and digits, single spaces) by identifier.
SENTENCES = {
    "gpl3 name": "this work is licensed under the gnu general public license version 3",
    "gpl2 name": "this work is licensed under the gnu general public license version 2",
    "gpl free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl2 or later": "either version 2 of the license or at your option any later version",
    "gpl3 or later": "either version 3 of the license or at your option any later version",
    "gpl hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl name": "this library is licensed under the gnu lesser general public license version 2 1",
    "agpl name": "this work is licensed under the gnu affero general public license version 3",
    "mit name": "released under the mit license",
    "mit grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as is": "the software is provided as is without warranty of any kind",
    "apache2 name": "licensed under the apache license version 2 0",
    "apache2 use": "you may not use this file except in compliance with the license",
    "apache2 copy": "you may obtain a copy of the license at",
    "bsd grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2 name": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc by": "licensed under cc by 4 0",
    "cc by sa": "licensed under cc by sa 4 0",
    "cc by nc": "licensed under cc by nc 4 0",
    "cc by nd": "licensed under cc by nd 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
    "lgpl free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl21 or later": "either version 2 1 of the license or at your option any later version",
    "lgpl hope": "this library is distributed in the hope that it will be useful but without any warranty",
    "lgpl copy": "you should have received a copy of the gnu lesser general public license along with this library",
    "agpl free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "agpl copy": "you should have received a copy of the gnu affero general public license along with this program",
    "gpl3 only": "version 3 of the license",
    "isc grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc as is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache2 basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mpl2 copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl2 copy s": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "epl2 terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "boost grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib as is": "this software is provided as is without any express or implied warranty",
    "zlib grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "unlicense use": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "wtfpl": "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
}
# Names of licences in normal form, by identifier.
NAMES = {
    "MIT": ("mit license",), "ISC": ("isc license",), "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"), "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "Apache-2.0": ("apache license 2 0", "apache license version 2 0", "apache 2 0 license"), "GPL-2.0-only": ("gnu general public license version 2", "gpl 2 0 license"), "GPL-3.0-only": ("gnu general public license version 3", "gpl 3 0 license"),
    "LGPL-2.1-only": ("gnu lesser general public license version 2 1",), "LGPL-3.0-only": ("gnu lesser general public license version 3",), "AGPL-3.0-only": ("gnu affero general public license version 3",),
    "MPL-2.0": ("mozilla public license 2 0", "mozilla public license version 2 0"), "EPL-2.0": ("eclipse public license 2 0", "eclipse public license version 2 0"), "BSL-1.0": ("boost software license version 1 0", "boost software license"),
    "CC-BY-4.0": ("creative commons attribution 4 0 international license",), "CC-BY-SA-4.0": ("creative commons attribution sharealike 4 0 international license",), "CC-BY-NC-4.0": ("creative commons attribution noncommercial 4 0 international license",),
    "CC-BY-ND-4.0": ("creative commons attribution noderivatives 4 0 international license",), "CC0-1.0": ("creative commons zero v1 0 universal license",), "Unlicense": ("unlicense",), "Zlib": ("zlib license",), "WTFPL": ("wtfpl",),
    "GPL-2.0-or-later": (), "GPL-3.0-or-later": (), "LGPL-2.1-or-later": (), "LGPL-3.0-or-later": (), "AGPL-3.0-or-later": (),
}
#: A name stands in these sentences, with an article or without; an identifier in a tag of its own line.
FORMS = ("licensed under {}", "released under {}", "distributed under {}", "available under {}", *(f"this {w} is licensed under {{}}" for w in ("project", "software", "work", "library", "program", "package", "file")))


# Ordered rules, the first match wins and uses up its identifiers.
RULES = (
    ("GPL-2.0-or-later", ("gpl free", "gpl2 or later", "gpl hope", "gpl copy")),
    ("GPL-3.0-or-later", ("gpl free", "gpl3 or later", "gpl hope", "gpl copy")),
    ("GPL-2.0-or-later", ("gpl free", "gpl2 or later")),
    ("GPL-3.0-or-later", ("gpl free", "gpl3 or later")),
    ("LGPL-2.1-or-later", ("lgpl free", "lgpl21 or later", "lgpl hope", "lgpl copy")),
    ("LGPL-3.0-or-later", ("lgpl free", "gpl3 or later", "lgpl hope", "lgpl copy")),
    ("AGPL-3.0-or-later", ("agpl free", "gpl3 or later", "gpl hope", "agpl copy")),
    ("LGPL-2.1-or-later", ("lgpl free", "lgpl21 or later")),
    ("LGPL-3.0-or-later", ("lgpl free", "gpl3 or later")),
    ("AGPL-3.0-or-later", ("agpl free", "gpl3 or later")),
    ("ISC", ("isc grant", "isc as is")),
    ("ISC", ("isc grant",)),
    ("0BSD", ("0bsd grant", "isc as is")),
    ("MIT", ("mit grant", "mit notice", "as is")),
    ("MIT", ("mit grant", "mit notice")),
    ("BSD-3-Clause", ("bsd grant", "bsd source", "bsd binary", "bsd endorse", "bsd disclaimer")),
    ("BSD-3-Clause", ("bsd grant", "bsd source", "bsd binary", "bsd endorse")),
    ("BSD-2-Clause", ("bsd grant", "bsd source", "bsd binary", "bsd disclaimer")),
    ("BSD-2-Clause", ("bsd grant", "bsd source", "bsd binary")),
    ("Apache-2.0", ("apache2 name", "apache2 use", "apache2 copy", "apache2 basis")),
    ("Apache-2.0", ("apache2 name", "apache2 use", "apache2 copy")),
    ("Apache-2.0", ("apache2 name", "apache2 use")),
    ("GPL-3.0-only", ("gpl3 name",)),
    ("GPL-2.0-only", ("gpl2 name",)),
    ("LGPL-2.1-only", ("lgpl name",)),
    ("AGPL-3.0-only", ("agpl name",)),
    ("MIT", ("mit name",)),
    ("Apache-2.0", ("apache2 name",)),
    ("MPL-2.0", ("mpl2 name", "mpl2 copy")),
    ("MPL-2.0", ("mpl2 name", "mpl2 copy s")),
    ("MPL-2.0", ("mpl2 name",)),
    ("EPL-2.0", ("epl2 terms",)),
    ("BSL-1.0", ("boost grant",)),
    ("Zlib", ("zlib as is", "zlib grant")),
    ("CC-BY-NC-4.0", ("cc by nc",)),
    ("CC-BY-SA-4.0", ("cc by sa",)),
    ("CC-BY-ND-4.0", ("cc by nd",)),
    ("CC-BY-4.0", ("cc by",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense", "unlicense use")),
    ("Unlicense", ("unlicense",)),
    ("WTFPL", ("wtfpl",)),
    ("All-Rights-Reserved", ("reserved",)),
    *((spdx, (f"{spdx} named",)) for spdx in NAMES),  # by name or tag
)
# Full standard wordings of known sentences, by identifier, besides those above. The SQL knows only those above.
FULL = (
    ("mit grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("as is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache2 name", "licensed under the apache license version 2 0 the license"),
    ("apache2 copy", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache2 copy", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
)
def named() -> list[tuple[str, str]]:
    """(identifier, sentence) of every licence's name in every form and of its tag, but for those listed above."""
    taken, out = {*SENTENCES.values(), *(s for _, s in FULL)}, {}
    for spdx, names in NAMES.items():
        found = [f.format(article + n) for n in names for f in FORMS for article in ("the ", "a ", "")]
        tag = " ".join("".join(c if c.isalnum() else " " for c in spdx.lower()).split())
        for s in (*found, f"spdx license identifier {tag}"):
            if s not in taken:
                out.setdefault(s, f"{spdx} named")
    return [(name, s) for s, name in out.items()]


#: A cheap test goes before the rest; between its words anything may stand that is no letter or digit.
HINT = r"(?i)licen[sc]e|wtfpl|redistribut|permission|warranty|copyright|public domain|rights reserved|later version|free software|copy of the".replace(" ", r"[^\p{L}\p{N}]+")
#: How a text is brought into normal form, step by step: comment marks and bullets at the start of lines go; the full stop of
#: 'v.' counts as a line end; one of .!?; before white space and blank lines become a bar. A line end may stand inside a
#: sentence or end it, a bar only ends it. In the GPL the semicolon
#: after 'free software' ends no sentence, and the part from 'either version' on is a sentence of its own.
STEPS = (
    (r"\n(?:[^\p{L}\p{N}\n]*(?:[0-9]{1,2}|[a-z])\)(?=[ \t]))?[^\p{L}\p{N}\n]*", "\n"),
    (r"(?<=(?<![\p{L}\p{N}])v\.)[ \x09-\x0D]+", "\n"),
    (r"(?<=[.!?;])(?<!(?<![\p{L}\p{N}])v\.)[ \x09-\x0D]+|\n{2,}", "|"),
    (r"[^\p{L}\p{N}|\n]+", " "),
    (r"((?:program|library)[ \n]+is[ \n]+free[ \n]+software) ?\|(?= ?you[ \n]+can[ \n]+redistribute)", "$1\n"),
    (r"(free[ \n]+software[ \n]+foundation)[ \n]+(?=either[ \n]+version )", "$1|"),
)
NAMED = named()
KNOWN = (*((name, s) for name, s in SENTENCES.items()), *FULL, *NAMED)
SENTENCE = r"(?<=(?:^|[|\n]) ?)(?:" + "|".join(s.replace(" ", r"[ \n]+") for _, s in KNOWN) + r")(?= ?(?:[|\n]|\z))"
RESTRICTED = ("GPL-2.0-or-later", "GPL-3.0-or-later", "GPL-2.0-only", "GPL-3.0-only", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "All-Rights-Reserved")


def sentence_ids(text: Column) -> Column:
    """The identifiers of a text's known licence sentences, in order."""
    ids = F.create_map(*[F.lit(x) for name, s in KNOWN for x in (s, name)])
    normal = F.translate(common.ascii_lower(text), "|", " ")
    for pattern, by in STEPS:
        normal = F.regexp_replace(normal, pattern, by)
    found = F.transform(F.regexp_extract_all(normal, F.lit(SENTENCE), F.lit(0)), lambda s: F.element_at(ids, F.regexp_replace(s, r"[ \n]+", " ")))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column) -> Column:
    """A struct of `rest` and of `found`: rules are tried in order, each uses up every place where its sequence stands."""
    # brackets delimit identifiers; a match leaves a bar, so that what surrounds it doesn't join up
    start = F.struct(F.concat_ws("", F.transform(ids, lambda x: F.concat(F.lit("["), x, F.lit("]")))).alias("rest"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"[{x}]" for x in names)).alias("key")) for name, names in RULES])

    def use(state: Column, rule: Column) -> Column:
        left = F.replace(state["rest"], rule["key"], F.lit("|"))
        times = (F.length(state["rest"]) - F.length(left)) / (F.length(rule["key"]) - 1)
        return F.struct(left.alias("rest"), F.concat(state["found"], F.array_repeat(rule["name"], times.cast("int"))).alias("found"))

    return F.aggregate(rules, start, use)


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: known sentences in order, licences found, sentences left over, and whether any restricts use."""
    df = documents.select(F.col(id_col).alias("doc_id"), sentence_ids(common.text_or_empty(F.col(text_col))).alias("sentences"))
    none = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("found"))
    df = df.withColumn("m", F.when(F.size("sentences") > 0, match_rules(F.col("sentences"))).otherwise(none))
    out = df.select("doc_id", "sentences", F.sort_array("m.found").alias("licenses"), F.regexp_count("m.rest", F.lit(r"\[")).cast("long").alias("n_unmatched"))
    return out.withColumn("restricted", F.arrays_overlap("licenses", F.array(*[F.lit(x) for x in RESTRICTED])) & (F.size("licenses") > 0))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("sentences", ",").alias("sentences"), F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"), "n_unmatched", "restricted")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def op2_sql() -> str:
    """DuckDB SQL of op2: the same sentence table and the same ordered rules, by lists."""
    table = [*SENTENCES.items(), *NAMED]
    names = ", ".join(_quoted(s) for _, s in table)
    ids = ", ".join(_quoted(n) for n, _ in table)
    rest, found = "array_to_string(list_transform(sentences, lambda x: '[' || x || ']'), '')", []
    steps = [f"r0 as (select doc_id, sentences, {rest} as rest from known)"]
    for k, (_, rule) in enumerate(RULES):
        key = "".join(f"[{x}]" for x in rule)
        prior = "".join(f", n{j}" for j in range(k))
        steps.append(f"r{k + 1} as (select doc_id, sentences, replace(rest, '{key}', '|') as rest{prior}, (length(rest) - length(replace(rest, '{key}', ''))) // {len(key)} as n{k} from r{k})")
        found.append(f"list_resize([]::varchar[], n{k}, '{RULES[k][0]}')")
    restricted = ", ".join(_quoted(x) for x in RESTRICTED)
    return f"""
with parts as (
  select doc_id, unnest(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?;])[ \t\x0B-\r]+', '\\1' || chr(10), 'g'), chr(10))) as s,
         generate_subscripts(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?;])[ \t\x0B-\r]+', '\\1' || chr(10), 'g'), chr(10)), 1) as k
  from documents),
normal as (select doc_id, k, trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as s from parts),
hits as (select doc_id, list(([{ids}])[list_position([{names}], s)] order by k) as sentences from normal where s in ({names}) group by doc_id),
known as (select d.doc_id, coalesce(h.sentences, []::varchar[]) as sentences from documents d left join hits h on h.doc_id = d.doc_id),
{", ".join(steps)},
done as (select doc_id, sentences, rest, list_sort({" || ".join(found)}) as licenses from r{len(RULES)})
select doc_id, len(sentences)::bigint as n_sentences, coalesce(array_to_string(sentences, ','), '') as sentences, len(licenses)::bigint as n_licenses,
       coalesce(array_to_string(licenses, ','), '') as licenses, (length(rest) - length(replace(rest, '[', '')))::bigint as n_unmatched, list_has_any(licenses, [{restricted}]) as restricted
from done"""

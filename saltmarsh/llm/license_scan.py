"""Licence texts in documents, by a positional index over their rare words.

Templates are word sequences with a label and a mandatory phrase: whole short licences, the notices of long ones, and bare names. Of each template
the index has the RARE words of its mandatory phrase that stand in fewest documents (highest inverse document frequency, counted over all
documents), with postings: template and place of the word in it; base phrases are indexed with all their words. A document looks up every
indexed word it has. Each place of such a word and each of its postings name one start at which the template would have to stand;
a start that two different words name is verified: the mandatory phrase word by word, and the score is the share of the template's words
that stand in their places.

Wherever a mandatory phrase stands, all its indexed words stand too and name one start, so no licence is missed, however many a document has.

Texts are read once: their words become numbers of the templates' vocabulary, which are stored, and the rest works on those. Everything is DataFrame
functions over one row's arrays: no shuffle but that of a few counts, so rows keep their identity.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between the words of a text whose letters A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: First and last + 1 place of the mandatory phrase.
    start: int
    stop: int
    base: bool = False


def template(label: str, text: str, phrase: str, base: bool = False) -> Template:
    words, must = tuple(text.split()), tuple(phrase.split())
    start = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
    return Template(label, words, start, start + len(must), base)


MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software
to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the
authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
connection with the software or the use or other dealings in the software"""
BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or
other materials provided with the distribution"""
BSD_END = """this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied
warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct
indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or
business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way
out of the use of this software even if advised of the possibility of such damage"""
BSD_THIRD = """3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission"""
ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and
this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied
warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever
resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or
performance of this software"""
ZLIB = """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this
software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to
the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a
product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must not be
misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution"""
UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either
in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or
authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law"""
BOOST = """permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the
software is furnished to do so all subject to the following"""
APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at
http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"""
GPL = """this program is free software you can redistribute it and or modify it under the terms of the gnu {0} public license as published by the free software foundation
either version {1} of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even
the implied warranty of merchantability or fitness for a particular purpose see the gnu {0} public license for more details"""
MPL = """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at
https mozilla org mpl 2 0"""

#: Base phrases; names with their versions; and public licences or their notices, as they are published, in words.
TEMPLATES = (
    template("mit", "mit license", "mit license", True),
    template("apache", "apache license", "apache license", True),
    template("gpl", "general public license", "general public license", True),
    template("mit-notice", "released under the mit license", "under the mit license"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("gpl-2.0", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    template("mit-text", MIT, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    template("bsd-2-text", f"{BSD} {BSD_END}", "redistributions in binary form must reproduce the above copyright notice"),
    template("bsd-3-text", f"{BSD} {BSD_THIRD} {BSD_END}", "neither the name of the copyright holder nor the names of its contributors"),
    template("isc-text", ISC, "permission to use copy modify and or distribute this software for any purpose"),
    template("zlib-text", ZLIB, "the origin of this software must not be misrepresented"),
    template("unlicense-text", UNLICENSE, "free and unencumbered software released into the public domain"),
    template("boost-text", BOOST, "free of charge to any person or organization obtaining a copy"),
    template("apache-2.0-text", APACHE, "licensed under the apache license version 2 0"),
    template("gpl-3.0-text", GPL.format("general", "3"), "gnu general public license as published by the free software foundation either version 3"),
    template("gpl-2.0-text", GPL.format("general", "2"), "gnu general public license as published by the free software foundation either version 2"),
    template("lgpl-text", GPL.format("lesser general", "3"), "gnu lesser general public license as published by"),
    template("agpl-text", GPL.format("affero general", "3"), "gnu affero general public license as published by"),
    template("mpl-2.0-text", MPL, "subject to the terms of the mozilla public license v 2 0"),
)
#: A template counts where at least this share of its words stands in place.
SHARE = 0.5
#: Words of a template's mandatory phrase in the index; two of them must name a start.
RARE = 3
#: Where a start, a template and a word are within one long.
WORD_BITS, START_BITS, LOWEST = 12, 36, 1 << 20


def document_words(text: Column | str) -> Column:
    """The words of a whole text; none for null."""
    lower = F.translate(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, BETWEEN), lambda w: w != "")


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    """The templates' words; those that stand in them most often come first, as they are the likeliest to be looked for."""
    many = Counter(w for t in templates for w in t.words)
    return sorted(many, key=lambda w: (-many[w], w))


def numbered(docs: DataFrame, known: list[str]) -> DataFrame:
    """doc_id and ids: for each word of a text its place in ``known``, or -1."""
    return docs.select("doc_id", F.transform(document_words("text"), lambda w: F.when(w.isin(known), F.array_position(_strings(known), w) - 1).otherwise(-1).cast("short")).alias("ids"))


def frequencies(numbers: DataFrame, known: list[str]) -> dict[str, int]:
    """In how many documents each of the templates' words stands. What reaches the driver is one count for each of those words."""
    met = numbers.select(F.explode(F.array_distinct("ids")).alias("w")).where("w >= 0").groupBy("w").count()
    return dict.fromkeys(known, 0) | {known[r["w"]]: r["count"] for r in met.collect()}


def indexed(templates: tuple[Template, ...], df: dict[str, int], rare: int = RARE) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """The index's words, rarest first, and the postings (template, place) of each."""

    def rank(w: str) -> tuple[int, str]:
        return df[w], w

    phrases = [set(t.words[t.start : t.stop]) for t in templates]
    chosen = [p if t.base else set(sorted(p, key=rank)[: max(2, rare)]) for t, p in zip(templates, phrases, strict=True)]
    if any(len(c) < 2 for c in chosen):
        raise ValueError("a mandatory phrase needs two different words")
    names = sorted(set().union(*chosen), key=rank)
    return names, [[(k, i) for k, t in enumerate(templates) if name in chosen[k] for i in range(t.start, t.stop) if t.words[i] == name] for name in names]


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, share: float = SHARE, rare: int = RARE) -> DataFrame:
    """docs' doc_id with n_words, n_base, first_word, last_word, base_labels, labels, score and hits.

    ``hits``: label, start, share of each template found, in order of place. ``n_base`` counts all places of base phrases,
    ``first_word`` and ``last_word`` are their least and greatest start (null without any), labels are distinct, sorted and joined by
    commas ('' without any), ``score`` is the greatest share found (0 without any). A null or empty text has no words. Each row
    of docs gives one row, whatever its doc_id; other columns are ignored; an empty table gives no rows.
    """
    known = vocabulary(templates)
    number = {w: k for k, w in enumerate(known)}
    words = Scratch(docs.sparkSession, "licences").store(numbered(docs, known), "ids")
    names, postings = indexed(templates, frequencies(words, known), rare)
    looked = [number[n] for n in names]
    # by a word's number: template, start and rank of each posting, in one long
    by_number = {number[name]: F.array(*[F.lit((k << START_BITS + WORD_BITS) + (LOWEST - at << WORD_BITS) + r) for k, at in p]) for r, (name, p) in enumerate(zip(names, postings, strict=True))}
    starts_of = F.array(*[by_number.get(i, F.array().cast("array<long>")) for i in range(len(known))])
    bodies = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.array(*[F.lit(number[w]).cast("short") for w in t.words]).alias("ids"), F.lit(t.start).alias("from"), F.lit(t.stop).alias("to")) for t in templates])
    some = F.exists("ids", lambda w: w.isin(looked))
    places = F.filter(F.transform("ids", lambda w, i: F.when(w.isin(looked), F.struct(w.alias("w"), i.alias("i")))), lambda p: p.isNotNull())
    rows = words.select("doc_id", "ids", F.when(some, places).otherwise(F.array().cast("array<struct<w:short,i:int>>")).alias("places"))
    # template, start and word in one long, for each posting of each place looked up
    named = F.flatten(F.transform("places", lambda p: F.transform(F.get(starts_of, p["w"].cast("int")), lambda c: c + F.shiftleft(p["i"].cast("long"), WORD_BITS))))
    rows = rows.select("doc_id", "ids", F.array_sort(F.array_distinct(named)).alias("named"))

    def at(i: Column) -> Column:
        """Template and start."""
        return F.shiftright(F.get("named", i), WORD_BITS)

    # the second word of each run of words that name one start
    twice = F.filter("named", lambda c, i: F.coalesce(F.shiftright(c, WORD_BITS) == at(i - 1), F.lit(False)) & ~F.coalesce(F.shiftright(c, WORD_BITS) == at(i - 2), F.lit(False)))
    rows = rows.select("doc_id", "ids", F.transform(twice, lambda c: F.shiftright(c, WORD_BITS)).alias("starts"))

    def hit(c: Column) -> Column:
        t, start = F.get(bodies, F.shiftright(c, START_BITS).cast("int")), (c.bitwiseAND(F.lit((1 << START_BITS) - 1)) - LOWEST).cast("int")
        # get() gives null outside the document
        fits = F.transform(t["ids"], lambda w, j: F.coalesce(F.get("ids", start + j) == w, F.lit(False)))
        return F.struct(start.alias("start"), t["label"].alias("label"), t["base"].alias("base"), t["from"].alias("from"), t["to"].alias("to"), fits.alias("fits"))

    def judged(h: Column) -> Column:
        must = F.forall(F.slice(h["fits"], h["from"] + 1, h["to"] - h["from"]), lambda x: x)
        return F.struct(h["start"].alias("start"), h["label"].alias("label"), h["base"].alias("base"), must.alias("must"), (F.size(F.filter(h["fits"], lambda x: x)) / F.size(h["fits"])).alias("share"))

    rows = rows.select("doc_id", F.size("ids").cast("long").alias("n_words"), F.transform("starts", hit).alias("met"))
    rows = rows.select("doc_id", "n_words", F.array_sort(F.filter(F.transform("met", judged), lambda h: h["must"] & (h["share"] >= share))).alias("hits"))
    base_hits = F.filter("hits", lambda h: h["base"])
    starts = F.transform(base_hits, lambda h: h["start"].cast("long"))

    def joined(hits: Column | str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    return rows.select(
        "doc_id",
        "n_words",
        F.size(base_hits).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base_hits).alias("base_labels"),
        joined("hits").alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0)).alias("score"),
        F.transform("hits", lambda h: F.struct(h["label"].alias("label"), h["start"].alias("start"), h["share"].alias("share"))).alias("hits"),
    )


def scan_sql(templates: tuple[Template, ...] = TEMPLATES, share: float = SHARE, rare: int = RARE) -> str:
    """The same result in DuckDB: the index, the starts that two words name, and their verification as joins."""
    postings = ", ".join(f"('{t.label}', {str(t.base).lower()}, {k}, {len(t.words)}, {t.start}, {t.stop}, {i}, '{w}')" for k, t in enumerate(templates) for i, w in enumerate(t.words))
    return f"""
WITH t(label, base, k, size, lo, hi, place, w) AS (VALUES {postings}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM d),
v AS (SELECT p.* FROM p SEMI JOIN t USING (w)),
f AS (SELECT w, coalesce(n, 0) AS n FROM (SELECT DISTINCT w FROM t) LEFT JOIN (SELECT w, count(DISTINCT doc_id) AS n FROM v GROUP BY w) USING (w)),
x AS (SELECT k, w FROM (SELECT DISTINCT k, w, base FROM t WHERE place >= lo AND place < hi) JOIN f USING (w) QUALIFY base OR row_number() OVER (PARTITION BY k ORDER BY n, w) <= {max(2, rare)}),
s AS (SELECT v.doc_id, k, v.i - t.place AS start FROM v JOIN x USING (w) JOIN t USING (k, w) WHERE t.place >= t.lo AND t.place < t.hi GROUP BY ALL HAVING count(DISTINCT v.w) >= 2),
h AS (SELECT s.doc_id, any_value(label) AS label, any_value(base) AS base, s.k, start, count(*) / any_value(size)::DOUBLE AS share, count(*) FILTER (place >= lo AND place < hi) = any_value(hi - lo) AS must
      FROM s JOIN t USING (k) JOIN v ON v.doc_id = s.doc_id AND v.w = t.w AND v.i = s.start + t.place GROUP BY s.doc_id, s.k, start),
g AS (SELECT * FROM h WHERE must AND share >= {share}),
a AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM g GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN a USING (doc_id)"""

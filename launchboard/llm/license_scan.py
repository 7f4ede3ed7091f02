"""License scan: lines and word windows compared to license templates by Dice
coefficient.

Lines and templates are normalised (lower case, runs of other characters than
letters and digits become one space) and compared as sets of word bigrams:

    dice = 2 * common / (line bigrams + template bigrams) >= MIN_DICE.

A template of t bigrams can reach the limit d only with lines of t * d / (2 - d) to
t * (2 - d) / d bigrams. These size bounds prune lines and, per line, templates;
a matching line also holds one of ``telling_parts``, so lines without any of these go
before anything is built. The templates are a fixed, small list that becomes part of
the expression: there is no join, no shuffle and no Python.

Notices that are wrapped over lines or stand inside a line are found as windows of the
whole text's words, line ends being like other spaces. Windows are compared with
``TEMPLATES`` and ``PASSAGES`` (paragraphs of headers and of full license texts). A best
window begins and ends with a bigram of its template, as others at its edges only lower
the coefficient, so all windows between two such bigrams, of at most the size bound,
are compared. Of overlapping windows the best stays (then the longest, then the
alphabetically last license). A window is left out if it touches a matching line of the
same license or of no lower coefficient. Its ``line`` is that of its first word.

Defined cases: null and empty texts have no line that matches; a line of one word
has no bigram and matches nothing; repeated lines and rows are each reported; a null
id is reported as null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_DICE = 0.7

# Short notices that name a license, and headers of licenses.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License."),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation."),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files"),
    "proprietary": ("All rights reserved.",),
}

# Paragraphs, for windows only: headers of several lines, and what full texts of
# licenses hold. The Apache, GPL and Creative Commons texts are recognised by their
# opening and main clauses.
PASSAGES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
        "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a "
        "perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license "
        "to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, "
        "and distribute the Work and such Derivative Works in Source or Object form."),
    "BSD-3-Clause": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission."),
    "CC-BY-4.0": (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the "
        "terms and conditions of this Creative Commons Attribution 4.0 International Public License",),
    "CC-BY-NC-4.0": (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the "
        "terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International "
        "Public License",),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "The GNU General Public License is a free, copyleft license for software and other kinds of "
        "works."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
}


def template_bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, dice: float) -> tuple[int, int]:
    return math.ceil(n * dice / (2 - dice) - 1e-9), math.floor(n * (2 - dice) / dice + 1e-9)


def telling_parts(grams: list[str], dice: float) -> set[str]:
    """Parts of which a line that reaches ``dice`` has at least one. It shares c or
    more of the template's bigrams, so it has one of any (all - c + 1) of them:
    those with the longest words are taken, and of each its longer word, or the
    bigram itself where both words are short."""
    least, _ = size_bounds(len(grams), dice)
    common = math.ceil(dice * (least + len(grams)) / 2 - 1e-9)
    longer = lambda g: max(g.split(" "), key=lambda w: (len(w), w))
    chosen = sorted(grams, key=lambda g: (-len(longer(g)), g))[:len(grams) - common + 1]
    return {longer(g) if len(longer(g)) >= 5 else g for g in chosen}


def line_words(line: Column) -> Column:
    """Words of a line; empty for a line without letters or digits."""
    clean = F.trim(F.regexp_replace(F.lower(line), "[^a-z0-9]+", " "))
    return F.when(clean != "", F.split(clean, " ")).otherwise(F.array().cast("array<string>"))


def bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                       F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def least_common(n: int, dice: float) -> int:
    """Bigrams of a template of ``n`` that any match of it holds."""
    return math.ceil(dice * (size_bounds(n, dice)[0] + n) / 2 - 1e-9)


def names_any(text: Column, known: list[tuple[str, list[str]]], dice: float) -> Column:
    """Whether the lower-case text holds a telling part of a template."""
    telling = sorted(set().union(*(telling_parts(grams, dice) for _, grams in known)))
    return functools.reduce(operator.or_, [
        text.rlike(t.replace(" ", "[^a-z0-9]+")) if " " in t else text.contains(t) for t in telling])


def document_parts(known: list[tuple[str, list[str]]], dice: float) -> list[str]:
    """Few parts of which any match holds at least one: words (or bigrams of short
    words) such that of no template so many bigrams are without them as a match needs.
    Words that many templates share, and long ones, are taken first."""
    parts = lambda g: {w for w in g.split(" ") if len(w) >= 5} or {g}
    left = [(len(grams) - least_common(len(grams), dice) + 1, set(grams)) for _, grams in known]
    chosen = []
    while left := [(need, grams) for need, grams in left if need > 0]:
        gain: dict[str, float] = {}
        for need, grams in left:
            count: dict[str, int] = {}
            for part in (x for g in grams for x in parts(g)):
                count[part] = count.get(part, 0) + 1
            for part, n in count.items():
                gain[part] = gain.get(part, 0) + min(n, need) * (
                    0.3 if " " in part else 1 if len(part) >= 7 else 0.4)
        best = max(gain, key=lambda x: (gain[x], x))
        chosen.append(best)
        left = [(need - len(of), grams - of) for need, grams in left
                for of in [{g for g in grams if best in parts(g)}]]
    return [x for x in sorted(chosen) if not any(y != x and y in x for y in chosen)]


def may_match(text: Column, known: list[tuple[str, list[str]]], dice: float) -> Column:
    """Whether a text can hold a match at all; it is lower-cased once."""
    return F.exists(F.array(F.lower(text)), lambda small: functools.reduce(operator.or_, [
        small.rlike(t.replace(" ", "[^a-z0-9]+")) if " " in t else small.contains(t)
        for t in document_parts(known, dice)]))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def windows(text: Column, lines: list[tuple[str, list[str]]], known: list[tuple[str, list[str]]],
            min_dice: float) -> Column:
    """Array of (line, license, dice) of the windows of ``text`` to report: matches of
    ``known`` that no match of a whole line, by ``lines``, stands for."""
    def table(templates):
        return F.array(*(F.struct(
            F.lit(name).alias("license"), F.array(*map(F.lit, grams)).alias("grams"),
            F.lit(least_common(len(grams), min_dice)).alias("common"),
            *(F.lit(x).alias(c) for c, x in zip(("least", "most"), size_bounds(len(grams), min_dice))))
            for name, grams in templates))

    def dice(grams, t):
        return 2.0 * F.size(F.array_intersect(grams, t["grams"])) / (
            F.size(F.array_distinct(grams)) + F.size(t["grams"]))

    def of_template(t, places, grams):
        def between(a, b):
            part = F.slice(grams, a["at"] + 1, b["at"] - a["at"] + 1)
            return F.struct(dice(part, t).alias("dice"), (b["at"] - a["at"]).alias("size"),
                            t["license"].alias("license"), a["at"].alias("start"), b["at"].alias("end"))
        return let(F.filter(places, lambda p: F.array_contains(t["grams"], p["gram"])), lambda own: F.flatten(
            F.transform(own, lambda a, i: let(
                F.filter(F.slice(own, i + 1, t["most"]), lambda b: b["at"] < a["at"] + t["most"]),
                lambda ends: F.filter(
                    F.transform(F.when(F.size(ends) >= t["common"], F.filter(
                        ends, lambda b: b["at"] >= a["at"] + t["least"] - 1)).otherwise(F.slice(ends, 1, 0)),
                        lambda b: between(a, b)),
                    lambda w: w["dice"] >= min_dice)))))

    def found(grams):
        common = F.array_intersect(grams, F.array(*map(F.lit, sorted({g for _, x in known for g in x}))))
        return let(common, lambda held: let(
            F.filter(F.transform(grams, lambda g, i: F.struct(i.alias("at"), g.alias("gram"))),
                     lambda p: F.array_contains(held, p["gram"])),
            lambda places: F.flatten(F.transform(
                F.filter(table(known), lambda t: F.size(F.array_intersect(held, t["grams"])) >= t["common"]),
                lambda t: of_template(t, places, grams)))))

    def line_match(line):
        """Best (dice, license) of a whole line, null without one."""
        return let(bigrams(line_words(line)), lambda grams: F.array_max(F.filter(
            F.transform(table(lines), lambda t: F.struct(dice(grams, t).alias("dice"), t["license"].alias("license"))),
            lambda m: m["dice"] >= min_dice)))

    def best_of(hits):
        # windows of bigrams that share a word overlap
        return let(F.reverse(F.array_sort(hits)), lambda best: F.aggregate(best, F.slice(best, 1, 0), lambda out, w: F.when(
            F.exists(out, lambda o: (o["start"] <= w["end"] + 1) & (w["start"] <= o["end"] + 1)),
            out).otherwise(F.concat(out, F.array(w)))))

    def reported(best, line_of, split):
        touched = F.array_distinct(F.flatten(F.transform(
            best, lambda w: F.sequence(line_of(w["start"]), line_of(w["end"] + 1)))))
        matched = F.filter(F.transform(touched, lambda i: F.struct(
            i.alias("line"), line_match(F.get(split, i)).alias("match"))), lambda m: m["match"].isNotNull())
        new = let(matched, lambda stated: F.filter(best, lambda w: ~F.exists(stated, lambda m: (
            m["line"].between(line_of(w["start"]), line_of(w["end"] + 1))
            & ((m["match"]["license"] == w["license"]) | (m["match"]["dice"] >= w["dice"]))))))
        return F.transform(new, lambda w: F.struct(
            line_of(w["start"]).alias("line"), w["license"].alias("license"), w["dice"].alias("dice")))

    split = F.split(text, "\n")
    words = F.flatten(F.transform(split, lambda x, i: F.transform(
        line_words(x), lambda w: F.struct(w.alias("word"), i.alias("line")))))
    return let(words, lambda w: let(
        F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                   lambda a, b: F.concat_ws(" ", a["word"], b["word"])),
        lambda grams: let(best_of(found(grams)), lambda best: reported(best, lambda at: F.get(w, at)["line"], split))))


def scan_licenses(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None,
                  min_dice: float = MIN_DICE,
                  passages: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(doc_id, line, license, dice) per line that matches a template, ``line`` from
    0, with its best license; of equally good ones the alphabetically last. Then the
    same per window that matches a template or passage and no such line stands for;
    own templates go without ``PASSAGES`` unless ``passages`` are given too."""
    if passages is None:
        passages = {} if templates else PASSAGES
    known = [(name, grams) for name, texts in sorted((templates or TEMPLATES).items())
             for grams in map(template_bigrams, texts) if grams]
    longer = [(name, grams) for name, texts in sorted(passages.items())
              for grams in map(template_bigrams, texts) if grams]
    bounds = [size_bounds(len(grams), min_dice) for _, grams in known]
    any_gram = F.array(*(F.lit(g) for g in sorted({g for _, grams in known for g in grams})))
    least, most = min(lo for lo, _ in bounds), max(hi for _, hi in bounds)
    lines = docs.where(may_match(F.col("text"), known, min_dice)).select("doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("line", "__text"))
    # a line of w words has at most w - 1 distinct bigrams, and at least 1 of them
    # is in a template; short lines go before anything is built
    small = F.lower("__text")
    sized = (lines.where((F.length("__text") >= 3 * least) & names_any(small, known, min_dice))
             .withColumn("__words", line_words(F.col("__text")))
             .where(F.size("__words") > least)
             .withColumn("__grams", bigrams(F.col("__words")))
             .where(F.size("__grams").between(least, most) & F.arrays_overlap("__grams", any_gram)))
    n = F.size("__grams")
    fits = [F.when(n.between(lo, hi), F.struct(
        (2.0 * F.size(F.array_intersect("__grams", F.array(*map(F.lit, grams)))) / (n + len(grams))).alias("dice"),
        F.lit(name).alias("license")))
        for (name, grams), (lo, hi) in zip(known, bounds)]
    whole = (sized.withColumn("__best", F.array_max(F.array_compact(F.array(*fits))))
            .where(F.col("__best.dice") >= min_dice)
            .select("doc_id", "line", F.col("__best.license").alias("license"), F.col("__best.dice").alias("dice")))
    inside = (docs.select("doc_id", "text").where(may_match(F.col("text"), known + longer, min_dice))
              .select("doc_id", F.explode(windows(F.col("text"), known, known + longer, min_dice)).alias("__w"))
              .select("doc_id", "__w.line", "__w.license", "__w.dice"))
    return whole.unionByName(inside)


def oracle_sql(templates: dict[str, tuple[str, ...]] | None = None, min_dice: float = MIN_DICE) -> str:
    """DuckDB SQL for ``scan_licenses`` over ``documents``, without any pruning."""
    rows = ", ".join(
        f"('{name}', [{', '.join(repr(g) for g in grams)}])"
        for name, texts in sorted((templates or TEMPLATES).items())
        for grams in map(template_bigrams, texts) if grams)
    return f"""
with templates(license, grams) as (values {rows}),
numbered as (select row_number() over () as row, doc_id, text from documents where text is not null),
lines as (
  select row, doc_id, unnest(string_split(text, chr(10))) as line_text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as line
  from numbered),
words as (
  select row, doc_id, line,
         string_split(trim(regexp_replace(lower(line_text), '[^a-z0-9]+', ' ', 'g')), ' ') as w
  from lines),
grams as (
  select row, doc_id, line, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) as g
  from words where len(w) > 1),
scores as (
  select row, doc_id, line, license,
         2.0::double * len(list_intersect(g, t.grams)) / (len(g) + len(t.grams)) as dice
  from grams, templates t)
select doc_id, line::int as line, license, dice
from scores where dice >= {min_dice}
qualify row_number() over (partition by row, line order by dice desc, license desc) = 1"""

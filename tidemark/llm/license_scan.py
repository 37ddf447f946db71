"""Licence scan in DataFrame functions: an n-gram model with an unknown class, confirmed by templates.

A multinomial logistic regression over binary word n-grams (1 to 3 words) is
fitted on windows of public licence notices, one class for each family, and on
all ordinary paragraphs of the corpus and sentences with licence words as the
unknown class.  Paragraphs that look the same to the model are one row with
their number; their weights are scaled so that a large corpus doesn't drown the
notices.  A threshold on the probability is calibrated on all paragraphs of
the kind that is scored and that the fit has not seen, a fifth by hash.  A prediction stands
only if the paragraph also shares enough n-grams with a template of that
family; otherwise the paragraph is unknown.

Every line with two neighbouring words of some template is scored.  The model
reads single words, too; the comparison counts pairs and triples of words only,
so no other line could be confirmed.  Words are looked up by hash, n-grams by a
broadcast of the weights and templates, whose number follows from the tables
below and not from the data.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

# Public notices of licence families.
TEMPLATES: list[tuple[str, str]] = [
    ("agpl", "This program is licensed under the GNU Affero General Public License, version 3 or later."),
    ("agpl", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "This project is released under the Apache License 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd", "This software is licensed under the BSD 3-Clause License."),
    ("bsd", "Released under the 2-clause BSD license."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("cc0", "This work has been dedicated to the public domain under CC0 1.0."),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "Released under the GNU General Public License version 2 or later."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("isc", "This software is licensed under the ISC License."),
    ("lgpl", "This library is free software licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "You can redistribute it under the terms of the GNU Lesser General Public License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mit", "Released under the MIT License."),
    ("mit", "This software is licensed under the terms of the MIT License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "Licensed under the Mozilla Public License 2.0."),
    ("reserved", "All rights reserved."),
    ("reserved", "Copyright the author. All rights reserved. No part may be reproduced without permission."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
SHORT = {
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "apache": ["Apache-2.0"], "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "cc-by": ["CC-BY-4.0"], "cc-by-nc": ["CC-BY-NC-4.0"], "cc-by-sa": ["CC-BY-SA-4.0"], "cc0": ["CC0-1.0"],
    "gpl": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"], "isc": ["ISC"], "lgpl": ["LGPL-2.1-only", "LGPL-2.1-or-later"], "mit": ["MIT"], "mpl": ["MPL-2.0"], "unlicense": ["Unlicense"],
}
TEMPLATES += [(f, f"{start} {x}") for f, names in SHORT.items() for x in names for start in ("SPDX-License-Identifier:", "Available under")]
TEMPLATES += [(f, f"{start} {x}.") for f, x in (("cc-by", "CC BY 4.0"), ("cc-by-nc", "CC BY-NC 4.0"), ("cc-by-sa", "CC BY-SA 4.0"), ("cc0", "CC0 1.0")) for start in ("Distributed under", "Released under")]
# Longer paragraphs of the same public licences.
TEMPLATES += [
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache", "See the License for the specific language governing permissions and limitations under the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("isc", "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library."),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit", "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
# Sentences with licence words that name no family above.
OTHER: list[str] = [
    "Please read the license before you install the program.", "Licensed under the terms agreed with the customer.", "A driving licence is needed for this work.",
    "The public license office is open until five.", "Permission was granted by the town.", "The copyright notice is on the last page.", "This work was released in the spring.",
    "Licensed under a private contract, version 7.", "The general public was free to enter.", "Rights were reserved for members.", "The warranty covers parts for two years.",
    "Released under the name of another author.", "Distribution of the paper is not permitted.",
    "Licensed under the Open Software License.", "Distributed under the terms of the Example Company Software License.", "All rights reserved by the office of the town.", "All rights in the land are reserved to the crown.",
    "The work was released to the public by the museum.", "This software is licensed to the customer named in the contract.", "Subject to the terms of the agreement with the publisher.", "You may not use this road without the permission of the owner.",
    "A copy of the licence was sent to the applicant.", "He was licensed under the act of 1902.", "The conditions are met in every case.", "Available under the counter.", "The copyright holder of the song is not known.",
]
UNKNOWN = "unknown"
WEIGHT = 4_000  # paragraphs that all ordinary ones together count as in training, at most
ORDINARY = 0.3  # paragraphs that share less with every template are surely ordinary
FALSE_ALARMS = 0.01  # share of unseen ordinary paragraphs that may pass the threshold
STEPS = 1 << 12  # probabilities of these are counted in so many steps
SHARED = 0.6  # pairs and triples of words in common with a template, of the smaller side, from which a prediction is confirmed

Model = tuple[DataFrame, DataFrame, float]


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def _runs(w: Column, n: int, make) -> Column:
    """``make`` of each run of ``n`` elements, none if there are fewer."""
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: make(*[F.get(w, i + k) for k in range(n)]))
    return F.when(F.size(w) >= n, runs)


def word_ngrams(text: Column) -> Column:
    """Distinct n-grams of 1 to 3 words as text."""
    grams = lambda w: F.concat(*[F.coalesce(_runs(w, n, lambda *x: F.concat_ws(" ", *x)), F.array().cast("array<string>")) for n in (1, 2, 3)])
    return F.array_distinct(F.flatten(F.transform(F.array(words(text)), grams)))


def gram_hashes(text: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Hashes of the distinct n-grams of ``sizes`` words."""
    grams = lambda w: F.concat(*[F.coalesce(_runs(w, n, F.xxhash64), F.array().cast("array<bigint>")) for n in sizes])
    return F.array_distinct(F.flatten(F.transform(F.array(words(text)), grams)))


def _template_words() -> list[list[str]]:
    return [re.findall("[a-z0-9]+", t.lower()) for _, t in TEMPLATES]


def neighbour_hashes(spark: SparkSession) -> list[int]:
    """Hashes of all pairs of neighbouring words in templates, some hundred numbers."""
    pairs = sorted({(a, b) for w in _template_words() for a, b in zip(w, w[1:], strict=False)})
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    return [r.h for r in spark.range(1).select(F.inline(rows)).select(F.xxhash64("a", "b").alias("h")).collect()]


def has_neighbours(text: Column, known: list[int]) -> Column:
    """Whether two neighbouring words of ``text`` are neighbours in a template."""
    some = lambda w: F.exists(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i)).isin(known))
    # the outer exists names the words, so that they are split once
    return F.exists(F.array(F.split(F.lower(text), "[^a-z0-9]+")), lambda w: F.coalesce(some(w), F.lit(False)))


def _templates(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(f).alias("family"), F.lit(t).alias("text")) for i, (f, t) in enumerate(TEMPLATES)])
    return spark.range(1).select(F.inline(rows))


def _windows(templates: DataFrame) -> DataFrame:
    """Whole notices and their runs of 5 to 12 words, with the family."""
    w = templates.withColumn("w", F.split("text", " "))
    cut_at = F.expr("inline(flatten(transform(array(5, 8, 12), n -> transform(sequence(1, greatest(size(w) - n + 1, 1), 2), i -> struct(i as at, n as len)))))")
    parts = w.select("family", "w", cut_at).select("family", F.expr("array_join(slice(w, at, len), ' ')").alias("text"))
    return templates.select("family", "text").union(parts).distinct()


def _cases(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, pos, line, h of the lines to be scored."""
    each = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return written(each.where(has_neighbours(F.col("line"), neighbour_hashes(docs.sparkSession))).withColumn("h", F.xxhash64("line")).distinct())


def _wordings(cases: DataFrame) -> DataFrame:
    """h, line, shares: of each family that has pairs or triples of words in common with the line, the largest share with one of its templates.

    A share is of the smaller side, which is taken to have three of them at
    least, so that two common words are no notice.
    """
    lines = cases.groupBy("h").agg(F.min("line").alias("line"))  # each wording once, however often it stands
    grams = lines.select("h", gram_hashes(F.col("line"), (2, 3)).alias("grams")).select("h", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    shapes = _templates(cases.sparkSession).select("t", "family", gram_hashes(F.col("text"), (2, 3)).alias("grams")).select("t", "family", F.size("grams").alias("t_size"), F.explode("grams").alias("gram"))
    common = grams.join(F.broadcast(shapes), "gram").groupBy("h", "t").agg(F.count("*").alias("c"), F.first("family").alias("family"), F.first("size").alias("size"), F.first("t_size").alias("t_size"))
    share = F.col("c") / F.greatest(F.least("size", "t_size"), F.lit(3))
    best = common.groupBy("h", "family").agg(F.max(share).alias("share")).groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("family", "share"))).alias("shares"))
    return written(lines.join(best, "h"))


def _ordinary(wordings: DataFrame, counts: CountVectorizerModel) -> DataFrame:
    """x, unseen, n: how many ordinary wordings have the same known n-grams and are, or aren't, left to calibration."""
    best = F.array_max(F.map_values("shares"))
    lines = wordings.where(best < ORDINARY).select(word_ngrams(F.col("line")).alias("grams"), _unseen(F.col("line")).alias("unseen")).where(F.size("grams") > 0)
    return counts.transform(lines).groupBy("x", "unseen").agg(F.count("*").alias("n"))


def _unseen(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(5)) == 0


def _threshold(sure: DataFrame) -> float:
    """The lowest step that paragraphs of at most ``FALSE_ALARMS`` of the weight reach, of p and weight; the driver gets a row a step."""
    steps = sure.groupBy(F.ceil(F.col("p") * STEPS).alias("step")).agg(F.sum("weight").alias("weight")).collect()
    left = FALSE_ALARMS * sum(r.weight for r in steps)
    for r in sorted(steps, reverse=True):
        left -= r.weight
        if left < 0:
            return r.step / STEPS  # p lies at or below its step
    return 0.0


def _fit(spark: SparkSession, wordings: DataFrame, weight: float) -> Model:
    singles = sorted({x for w in _template_words() for x in w})
    other = spark.range(1).select(F.explode(F.array(*map(F.lit, OTHER + singles))).alias("text")).select(F.lit(UNKNOWN).alias("family"), "text")
    index = F.array_position(F.array(*map(F.lit, classes())), F.col("family")) - 1
    given = _windows(_templates(spark)).unionByName(other).select("family", word_ngrams(F.col("text")).alias("grams"), index.cast("double").alias("y"), _unseen(F.col("text")).alias("unseen")).where(F.size("grams") > 0)
    given = written(given)
    named = given.where(F.col("family") != UNKNOWN).select("grams").unionByName(other.select(word_ngrams(F.col("text")).alias("grams")))
    counts = CountVectorizer(inputCol="grams", outputCol="x", binary=True, vocabSize=1 << 14).fit(named)
    plain = written(_ordinary(wordings, counts))
    each = min(1.0, weight / max(plain.agg(F.sum("n").alias("n")).first().n or 0, 1))
    unknown = float(len(classes()) - 1)
    rows = counts.transform(given).select("x", "y", "unseen", F.lit(1.0).alias("weight")).unionByName(plain.select("x", F.lit(unknown).alias("y"), "unseen", (F.col("n") * F.lit(each)).alias("weight")))
    seen = rows.where(~F.col("unseen") | (F.col("y") != unknown))
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", family="multinomial", regParam=0.002, maxIter=80).fit(seen)
    # how sure of a family the model is of paragraphs of the unknown class that it hasn't seen
    surest = F.array_max(F.slice(vector_to_array(F.col("probability")), 1, len(classes()) - 1))
    sure = _threshold(model.transform(rows.where(F.col("unseen") & (F.col("y") == unknown))).select(surest.alias("p"), "weight"))
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = spark.createDataFrame([(g, [float(x) for x in w[:, i]]) for i, g in enumerate(counts.vocabulary)], "gram string, w array<double>")
    g = F.split("gram", " ")
    hashed = F.when(F.size(g) == 1, F.xxhash64(g[0])).when(F.size(g) == 2, F.xxhash64(g[0], F.get(g, F.lit(1)))).otherwise(F.xxhash64(g[0], F.get(g, F.lit(1)), F.get(g, F.lit(2))))
    return written(weights.select(hashed.alias("gram"), "w")), spark.range(1).select(F.array(*[F.lit(float(x)) for x in b]).alias("b")), max(0.5, sure)


def train(docs: DataFrame, weight: float = WEIGHT) -> Model:
    """Weights (gram, a hash, and w), intercepts (one row, b) and the probability threshold; columns follow ``classes()``.

    The unknown class is ``OTHER``, the single words of the templates (such a
    text shares all it has with a template), and ordinary lines: all that would
    be scored and share less than ``ORDINARY`` with every template, each wording
    once.  If there are more than ``weight``, together they count as so many.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _fit(docs.sparkSession, _wordings(_cases(d)), weight)


def classes() -> list[str]:
    return [*sorted({f for f, _ in TEMPLATES}), UNKNOWN]


def scan_paragraphs(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each paragraph with two neighbouring words of a template: doc_id, row_hash, pos, line, predicted, probability, shared, family.

    ``family`` is the confirmed family or ``unknown``: when the probability is
    below the calibrated threshold or no template of the predicted family
    shares enough.  A paragraph is a line; ``pos`` counts from 0.

    Edge cases: null and empty texts have no row; a very long text is split
    where it is read, a very long line scored whole; rows that repeat an id are
    told apart by ``row_hash``, rows that repeat id and text give their
    paragraphs once; null ids stay null; ties between families go to the first
    by name; other columns are ignored; an empty table gives no rows.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cases = _cases(d)
    wordings = _wordings(cases)
    weights, bias, threshold = model or _fit(docs.sparkSession, wordings, WEIGHT)
    k = len(classes())
    found = wordings.select("h", F.explode(gram_hashes(F.col("line"))).alias("gram")).join(F.broadcast(weights), "gram")
    sums = found.groupBy("h").agg(*[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(k)])
    logits = wordings.select("h", "shares").join(sums, "h", "left").crossJoin(F.broadcast(bias)).select("h", "shares", F.array(*[F.coalesce(f"s{i}", F.lit(0.0)) + F.col("b")[i] for i in range(k)]).alias("z"))
    shifted = logits.withColumn("e", F.expr("transform(z, v -> exp(v - array_max(z)))"))
    names = F.array(*map(F.lit, classes()))
    known = F.slice("e", 1, k - 1)
    best = shifted.select("h", "shares", F.element_at(names, F.array_position(known, F.array_max(known)).cast("int")).alias("predicted"), (F.array_max(known) / F.expr("aggregate(e, 0D, (s, v) -> s + v)")).alias("probability"))
    scored = best.select("h", "predicted", "probability", F.coalesce(F.try_element_at("shares", F.col("predicted")), F.lit(0.0)).alias("shared"))
    family = F.when((F.col("probability") >= threshold) & (F.col("shared") >= SHARED), F.col("predicted")).otherwise(UNKNOWN)
    return cases.join(scored, "h").select("doc_id", "row_hash", "pos", "line", "predicted", "probability", "shared", family.alias("family"))


def scan_documents(docs: DataFrame, model: tuple[DataFrame, DataFrame, float] | None = None) -> DataFrame:
    """doc_id, n_paragraphs, n_licence, families (ascending, joined by blanks) of every row of ``docs``; null texts count as one empty paragraph."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = scan_paragraphs(d, model).where(F.col("family") != UNKNOWN).withColumn("kid", F.coalesce("doc_id", F.lit(-(2**63))))
    per = found.groupBy("kid", "row_hash").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), " ").alias("families"))
    n_lines = (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long")
    rows = d.select("doc_id", n_lines.alias("n_paragraphs"), F.coalesce("doc_id", F.lit(-(2**63))).alias("kid"), F.xxhash64("text").alias("row_hash"))
    out = rows.join(per, ["kid", "row_hash"], "left")
    return out.select("doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).alias("n_licence"), F.coalesce("families", F.lit("")).alias("families"))

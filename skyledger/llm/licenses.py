"""License scan: runs of words vote for diagonals between a text and license templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import let

# Phrases of the base scan and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Passages of common licenses, of any length, and their labels.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("mit", "released under the MIT license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of "
        "this software and associated documentation files",
    ),
    (
        "mit",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "isc",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "bsd",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "bsd-3-clause",
        "nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
    ),
    (
        "gpl",
        "This program is free software you can redistribute it and or modify it under the terms of "
        "the GNU General Public License",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License",
    ),
    (
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions",
    ),
    (
        "boost",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means.",
    ),
    ("cc-by", "this work is licensed under a creative commons attribution"),
)

# Variants and versions, which a word tells apart; their words must all stand.
VARIANTS = (
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("gnu-v2", "Free Software Foundation either version 2 of the License"),
    ("gnu-v3", "Free Software Foundation either version 3 of the License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives"),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike"),
)

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words that are hashed together: of phrases, which are short, and of the others.
PHRASE_GRAM, GRAM = 2, 4

# Diagonals this close are one occurrence with words put in or left out, and the share
# of a template's words that an occurrence must have in such runs.
NEIGHBOURS = 2
LEAST_SHARE = 0.8


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case.

    ``lower`` is far faster than ``translate`` and differs where words are concerned
    only for two letters that it turns into ASCII ones.
    """
    odd = F.contains(text, F.lit("İ")) | F.contains(text, F.lit("K"))
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    lowered = F.coalesce(ascii_lower(text), F.lit(""))
    return F.array_remove(F.split(lowered, SEPARATOR), "")


def listed() -> list[tuple[str, list[str], int, float]]:
    """(label, words, words hashed together, least share) of every phrase and template."""
    def split(text: str) -> list[str]:
        return [word for word in re.split(SEPARATOR, text.lower()) if word]

    phrases = [(label, split(text), PHRASE_GRAM, 1.0) for text, label in PHRASES.items()]
    templates = [(label, split(text), GRAM, LEAST_SHARE) for label, text in TEMPLATES]
    return phrases + templates + [(label, split(text), GRAM, 1.0) for label, text in VARIANTS]


def _grams(hashes: Column, size: int) -> Column:
    """(pos, gram) of every ``size`` neighbouring words, from the words' hashes."""
    return F.when(
        F.size(hashes) >= size,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - size),
            lambda k: F.struct(
                k.alias("pos"),
                F.xxhash64(*(F.get(hashes, k + j) for j in range(size))).alias("gram"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<pos:int,gram:bigint>>"))


def _hashes(words: str) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def template_grams(spark: SparkSession) -> DataFrame:
    """(gram, template, at), and for template -1 the mark that stands for a document."""
    rows = [(k, words, size) for k, (_, words, size, _) in enumerate(listed())]
    texts = spark.createDataFrame(rows, "template int, words array<string>, size int")
    parts = [
        texts.filter(F.col("size") == size)
        .select("template", F.explode(let(_hashes("words"), lambda h: _grams(h, size))).alias("g"))
        .select("g.gram", "template", F.col("g.pos").alias("at"))
        for size in (PHRASE_GRAM, GRAM)
    ]
    mark = spark.range(1).select(
        F.xxhash64(F.lit("document")).alias("gram"),
        F.lit(-1).alias("template"),
        F.lit(0).alias("at"),
    )
    return parts[0].unionByName(parts[1]).unionByName(mark)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    The hashes of neighbouring words, two for phrases and four for license texts, are
    joined to those of the templates, and each match votes for its diagonal, the place
    where the template would start. A diagonal with all of a base phrase is a place of
    that phrase; ``first_word`` and ``last_word`` are the smallest and largest of these.
    For the other templates close diagonals are merged. Such a span is verified by the
    template's words that its matches cover: it adds its label if these are
    ``LEAST_SHARE`` of the template, all for a variant, and stand within a stretch not
    much longer. ``score`` is the largest share found, 1 for a base phrase, 0 for nothing.
    Labels are distinct, sorted and comma-joined. Words are told apart by 64 bits.

    A null or empty text has no words, no labels and the score 0. Repeated rows stay
    repeated; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    known = listed()
    row = ["doc_id", "key", "n_words"]
    words = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("key"),
        words_of(F.col("text")).alias("words"),
    )
    listed_grams = template_grams(spark)
    # Pairs of words are few and common: those of no phrase are left out before all others.
    phrases = listed_grams.filter(F.col("template").between(0, len(PHRASES) - 1))
    pairs = [found["gram"] for found in phrases.select("gram").distinct().collect()]
    mark = F.struct(F.lit(0).alias("pos"), F.xxhash64(F.lit("document")).alias("gram"))
    grams = let(
        _hashes("words"),
        lambda h: F.concat(
            F.filter(_grams(h, PHRASE_GRAM), lambda g: g["gram"].isin(pairs)),
            _grams(h, GRAM),
            F.array(mark),
        ),
    )
    votes = (
        words.select(
            "doc_id",
            "key",
            F.size("words").cast("long").alias("n_words"),
            F.explode(grams).alias("g"),
        )
        .select(*row, "g.pos", "g.gram")
        .join(F.broadcast(listed_grams), "gram")
        .withColumn(
            "diagonal", F.when(F.col("template") < 0, 0).otherwise(F.col("pos") - F.col("at"))
        )
        .groupBy(*row, "template", "diagonal")
        .agg(
            F.collect_set("at").alias("ats"),
            F.min("pos").alias("first"),
            F.max("pos").alias("last"),
            F.count(F.lit(1)).alias("n"),
        )
    )

    def of_template(values: list) -> Column:
        place = F.greatest(F.col("template"), F.lit(0)) + 1
        return F.element_at(F.array(*map(F.lit, values)), place)

    label = of_template([label for label, *_ in known])
    size = of_template([len(words) for _, words, *_ in known])
    gram = of_template([gram for *_, gram, _ in known])
    least = of_template([share for *_, share in known])
    listed_one = F.col("template") >= 0
    phrase = listed_one & (F.col("template") < len(PHRASES))
    by_diagonal = Window.partitionBy(*row, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > NEIGHBOURS
    covered = F.array_distinct(
        F.flatten(F.transform("ats", lambda at: F.sequence(at, at + F.col("gram") - 1)))
    )
    spans = (
        votes.withColumn("new", (F.coalesce(apart, F.lit(True)) | ~listed_one | phrase).cast("int"))
        .withColumn("span", F.sum("new").over(by_diagonal))
        .groupBy(*row, "template", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"),
            F.min("diagonal").alias("start"),
            (F.max("last") - F.min("first")).alias("length"),
            F.max("n").alias("n"),
        )
        .withColumn("gram", gram)
        .withColumn("share", F.size(covered) / size)
    )
    is_base = phrase & (F.col("share") == 1)
    is_found = (
        listed_one
        & ~phrase
        & (F.col("share") >= least)
        & (F.col("length") + F.col("gram") <= size * 1.25 + NEIGHBOURS)
    )

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, label))), ",")

    per_row = spans.groupBy(*row).agg(
        F.max(F.when(~listed_one, F.col("n"))).alias("copies"),
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        joined(is_base).alias("base_labels"),
        joined(is_base | is_found).alias("labels"),
        F.coalesce(
            F.max(F.when(is_base, 1.0).when(is_found, F.col("share"))), F.lit(0.0)
        ).alias("score"),
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return per_row.withColumn("copy", each).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )

r"""License scan: sparse TF-IDF cosine to templates, then directory inheritance.

Files are (path, text). Template lines are short notices of known licenses.
A file's header is its lines; every line is compared to every template's
weights as a sparse TF-IDF vector of words, by one join on the word, with
inverse document frequencies taken over the templates. The best line of a file
at or above ``THRESHOLD`` gives the license the file states itself.

A license file (LICENSE, COPYING, NOTICE and the like, by its name) that
matches licenses its directory. Where names say nothing, a file is a license
file by its content: each of its lines with a letter or digit matches a
template, whatever its length. A file without a statement of its own inherits from the
nearest directory above it that has a license: its path is expanded to its
ancestor directories, joined to the licensed directories by equality and the
deepest hit is kept by a map-side aggregate.

The template vectors are a fixed small table and the only broadcast side. The
corpus is read for its words in one pass; only lines whose words could reach the
threshold at all (an exact bound) are exploded into words, so prose and texts
are never shuffled. What files state is written to the shared folder before
directories inherit it.

Defined cases: a null or empty text states nothing but may inherit; a null path
has no directory, so it only states; ties between licenses go to the higher
score, then to the first id in code point order; two licenses in one directory
resolve the same way; repeated rows get equal results; an empty table gives no
rows; extra columns are kept out of the way by prefixed names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

# Notices and titles by license id (fixed values: public license names and their usual wording).
NOTICES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU Affero General Public License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "GNU General Public License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU Lesser General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This text is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This text is licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This text is licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
)
# Identifiers that a one-line tag may name, by license id (fixed values).
IDENTIFIERS = {
    "Apache-2.0": ("Apache-2.0",), "MIT": ("MIT",), "BSD-3-Clause": ("BSD-3-Clause",), "MPL-2.0": ("MPL-2.0",),
    "AGPL-3.0": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"), "LGPL-3.0": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "CC-BY-4.0": ("CC-BY-4.0",), "CC-BY-SA-4.0": ("CC-BY-SA-4.0",), "CC-BY-NC-4.0": ("CC-BY-NC-4.0",), "CC0-1.0": ("CC0-1.0",),
}
TEMPLATES = NOTICES + tuple((license, f"SPDX-License-Identifier: {name}") for license, names in IDENTIFIERS.items()
                            for name in names)
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|copyright)([._-].*)?$"
THRESHOLD = 0.8
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def tokens_of(text: str) -> list[str]:
    """The word rule of the scan, for the templates."""
    import re

    return re.findall(TOKEN, text.lower())


def template_vectors(templates: Sequence[tuple[str, str]]) -> tuple[dict[str, float], list[dict[str, float]]]:
    """Inverse frequencies over the templates and each template's unit vector."""
    bags = [tokens_of(t) for _, t in templates]
    words = sorted({w for bag in bags for w in bag})
    idf = {w: math.log((1 + len(bags)) / (1 + sum(w in bag for bag in bags))) + 1 for w in words}
    vectors = []
    for bag in bags:
        weights = {w: bag.count(w) * idf[w] for w in bag}
        length = math.sqrt(sum(x * x for x in weights.values()))
        vectors.append({w: x / length for w, x in weights.items()})
    return idf, vectors


def weights_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(word, template, license, weight, idf): as many rows as the templates have words."""
    idf, vectors = template_vectors(templates)
    rows = [(w, i, templates[i][0], x, idf[w]) for i, v in enumerate(vectors) for w, x in v.items()]
    return spark.createDataFrame(rows, "__word string, __template int, __license string, __weight double, __idf double")


def candidate_lines(text: Column, templates: Sequence[tuple[str, str]]) -> Column:
    """Distinct lines that may reach the threshold against some template, cut by
    its rarest words: a line without any of them cannot be similar enough."""
    idf, vectors = template_vectors(templates)
    marks = set()
    for vector in vectors:
        # Words in falling weight, long ones first (prose is full of short ones), until the
        # rest's squared weight is below the threshold's square.
        left = 1.0
        for w, x in sorted(vector.items(), key=lambda i: (-round(i[1], 9), -len(i[0]), i[0])):
            if left < THRESHOLD ** 2:
                break
            marks.add(w)
            left -= x * x
    pattern = r"(?i)(?<![a-z0-9])(?:" + "|".join(sorted(w.replace(".", r"\.") for w in marks)) + r")(?![a-z0-9])"
    return F.when(text.rlike(pattern), F.array_distinct(F.filter(lines_of(text), lambda x: x.rlike(pattern))))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]", -1)


def written_lines(text: Column, templates: Sequence[tuple[str, str]]) -> Column:
    """Number of distinct lines with a letter or digit; only counted where some line may match."""
    return F.when(F.size(candidate_lines(text, templates)) > 0,
                  F.size(F.array_distinct(F.filter(lines_of(text), lambda x: x.rlike(r"[\p{L}\p{N}]")))))


def plausible(words: Column, templates: Sequence[tuple[str, str]], threshold: float) -> Column:
    """Whether a line can reach the threshold against any template at all.

    Only words of the templates add to a cosine, so its square is at most their share of
    the line's squared length. A word outside counts once per place here, which is no more
    than it does in the length, so no line is lost; the margin covers the score's rounding."""
    idf, _ = template_vectors(templates)
    outside = math.log(1 + len(templates)) + 1
    table = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(x).alias("x")) for w, x in sorted(idf.items())])

    def enough(inner: Column) -> Column:
        inside = F.aggregate(table, F.lit(0.0), lambda total, e: total + F.pow(
            F.size(F.filter(inner, lambda x: x == e["w"])) * e["x"], F.lit(2.0)))
        others = (F.size(words) - F.size(inner)) * outside ** 2
        return F.transform(F.array(inside), lambda i: i >= (threshold ** 2 - 1e-8) * (i + others))[0]

    # The words inside are bound to a lambda variable, so that they are looked up once a line.
    return F.transform(F.array(F.filter(words, lambda x: x.isin(*sorted(idf)))), enough)[0]


def stated(files: DataFrame, key: str, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES,
           threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, score, __whole): the license each file states itself and whether all its lines are
    notices, files without one left out. ``key`` tells files apart."""
    weights = F.broadcast(weights_table(files.sparkSession, templates))    # as small as the templates
    outside = math.log(1 + len(templates)) + 1                              # idf of a word in no template
    # A line goes on as its hash and words, not as its text.
    worded = F.transform(candidate_lines(F.col(text), templates), lambda x: F.struct(
        F.xxhash64(x).alias("line"), F.regexp_extract_all(F.lower(x), F.lit(TOKEN), F.lit(0)).alias("words")))
    lines = (files.select(F.col(key).alias("__key"), F.explode(worded).alias("__l"),
                          written_lines(F.col(text), templates).alias("__n"))
                  .where(plausible(F.col("__l.words"), templates, threshold))
                  .select("__key", F.col("__l.line").alias("__line"), F.col("__l.words").alias("__words"), "__n"))
    # The few lines left are written once: scores and lengths both read them, and the corpus is read once.
    lines = staged(lines, "license-lines")
    counted = (lines.withColumn("__word", F.explode("__words"))
                    .groupBy("__key", "__line", "__word").agg(F.count(F.lit(1)).alias("__tf"),
                                                              F.max("__n").alias("__n")))
    idf_of = weights.select("__word", "__idf").distinct()
    lengths = (counted.join(idf_of, "__word", "left")
                      .groupBy("__key", "__line")
                      .agg(F.sqrt(F.sum(F.pow(F.col("__tf") * F.coalesce("__idf", F.lit(outside)), F.lit(2.0))))
                            .alias("__length"), F.max("__n").alias("__n")))
    dots = (counted.join(weights, "__word").groupBy("__key", "__line", "__template", "__license")
                   .agg(F.sum(F.col("__tf") * F.col("__idf") * F.col("__weight")).alias("__dot")))
    scored = (dots.join(lengths, ["__key", "__line"])
                  .withColumn("__score", F.round(F.col("__dot") / F.col("__length"), 9)))
    best = F.min(F.struct((-F.col("__score")).alias("s"), F.col("__license").alias("l")))
    notices = (scored.where(F.col("__score") >= threshold).groupBy("__key", "__line")
                     .agg(best.alias("__b"), F.max("__n").alias("__n")))
    return (notices.groupBy("__key").agg(F.min("__b").alias("__b"),
                                         (F.count(F.lit(1)) == F.max("__n")).alias("__whole"))
                   .select(F.col("__key").alias(key), F.col("__b.l").alias("license"),
                           (-F.col("__b.s")).alias("score"), "__whole"))


def directories(path: Column) -> Column:
    """The directories above a path, the deepest last; the root is the empty string."""
    parts = F.filter(F.split(path, "/", -1), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0))),
                       lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def scan(files: DataFrame, key: str, path: str, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD, by_content: bool = False) -> DataFrame:
    """(key, path, license, score, origin, from_directory) of every file; origin is
    ``stated``, ``inherited`` or ``none``. A file licenses its directory by its name,
    or ``by_content`` if all its lines are notices."""
    own = stated(files, key, text, templates, threshold)
    named = files.select(F.col(key).alias(key), F.col(path).alias("path"))
    known = staged(named.join(own, key, "left"), "license-stated")
    is_license = F.col("__whole") if by_content else file_name(F.col("path")).rlike(LICENSE_FILE)
    licensed = (known.where(F.col("license").isNotNull() & is_license)
                     .withColumn("__dir", F.element_at(directories(F.col("path")), -1))
                     .groupBy("__dir").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("l")))
                                            .alias("__b"))
                     .select("__dir", F.col("__b.l").alias("__inherited"), (-F.col("__b.s")).alias("__their")))
    # One row per directory, not per file, climbs to the ancestors; a directory with many files counts once.
    homes = known.where(F.col("license").isNull() & F.col("path").isNotNull()).select(
        F.element_at(directories(F.col("path")), -1).alias("__home")).distinct()
    climbs = homes.withColumn("__dir", F.explode(directories(F.concat("__home", F.lit("/x")))))
    nearest = (climbs.join(licensed, "__dir").groupBy("__home")
                     .agg(F.max(F.struct(F.length("__dir").alias("n"), F.col("__dir").alias("d"),
                                         F.col("__inherited").alias("l"), F.col("__their").alias("s"))).alias("__b")))
    out = (known.withColumn("__home", F.element_at(directories(F.col("path")), -1)).join(nearest, "__home", "left"))
    return out.select(
        key, "path", F.coalesce("license", "__b.l").alias("license"), F.coalesce("score", "__b.s").alias("score"),
        F.when(F.col("license").isNotNull(), "stated").when(F.col("__b.l").isNotNull(), "inherited")
         .otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("__b.d")).alias("from_directory"))

"""License scans: TF-IDF cosine to templates, then directory inheritance.

Candidate lines are the lines of a file that hold a licence word. Each
distinct line is scored once: sparse TF-IDF vectors of its terms against those
of the templates, joined on terms; the inverse document frequencies are taken
over the candidate lines of all files (each distinct line weighs the files
that hold it) and the templates. A file's own licence is its best template at
or over ``least``. A licence file is one whose name says so or most of whose
words (non-blank lines) are licence lines; it speaks for its directory, by
the most frequent licence there. A file without a licence of its own takes
that of the nearest ancestor directory that has one, by joining its ancestor
paths with the directories.

Whole texts are compared besides, without a word filter: the file, its leading
comment, and the runs of its first paragraphs against the full texts and
headers of ``licence_texts``, lines of copyright holders left out. Their vectors
have weight (1 + ln tf) * idf with frequencies over those texts. A block at or
over ``least`` is the file's own licence before that of any line; a file that
matches as a whole is a licence file. Files without any of a few terms of every
licence text, without which no similarity reaches ``least``, are not vectorised.

Null texts and paths are empty; ties go by similarity, then name. Repeated
files are each scanned. Empty tables give no row.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.llm.licence_texts import block_texts
from pushback.operators.joins import broadcast_if_small
from pushback.session import cut_lineage

LEAST = 0.8
LICENCE_WORD = "(?i)licen[sc]|copyright|spdx|public domain|all rights reserved|redistribution"
LICENCE_FILE = "(?i)^(licen[sc]e|copying|copyright|notice|unlicense)([.-].*)?$"
TERM = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
#: Lines that name a copyright holder.
HOLDER = r"(?im)^[^\p{L}\p{N}\n]*(?:copyright\s*(?:\(c\)|[©:\d])|\(c\)\s|©).*$"
COMMENT_LINE = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|\.\.\s)"
LEADING_COMMENT = r'(?s)^\s*(?:/\*.*?\*/|<!--.*?-->|""".*?""")'
PARAGRAPH_END = r"\n[^\p{L}\p{N}\n]*\n"
#: Paragraphs at the start of a file that may hold its header.
HEAD_PARAGRAPHS = 10
#: Usual notices of public licences, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
]


def terms_of(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0))


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(TEMPLATES)],
                                 "template int, license string, line string")


def block_vectors(texts: list[tuple[str, str]]) -> tuple[list[tuple], list[tuple], float]:
    """(template, license, term, weight) rows of unit length, (term, idf) rows and the idf of other terms."""
    holder = HOLDER.replace(r"\p{L}\p{N}", r"a-zA-Z0-9")
    counts = [Counter(re.findall(TERM, re.sub(holder, "", t).lower())) for _, t in texts]
    df = Counter(x for c in counts for x in c)
    other = math.log(len(texts) + 1) + 1
    idf = {x: math.log((len(texts) + 1) / (n + 1)) + 1 for x, n in df.items()}
    rows = []
    for i, ((name, _), c) in enumerate(zip(texts, counts)):
        w = {x: (1 + math.log(n)) * idf[x] for x, n in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        rows += [(i, name, x, v / norm) for x, v in w.items()]
    return rows, sorted(idf.items()), other


def needed_terms(rows: list[tuple], least: float) -> list[str]:
    """Terms of which a text must have one to reach ``least`` with any template:
    what lacks terms of more than 1 - least² of a template's square cannot."""
    own: dict[int, list[tuple]] = {}
    for i, _, term, w in rows:
        own.setdefault(i, []).append((-len(term), term, w * w))
    need: set[str] = set()
    for terms in own.values():
        left = 1 - least * least + 1e-6
        for _, term, square in sorted(terms):
            if left < 0:
                break
            need.add(term)
            left -= square
    return sorted(need)


def file_blocks(text: Column) -> Column:
    """The whole text first, then its leading comments and runs of its first paragraphs."""
    lines = F.split(text, "\n")
    code = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT_LINE) | (F.trim(x) == "")), False)
    comment = F.when(code > 1, F.array_join(F.slice(lines, F.lit(1), (code - 1).cast("int")), "\n")).otherwise("")
    paragraphs = F.slice(F.filter(F.split(text, PARAGRAPH_END), lambda x: x.rlike(r"[\p{L}\p{N}]")), 1, HEAD_PARAGRAPHS)
    n = F.size(paragraphs)
    runs = F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), n - i + 1), lambda k: F.array_join(F.slice(paragraphs, i, k), "\n"))))).otherwise(F.array(F.lit("")))
    return F.array_distinct(F.concat(F.array(text, comment, F.regexp_extract(text, LEADING_COMMENT, 0)), runs))


def block_matches(files: DataFrame, vectors: tuple[list[tuple], list[tuple], float], least: float) -> DataFrame:
    """(_id, path, similarity, license, whole) of files (_id, path, text) with a block at or over ``least``."""
    spark = files.sparkSession
    rows, idfs, other = vectors
    templates_ = spark.createDataFrame(rows, "template int, license string, term string, wb double")
    idf = spark.createDataFrame(idfs, "term string, idf double")
    key = ["_f", "block"]
    # equal files are one
    held = files.distinct().select("_id", "path", F.xxhash64("_id", "path", "text").alias("_f"),
                                   F.posexplode(file_blocks(F.col("text"))).alias("block", "part"))
    tf = (held.select(*key, F.explode(terms_of(F.regexp_replace("part", HOLDER, ""))).alias("term"))
          .groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf")))
    w = (tf.join(F.broadcast(idf), "term", "left")  # tables of the fixed templates
         .select(*key, "term", ((F.log("tf") + 1) * F.coalesce("idf", F.lit(other))).alias("w")))
    w = cut_lineage(w, "licence_blocks")
    norm = w.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = (w.join(F.broadcast(templates_), "term").groupBy(*key, "template", "license")
           .agg(F.sum(F.col("w") * F.col("wb")).alias("dot")))
    best = (dot.join(norm, key).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6))
            .where(F.col("similarity") >= least).groupBy("_f")
            .agg(F.max(F.struct("similarity", "license")).alias("m"), F.max(F.col("block") == 0).alias("whole")))
    names = files.distinct().select("_id", "path", F.xxhash64("_id", "path", "text").alias("_f"))
    return (names.join(best, "_f").groupBy("_id", "path")
            .agg(F.max("m").alias("m"), F.max("whole").alias("whole"))
            .select("_id", "path", "m.similarity", "m.license", "whole"))


def line_matches(lines: DataFrame, notices: DataFrame) -> DataFrame:
    """(line, license, similarity): the best template of each distinct line.

    ``lines``: line, n (files that hold it); ``notices``: template, license, line.
    """
    own = (lines.select("line", "n", F.explode(terms_of(F.col("line"))).alias("term"))
           .groupBy("line", "term").agg(F.count(F.lit(1)).alias("tf"), F.max("n").alias("n")))
    theirs = notices.select("template", "license", F.explode(terms_of(F.col("line"))).alias("term"))
    df = (own.select("term", "n")
          .unionByName(theirs.groupBy("template", "term").agg(F.lit(1).cast("bigint").alias("n")).select("term", "n"))
          .groupBy("term").agg(F.sum("n").alias("df")))
    n_all = (lines.agg(F.sum("n")).first()[0] or 0) + notices.count()  # one number
    idf = df.select("term", (F.log((F.lit(float(n_all)) + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    # the weights of lines and templates, written once: norms and products read them again
    both = own.drop("n").unionByName(theirs.groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf")),
                                     allowMissingColumns=True)
    weights = cut_lineage(both.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf")).drop("tf", "idf"),
                          "licence_weights")
    a = weights.where(F.col("line").isNotNull()).select("line", "term", "w")
    b = weights.where(F.col("line").isNull()).select("template", "license", "term", "w")
    norm_a = a.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("na"))
    norm_b = b.groupBy("template", "license").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("nb"))
    dot = (a.join(b.withColumnRenamed("w", "wb"), "term").groupBy("line", "template", "license")
           .agg(F.sum(F.col("w") * F.col("wb")).alias("dot")))
    sim = (dot.join(norm_a, "line").join(norm_b, ["template", "license"])
           .select("line", "license", F.round(F.col("dot") / F.col("na") / F.col("nb"), 6).alias("similarity")))
    return sim.groupBy("line").agg(F.max(F.struct("similarity", "license")).alias("m")).select(
        "line", F.col("m.license").alias("license"), F.col("m.similarity").alias("similarity"))


def ancestors(directory: Column) -> Column:
    """The directory and all above it, up to the root ''."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(F.concat(F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")),
        F.array(F.lit(""))))


def scan(files: DataFrame, *, id_col: str, path_col: str = "path", text_col: str = "text",
         least: float = LEAST) -> DataFrame:
    """(id, path, own_license, similarity, license, origin, from_dir) of each file.

    origin: 'own', 'inherited' or 'none'; similarity is the best one found."""
    spark = files.sparkSession
    path = F.coalesce(F.col(path_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    vectors = block_vectors(block_texts())
    needed = F.array(*[F.lit(x) for x in needed_terms(vectors[0], least)])
    base = cut_lineage(files.select(  # texts are read once; only licence lines go on
        F.col(id_col).alias("_id"), path.alias("path"),
        F.size(lines).alias("n_lines"), F.filter(lines, lambda x: x.rlike(LICENCE_WORD)).alias("hits"),
        F.when(F.arrays_overlap(terms_of(text), needed), text).alias("block_text")), "licence_lines")
    held = base.where(F.size("hits") > 0).select(
        F.xxhash64("_id", "path").alias("_f"), "_id", "path", "n_lines",
        F.explode(F.transform("hits", lambda x: F.trim(x))).alias("line"))
    distinct = cut_lineage(held.groupBy("line").agg(F.count(F.lit(1)).alias("n")), "licence_distinct")
    best = line_matches(distinct, templates(spark))
    own = (held.join(best, "line").groupBy("_id", "path", "n_lines").agg(
        F.max(F.struct("similarity", "license")).alias("m"),
        F.sum(F.when(F.col("similarity") >= least, 1).otherwise(0)).alias("n_licence_lines"))
        .select(F.col("_id").alias("_oid"), F.col("path").alias("_opath"), F.col("m.similarity").alias("similarity"),
                F.when(F.col("m.similarity") >= least, F.col("m.license")).alias("own_license"),
                (F.col("n_licence_lines") * 2 > F.col("n_lines")).alias("mostly")))
    blocks = block_matches(base.where(F.col("block_text").isNotNull()).select(
        "_id", "path", F.col("block_text").alias("text")), vectors, least)
    # a block's licence goes before a line's; written, for directories and files read it again,
    # and each reading would plan and compile all of the above anew in the driver
    own = cut_lineage(own.withColumn("of_block", F.lit(0)).unionByName(blocks.select(
        F.col("_id").alias("_oid"), F.col("path").alias("_opath"), "similarity", F.col("license").alias("own_license"),
        F.col("whole").alias("mostly"), F.lit(1).alias("of_block")))
        .groupBy("_oid", "_opath").agg(F.max(F.struct("of_block", "similarity", "own_license")).alias("m"),
                                       F.max("mostly").alias("mostly"))
        .select("_oid", "_opath", "m.similarity", "m.own_license", "mostly"), "licence_own")
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    name = F.regexp_extract("path", "[^/]*$", 0)
    seen = own.select("_oid", F.col("_opath").alias("path"), "own_license", "mostly")
    speak = (seen.where(F.col("own_license").isNotNull() & (F.col("mostly") | name.rlike(LICENCE_FILE)))
             .groupBy(directory.alias("dir"), "own_license").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("dir").agg(F.max(F.struct(F.col("n"), F.col("own_license"))).alias("m"))
             .select("dir", F.col("m.own_license").alias("dir_license")))
    # directories are few against files: the nearest speaking ancestor is found once for each
    dirs = base.select(directory.alias("d")).distinct()
    near = (dirs.select("d", F.posexplode(ancestors(F.col("d"))).alias("up", "dir")).join(speak, "dir")
            .groupBy("d").agg(F.min(F.struct("up", "dir", "dir_license")).alias("m"))
            .select("d", F.col("m.dir").alias("from_dir"), F.col("m.dir_license").alias("dir_license")))
    out = (base.select("_id", "path", directory.alias("d"))
           .join(own.drop("mostly"), F.col("_id").eqNullSafe(F.col("_oid")) & (F.col("path") == F.col("_opath")), "left")
           .join(broadcast_if_small(near), "d", "left"))
    inherited = F.col("own_license").isNull() & F.col("dir_license").isNotNull()
    return out.select(
        F.col("_id").alias(id_col), "path", "own_license", F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        F.coalesce("own_license", "dir_license").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(inherited, F.col("from_dir")).alias("from_dir"))

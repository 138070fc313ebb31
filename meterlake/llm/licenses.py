"""License scans: TF-IDF cosine to templates, then inheritance along directories.

Only DataFrame expressions run. A file's units are its lines (headers) and its
whole text (a licence file). Lines are compared with notices, whole texts with
notices and with licence texts. A unit's terms are weighted by their count times
their inverse document frequency over all files (for whole texts see
:func:`scan`); its cosine to each template is a sum over its terms, so
templates are columns of one aggregate. A file without a
notice of its own takes the licence of the nearest directory above it that
holds a licence file, by joins on directory paths.

Only units that could reach the threshold are taken apart: a template's
heaviest terms are its anchors, chosen so that a unit without any of them
stays below the threshold whatever its other terms are.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.graph import stored
from meterlake.llm.license_texts import TEXTS
from meterlake.operators.joins import skew_safe_join

# Short public licence notices, by SPDX-like name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License version 3"),
    ("GPL-2.0", "This program is free software under the GNU General Public License version 2"),
    ("LGPL-3.0", "GNU Lesser General Public License version 3"),
    ("AGPL-3.0", "GNU Affero General Public License version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
)
HEADER_LEAST = 0.6  # cosine of a line
FILE_LEAST = 0.5  # cosine of a whole text to a notice
TEXT_LEAST = 0.8  # cosine of a whole text to a licence text
FILE_SHARE = 0.9  # of a whole text's words must be words of the template: a text about something else is no licence file
WHOLE = -1  # the unit number of a whole text

# Terms: runs of ASCII letters and digits and of anything beyond ASCII.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BETWEEN), lambda t: t != "")


def _terms(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def vocabulary(templates=TEMPLATES + TEXTS) -> list[str]:
    return sorted({t for _, text in templates for t in _terms(text)})


def template_weights(counts: dict[str, int], n: int, templates=TEMPLATES + TEXTS) -> tuple[dict[str, float], list[dict[str, float]]]:
    """Inverse document frequency by term, and each template's unit vector."""
    idf = {t: math.log((n + 1) / (counts.get(t, 0) + 1)) + 1 for t in vocabulary(templates)}
    vectors = []
    for _, text in templates:
        weight = {t: c * idf[t] for t, c in Counter(_terms(text)).items()}
        length = math.sqrt(sum(w * w for w in weight.values()))
        vectors.append({t: w / length for t, w in weight.items()})
    return idf, vectors


def anchors(vectors: list[dict[str, float]], least: float) -> list[str]:
    """Terms without any of which no unit reaches ``least``: a unit's cosine is
    at most the length of the template's vector over the terms they share."""
    found = set()
    for vector in vectors:
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < (least * (1 - 1e-9)) ** 2:
                break
            found.add(term)
            rest -= weight * weight
    return sorted(found)


def scan(
    files: DataFrame, *, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
    templates=TEMPLATES, texts=TEXTS, header_least: float = HEADER_LEAST, file_least: float = FILE_LEAST,
    text_least: float = TEXT_LEAST, file_share: float = FILE_SHARE,
) -> DataFrame:
    """The licence of every file, and where it comes from.

    In a line every term weighs by its document frequency over all files, so a
    notice among common words is found on a table of any size. In a whole text
    a term of no template weighs as if no other file had it; to be a licence
    file, a text must consist of a template's words by ``file_share`` besides, so
    that prose with a notice line doesn't spread to the files around it. Such a
    text is a lone notice of ``templates``, or one of the licence ``texts`` with a
    holder's lines. The text of a licence that has only notices here (the GNU
    and Creative Commons ones, MPL) is reported by its notice lines (``header``),
    and isn't inherited.

    Returns doc_id, path, license, via (``file``: the whole text is a licence;
    ``header``: its best line; ``inherited``; null without licence), score (the
    cosine of that evidence, 6 digits) and from_directory (of an inherited one).

    Reserved-rights notices ("All rights reserved.") have no template and are not
    reported: such a file looks like one without any notice.

    Defined cases: null and empty texts have no notice of their own and may
    inherit; a null path lies in the root directory; rows that repeat an id and
    path are one file whose texts are pooled; ties go to the smaller licence
    name; a text of any length is read whole; other input columns are ignored;
    an empty table gives no rows.
    """
    rows = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    every = (*templates, *texts)
    # Files by term, over the whole corpus, in one pass; of these the templates' own terms
    # (at most one row each) reach the driver.
    spread = stored(rows.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df")), "terms")
    n = rows.count()
    found = spread.where(F.col("term").isin(vocabulary(every))).collect()
    idf, vectors = template_weights({r["term"]: r["df"] for r in found}, n, every)

    in_lines = anchors(vectors[: len(templates)], min(header_least, file_least))
    in_texts = anchors(vectors[len(templates) :], text_least)
    units = _weighted(rows, spread, idf, vectors, in_lines, in_texts, n)
    # Of equal cosines the smallest name wins: negated scores, then names, by min.
    whole = F.col("unit") == WHOLE
    fitting = []
    for k, (name, _) in enumerate(every):
        score = F.round(F.col(f"dot{k}") / F.sqrt("norm"), 6)
        fits = whole & (score >= (file_least if k < len(templates) else text_least)) & (F.col(f"words{k}") >= file_share * F.col("words"))
        if k < len(templates):
            fits |= ~whole & (score >= header_least)
        fitting.append(F.when(fits, F.struct((-score).alias("minus"), F.lit(name).alias("license"))))
    scored = units.select("doc_id", "path", whole.alias("whole"), F.array_min(F.array(*fitting)).alias("best"))
    own = scored.groupBy("doc_id", "path").agg(
        F.min(F.when(F.col("whole"), F.col("best"))).alias("file"),
        F.min(F.when(~F.col("whole"), F.col("best"))).alias("header"),
    ).where(F.col("file").isNotNull() | F.col("header").isNotNull())

    listed = rows.select("doc_id", "path").distinct().withColumn("directory", directory_of(F.col("path")))
    own = own.select(F.col("doc_id").alias("own_id"), F.col("path").alias("own_path"), "file", "header")
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path"))
    resolved = _inherited(listed, own.where(F.col("file").isNotNull()).select(directory_of(F.col("own_path")).alias("holder"), "file"))
    # A directory that holds very many files is dealt over several tasks.
    joined = skew_safe_join(listed, resolved, "directory", "left").join(own, same, "left")
    pick = F.coalesce(F.col("file"), F.col("header"), F.col("inherited"))
    via = F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header").when(F.col("inherited").isNotNull(), "inherited")
    return joined.select(
        "doc_id", "path", pick["license"].alias("license"), via.alias("via"), (-pick["minus"]).alias("score"),
        F.when(via == "inherited", F.col("holder")).alias("from_directory"),
    )


def _weighted(
    rows: DataFrame, spread: DataFrame, idf: dict[str, float], vectors: list[dict[str, float]], in_lines: list[str], in_texts: list[str], n: int,
) -> DataFrame:
    """Norm, dot products and numbers of words (all, and each template's) of every
    unit that holds an anchor: of a notice, or in whole texts of a licence text too."""
    in_whole = sorted({*in_lines, *in_texts})
    near = rows.where(F.arrays_overlap(terms(F.col("text")), _array(in_whole)))
    whole = F.struct(F.lit(WHOLE).alias("unit"), F.col("text").alias("body"))
    lines = F.transform(F.split("text", "\n"), lambda line, k: F.struct(k.alias("unit"), line.alias("body")))
    units = near.select("doc_id", "path", F.inline(F.concat(F.array(whole), lines))).select("doc_id", "path", "unit", terms(F.col("body")).alias("words"))
    units = units.where((F.col("unit") == WHOLE) | F.arrays_overlap("words", _array(in_lines)))
    counted = units.select("doc_id", "path", "unit", F.explode("words").alias("term")).groupBy("doc_id", "path", "unit", "term").agg(F.count("*").alias("tf"))
    df = F.when(F.col("unit") == WHOLE, 0).otherwise(F.coalesce("df", F.lit(0)))  # in a whole text as if no other file had it
    # One row per template term: a fixed table of a few hundred rows.
    fixed = json.dumps([{"term": t, "idf": idf[t]} | {f"w{k}": v[t] for k, v in enumerate(vectors) if t in v} for t in sorted(idf)])
    shape = ", ".join(["term: string", "idf: double", *[f"w{k}: double" for k in range(len(vectors))]])
    table = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(fixed), f"array<struct<{shape}>>")))
    weight = F.col("tf") * F.coalesce("idf", F.log(F.lit(n + 1.0) / (df + 1)) + 1)
    return counted.join(spread, "term", "left").join(F.broadcast(table), "term", "left").groupBy("doc_id", "path", "unit").agg(
        F.sum(weight * weight).alias("norm"), F.sum("tf").alias("words"),
        *[F.sum(F.when(F.col(f"w{k}") > 0, F.col("tf")).otherwise(0)).alias(f"words{k}") for k in range(len(vectors))],
        *[F.sum(F.coalesce(weight * F.col(f"w{k}"), F.lit(0.0))).alias(f"dot{k}") for k in range(len(vectors))],
    )


def directory_of(path: Column) -> Column:
    """The directory a path lies in, with a slash at its end; empty for the root."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"\A(.*/)?", 0)


def _inherited(listed: DataFrame, holders: DataFrame) -> DataFrame:
    """Per directory, the licence file of the nearest directory at or above it.

    Directories are made distinct (with a partial aggregate) before they are
    taken apart, so a directory with a third of all files is one row here."""
    held = holders.groupBy("holder").agg(F.min("file").alias("inherited"))
    directories = listed.select("directory").distinct()
    parts = F.split(F.col("directory"), "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda k: F.struct(k.alias("depth"), F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.when(k > 0, "/").otherwise("")).alias("holder")),
    )
    return (
        directories.select("directory", F.inline(above)).join(held, "holder")
        .groupBy("directory").agg(F.max_by(F.struct("holder", "inherited"), "depth").alias("nearest"))
        .select("directory", "nearest.holder", "nearest.inherited")
    )


def documents_as_files(documents: DataFrame) -> DataFrame:
    """Documents as files ``source/lang/doc_id``; a null part is left out of the path.
    Null and empty texts and repeated rows are passed on as they are."""
    return documents.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")


def scan_sql(templates=TEMPLATES, texts=TEXTS, header_least: float = HEADER_LEAST, file_least: float = FILE_LEAST,
             text_least: float = TEXT_LEAST, file_share: float = FILE_SHARE) -> str:
    """The same over ``documents`` in DuckDB, without the anchors."""
    quoted = [(name, text.replace("'", "''")) for name, text in (*templates, *texts)]
    values = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(quoted))
    between = _BETWEEN
    return rf"""
WITH files AS (
  SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, text FROM documents
), tt AS (
  SELECT k, name, unnest(list_filter(regexp_split_to_array(lower(body), '{between}'), lambda t: t <> '')) AS term
  FROM (VALUES {values}) AS v(k, name, body)
), n AS (SELECT count(*) AS n FROM files
), df AS (
  SELECT term, count(*) AS df FROM (
    SELECT DISTINCT doc_id, path, unnest(regexp_split_to_array(lower(text), '{between}')) AS term FROM files)
  GROUP BY term
), idf AS (
  SELECT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), n
), tw AS (SELECT k, name, term, count(*) * any_value(idf) AS w FROM tt JOIN idf USING (term) GROUP BY k, name, term
), tn AS (SELECT k, name, term, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS w FROM tw
), units AS (
  SELECT doc_id, path, {WHOLE} AS unit, text AS body FROM files
  UNION ALL
  SELECT doc_id, path, unnest(range(len(lines))), unnest(lines) FROM (SELECT doc_id, path, string_split(text, chr(10)) AS lines FROM files)
), tf AS (
  SELECT doc_id, path, unit, term, count(*) AS tf FROM (
    SELECT doc_id, path, unit, unnest(regexp_split_to_array(lower(body), '{between}')) AS term FROM units)
  WHERE term <> '' GROUP BY ALL
), norm AS (
  SELECT doc_id, path, unit, sum(tf) AS words,
         sum((tf * coalesce(idf, ln((n + 1) / (CASE WHEN unit = {WHOLE} THEN 0 ELSE coalesce(df, 0) END + 1)) + 1)) ** 2) AS norm
  FROM tf LEFT JOIN idf USING (term) LEFT JOIN df USING (term), n GROUP BY doc_id, path, unit
), dot AS (
  SELECT doc_id, path, unit, k, name, sum(tf) AS shared, sum(tf * idf * w) AS dot FROM tf JOIN tn USING (term) JOIN idf USING (term) GROUP BY ALL
), cosine AS (
  SELECT doc_id, path, unit, k, name, round(dot / sqrt(norm), 6) AS score FROM dot JOIN norm USING (doc_id, path, unit)
  WHERE CASE WHEN unit = {WHOLE} THEN shared >= {file_share} * words ELSE k < {len(templates)} END
), own AS (
  SELECT doc_id, path, name, score, CASE WHEN unit = {WHOLE} THEN 'file' ELSE 'header' END AS via FROM cosine
  WHERE score >= CASE WHEN unit <> {WHOLE} THEN {header_least} WHEN k < {len(templates)} THEN {file_least} ELSE {text_least} END
), listed AS (
  SELECT DISTINCT doc_id, path, regexp_extract(path, '^(.*/)?') AS directory FROM files
), held AS (
  SELECT regexp_extract(path, '^(.*/)?') AS holder, name, score FROM own WHERE via = 'file'
  QUALIFY row_number() OVER (PARTITION BY regexp_extract(path, '^(.*/)?') ORDER BY score DESC, name) = 1
), evidence AS (
  SELECT doc_id, path, name AS license, via, score, NULL AS from_directory, CASE via WHEN 'file' THEN 0 ELSE 1 END AS o, 0 AS depth FROM own
  UNION ALL
  SELECT doc_id, path, name, 'inherited', score, holder, 2, length(holder) FROM listed JOIN held ON starts_with(directory, holder)
), best AS (
  SELECT * FROM evidence QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY o, depth DESC, score DESC, license) = 1
)
SELECT l.doc_id, l.path, b.license, b.via, b.score, b.from_directory FROM listed l LEFT JOIN best b USING (doc_id, path)
"""

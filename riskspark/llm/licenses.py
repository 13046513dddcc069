"""Operator 12: license scans by diagonal voting.

Texts and templates are sequences of words (A-Z lower-cased). Every run of K consecutive words of every text is hashed
(rolling) and joined with the places of the templates' runs by (hash, words); hashes that no template holds are dropped
where they are made, as a join's run-time filter does. A match of text place p with template place a votes for the
diagonal p - a of (text, template). Diagonals at most SHIFT apart (words put in or left out) are merged into one span,
and the span is verified: the template's words that its matches cover, by the longer of template and span, must reach
LEAST. Where a span as merged is less like its template than its best diagonal alone, that diagonal stands for it. Of
spans that begin at one word the most similar counts (then the label that sorts first).

Base phrases are templates, too, whose places are the diagonals with every vote (all runs of the phrase in place).

The join's right side is the templates (at most MAX_TEMPLATE_WORDS words, checked), so texts are not moved; votes are
counted in the tasks before they are shuffled, and a group is what one text votes for one template.

Null and empty texts have no words and no spans. Repeated rows give repeated results. Phrases and templates shorter
than K words are an error. Columns to be kept are named by the caller; those named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskspark.llm.common import Numbered, materialize, rolling, slices, table, word_hashes

K = 3
SHIFT = 3
LEAST = 0.8
MAX_TEMPLATE_WORDS = 100_000

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Openings of well-known license notices, in natural order.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("lgpl-3", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)

# bytes: A-Z become a-z; what is neither a digit, a-z nor beyond ASCII becomes a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPANS = "array<struct<start:int,end:int,label:string,base:boolean,score:double>>"


def words(text: str | None) -> list[bytes]:
    """The words of a text."""
    return (text or "").encode().translate(_FOLD).split()


def template_rows(base: dict[str, str], templates, k: int) -> list[tuple[int, str, bool, int, int, str]]:
    """(template, label, base, words, place, run) of each run of ``k`` words of each template."""
    out = []
    for number, (label, text, is_base) in enumerate([(v, t, True) for t, v in base.items()] + [(v, t, False) for v, t in templates]):
        own = [w.decode() for w in words(text)]
        if len(own) < k:
            raise ValueError(f"template of fewer than {k} words: {text}")
        out += [(number, label, is_base, len(own), a, " ".join(own[a:a + k])) for a in range(len(own) - k + 1)]
    if len(out) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    return out


def gram_hashes(grams: list[str]) -> np.ndarray:
    """The rolling hash of runs of words given as texts."""
    return np.array([rolling(word_hashes([w.encode() for w in g.split(" ")]), g.count(" ") + 1)[0] for g in grams], np.uint64)


def _find(k: int, known: np.ndarray, schema: pa.Schema):
    """Per row: number of words, and (place, hash, words) of the runs whose hash is among ``known`` (rising)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "_text"):
            vocab, parts, sizes = Numbered(), [], np.zeros(len(texts) + 1, np.int64)
            for i, t in enumerate(texts):
                own = words(t)
                parts.append(np.fromiter(map(vocab.__getitem__, own), np.int64, len(own)))
                sizes[i + 1] = len(own)
            ids, offsets, vocab = np.concatenate(parts), np.cumsum(sizes), list(vocab)
            h = rolling(word_hashes(vocab)[ids] if len(ids) else np.zeros(0, np.uint64), k)
            hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h) if len(known) else np.zeros(0, np.int64)
            doc = np.searchsorted(offsets, hit, side="right") - 1
            inside = hit + k <= offsets[doc + 1]
            hit, doc = hit[inside], doc[inside]
            grams = [b" ".join([vocab[w] for w in ids[p:p + k].tolist()]).decode() for p in hit.tolist()]
            place = pa.StructArray.from_arrays([pa.array((hit - offsets[doc]).astype(np.int32)), pa.array(h[hit].view(np.int64)), pa.array(grams, pa.string())], ["pos", "h", "gram"])
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)), place)
            out = rows.drop_columns(["_text"]).append_column("_n", pa.array(sizes[1:])).append_column("_hits", found)
            yield from out.cast(schema).to_batches()
    return run


def runs(docs: DataFrame, text: str, keep: list[str], rows: list[tuple], k: int) -> DataFrame:
    """``keep``, ``_row``, ``_n`` (words) and ``_hits`` of each row, as a written table."""
    from pyspark.sql.pandas.types import to_arrow_schema

    own = docs.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([f for f in own.schema.fields if f.name != "_text"] + T.StructType.fromDDL("_n long, _hits array<struct<pos:int,h:long,gram:string>>").fields)
    known = np.unique(gram_hashes([r[-1] for r in rows])) if rows else np.zeros(0, np.uint64)
    return materialize(own.mapInArrow(_find(k, known, to_arrow_schema(schema)), schema), "license-runs")


def likeness(ats: str, size: str, k: int) -> Column:
    """Template words that matches at the places ``ats`` cover, by the longer of template and span."""
    return F.expr(f"size(array_distinct(flatten(transform({ats}, a -> sequence(a, a + {k - 1}))))) / cast(greatest(len, {size}) as double)")


def vote(found: DataFrame, rows: list[tuple], k: int = K, shift: int = SHIFT, least: float = LEAST) -> DataFrame:
    """(_row, start, end, label, base, score) of all verified spans of a table that runs() wrote."""
    hashes = gram_hashes([r[-1] for r in rows]).view(np.int64).tolist()
    places = found.sparkSession.createDataFrame([(*r, h) for r, h in zip(rows, hashes)], "template int, label string, base boolean, len int, at int, gram string, h long")
    matches = found.select("_row", F.explode("_hits").alias("x")).select("_row", "x.*").join(F.broadcast(places), ["h", "gram"])  # bounded: checked
    key = ["_row", "template", "label", "base", "len"]
    votes = matches.groupBy(*key, (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"), (F.max("pos") + k).alias("hi"), F.collect_list("at").alias("ats"))
    phrases = votes.where(F.col("base") & (F.col("votes") == F.col("len") - (k - 1))).select(
        "_row", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("len")).alias("end"), "label", "base", F.lit(1.0).alias("score"))
    w = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > shift, F.lit(True))
    merged = votes.where(~F.col("base")).withColumn("_new", apart.cast("int")).withColumn("_span", F.sum("_new").over(w))
    alone = F.struct(likeness("ats", "hi - lo", k).alias("score"), (-F.col("lo")).alias("from"), F.col("hi").alias("to"))
    merged = merged.withColumn("_alone", alone).groupBy(*key, "_span").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.flatten(F.collect_list("ats")).alias("ats"), F.max("_alone").alias("_alone"))
    best = F.greatest(F.struct(likeness("ats", "hi - lo", k).alias("score"), (-F.col("lo")).alias("from"), F.col("hi").alias("to")), F.col("_alone"))
    spans = merged.select("_row", "label", best.alias("b")).where(F.col("b.score") >= least)
    spans = spans.groupBy("_row", (-F.col("b.from")).alias("start")).agg(F.min(F.struct((-F.col("b.score")).alias("score"), "label", F.col("b.to").alias("to"))).alias("s"))
    return phrases.unionByName(spans.select("_row", "start", F.col("s.to").alias("end"), "s.label", F.lit(False).alias("base"), (-F.col("s.score")).alias("score")))


def scan(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), base: dict[str, str] = BASE, templates=TEMPLATES,
         k: int = K, shift: int = SHIFT, least: float = LEAST) -> DataFrame:
    """``keep`` of each row with ``n_words`` and ``license_spans``: array of (start, end, label, base, score), in words
    from 0, end exclusive, by start."""
    rows = template_rows(base, templates, k)
    found = runs(docs, text, list(keep), rows, k)
    spans = vote(found, rows, k, shift, least).groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "base", "score"))).cast(SPANS).alias("_spans"))
    kept = [F.col(f"`{c}`") for c in keep if c not in ("n_words", "license_spans")]
    return found.join(spans, "_row", "left").select(*kept, F.col("_n").alias("n_words"), F.coalesce("_spans", F.expr(f"cast(array() as {SPANS})")).alias("license_spans"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    out = scan(table(spark, sf_dir, "documents"))
    base = "filter(license_spans, s -> s.base)"
    labels = lambda of: F.expr(f"array_join(array_sort(array_distinct(transform({of}, s -> s.label))), ',')")
    return out.select(
        "doc_id", "n_words", F.expr(f"cast(size({base}) as long)").alias("n_base"),
        F.expr(f"cast(array_min(transform({base}, s -> s.start)) as long)").alias("first_word"),
        F.expr(f"cast(array_max(transform({base}, s -> s.start)) as long)").alias("last_word"),
        labels(base).alias("base_labels"), labels("license_spans").alias("labels"),
        F.expr("coalesce(array_max(transform(license_spans, s -> s.score)), 0D)").alias("score"))


def _sql(k: int = K, shift: int = SHIFT, least: float = LEAST) -> str:
    rows = ", ".join(f"({t}, '{label}', {str(base).lower()}, {n}, {a}, '{gram}')" for t, label, base, n, a, gram in template_rows(BASE, TEMPLATES, k))
    likeness_sql = f"len(list_distinct(flatten(list_transform({{}}, lambda a: range(a, a + {k})))))::DOUBLE / greatest(len, hi - lo)"
    return rf"""
    WITH places(template, label, base, len, a0, gram) AS (VALUES {rows}),
    texts AS (SELECT row_number() OVER () AS row_, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    starts AS (SELECT row_, w, unnest(range(greatest(len(w) - {k - 1}, 0))) AS pos FROM texts),
    votes AS (SELECT row_, template, label, base, len, pos - a0 AS diagonal, count(*) AS votes, min(pos) AS lo, max(pos) + {k} AS hi, list(a0) AS ats
        FROM starts JOIN places ON gram = array_to_string(w[pos + 1:pos + {k}], ' ') GROUP BY row_, template, label, base, len, pos - a0),
    cut AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY row_, template ORDER BY diagonal) AS gap FROM votes WHERE NOT base),
    spanned AS (SELECT *, sum(CASE WHEN gap <= {shift} THEN 0 ELSE 1 END) OVER (PARTITION BY row_, template ORDER BY diagonal) AS span FROM cut),
    merged AS (SELECT row_, template, label, len, span, min(lo) AS lo, max(hi) AS hi, flatten(list(ats)) AS ats FROM spanned GROUP BY row_, template, label, len, span),
    ways AS (SELECT row_, template, span, label, lo, hi, {likeness_sql.format('ats')} AS score FROM merged
        UNION ALL SELECT row_, template, span, label, lo, hi, {likeness_sql.format('ats')} FROM spanned),
    best AS (SELECT * FROM ways QUALIFY row_number() OVER (PARTITION BY row_, template, span ORDER BY score DESC, lo, hi DESC) = 1),
    spans AS (SELECT row_, lo AS start, label, false AS base, score FROM best WHERE score >= {least}
            QUALIFY row_number() OVER (PARTITION BY row_, lo ORDER BY score DESC, label, hi) = 1
        UNION ALL SELECT row_, diagonal, label, true, 1.0 FROM votes WHERE base AND votes = len - {k - 1}),
    found AS (SELECT row_, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM spans GROUP BY row_)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
    FROM texts LEFT JOIN found USING (row_)"""


QUERIES = {"op12_license_scan": op12_license_scan}
SQL = {"op12_license_scan": _sql()}

"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory above.

Each line of a file (long lines in overlapping stretches) is compared with the templates as a sparse
TF-IDF vector. How many documents use each word of the templates is counted over all documents first; a
word that no template has weighs as the words of the template that it is compared with (root mean
square), so a notice of n words with k others has about the cosine sqrt(n / (n + k)), however large the
corpus is. A line can only reach the threshold if it has
one of a template's heaviest words, so other files are passed over without loss.

A file that is a licence file, by its name or because most of its words are the notice, speaks for its
directory. Files without a notice of their own take the licence of the nearest directory above: their
distinct directories are joined with the speaking directories by path.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.llm import workers
from reconlake.session import scratch_path

LEAST_COSINE = 0.6
#: Words of a stretch of a long line, and the words after which the next begins.
STRETCH_WORDS = 40
STRETCH_STEP = 20
#: A file of which so large a share of words is a notice is a licence file.
LICENSE_FILE_SHARE = 0.5

# Short notices as licences ask for them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License, version 3",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose is hereby granted",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

_WORD = re.compile(r"[^\W_]+")
_LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)[^/]*$"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Matcher:
    """Template vectors of length 1 with the squared weight of other words, the weights of words, and the
    words of which a match needs one."""

    vectors: list[tuple[str, dict[str, float], float]]
    weights: dict[str, float]
    least: float
    needed: frozenset[str]

    @classmethod
    def of(cls, templates: Mapping[str, tuple[str, ...]], used_by: Mapping[str, int], documents: int, least: float) -> Matcher:
        """``used_by``: number of documents that have a word."""
        vocabulary = {w for texts in templates.values() for t in texts for w in words(t)}
        weights = {w: 1 + math.log((1 + documents) / (1 + used_by.get(w, 0))) for w in vocabulary}
        made = cls([], weights, least, frozenset())
        made.vectors = [(name, *made.template(words(t))) for name in sorted(templates) for t in templates[name]]
        needed: set[str] = set()
        for _, vector, _ in made.vectors:
            # without its heaviest words a template cannot be reached
            rest = 1.0
            for word, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if math.sqrt(max(rest, 0.0)) < least - 1e-9:
                    break
                needed.add(word)
                rest -= weight * weight
        made.needed = frozenset(needed)
        return made

    def template(self, found: list[str]) -> tuple[dict[str, float], float]:
        made = {w: n * self.weights[w] for w, n in Counter(found).items()}
        length = math.sqrt(sum(v * v for v in made.values())) or 1.0
        mean_square = sum(self.weights[w] ** 2 for w in made) / max(len(made), 1)
        return {w: v / length for w, v in made.items()}, mean_square

    def best(self, found: list[str]) -> tuple[str | None, float]:
        """The nearest template's licence and cosine; of equals, the first by name."""
        counts, name, score = Counter(found), None, 0.0
        vector = {w: n * self.weights[w] for w, n in counts.items() if w in self.weights}
        known = sum(v * v for v in vector.values())
        others = sum(n * n for w, n in counts.items() if w not in vector)
        for license_id, template, mean_square in self.vectors:
            dot = sum(v * vector.get(w, 0.0) for w, v in template.items())
            cosine = dot / math.sqrt(known + others * mean_square) if dot else 0.0
            if cosine > score + 1e-12:
                name, score = license_id, cosine
        return (name, min(score, 1.0)) if score >= self.least else (None, 0.0)

    def scan(self, text: str) -> tuple[str | None, float, float]:
        """Licence and cosine of the best stretch, and the share of words in stretches that match."""
        if self.needed.isdisjoint(words(text)):
            return None, 0.0, 0.0
        name, score, total, inside = None, 0.0, 0, 0
        for line in text.split("\n"):
            found = words(line)
            total += len(found)
            covered = 0
            for at in range(0, max(len(found) - STRETCH_WORDS, 0) + STRETCH_STEP, STRETCH_STEP):
                stretch = found[at : at + STRETCH_WORDS]
                if not stretch or self.needed.isdisjoint(stretch):
                    continue
                license_id, cosine = self.best(stretch)
                if license_id:
                    inside += min(at + len(stretch), len(found)) - max(at, covered)
                    covered = at + len(stretch)
                    if cosine > score + 1e-12:
                        name, score = license_id, cosine
        return name, score, inside / total if total else 0.0


class LicenseScan:
    """Licences of files with a path and a text.

    Defined cases: NULL and empty texts have no notice of their own; a NULL path has no directory, so it
    inherits nothing; of several licence files in one directory the highest cosine speaks, then the first
    licence by name; rows of one path and text get equal results; an empty table gives no rows; other
    columns are kept as they are.
    """

    def __init__(
        self,
        files: DataFrame,
        templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
        least: float = LEAST_COSINE,
        path: str = "path",
        text: str = "text",
        keep: tuple[str, ...] = (),
    ):
        self.spark, self.keep = files.sparkSession, keep
        workers.importable(self.spark)
        named = files.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("kept"),
                             F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("t"))
        shared = self.spark.sparkContext.broadcast(self._matcher(named, templates, least))

        @F.pandas_udf("license string, score double, share double")
        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield pd.DataFrame(
                    [shared.value.scan(t) if t else (None, 0.0, 0.0) for t in texts], columns=["license", "score", "share"]
                )

        at = scratch_path(self.spark, "licenses")
        own = named.withColumn("found", scan("t")).select("kept", "path", "found.*")
        directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
        own.withColumn("directory", F.when(F.col("path").isNotNull(), directory)).write.parquet(f"{at}/own")
        self.own = self.spark.read.parquet(f"{at}/own")

    def _matcher(self, named: DataFrame, templates: Mapping[str, tuple[str, ...]], least: float) -> Matcher:
        """Counts, over all documents, how many have each word of the templates."""
        vocabulary = frozenset(w for texts in templates.values() for t in texts for w in words(t))

        def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts: Counter = Counter()
                for text in batch.column(0):
                    whole = text.as_py()
                    counts[""] += 1
                    if whole:
                        counts.update(vocabulary.intersection(words(whole)))
                yield pa.RecordBatch.from_pydict(
                    {"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
                )

        counted = named.select("t").mapInArrow(used, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        # at most one row per word of the templates
        used_by = {r["word"]: r["n"] for r in counted.collect()}
        return Matcher.of(templates, used_by, used_by.pop("", 0), least)

    def _directories(self) -> DataFrame:
        """The licence of every distinct directory, from itself or the nearest one above, and how far up."""
        speaks = self.own.where(
            F.col("license").isNotNull()
            & F.col("directory").isNotNull()
            & (F.col("path").rlike(_LICENSE_FILE) | (F.col("share") >= LICENSE_FILE_SHARE))
        )
        best = F.min(F.struct((-F.col("score")).alias("far"), "license"))
        speaking = speaks.groupBy(F.col("directory").alias("above")).agg(best.alias("best"))
        speaking = speaking.select("above", F.col("best.license").alias("license"))
        asking = self.own.where("directory IS NOT NULL").select("directory").distinct()
        parts = F.split("directory", "/")
        ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
            n.alias("up"), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - n), "/").alias("above")))
        lines = asking.select("directory", F.explode(ups).alias("u")).select("directory", "u.*")
        met = lines.join(speaking, "above")
        nearest = met.groupBy("directory").agg(F.min_by("license", "up").alias("inherited"), F.min("up").alias("up"))
        return nearest.withColumnRenamed("directory", "asking")

    def result(self) -> DataFrame:
        """The kept columns, license (NULL: none found), how (own, inherited), score and levels up."""
        joined = self.own.join(self._directories(), F.col("directory") == F.col("asking"), "left")
        own = F.col("license").isNotNull()
        return joined.select(
            *[F.col(f"kept.`{c}`").alias(c) for c in self.keep],
            F.coalesce("license", "inherited").alias("license"),
            F.when(own, "own").when(F.col("inherited").isNotNull(), "inherited").alias("how"),
            F.round("score", 6).alias("score"),
            F.when(~own, F.col("up")).alias("levels_up"),
        )

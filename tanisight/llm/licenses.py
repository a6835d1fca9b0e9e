"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

A unit of text is compared with each template: every line with a cue, the header (lines up to the
first blank one) if it has a cue, and the whole text of a licence file. Terms are weighted by how
rare they are among all documents; the frequencies, of the templates' terms only, are counted over
the whole table. A file without a licence of its own takes that of the nearest directory above it
that holds a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.llm.common import as_bytes, slices
from tanisight.session import materialize, ship_package

TERM = re.compile(rb"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]")
CUE = re.compile(rb"licen[sc]e|copyright|rights reserved|permission|spdx|creative commons|public domain|warrant|redistribut")
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.-][^/]*)?$"

#: Statements of common licences, as they are written (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2, as published by the Free Software Foundation."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without permission."),
]
OWN = "doc_id long, path string, license string, similarity double, is_file boolean"


def terms(text: bytes) -> Counter:
    return Counter(TERM.findall(text.lower()))


def units(text: bytes, whole: bool) -> list[bytes]:
    if not text or not CUE.search(text.lower()):
        return []
    lines = text.split(b"\n")
    blank = next((i for i, line in enumerate(lines) if not line.strip()), len(lines))
    found = [line for line in lines if CUE.search(line.lower())]
    header = b"\n".join(lines[:blank])
    if blank > 1 and CUE.search(header.lower()):
        found.append(header)
    return [*found, text] if whole and len(lines) > 1 else found


class Templates:
    """Weighted template vectors, and the best template of a unit."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], documents: int):
        self.rarest = math.log((1 + documents) / 1) + 1
        self.weight = {t: math.log((1 + documents) / (1 + n)) + 1 for t, n in frequency.items()}
        self.vectors = [(name, self.vector(terms(text.encode()))) for name, text in templates]

    def vector(self, counts: Counter) -> dict[bytes, float]:
        raw = {t: (1 + math.log(n)) * self.weight.get(t, self.rarest) for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        return {t: x / norm for t, x in raw.items()}

    def best(self, unit: bytes) -> tuple[float, str]:
        own = self.vector(terms(unit))
        return max(((sum(x * own.get(t, 0.0) for t, x in v.items()), name) for name, v in self.vectors), key=lambda p: (p[0], p[1]), default=(0.0, ""))


def directory(path):
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def scan(spark: SparkSession, files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.6) -> DataFrame:
    """Per file (doc_id, path, text): license, similarity, and where it is from.

    origin: "own", "inherited" (license_dir says from where) or null without a licence. A licence
    file's own licence holds for its directory; among several in one directory the most similar,
    then the first by name. Null path: the root directory. Null and empty text: no own licence.
    Rows are judged one by one; an empty table gives no rows. Directories, not files, are joined
    with their ancestors, so a directory above a third of all files costs a row per directory.
    """
    ship_package(spark)
    vocabulary = {t for _, text in templates for t in terms(text.encode())}

    def count(batches):
        seen: Counter = Counter()
        documents = 0
        for batch in slices(batches):
            for text in as_bytes(batch):
                documents += 1
                seen.update(vocabulary.intersection(TERM.findall(text.lower())))
        yield pa.RecordBatch.from_arrays([pa.array([b"", *seen], pa.binary()), pa.array([documents, *seen.values()], pa.int64())], ["term", "n"])

    counts = {bytes(r.term): r.n for r in files.select("text").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    model = Templates(templates, {t: counts.get(t, 0) for t in vocabulary}, counts.get(b"", 0))

    def judge(batches):
        for batch in slices(batches):
            out = []
            is_file = batch.column("is_file").to_pylist()
            for text, whole in zip(as_bytes(batch), is_file, strict=True):
                similar, name = max((model.best(u) for u in units(text, whole)), default=(0.0, ""))
                out.append((name, similar) if similar >= least else (None, None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("path").cast(pa.string()), pa.array([x for x, _ in out], pa.string()),
                 pa.array([x for _, x in out], pa.float64()), pa.array(is_file, pa.bool_())], ["doc_id", "path", "license", "similarity", "is_file"])

    named = files.select("doc_id", F.coalesce("path", F.lit("")).alias("path"), "text")
    own = materialize(named.withColumn("is_file", F.col("path").rlike(LICENSE_FILE)).mapInArrow(judge, OWN).withColumn("dir", directory(F.col("path"))))
    declared = own.filter("is_file and license is not null").groupBy("dir").agg(
        F.max_by("license", F.struct("similarity", "license")).alias("license"), F.max("similarity").alias("similarity"))
    steps = F.split("dir", "/")
    above = own.select("dir").distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(steps)))))
    above = above.withColumn("license_dir", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/"))
    nearest = above.join(declared.withColumnRenamed("dir", "license_dir"), "license_dir").groupBy("dir").agg(
        F.max_by(F.struct("license_dir", "license", "similarity"), "depth").alias("from"))
    rows = own.join(nearest, "dir", "left")
    mine = F.col("license").isNotNull()
    return rows.select(
        "doc_id", "path", F.when(mine, F.col("license")).otherwise(F.col("from.license")).alias("license"),
        F.when(mine, F.col("similarity")).otherwise(F.col("from.similarity")).alias("similarity"),
        F.when(mine, F.lit("own")).when(F.col("from.license").isNotNull(), F.lit("inherited")).alias("origin"),
        F.when(~mine, F.col("from.license_dir")).alias("license_dir"))

"""License scans by conditional compression.

Sentences and lines that mention licensing, and stretches of words around a mention that hold most of a template,
over line breaks too, are blocks. They are compressed with each license template as a raw dictionary. The more
a template shortens the compressed block, the likelier the block is its wording; of the templates
that shorten it enough, the one whose wording differs in the fewest words is confirmed if that is little enough.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.worker import kept

# Words that mark a block for comparison.
CUES = r"licen[sc]|copyright|copyleft|©|spdx|public domain|rights reserved|creative commons|\bcc[ -](by|0)|\bgnu\b|warrant(y|ies)|permission is|redistribut"

# Usual wordings of licenses. Words in the last field may not be missing from a match.
TEMPLATES = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    ("MIT", "This project is licensed under the terms of the MIT license.", "mit"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "sublicense"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2 0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache 2 0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu general 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gnu general 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu lesser 3"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1.", "gnu lesser 2 1"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "gnu lesser 2 1"),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gnu library general 2"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu affero 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2 0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "mozilla 2 0"),
    # the opening alone does not tell which of the family it is
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "redistribution binary"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistributions reproduce"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "redistributions reproduce neither endorse"),
    ("BSD-4-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. 4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "redistributions reproduce advertising acknowledgement neither"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "fee"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4 0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative attribution 4 0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by sa 4 0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "creative sharealike 4 0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by nc 4 0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "creative noncommercial 4 0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "cc by nd 4 0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "cc by nc sa 4 0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "creative noncommercial sharealike 4 0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0.", "cc by nc nd 4 0"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "creative noncommercial noderivatives 4 0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "creative noderivatives 4 0"),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0 Universal.", "cc0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("proprietary", "All rights reserved.", "all rights reserved"),
)

# Words that may not stand between those of a license's wording; they make it another license.
_CC = {"sa": "sa sharealike", "nc": "nc noncommercial", "nd": "nd noderivatives noderivs"}
FOREIGN = {
    "GPL-3.0": "lesser library affero 2",
    "GPL-2.0": "lesser library affero 3",
    "LGPL-3.0": "affero 2",
    "LGPL-2.1": "affero 3",
    "LGPL-2.0": "affero lesser 3 1",
    "AGPL-3.0": "lesser 2",
    "BSD-2-Clause": "neither endorse advertising",
    "BSD-3-Clause": "advertising",
    "CC-BY-4.0": " ".join(_CC.values()),
    "CC-BY-SA-4.0": _CC["nc"] + " " + _CC["nd"],
    "CC-BY-NC-4.0": _CC["sa"] + " " + _CC["nd"],
    "CC-BY-ND-4.0": _CC["nc"] + " " + _CC["sa"],
    "CC-BY-NC-SA-4.0": _CC["nd"],
    "CC-BY-NC-ND-4.0": _CC["sa"],
}

LEAST_REDUCTION = 0.2
#: Shares of a template's words that may be missing, and of words that may stand between them.
MOST_MISSING = 0.2
MOST_EXTRA = 0.35
#: Blocks a worker remembers before it starts anew; bounds its memory, not its results.
REMEMBERED = 100_000


class Match(NamedTuple):
    license: str
    template: int
    reduction: float
    missing: str
    extra: str


def wording(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def family(license: str) -> str:
    return license.split("-")[0]


def common(template: list[str], block: list[str]) -> tuple[list[str], list[int]]:
    """Template words that a longest common subsequence leaves out, and the places of the block's words that it keeps."""
    n, m = len(template), len(block)
    table = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if template[i] == block[j] else max(table[i + 1][j], table[i][j + 1])
    i = j = 0
    missing, kept_at = [], []
    while i < n and j < m:
        if template[i] == block[j] and table[i][j] == table[i + 1][j + 1] + 1:
            kept_at.append(j)
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            missing.append(template[i])
            i += 1
        else:
            j += 1
    return missing + template[i:], kept_at


def alignment(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """Template words that a longest common subsequence leaves out, and the block's words that stand between the
    first and the last word it keeps."""
    missing, kept_at = common(template, block)
    held = set(kept_at)
    extra = [block[k] for k in range(kept_at[0], kept_at[-1] + 1) if k not in held] if kept_at else []
    return missing, extra


class Scanner:
    """The templates as raw dictionaries, and the verdicts on blocks met before."""

    def __init__(self) -> None:
        import zstandard

        raw = lambda t: zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.with_template = [zstandard.ZstdCompressor(dict_data=raw(t), **options) for _, t, _ in TEMPLATES]
        self.words = [wording(t) for _, t, _ in TEMPLATES]
        self.foreign = [set(FOREIGN.get(n, "").split()) - set(wording(t)) for n, t, _ in TEMPLATES]
        self.needed = [set(k.split()) for _, _, k in TEMPLATES]
        self.met: dict[str, Match | None] = {}

    def verdict(self, block: str) -> Match | None:
        if block not in self.met:
            if len(self.met) >= REMEMBERED:
                self.met.clear()
            self.met[block] = self._judged(block)
        return self.met[block]

    def wordings(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(line number from 0, lines, block): for each cue and template the closest stretch of words that keeps
        enough of the template, within one and a half template lengths before and after the cue, over line breaks."""
        places = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
        words, starts = [text[a:b].lower() for a, b in places], [a for a, _ in places]
        breaks = [m.start() for m in re.finditer("\n", text)]
        met = set()
        for cue in kept("licenses", CUES, lambda: re.compile(CUES, re.IGNORECASE)).finditer(text):
            at = bisect_right(starts, cue.end() - 1)
            around: dict[int, set[str]] = {}
            for template, needed in zip(self.words, self.needed, strict=True):
                n = len(template)
                reach = n + n // 2 + 1
                low, high = max(0, at - reach), at + reach
                if reach not in around:
                    around[reach] = set(words[low:high])
                if not needed <= around[reach] or len(set(template) - around[reach]) > MOST_MISSING * n:
                    continue
                missing, there = common(template, words[low:high])
                if len(missing) > MOST_MISSING * n:
                    continue
                end = low + there[-1]
                _, there = common(template[::-1], words[low : end + 1][::-1])  # as late a beginning as that end allows
                first = end - there[-1]
                if (first, end) not in met:
                    met.add((first, end))
                    line = bisect_left(breaks, places[first][0])
                    block = " ".join(text[places[first][0] : places[end][1]].split())
                    yield line, bisect_left(breaks, places[end][0]) - line + 1, block

    def _judged(self, block: str) -> Match | None:
        data = block.encode()
        alone = len(self.plain.compress(data))
        reductions = [1 - len(c.compress(data)) / alone for c in self.with_template]
        own = wording(block)
        found = []
        for k, reduction in enumerate(reductions):
            if reduction < LEAST_REDUCTION or not self.needed[k] <= set(own):
                continue
            missing, extra = alignment(self.words[k], own)
            size = len(self.words[k])
            if len(missing) <= MOST_MISSING * size and len(extra) <= MOST_EXTRA * size and not self.needed[k] & set(missing) and not self.foreign[k] & set(extra):
                # a longer wording says more than one it contains: count what it leaves of the block too
                rest = len(own) - size + len(missing) - len(extra)
                found.append((len(missing) + len(extra) + rest, -reduction, k, " ".join(missing), " ".join(extra)))
        if not found:
            return None
        _, reduction, k, missing, extra = min(found)
        return Match(TEMPLATES[k][0], k, -reduction, missing, extra)


def candidate_blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """(line number from 0, lines, block): the sentences of each line that mention licensing, and the line itself.
    Wordings that run over lines or stand in a longer line are those of ``Scanner.wordings``."""
    cue = kept("licenses", CUES, lambda: re.compile(CUES, re.IGNORECASE))
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if not cue.search(line):
            continue
        sentences = re.split(r"(?<=[.!?:;])\s+(?=[A-Z(\"])", line.strip())
        for sentence in sentences:
            if cue.search(sentence):
                yield i, 1, sentence
        if len(sentences) > 1:
            yield i, 1, line.strip()


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document, license and line: the key, ``license``, ``line`` (from 0), ``reduction`` (of the
    compressed size by the template), ``missing`` and ``extra`` words against it, ``exact``, and the ``block``.

    Null and empty texts and texts without a mention have no rows; texts are taken whole. Of several blocks of a line
    that match one license, the one with fewest differences counts. Repeated rows give their rows each; ties go by
    the order of templates. Null keys are kept. An empty table gives no rows; other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("reduction", T.DoubleType()),
            T.StructField("missing", T.StringType()),
            T.StructField("extra", T.StringType()),
            T.StructField("exact", T.BooleanType()),
            T.StructField("block", T.StringType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept("licenses", "scanner", Scanner)
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                best: dict[tuple[str, int], tuple] = {}
                spans: dict[tuple[str, int], list[int]] = {}
                whole: dict[tuple[str, int], set[tuple[str, str]]] = {}
                text_of_row = batch.column(1)[r].as_py() or ""
                for line, lines, block in chain(candidate_blocks(text_of_row), scanner.wordings(text_of_row)):
                    m = scanner.verdict(block)
                    if m:
                        differences = len(m.missing.split()) + len(m.extra.split())
                        said = " ".join(wording(block))
                        for k in range(line, line + lines):
                            whole.setdefault((family(m.license), k), set()).add((m.license, said))
                        for k in range(line + 1, line + lines):
                            spans.setdefault((m.license, k), []).append(differences)
                        old = best.get((m.license, line))
                        if old is None or differences < old[0]:
                            best[m.license, line] = (differences, r, m.license, line, m.reduction, m.missing, m.extra, differences == 0, block)
                # the rest of a wording, from a later line on, is no finding of its own, nor is a family's
                # shorter wording within a longer one
                for at, b in sorted(best.items()):
                    said = " ".join(wording(b[-1]))
                    longer = any(n != at[0] and len(x) > len(said) and said in x for n, x in whole[family(at[0]), at[1]])
                    if not longer and all(d > b[0] for d in spans.get(at, [])):
                        rows.append(b[1:])
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            keys = batch.column(0).take(pa.array(columns[0], pa.int64()))
            kinds = [pa.string(), pa.int32(), pa.float64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
            rest = [pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([keys, *rest], [f.name for f in schema])

    mentions = docs.select(key, text).where(F.rlike(text, F.lit("(?i)" + CUES)))
    return mentions.mapInArrow(scan, schema)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))

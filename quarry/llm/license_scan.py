"""Licence scan (operator 2).

Passages of a file are compared with licence statements, header notices, licence texts and headings by
the cosine of sparse TF-IDF vectors: every line, every two or three lines joined, and every run of about
as many words as the statement wherever it begins, across line ends and comment marks. The best passage at or
above ``MIN_COSINE`` gives the file's own licence. A licence file
speaks for its directory; of web pages, index pages and those with a statement in head block or footer
do. Files without a licence of their own take that of the nearest directory above them that has one,
found by joins of directory paths.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import free_name, saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_COSINE = 0.8
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
INDEX_PAGE = r"(?i)^((index|default|home)\.[a-z0-9]+)?$"
HEAD_LINES = 3          # lines of a file's or page's head block
JOINED_LINES = 3        # lines that are joined to one passage at most
SHORT_STATEMENT = 12    # words; only runs of longer statements' words may be shorter than the statement
AFTER = 4               # words after a run in which its version may follow
# Elements that begin and end a line of a page; all others are inline.
BLOCKS = ("address|article|aside|blockquote|body|br|button|caption|center|dd|details|dialog|dir|div|dl|dt|fieldset|"
          "figcaption|figure|footer|form|frame|frameset|h[1-6]|head|header|hgroup|hr|html|iframe|legend|li|link|main|"
          "menu|meta|nav|noscript|object|ol|optgroup|option|p|pre|search|section|select|summary|table|tbody|td|"
          "textarea|template|tfoot|th|thead|title|tr|ul|video")
TOKEN = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
# Licence identifiers and the statements that name them, then notices and licence texts.
_GNU = (("AGPL-3.0", "Affero General", "3"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"),
        ("LGPL-2.0", "Library General", "2"), ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"))
_CC = (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-SA", "Attribution-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"))
_NAMED = (("Apache-2.0", "Apache License 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
          ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-2-Clause", 'BSD 2-Clause "Simplified" License'),
          ("BSD-3-Clause", 'BSD 3-Clause "New" or "Revised" License'), ("BSL-1.0", "Boost Software License, Version 1.0"),
          ("ISC", "ISC License"), ("MIT", "MIT License"), ("MPL-2.0", "Mozilla Public License 2.0"),
          ("GPL-2.0", "GPLv2"), ("GPL-3.0", "GPLv3"))
_SPDX = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "ISC", "MIT", "MPL-2.0", "0BSD", "CC0-1.0", "Unlicense", *(f"CC-{k}-4.0" for k, _ in _CC))
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. {}This software is provided by the copyright holders and contributors \"as is\" and any express or "
        "implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
        "particular purpose are disclaimed.")
_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_PLAIN = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the Apache License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and modify it under the terms of the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
STATEMENTS = _PLAIN + (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "The ASF licenses this file to you under the Apache License, Version 2.0"),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format("Neither the name of the copyright holder nor the names of its contributors may be used to "
                                 "endorse or promote products derived from this software without specific prior written "
                                 "permission. ")),
    ("0BSD", _USE + ". The software is provided \"as is\" and the author disclaims all warranties with regard to this "
                    "software including all implied warranties of merchantability and fitness."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                "and accompanying documentation covered by this license"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("CC0-1.0", "Dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain Dedication."),
    ("ISC", _USE + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    *((i, f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public "
          f"License as published by the Free Software Foundation, either version {v} of the License, or (at your option) any "
          "later version.") for i, kind, v in _GNU for what in ("program", "library")),
    *((i, f"under the terms of the GNU {kind} Public License version {v} as published by the Free Software Foundation")
      for i, kind, v in _GNU),
    *((i, f"Licensed under the GNU {kind} Public License, version {v}") for i, kind, v in _GNU),
    *((i, f"{how} under the {name}") for i, name in _NAMED for how in ("Licensed", "Distributed")),
    *((f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License.") for k, name in _CC),
    *((f"CC-{k}-4.0", f"Licensed under CC {k} 4.0.") for k, _ in _CC[4:]),
    *((i, f"SPDX-License-Identifier: {i}") for i in _SPDX),
    *((i, f"SPDX-License-Identifier: {i}{only}") for i, _, _ in _GNU for only in ("", "-only", "-or-later")),
)
# without a version these names mean a later one
OLDER = ("GPL-2.0", "LGPL-2.0", "LGPL-2.1")
# headings of licence files: they count as whole lines only
HEADINGS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.0", "GNU Library General Public License Version 2, June 1991"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("MIT", "The MIT License (MIT)"), ("CC0-1.0", "CC0 1.0 Universal"), ("Unlicense", "The Unlicense"),
    *((i, f"GNU {kind} Public License, version {v}") for i, kind, v in _GNU),
    *((i, name) for i, name in _NAMED),
    *((i, f"License: {i}") for i in _SPDX),
    *((f"CC-{k}-4.0", f"{name} 4.0 International") for k, name in _CC),
    *((f"CC-{k}-4.0", f"Creative Commons {name} 4.0 International Public License") for k, name in _CC),
)


def words(text: str) -> list[str]:
    """Words and numbers in lower case; ``2.0`` is written as ``2``."""
    return [w.removesuffix(".0") for w in TOKEN.findall(text.lower())]


def word_lines(text: str | None) -> list[list[str]]:
    """Words of each line that has some."""
    return [x for x in map(words, (text or "").splitlines()) if x]


class Index:
    """Unit TF-IDF vectors of the statements and headings, one row each."""

    def __init__(self, statements=STATEMENTS, headings=HEADINGS, min_cosine: float = MIN_COSINE, strict: bool = True):
        """Not ``strict``: single lines only, of any length."""
        known = [*statements, *headings]
        self.strict = strict
        self.min_cosine = min_cosine
        self.names = [n for n, _ in known]
        self.sliding = [strict and i < len(statements) for i in range(len(known))]
        bags = [Counter(words(t)) for _, t in known]
        self.lengths = [sum(b.values()) for b in bags]
        # a word counts by the number of licences that have it
        df = Counter(w for _, w in {(n, w) for n, b in zip(self.names, bags) for w in b})
        n = len(set(self.names))
        self.ids = {w: i for i, w in enumerate(sorted(df), 1)}      # 0: a word in no statement
        self.idf = np.full(len(df) + 1, 1 + math.log(1 + n))
        for w, d in df.items():
            self.idf[self.ids[w]] = 1 + math.log((1 + n) / (1 + d))
        self.unit = np.zeros((len(bags), len(df) + 1))
        self.needs, self.version = [], []
        for i, b in enumerate(bags):
            for w, c in b.items():
                self.unit[i, self.ids[w]] = c * self.idf[self.ids[w]]
            self.unit[i] /= math.sqrt((self.unit[i] ** 2).sum())
            name, short = [w for w in words(self.names[i]) if w in b], self.lengths[i] <= SHORT_STATEMENT
            clauses = self.names[i].startswith("BSD") and not short     # their numbers are often left out
            # tags and headings are too short to do without a word of the licence's name
            tag = [w for w in (*name, "spdx") if short and w in b and not w[0].isdigit()]
            self.needs.append(np.array([self.ids[w] for w in tag if strict and known[i] not in _PLAIN], dtype=np.int64))
            self.version.append(np.array([self.ids[w] for w in name if w[0].isdigit() and not clauses], dtype=np.int64))
        self.mass = self.unit ** 2

    def passages(self, lines: list[list[str]]) -> tuple[list[tuple[str, float]], bool]:
        """Licence and cosine of the best passage of ``word_lines`` for each statement that is met, and
        whether one of these passages begins in the first ``HEAD_LINES`` lines."""
        met = np.zeros(self.unit.shape[1])
        met[[self.ids[w] for w in self.ids.keys() & set().union(*lines)]] = 1
        # a passage's cosine is at most the root of the statement's mass on words that the text has
        near = np.flatnonzero(self.mass @ met >= self.min_cosine ** 2 * (1 - 1e-9))
        near = [i for i in near if met[self.needs[i]].all()]
        if not near:
            return [], False
        at = np.array([self.ids.get(w, 0) for x in lines for w in x], dtype=np.int64)
        number = np.array([w[0].isdigit() for x in lines for w in x], dtype=bool)
        first = np.cumsum([0, *map(len, lines)])
        head = int(first[min(HEAD_LINES, len(lines))])
        weight = self.idf[at]
        square = np.concatenate(([0.0], np.cumsum(weight ** 2)))
        joined = [(first[:-k], first[k:]) for k in range(1, (JOINED_LINES if self.strict else 1) + 1) if k <= len(lines)]
        found, opens = [], False
        for i in near:
            pairs = list(joined)
            whole = sum(len(a) for a, _ in pairs)
            if self.sliding[i]:
                for size in {min(self.lengths[i] * k // 4, len(at)) for k in (3, 4, 5)[self.lengths[i] <= SHORT_STATEMENT:]}:
                    start = np.arange(len(at) - size + 1)
                    pairs.append((start, start + size))
            s, e = (np.concatenate(x) for x in zip(*pairs))
            dot = np.concatenate(([0.0], np.cumsum(weight * self.unit[i][at])))
            # repeated words make a passage longer than this, so no cosine exceeds the bound
            bound = np.minimum(1.0, (dot[e] - dot[s]) / np.sqrt(square[e] - square[s]))
            order = np.flatnonzero(bound >= self.min_cosine - 1e-9)
            order = order[np.argsort(-bound[order], kind="stable")]
            best, starts = 0.0, False
            for j in order.tolist():
                in_head = s[j] < head and not starts
                if bound[j] <= best + 1e-9 and not in_head:
                    continue
                # a run of words may end just before the version
                cos = self.cosine(i, at[s[j]:e[j]], number[s[j]:e[j] + AFTER * int(j >= whole)].any())
                if cos >= self.min_cosine:
                    best, starts = max(best, cos), starts or bool(in_head)
            if best:
                found.append((self.names[i], best))
                opens = opens or starts
        return found, opens

    def cosine(self, i: int, at: np.ndarray, numbers: bool) -> float:
        """Cosine of statement ``i`` and the words of one passage; 0 if it lacks a word that the statement
        needs, or has ``numbers`` without the statement's version."""
        one, counts = np.unique(at, return_counts=True)
        dated = numbers or self.strict and self.names[i] in OLDER
        if not np.isin(self.needs[i], one).all() or dated and not np.isin(self.version[i], one).all():
            return 0.0
        unseen = counts[one == 0].sum()                     # unseen words count as all different
        x = counts * self.idf[one]
        total = (x[one != 0] ** 2).sum() + unseen * self.idf[0] ** 2
        return min(1.0, round(float((x * self.unit[i][one]).sum() / math.sqrt(total)), 9))
    def best(self, text: str | None) -> tuple[str, float] | None:
        """Licence and cosine of the closest passage (ties: first by name); None where none is close."""
        found, _ = self.passages(word_lines(text))
        return min(found, key=lambda f: (-f[1], f[0])) if found else None


class Scan:
    """The full index, and where it finds nothing the plain statements by themselves, line by line."""

    def __init__(self, statements=STATEMENTS, headings=HEADINGS, min_cosine: float = MIN_COSINE):
        plain = [x for x in statements if x in _PLAIN]
        self.indexes = [Index(statements, headings, min_cosine)]
        self.indexes += [Index(plain, (), min_cosine, strict=False)] if plain else []

    def best(self, text: str | None) -> tuple[str | None, float | None, bool]:
        """Licence and cosine of the closest passage (ties: first by name), and whether the text opens
        with a passage that is close."""
        lines = word_lines(text)
        for index in self.indexes:
            found, head = index.passages(lines)
            if found:
                return *min(found, key=lambda f: (-f[1], f[0])), head
        return None, None, False


FOUND = "struct<licence:string,cosine:double,head:boolean>"


def own_licence(text: Column, statements=STATEMENTS, min_cosine: float = MIN_COSINE, headings=HEADINGS) -> Column:
    """Licence, cosine and whether the text opens with one; null fields where no passage is close."""

    @F.arrow_udf(FOUND)
    def scan(arr: pa.Array) -> pa.Array:
        scanner, out = Scan(statements, headings, min_cosine), []
        for t in arr:
            out.append(dict(zip(("licence", "cosine", "head"), scanner.best(t.as_py()))))
        return pa.array(out, pa.struct([("licence", pa.string()), ("cosine", pa.float64()), ("head", pa.bool_())]))

    return scan.asNondeterministic()(text)


def directory(path: Column) -> Column:
    """The path up to its last slash; a path without one lies in the root, the empty path."""
    return F.regexp_replace(path, r"/?[^/]*\z", "")


def above(folder: Column) -> Column:
    """The directory itself and all directories above it, down from the root."""
    parts = F.split(folder, "/")
    return F.array_union(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, F.lit(1), n))))


def licences(files: DataFrame, path: str = "path", text: str = "text", out: str = "licence",
             min_cosine: float = MIN_COSINE, head_speaks: bool = False, notice: str | None = None) -> DataFrame:
    """Every row of ``files`` (all columns kept) with a struct ``out``: ``licence``, ``cosine`` (of an
    own licence), ``how`` (``own``, ``inherited`` or ``none``) and ``source`` (the directory it comes from).

    A licence file is known by its name; with ``head_speaks`` a file that opens with a statement counts
    as well. ``notice``, for web pages, names a column with the text of head block and footer (see
    ``page_notice``): a page speaks with the licence stated there, a directory's index page with any
    licence of its own. Where a directory's licence files disagree, the licence most of them name holds
    (ties: first by name). Null paths lie in no directory and inherit nothing; null and empty texts have no licence;
    repeated rows are treated alike. A column of ``files`` named ``out`` is replaced.
    """
    p = F.col(f"`{path}`")
    own, at, said, folder, nearest = (free_name(files, c) for c in ("own", "at", "said", "folder", "nearest"))
    stated = own_licence(F.col(f"`{notice}`"), min_cosine=min_cosine)["licence"] if notice else F.lit(None).cast("string")
    scanned = saved(files.withColumn(own, own_licence(F.col(f"`{text}`"), min_cosine=min_cosine)).withColumn(said, stated)
                    .withColumn(at, directory(p)).drop(*([out] if out in files.columns else [])), "licences")
    o = F.col(own)
    # one row per directory: rows of a hot directory are aggregated before any shuffle
    file = F.regexp_extract(p, r"[^/]*\z", 0)
    speaker = (F.lit(head_speaks) & F.col(f"{own}.head")) | file.rlike(LICENCE_FILE)
    if notice:
        speaker = speaker | file.rlike(INDEX_PAGE)
    speaks = scanned.where(p.isNotNull()).select(F.col(at).alias("dir"), F.coalesce(
        F.col(said), F.when(speaker, F.col(f"{own}.licence"))).alias("name")).where("name is not null")
    votes = speaks.groupBy("dir", "name").count()
    declared = votes.groupBy("dir").agg(F.min(F.struct(-F.col("count"), "name")).alias("v")).select("dir", "v.name")
    folders = scanned.where(p.isNotNull()).select(F.col(at).alias("folder")).distinct()
    near = (folders.select("folder", F.posexplode(above(F.col("folder"))).alias("depth", "dir"))
                   .join(declared, "dir").groupBy("folder")
                   .agg(F.max(F.struct("depth", "name", "dir")).alias("n"))
                   .select(F.col("folder").alias(folder), F.struct("n.name", "n.dir").alias(nearest)))
    j = scanned.join(near, F.col(at) == F.col(folder), "left")
    n = F.col(nearest)
    how = F.when(o.licence.isNotNull(), "own").when(n.isNotNull(), "inherited").otherwise("none")
    return j.withColumn(out, F.struct(F.coalesce(o.licence, n["name"]).alias("licence"), o.cosine.alias("cosine"),
                                      how.alias("how"), F.when(o.licence.isNull(), n["dir"]).alias("source"))
                        ).drop(own, at, said, folder, nearest)


def page_path(url: Column) -> Column:
    """Host and path of a URL without scheme, query and fragment; a host alone is its root page."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*\z", "")
    return F.when(bare.rlike(r"^[^/]+\z"), F.concat(bare, F.lit("/"))).otherwise(bare)


def page_text(html: Column) -> Column:
    """Visible text of a page, one line per block element; inline elements leave their line whole."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    lines = F.regexp_replace(bare, rf"(?i)</?(?:{BLOCKS})(?![A-Za-z0-9-])[^>]*>", "\n")
    return F.regexp_replace(F.regexp_replace(lines, r"(?s)<[^>]*>", ""), r"(?i)&(?:nbsp|#160|#xa0);|\x{A0}", " ")


def page_notice(html: Column) -> Column:
    """Text of a page's head block and footers: the first ``HEAD_LINES`` lines after title and
    navigation, then its header and footer elements. Those of an article speak for the article only."""
    body = F.regexp_replace(html, r"(?is)<(title|nav)\b.*?</\1\s*>|\s+", " ")
    head = F.slice(F.filter(F.split(page_text(body), "\n"), lambda x: F.trim(x) != ""), 1, HEAD_LINES)
    site = F.regexp_replace(body, r"(?i)<article\b.*?</article\s*>", "\n")
    ends = F.regexp_extract_all(site, F.lit(r"(?i)<(header|footer)\b[^>]*>.*?(?:</\1\s*>|\z)"), 0)
    return F.concat_ws("\n", head, F.transform(ends, page_text))

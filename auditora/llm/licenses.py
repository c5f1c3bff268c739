"""License recognition by sentence rules.

A text is cut into sentences at their marks and at blank lines; a sentence may
run over line ends, and over one blank line where its known form has one.  Words are lower-case letters and digits; marks of comments
and punctuation do not count.  Sentences known from license texts become
identifiers, and ordered rules over identifiers, longest first, name licenses:
a rule's identifiers must follow each other with at most MAX_GAP other
sentences between two of them, and no identifier serves two findings.

Edge cases: null and empty texts have no findings; repeated sentences give
repeated findings; very long texts are read once from front to back; other
columns pass through.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_GAP = 3

# Sentences of public license texts and notices.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-notice-the": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-obtain": "You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3-free-library": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl21-free-program": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "lgpl-copy": "You should have received a copy of the GNU Lesser General Public License along with this program",
    "lgpl-copy-library": "You should have received a copy of the GNU Lesser General Public License along with this library",
    "agpl-copy": "You should have received a copy of the GNU Affero General Public License along with this program",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-title": "CC0 1.0 Universal",
    "cc0-dedicated": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
}

# Ordered rules: license, then the identifiers in order.
RULES = (
    ("Apache-2.0", ("apache-notice-the", "apache-comply", "apache-obtain", "apache-as-is")),
    ("Apache-2.0", ("apache-notice-the", "apache-comply")),
    ("Apache-2.0", ("apache-notice-the",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("spdx-mit",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-copy")),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0", ("spdx-gpl3",)),
    ("GPL-2.0", ("gpl2-free", "gpl-hope", "gpl-copy")),
    ("GPL-2.0", ("gpl2-free",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-form",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    ("CC-BY-4.0", ("cc-by-4-work",)),
    ("LGPL-3.0", ("lgpl3-free", "gpl-hope", "lgpl-copy")),
    ("LGPL-3.0", ("lgpl3-free",)),
    ("LGPL-3.0", ("lgpl3-free-library", "lgpl-hope", "lgpl-copy-library")),
    ("LGPL-3.0", ("lgpl3-free-library",)),
    ("LGPL-2.1", ("lgpl21-free", "lgpl-hope", "lgpl-copy-library")),
    ("LGPL-2.1", ("lgpl21-free",)),
    ("LGPL-2.1", ("lgpl21-free-program", "gpl-hope", "lgpl-copy")),
    ("LGPL-2.1", ("lgpl21-free-program",)),
    ("AGPL-3.0", ("agpl3-free", "gpl-hope", "agpl-copy")),
    ("AGPL-3.0", ("agpl3-free",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("Unlicense", ("unlicense-free", "unlicense-anyone",)),
    ("Unlicense", ("unlicense-free",)),
)

# Further SPDX identifiers and their licenses, the old forms without -only included.
_SPDX = {f"{k}{end}": k for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("", "-only", "-or-later") if k + end != "GPL-3.0-only"}
_SPDX |= {k: k for k in ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense")}
SENTENCES |= {f"spdx-{k.lower()}": f"SPDX-License-Identifier: {k}" for k in _SPDX}
RULES += tuple((v, (f"spdx-{k.lower()}",)) for k, v in _SPDX.items())

_WORDS = re.compile(r"[a-z0-9]+")
# Semicolons and colons end sentences only outside known ones, so the trie walks on across them.
_MARK = re.compile(r"([.!?;:]+(?=\s|\Z)|\n)")
_END = "\0"
_BLANK = "\1"


def build_trie(sentences: dict[str, str]) -> dict:
    trie: dict = {}
    for name, sentence in sentences.items():
        node = trie
        for k, paragraph in enumerate(sentence.lower().split("\n\n")):
            if k:
                node[_BLANK] = True
            for word in _WORDS.findall(paragraph):
                node = node.setdefault(word, {})
        node[_END] = name
    return trie


def recognise(text: str, trie: dict) -> list[tuple[int, int, str]]:
    """Known sentences of a text as (first part, part behind, identifier); parts lie between marks and line ends."""
    parts = _MARK.split(text.lower())
    found: list[tuple[int, int, str]] = []
    i, n = 0, len(parts)
    while i < n:
        first = _WORDS.search(parts[i])
        if first is None or first[0] not in trie:
            i += 2
            continue
        node, j, hit, blank = trie, i, None, False
        while node is not None and j < n:
            words = _WORDS.findall(parts[j])
            if not words and j > i and not parts[j].strip() and j >= 2 and parts[j - 1] == "\n":
                if blank or _BLANK not in node:
                    break  # a blank line ends any other sentence
                blank = True
            for word in words:
                node = node.get(word)
                if node is None:
                    break
            if node is not None and _END in node:
                hit = (i // 2, j // 2 + 1, node[_END])
            j += 2
        if hit:
            found.append(hit)
            i = 2 * hit[1]
        else:
            i += 2
    return found


def match_rules(found: list[tuple[int, int, str]], rules: tuple = RULES, max_gap: int = MAX_GAP) -> list[tuple[str, int, int]]:
    """(license, first identifier, number of identifiers spanned) in order of place."""
    used = [False] * len(found)
    out: list[tuple[str, int, int]] = []
    for name, ids in sorted(rules, key=lambda r: -len(r[1])):
        for start in range(len(found)):
            if used[start] or found[start][2] != ids[0]:
                continue
            taken = [start]
            for wanted in ids[1:]:
                k = taken[-1] + 1
                while k < len(found) and found[k][0] - found[taken[-1]][1] <= max_gap and (used[k] or found[k][2] != wanted):
                    k += 1
                if k >= len(found) or found[k][0] - found[taken[-1]][1] > max_gap:
                    break
                taken.append(k)
            if len(taken) == len(ids):
                for k in taken:
                    used[k] = True
                out.append((name, start, taken[-1] - start + 1))
    return sorted(out, key=lambda r: r[1])


RESULT = "struct<sentences:array<struct<part:int, n_parts:int, id:string>>, licenses:array<struct<license:string, first:int, n:int>>>"
_ARROW = pa.struct([("sentences", pa.list_(pa.struct([("part", pa.int32()), ("n_parts", pa.int32()), ("id", pa.string())]))), ("licenses", pa.list_(pa.struct([("license", pa.string()), ("first", pa.int32()), ("n", pa.int32())])))])


def scan_licenses(text: Column, sentences: dict[str, str] | None = None, rules: tuple = RULES, max_gap: int = MAX_GAP) -> Column:
    """struct of the known sentences in order and of the licenses that the rules find in them."""
    trie = build_trie(SENTENCES if sentences is None else sentences)

    @F.arrow_udf(RESULT)
    def scanned(column: pa.Array) -> pa.Array:
        out = []
        for value in column:
            found = recognise(value.as_py() or "", trie)
            out.append({"sentences": [{"part": a, "n_parts": b - a, "id": k} for a, b, k in found], "licenses": [{"license": a, "first": b, "n": c} for a, b, c in match_rules(found, rules, max_gap)]})
        return pa.array(out, _ARROW)

    return scanned(text)

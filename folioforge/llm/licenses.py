"""License scans by conditional compression, confirmed by exact wording differences."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices by which works state their license.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT (permission)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 (header)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY (prose)": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Proprietary": "All rights reserved.",
    "CC-BY-SA-4.0 (prose)": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0 (short)": "available under Creative Commons Attribution-ShareAlike 4.0",
    "GPL-3.0-or-later": "This is free software under the GPL v3 or later.",
    "GPL-3.0 (German)": "Dieses Programm ist freie Software. Sie können es unter den Bedingungen der GNU General Public License, wie von der Free Software Foundation veröffentlicht, weitergeben und/oder modifizieren, entweder gemäß Version 3 der Lizenz oder (nach Ihrer Option) jeder späteren Version.",
    "GPL-3.0 (French)": "Ce programme est un logiciel libre ; vous pouvez le redistribuer ou le modifier suivant les termes de la GNU General Public License telle que publiée par la Free Software Foundation ; soit la version 3 de la licence, soit (à votre gré) toute version ultérieure.",
    "GPL-3.0 (Spanish)": "Este programa es software libre: usted puede redistribuirlo y/o modificarlo bajo los términos de la Licencia Pública General GNU publicada por la Fundación para el Software Libre, ya sea la versión 3 de la Licencia, o (a su elección) cualquier versión posterior.",
    "MIT (text)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC (text)": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause (text)": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Apache-2.0 (text)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib (text)": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
}
# Identifiers that stand in a one-line tag.
TAGGED = "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-or-later LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib".split()
TEMPLATES |= {f"{k} (tag)": f"SPDX-License-Identifier: {k}" for k in TAGGED}
#: Differences, as a share of a template's words, up to which an unconfirmed block is reported.
REPORTED = 0.5
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(word: str) -> str:
    return word.lower().strip(".,;:!?\"'()")


def intact_run(n_words: int, max_differences: float) -> int:
    """Words in a row of a template that any notice shows that may be confirmed: so many differences cut it into one piece more.

    A template that allows none is looked for by three words, so that altered ones are reported as well.
    """
    cuts = int(n_words * max_differences + 1e-9)
    return -(-(n_words - cuts) // (cuts + 1)) if cuts else min(3, n_words)


class Templates:
    """Templates with their raw-content compressors, their runs of words, and the cues: words of which every run has one."""

    def __init__(self, templates: dict[str, str], max_differences: float):
        self.most = max_differences
        self.words = {k: [plain(w) for w in WORD.findall(v)] for k, v in templates.items()}
        self.bare = zstandard.ZstdCompressor(level=6, write_content_size=False, write_checksum=False)
        self.counts = {k: Counter(v) for k, v in self.words.items()}
        self.runs: dict[tuple[str, ...], set[str]] = {}
        for name, words in self.words.items():
            n = intact_run(len(words), max_differences)
            for i in range(len(words) - n + 1) if n else ():
                self.runs.setdefault(tuple(words[i : i + n]), set()).add(name)
        self.lengths = sorted({len(r) for r in self.runs})
        # Rare words first: those of few templates, and long ones.
        used = Counter(w for words in self.words.values() for w in set(words))
        cues: set[str] = set()
        for run in sorted(self.runs, key=lambda r: (len(r), r)):
            if not cues.intersection(run):
                cues.add(min(run, key=lambda w: (-len(w), used[w], w)))
        self.cues = sorted(cues)
        self.finder = re.compile("|".join(map(re.escape, sorted(cues, key=lambda w: (-len(w), w)))) or "(?!)", re.IGNORECASE)
        self.automaton = ahocorasick.Automaton()
        for cue in self.cues:
            self.automaton.add_word(cue, cue)
        self.automaton.make_automaton()
        self.packers = {}
        for k, v in templates.items():
            content = zstandard.ZstdCompressionDict(v.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.packers[k] = zstandard.ZstdCompressor(level=6, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)

    def may_hold(self, text: str) -> bool:
        return bool(self.cues) and next(self.automaton.iter(text.lower()), None) is not None

    def met(self, words: list[str], at: int) -> set[str]:
        """Templates of which a run stands in words around the one at `at`."""
        found: set[str] = set()
        for n in self.lengths:
            for i in range(max(0, at - n + 1), at + 1):
                found |= self.runs.get(tuple(words[i : i + n]), set())
        return found

    def reach(self, name: str) -> int:
        """Words to each side of any of its words that hold the notice, extra words and all, if it may be confirmed."""
        return int(len(self.words[name]) * (1 + self.most)) + 1

    def ranked(self, block: str) -> list[tuple[int, str]]:
        """(bytes saved, template), the largest saving first, ties by name."""
        raw = block.encode("utf-8", "surrogatepass")
        size = len(self.bare.compress(raw))
        return sorted(((size - len(p.compress(raw)), k) for k, p in self.packers.items()), key=lambda x: (-x[0], x[1]))

    def least(self, name: str, have: Counter[str]) -> int:
        """At least so many words of the template are missing from a block of these words."""
        return (self.counts[name] - have).total()

    def differences(self, name: str, have: list[str], cue: int) -> tuple[int, int, list[str]]:
        """The span of words, holding the one at cue, with the fewest wording differences from the template, and these (-missing, +extra).

        Row i of the table has the differences of the template's first i words from a span that begins at or before the
        cue's word and ends before word j.
        """
        want = self.words[name]
        row = [max(0, j - cue) for j in range(len(have) + 1)]
        table = [row]
        for w in want:
            above, row = row, [row[0] + 1]
            for j, h in enumerate(have):
                row.append(above[j] if w == h else 1 + min(above[j + 1], row[j]))
            table.append(row)
        end = j = min(range(cue + 1, len(have) + 1), key=row.__getitem__)
        i, out = len(want), []
        while i or j > cue:
            if i and j and want[i - 1] == have[j - 1]:
                i, j = i - 1, j - 1
            elif j and (table[i][j - 1] + 1 == table[i][j]):
                out.append("+" + have[j - 1])
                j -= 1
            elif i:
                out.append("-" + want[i - 1])
                i -= 1
        return j, end, out[::-1]


def words_around(text: str, at: int, first: int, n: int) -> tuple[list[tuple[int, int]], int]:
    """Places of up to n words to each side of the one that holds position `at`, none beginning before `first`, and that word's index."""
    begin = at
    while begin > first and not text[begin - 1].isspace():
        begin -= 1
    room, before = 40 * n, []
    while True:  # a wider look where words are long
        low = max(first, begin - room)
        before = [m.span() for m in WORD.finditer(text, low, begin)]
        if low > first and before and before[0][0] == low:
            before = before[1:]  # may be the end of a longer word
        if len(before) >= n or low == first:
            break
        room *= 4
    before, after = before[-n:], []
    for m in WORD.finditer(text, begin):
        after.append(m.span())
        if len(after) > n:
            break
    return before + after, len(before)


def scan_text(text: str | None, known: Templates) -> list[tuple]:
    """Candidate blocks of a whole text: (start, end, license, saved, differences, confirmed), in order."""
    text = text or ""
    if not known.may_hold(text):
        return []
    out, done, doubtful = [], 0, 0
    longest = max(known.lengths)
    for cue in known.finder.finditer(text):
        if cue.start() < done:
            continue
        spans, at = words_around(text, cue.start(), done, longest)
        names = known.met([plain(text[a:b]) for a, b in spans], at)
        if not names:
            continue
        spans, at = words_around(text, cue.start(), done, max(map(known.reach, names)))
        words = [plain(text[a:b]) for a, b in spans]
        saved = dict((k, n) for n, k in known.ranked(text[spans[0][0] : spans[-1][1]]))
        best = None
        bounds = []
        for name in names:
            low, high = max(0, at - known.reach(name)), at + known.reach(name) + 1
            bounds.append((known.least(name, Counter(words[low:high])) / len(known.words[name]), -saved[name], name, low, high))
        for bound in sorted(bounds):
            if best is not None and bound[:3] >= best[0]:
                break  # the bounds that follow are no smaller
            _, less, name, low, high = bound
            start, end, differs = known.differences(name, words[low:high], at - low)
            found = (len(differs) / len(known.words[name]), less, name)
            if best is None or found < best[0]:
                best = found, start + low, end + low, differs
        (share, less, name), start, end, differs = best
        ok = share <= known.most
        if ok:
            done = spans[end - 1][1]
        elif share > REPORTED or spans[start][0] < doubtful:
            continue
        else:
            doubtful = spans[end - 1][1]
        out.append((spans[start][0], spans[end - 1][1], name, -less, " ".join(differs), ok))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, max_differences: float = 0.1, id_col: str = "doc_id") -> DataFrame:
    """One row for each candidate block: (doc_id, block, start, end, license, bytes_saved, differences, n_differences, confirmed).

    A notice within max_differences shows a run of words of its template (intact_run), in whatever language that is. Each
    run holds a cue word; at each cue of the whole text the words around it are looked up among all runs of all templates,
    so no notice that may be confirmed is passed over, but for cues inside a notice already confirmed. A block reaches to
    each side as far as the longest template met there may, so its size is bounded however long the text is. It is
    compressed alone and with every template as raw zstandard dictionary, which ranks them by bytes saved; the templates met are
    compared word by word (case and surrounding punctuation apart) with the
    span around the cue that fits each best; a notice elsewhere in the block does not answer for the cue. The template with
    the fewest differences for its length wins, at ties the one that saves most bytes. It is confirmed if the
    differences, missing words (-) and extra ones inside (+), are at most max_differences of the template's words. Otherwise it
    is reported, once for overlapping spans, if they are at most half of them.
    start and end are code points. NULL and empty texts and texts without a cue give no rows; NULL ids are kept;
    repeated rows give repeated rows; an empty table gives none; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, max_differences)
        names = ["doc_id", "block", "start", "end", "license", "bytes_saved", "differences", "n_differences", "confirmed"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.bool_()]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, (a, b, name, saved, differs, ok) in enumerate(scan_text(text, known)):
                    rows.append((doc, i, a, b, name, saved, differs, len(differs.split()), ok))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    schema = "doc_id long, block int, start long, end long, license string, bytes_saved int, differences string, n_differences int, confirmed boolean"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "text").mapInArrow(run, schema)

"""Licence scan: Dice coefficient over word bigrams against licence templates.

Scanned units are every line of a text, and every paragraph: a run of two or more lines that are
not blank. A unit's normal form is its words: runs of ASCII letters and digits, A-Z lower-cased, dots
allowed inside. With A and B the sets of word bigrams of unit and template (a single word counts
as a bigram), Dice is ``2|A & B| / (|A| + |B|)``. It can reach t only if
``t / (2 - t) <= |A| / |B| <= (2 - t) / t``, so templates are filed under the set sizes that can
reach t, and a unit is compared only with those under its own size.

A set of bigrams is at least as large as the unit's distinct words less one, so long units
are dropped before their bigrams are made.

A notice inside a longer line, or over comment lines of ``#``, ``//`` or ``*``, is no unit of its own. So word windows
of the whole text are scored as well, against the templates and against NOTICES. A window that reaches t has at most
``(2 - t) / t * |B|`` bigrams, and at least ``t / (2 - t) * |B|`` in common with the template; the best one begins
and ends with a common bigram, so only those are made, in texts that have enough of the template's bigrams.
"""

from __future__ import annotations

import bisect
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import text_or_empty

THRESHOLD = 0.8
# Licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
                "If a copy of the MPL was not distributed with this file, You can obtain one at"],
}
# Notices that are looked for in word windows only, beside the templates. Licences too long to be a
# template are known by the heading of their full text.
_GNU = ("{it} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {name} as "
        "published by the Free Software Foundation{sep2} either version {version} of the License, or (at your "
        "option) any later version.")
_GNU_HEAD = ("GNU {name} Version {version}, {date} Copyright (C) {years} Free Software Foundation, Inc. {place} Everyone "
             "is permitted to copy and distribute verbatim copies of this license document, but changing it is not "
             "allowed.")
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_TEMPLE = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_AS_IS = ("IN NO EVENT SHALL THE {who} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
          "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
          "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
          "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
          "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = (TEMPLATES["BSD"][0] + " 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. " + _AS_IS.format(who="COPYRIGHT HOLDER OR CONTRIBUTORS"))
NOTICES = {
    "Apache-2.0": [
        TEMPLATES["Apache-2.0"][1] + " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
    ],
    "MIT": [
        "terms of the MIT License",
        TEMPLATES["MIT"][2] + " The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        _GNU.format(it="This program", sep=";", sep2=";", name=_GPL, version="2"),
        _GNU_HEAD.format(name=_GPL, version="2", date="June 1991", years="1989, 1991", place=_TEMPLE),
    ],
    "GPL-3.0": [
        _GNU_HEAD.format(name=_GPL, version="3", date="29 June 2007", years="2007", place="https://fsf.org/"),
    ],
    "LGPL-2.1": [
        _GNU.format(it="This library", sep=";", sep2=";", name=_LGPL, version="2.1"),
        _GNU_HEAD.format(name=_LGPL, version="2.1", date="February 1999", years="1991, 1999", place=_TEMPLE),
    ],
    "LGPL-3.0": [
        _GNU.format(it="This program", sep=":", sep2=",", name=_LGPL, version="3"),
        _GNU_HEAD.format(name=_LGPL, version="3", date="29 June 2007", years="2007", place="https://fsf.org/"),
    ],
    "AGPL-3.0": [
        _GNU.format(it="This program", sep=":", sep2=",", name=_AGPL, version="3"),
        _GNU_HEAD.format(name=_AGPL, version="3", date="19 November 2007", years="2007", place="https://fsf.org/"),
    ],
    "BSD": [
        _BSD + _BSD_END,
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. " + _BSD_END,
    ],
    "MPL-2.0": [
        TEMPLATES["MPL-2.0"][0] + " http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity "
        "that creates, contributes to the creation of, or owns Covered Software.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
UNITS = "array<struct<unit:string,unit_no:int,licence:string,dice:double>>"
_WORD = re.compile(rb"[a-z0-9]+(?:\.[a-z0-9]+)*")


def words(unit: bytes) -> list[bytes]:
    return _WORD.findall(unit.lower())


def bigrams(w: list[bytes]) -> set:
    return set(zip(w, w[1:], strict=False)) if len(w) > 1 else set(w)


def size_range(n: int, threshold: float) -> range:
    """Sizes of sets that can reach the threshold against a set of n."""
    low = math.ceil(n * threshold / (2 - threshold) - 1e-9)
    return range(max(1, low), math.floor(n * (2 - threshold) / threshold + 1e-9) + 1)


class TemplateFile:
    """Templates filed under the sizes of the units that can reach the threshold."""

    def __init__(self, templates: dict[str, list[str]], threshold: float, notices: dict[str, list[str]] | None = None):
        self.threshold = threshold
        self.by_size: dict[int, list[tuple[str, set]]] = {}
        for licence, texts in templates.items():
            for text in texts:
                grams = bigrams(words(text.encode()))
                for n in size_range(len(grams), threshold) if grams else ():
                    self.by_size.setdefault(n, []).append((licence, grams))
        self.most = max(self.by_size, default=0)
        # for windows: (licence, bigrams, least in common, most bigrams in a row), and the templates of a bigram
        self.windowed: list[tuple[str, set, int, int]] = []
        self.owners: dict[tuple, list[int]] = {}
        for licence, texts in [*templates.items(), *(notices or {}).items()]:
            for text in texts:
                w = words(text.encode())
                if len(w) > 1:
                    grams = bigrams(w)
                    sizes = size_range(len(grams), threshold)
                    for g in grams:
                        self.owners.setdefault(g, []).append(len(self.windowed))
                    # a template that repeats itself may be that much longer than its set
                    self.windowed.append((licence, grams, sizes[0], sizes[-1] + len(w) - 1 - len(grams)))

    def match(self, w: list[bytes]) -> dict[str, float]:
        """Dice of the best template of every licence that reaches the threshold."""
        if not w or len(set(w)) - 1 > self.most:
            return {}
        grams = bigrams(w)
        best: dict[str, float] = {}
        for licence, t in self.by_size.get(len(grams), ()):
            dice = 2.0 * len(grams & t) / (len(grams) + len(t))
            if dice >= self.threshold and dice > best.get(licence, 0.0):
                best[licence] = dice
        return best

    def windows(self, w: list[bytes], taken: list[tuple[str, int, int, float]]) -> list[tuple[str, int, float]]:
        """(licence, first word, dice) of the windows that share no word with a better one in ``taken``.

        ``taken`` holds (licence, first word, last word, dice) of units that matched, and the windows as they are
        found: highest dice first, then the longest, then the first. A window gives way to any match of its own
        licence and to a match of higher dice of another, as a version 3 notice is also near to version 2.
        """
        hits = [(i, g) for i, g in enumerate(zip(w, w[1:], strict=False)) if g in self.owners]
        common: dict[int, int] = {}
        for g in {g for _, g in hits}:
            for t in self.owners[g]:
                common[t] = common.get(t, 0) + 1
        found = []
        for t, n in common.items():
            licence, grams, least, most = self.windowed[t]
            if n < least:
                continue
            # no window within a matched unit of the licence, as it would be dropped in the end
            at = [(i, g) for i, g in hits if g in grams
                  and not any(name == licence and a <= i + 1 and i <= b for name, a, b, _ in taken)]
            held: dict[tuple, int] = {}
            end = 0
            for k, (first, gram) in enumerate(at):
                while end < len(at) and at[end][0] < first + most:
                    held[at[end][1]] = held.get(at[end][1], 0) + 1
                    end += 1
                if len(held) >= least:
                    found += self._from(w, licence, grams, first, [i for i, _ in at[k:end]])
                held[gram] -= 1
                if not held[gram]:
                    del held[gram]
        out = []
        for dice, first, last, licence in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
            if not any((name == licence or d > dice) and a <= last and first <= b for name, a, b, d in taken):
                taken.append((licence, first, last, dice))
                out.append((licence, first, dice))
        return out

    def _from(self, w, licence, grams, first, ends):
        """The best window beginning with bigram ``first`` and ending with a bigram of ``ends``, if it matches."""
        seen: set = set()
        both, at, best = 0, first, None
        for e in ends:
            for i in range(at, e + 1):
                g = (w[i], w[i + 1])
                if g not in seen:
                    seen.add(g)
                    both += g in grams
            at = e + 1
            dice = 2.0 * both / (len(seen) + len(grams))
            if dice >= self.threshold and (best is None or dice >= best[0]):
                best = (dice, first, e + 1, licence)
        return [best] if best else []

    def scan(self, text: str) -> list[dict]:
        out: list[dict] = []
        run: list[list[bytes]] = []
        every: list[bytes] = []
        starts: list[int] = []  # of every line, its first word in ``every``
        taken: list[tuple[str, int, int, float]] = []

        def add(unit, no, w):
            got = sorted(self.match(w).items())
            out.extend({"unit": unit, "unit_no": no, "licence": name, "dice": dice} for name, dice in got)
            taken.extend((name, starts[no], starts[no] + len(w) - 1, dice) for name, dice in got)

        lines = text.encode("utf-8", "surrogatepass").split(b"\n")
        for no, line in enumerate([*lines, b""]):
            starts.append(len(every))
            if line.strip(b" \t\r"):
                w = words(line)
                every.extend(w)
                add("line", no, w)
                run.append(w)
            else:
                if len(run) > 1:
                    add("paragraph", no - len(run), [x for part in run for x in part])
                run = []
        out.extend({"unit": "window", "unit_no": bisect.bisect_right(starts, first) - 1, "licence": name, "dice": dice}
                   for name, first, dice in self.windows(every, taken))
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD, templates: dict | None = None) -> DataFrame:
    """Per unit and licence that reaches the threshold: id, unit ('line', 'paragraph' or 'window'),
    unit_no (the number of its first line, from 0), licence, dice (of the licence's best template).

    A window has two words or more and is given only where no line, paragraph or better window of the same licence,
    and no better match of another, shares a word with it. Lines and paragraphs are compared with ``templates``, windows also with NOTICES
    unless other templates are given.

    Defined cases: a null or empty text has no units with words and gives no row; a unit
    without words matches nothing; repeated rows give their rows again; licences that tie are all
    returned; a null id is kept; an empty table gives an empty result; other columns are not read.
    """
    filed = TemplateFile(templates or TEMPLATES, threshold, None if templates else NOTICES)

    @F.pandas_udf(UNITS)
    def units(texts: pd.Series) -> pd.Series:
        return pd.Series([filed.scan(t) for t in texts], dtype=object)

    found = docs.select(F.col(id_col).alias("id"),
                        units.asNondeterministic()(text_or_empty(text_col)).alias("u"))
    return (found.where(F.size("u") > 0).select("id", F.explode("u").alias("u"))
            .select(F.col("id").alias(id_col), "u.*"))

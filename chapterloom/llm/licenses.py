"""License scans: normalised texts against licence templates by Dice coefficient over word bigrams.

A text's units are the whole text (unit 0) and its lines (from 1). A unit is lower-cased
(A-Z), ``licence`` becomes ``license``, and its words are runs of a-z and 0-9; its set
holds the distinct pairs of neighbouring words. Dice is twice the shared pairs over both
sets' sizes. A template can only reach the threshold t with a unit whose size is between
t / (2 - t) and (2 - t) / t times its own, so units outside all bounds are dropped by
their word count, and an index from pairs to templates finds the few others to compare.

A template that neither a line nor the whole text resembles is also compared with every run of
consecutive lines, as licences are often wrapped; its best run, of equal ones that which begins last, counts as a unit
by the number of its first line. A run can only reach the threshold where the whole text has t / (2 - t) of the template's pairs.

Defined results: null and empty texts, and units of fewer than two words, match nothing.
Of equal Dice the template that sorts first wins, then the first unit. Repeated rows match alike.
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import insort
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import with_text_columns

# Notices and short texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    # Whole texts of short licences, and the usual headers of long ones.
    "AGPL-3.0-header": 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.',
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-2-Clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSL-1.0-text": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "GPL-2.0-header": 'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.',
    "GPL-3.0-header": 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.',
    "ISC-text": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "LGPL-3.0-header": 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.',
    "MIT-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "Unlicense-text": 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}

_WORDS = re.compile(rb"[a-z0-9]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def normalised(text: str) -> list[bytes]:
    return [b"license" if w == b"licence" else w for w in _WORDS.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER))]


def pairs(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


class Matcher:
    """Finds the templates that a unit resembles by the threshold at least."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8):
        self.threshold = threshold
        self.sizes, self.index = {}, defaultdict(list)
        for name in sorted(templates):
            own = pairs(normalised(templates[name]))
            self.sizes[name] = len(own)
            for p in own:
                self.index[p].append(name)
        bound = (2 - threshold) / threshold
        self.low = min((math.floor(n / bound) for n in self.sizes.values()), default=0)
        self.high = max((math.ceil(n * bound) for n in self.sizes.values()), default=0)
        self.bound = bound

    def unit(self, words: list[bytes]) -> list[tuple[float, str]]:
        if len(words) < 2 or len(words) - 1 < self.low:
            return []
        own = pairs(words)
        if not self.low <= len(own) <= self.high:
            return []
        shared = Counter(name for p in own if p in self.index for name in self.index[p])
        found = []
        for name, n in shared.items():
            size = self.sizes[name]
            if size <= len(own) * self.bound + 1e-9 and len(own) <= size * self.bound + 1e-9:
                dice = 2 * n / (size + len(own))
                if dice >= self.threshold:
                    found.append((dice, name))
        return found

    def wrapped(self, lines: list[list[bytes]], whole: list[bytes], done: set[str]) -> list[tuple[float, str, int]]:
        """(Dice, template, first line) of the best run of lines of each template that isn't done yet.

        One pass a template: a window begins at each word in turn and reaches as far as its distinct pairs stay within the
        template's bound. Only the places where pairs occur first in it are kept, so repeating texts cost no more than others.
        """
        if sum(map(bool, lines)) < 2:
            return []
        code: dict[tuple[bytes, bytes], int] = {}
        flat = [code.setdefault(p, len(code)) for p in zip(whole, whole[1:])]
        hits = Counter(name for p in code if p in self.index for name in self.index[p])
        wanted = [name for name, n in hits.items() if name not in done and n >= self.sizes[name] / self.bound - 1e-9]
        if not wanted:
            return []
        n, seen = len(flat), {}
        before, after = [-1] * n, [n] * n
        for i, c in enumerate(flat):
            j = seen.get(c, -1)
            before[i] = j
            if j >= 0:
                after[j] = i
            seen[c] = i
        #: The line of a pair is that of its second word.
        ends = np.repeat(np.arange(1, len(lines) + 1), [len(x) for x in lines])[1:]
        starts = [(at - len(x), at, k) for (k, x), at in zip(enumerate(lines, 1), itertools.accumulate(map(len, lines))) if x]
        codes, found = np.array(flat), []
        for name in wanted:
            size, cap = self.sizes[name], math.floor(self.sizes[name] * self.bound + 1e-9)
            of_template = np.array([name in self.index.get(p, ()) for p in code])
            shares = of_template[codes]
            upto, share = np.append(0, np.cumsum(shares)), shares.tolist()
            best, firsts, shared, at, end = (self.threshold, 0), [], 0, 0, 0
            for lo, hi, k in starts:
                # A best run begins with a line that shares a pair, by itself or with the next word: without the line it were as good.
                if lo >= n or upto[min(hi, n)] == upto[lo]:
                    continue
                while at < lo:
                    if at < end:
                        firsts.pop(0)
                        if after[at] < end:
                            insort(firsts, after[at])
                        else:
                            shared -= share[at]
                    at += 1
                end = max(end, lo)
                while end < n and (before[end] >= lo or len(firsts) < cap):
                    if before[end] < lo:
                        firsts.append(end)
                        shared += share[end]
                    end += 1
                if 2 * shared / (size + shared) < best[0]:
                    continue
                first = np.array(firsts)
                line = ends[first]
                last = np.append(line[1:] != line[:-1], True) & ((end == n) | (line < ends[min(end, n - 1)]))
                dice = 2 * np.cumsum(shares[first])[last] / (size + np.arange(1, len(first) + 1)[last])
                if len(dice) and dice.max() >= best[0]:
                    best = float(dice.max()), k
            if best[1]:
                found.append((best[0], name, best[1]))
        return found

    def text(self, text: str | None):
        """(best template, its Dice, its unit, matching units, all templates)."""
        if not text:
            return None, None, None, 0, []
        lines = [normalised(x) for x in text.split("\n")]
        found = [(dice, name, k) for k, words in enumerate(lines, 1) for dice, name in self.unit(words)]
        # The whole text has at least as many pairs as any line and isn't put together beyond the largest template's bound.
        if sum(map(len, lines)) - 1 >= self.low:
            whole = [w for x in lines for w in x]
            if len(whole) <= 4 * self.high or len(pairs(whole)) <= self.high:
                found += [(dice, name, 0) for dice, name in self.unit(whole)]
            found += self.wrapped(lines, whole, {x[1] for x in found})
        if not found:
            return None, None, None, 0, []
        dice, name, k = min(found, key=lambda x: (-x[0], x[1], x[2]))
        return name, dice, k, len({x[2] for x in found}), sorted({x[1] for x in found})


FIELDS = [
    T.StructField("license", T.StringType()),
    T.StructField("dice", T.DoubleType()),
    T.StructField("unit", T.LongType()),
    T.StructField("n_units", T.LongType()),
    T.StructField("licenses", T.ArrayType(T.StringType())),
]


def read_templates(spark: SparkSession, path: str, limit_chars: int = 8_000_000) -> dict[str, str]:
    """Whole licence texts as templates: a file each, named by the file without its ending; all together go to every task, so more than limit_chars raise."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    if (files.agg(F.sum(F.length("value"))).first()[0] or 0) > limit_chars:
        raise ValueError(f"templates of more than {limit_chars} characters")
    return {re.sub(r"\.(txt|md)$", "", r.name): r.value for r in files.collect()}


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """Adds license, dice, unit, n_units and licenses to every row."""
    return with_text_columns(docs, lambda: (lambda m: lambda texts: list(map(list, zip(*map(m.text, texts)))))(Matcher(templates, threshold)), FIELDS, text_col)


def sql(templates: dict[str, str] = TEMPLATES, threshold: float = 0.8) -> str:
    """The scan of documents in DuckDB's SQL, without index; licenses joined by commas. Runs of lines are all tried where the whole text has the pairs for one."""
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in item)) for item in sorted(templates.items()))
    words = lambda c: f"list_transform(regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+'), lambda w: CASE WHEN w = 'licence' THEN 'license' ELSE w END)"
    grams = "CASE WHEN len(w) < 2 THEN [] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END"
    return f"""
WITH t AS (SELECT name, {grams} AS g FROM (SELECT name, {words("body")} AS w FROM (VALUES {values}) AS v(name, body))),
u AS (
  SELECT doc_id, unit, {grams} AS g FROM (
    SELECT doc_id, unit, {words("body")} AS w FROM (
      SELECT doc_id, 0 AS unit, text AS body FROM documents WHERE text IS NOT NULL
      UNION ALL
      SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS unit, unnest(string_split(text, chr(10))) AS body FROM documents WHERE text IS NOT NULL
    )
  )
),
units AS (
  SELECT * FROM (SELECT doc_id, unit, name, 2.0::DOUBLE * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice FROM u, t WHERE len(u.g) > 0) WHERE dice >= {threshold}
),
open AS (
  SELECT doc_id, name, t.g AS tg FROM u, t
  WHERE unit = 0 AND len(list_intersect(u.g, t.g)) >= len(t.g) * {threshold / (2 - threshold)} - 1e-9 AND (doc_id, name) NOT IN (SELECT (doc_id, name) FROM units)
),
long AS (
  SELECT doc_id, list(k ORDER BY k) AS ks, list(w ORDER BY k) AS ws FROM (
    SELECT doc_id, k, {words("body")} AS w FROM (
      SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k, unnest(string_split(text, chr(10))) AS body
      FROM documents WHERE doc_id IN (SELECT doc_id FROM open)
    )
  ) WHERE len(w) > 0 GROUP BY doc_id
),
runs AS (
  SELECT doc_id, name, tg, k, {grams} AS g FROM (
    SELECT doc_id, name, tg, ks[lo] AS k, flatten(ws[lo:hi]) AS w FROM (
      SELECT *, unnest(range(lo, len(ks) + 1)) AS hi FROM (SELECT *, unnest(range(1, len(ks) + 1)) AS lo FROM open JOIN long USING (doc_id) WHERE len(ks) > 1)
    )
  )
),
m AS (
  SELECT doc_id, unit, name, dice FROM units
  UNION ALL
  SELECT doc_id, arg_max(k, (dice, k)), name, max(dice) FROM (
    SELECT doc_id, k, name, 2.0::DOUBLE * len(list_intersect(g, tg)) / (len(g) + len(tg)) AS dice FROM runs WHERE len(g) > 0
  ) WHERE dice >= {threshold} GROUP BY doc_id, name
),
best AS (
  SELECT doc_id, arg_min(name, (-dice, name, unit)) AS license, max(dice) AS dice, arg_min(unit, (-dice, name, unit)) AS unit,
    count(DISTINCT unit) AS n_units, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, license, dice, CAST(unit AS BIGINT) AS unit, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN best USING (doc_id)
"""

"""Licence scan: matching statistics against a generalised suffix automaton of licence tokens.

Every text is streamed through the automaton word by word; the longest match that ends at each word
is known, long maximal matches are chained into spans of a template that keep its order, and a template covered
far enough gives its label. Licences borrow from each other: of chains that lie over each other, by more than half of the one
that covers fewer words, the one that covers most words stays, of equal ones the one with the larger share of its template. The base phrases are strings of the same automaton.

Defined results: a null text counts as empty (no word, no label, score 0); repeated rows are judged
each by itself; extra columns are ignored. The automaton is a few thousand states whatever the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

# The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Passages of public licence texts, by label.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
}
# Further passages, with labels; a label may have several. Short licences stand whole but for names and headings, long ones by their notice or a grant.
PASSAGES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("x11", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-4", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
    ("boost-1", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("ncsa", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal with the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimers in the documentation and/or other materials provided with the distribution."),
    ("postgresql", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."),
    ("curl", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT OF THIRD PARTY RIGHTS."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION You just DO WHAT THE FUCK YOU WANT TO."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("lgpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts. A copy of the license is included in the section entitled GNU Free Documentation License."),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at https://www.mozilla.org/MPL/ Software distributed under the License is distributed on an AS IS basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing rights and limitations under the License."),
    ("cc0", "To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related Rights and associated claims and causes of action, whether now known or unknown (including existing as well as future claims and causes of action), in the Work"),
    ("artistic", "The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package, while giving the users of the package the right to use and distribute the Package in a more-or-less customary fashion, plus the right to make reasonable modifications."),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
)
#: A match shorter than this many words isn't chained; links of a chain skip at most so many words; and a chain gives its label from this share of the template.
MIN_MATCH, MAX_SKIP, MIN_COVER = 4, 12, 0.3


def tokens(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER))


class Automaton:
    """Suffix automaton of several word strings."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], passages: Iterable[tuple[str, str]] = ()) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ids: dict[str, int] = {}
        self.phrases = [(self._encode(p), label) for p, label in phrases.items() if tokens(p)]
        self.templates = [(label, self._encode(t)) for label, t in (*templates.items(), *passages)]
        #: Words of the shortest string that counts.
        self.shortest = max(1, min([MIN_MATCH, *(len(s) for s, _ in self.phrases)]))
        for s in [s for s, _ in self.phrases] + [s for _, s in self.templates]:
            last = 0
            for c in s:
                last = self._extend(last, c)
        n = len(self.next)
        # ends[v]: for each template the places at which v's strings end
        self.ends: list[dict[int, set[int]]] = [{} for _ in range(n)]
        for k, (_, s) in enumerate(self.templates):
            v = 0
            for i, c in enumerate(s):
                v = self.next[v][c]
                self.ends[v].setdefault(k, set()).add(i)
        for v in sorted(range(1, n), key=lambda x: -self.len[x]):
            for k, places in self.ends[v].items():
                self.ends[self.link[v]].setdefault(k, set()).update(places)
        # whole[v]: phrases that are suffixes of v's strings, with their lengths
        self.whole: list[tuple[tuple[int, int], ...]] = [()] * n
        at: dict[int, list[tuple[int, int]]] = {}
        for k, (s, _) in enumerate(self.phrases):
            v = 0
            for c in s:
                v = self.next[v][c]
            at.setdefault(v, []).append((k, len(s)))
        for v in sorted(range(1, n), key=lambda x: self.len[x]):
            self.whole[v] = (*self.whole[self.link[v]], *at.get(v, ()))

    def _encode(self, text: str) -> list[int]:
        return [self.ids.setdefault(w, len(self.ids)) for w in tokens(text)]

    def _clone(self, p: int, q: int, c: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, c)
        new = len(self.next)
        self.next.append({})
        self.len.append(self.len[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        return new

    def stream(self, ids: list[int], start: int = 0) -> Iterator[tuple[int, int, int]]:
        """Matching statistics: (place, state, length of the longest match that ends there)."""
        v = n = 0
        for i, c in enumerate(ids, start):
            while v and c not in self.next[v]:
                v = self.link[v]
                n = self.len[v]
            v = self.next[v].get(c, 0)
            n = n + 1 if v else 0
            yield i, v, n


def _chain(matches: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The chain of (text start, template start, length) in both orders that covers most: words covered, first and last word."""
    best: list[tuple[int, int]] = []
    ending: dict[int, list[int]] = {}  # matches by the text place after them: all that end near enough are tried
    for i, (a, t, n) in enumerate(matches):
        top = (n, a)
        for end in range(a - MAX_SKIP, a + 1):
            for j in ending.get(end, ()):
                if matches[j][1] + matches[j][2] <= t and best[j][0] + n > top[0]:
                    top = (best[j][0] + n, best[j][1])
        best.append(top)
        ending.setdefault(a + n, []).append(i)
    k = max(range(len(matches)), key=lambda i: best[i][0])
    return best[k][0], best[k][1], matches[k][0] + matches[k][2] - 1


def scan(auto: Automaton, text: str | None) -> dict:
    words = tokens(text or "")
    get = auto.ids.get
    ids = [get(w) for w in words]
    known = bytes(x is not None for x in ids)
    places: list[tuple[int, int]] = []
    maximal: list[tuple[int, int, int]] = []
    for run in re.finditer(b"\x01{%d,}" % auto.shortest, known):
        last = (0, 0, 0)
        for i, v, n in auto.stream(ids[run.start() : run.end()], run.start()):
            if n <= last[2] and last[2] >= MIN_MATCH:
                maximal.append(last)
            last = (i, v, n)
            for k, size in auto.whole[v]:
                if n >= size:
                    places.append((i - size + 1, k))
        if last[2] >= MIN_MATCH:
            maximal.append(last)
    by: dict[int, list[tuple[int, int, int]]] = {}
    for i, v, n in maximal:
        for k, ends in auto.ends[v].items():
            by.setdefault(k, []).extend((i - n + 1, end - n + 1, n) for end in ends)
    chains, score = [], 1.0 if places else 0.0
    for k, found in sorted(by.items()):
        covered, a, b = _chain(sorted(found))
        share = covered / len(auto.templates[k][1])
        score = max(score, min(1.0, share))
        if share >= MIN_COVER:
            chains.append((-covered, -share, auto.templates[k][0], a, b))
    spans: list[tuple[str, int, int]] = []
    for _, _, label, a, b in sorted(chains):
        if all(2 * (min(b, v) - max(a, u) + 1) <= b - a + 1 for _, u, v in spans):
            spans.append((label, a, b))
    spans.sort(key=lambda x: (x[1], x[2], x[0]))
    base = sorted({auto.phrases[k][1] for _, k in places})
    starts = [a for a, _ in places]
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(base),
        "labels": ",".join(sorted({*base, *(s[0] for s in spans)})),
        "score": score,
        "spans": ",".join(f"{label}:{a}:{b}" for label, a, b in spans),
    }


FIELDS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.string(),
}


def licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, passages: Iterable[tuple[str, str]] = PASSAGES
) -> DataFrame:
    """doc_id and FIELDS for every row; spans are label:first word:last word of the chains, in the order of the text.
    templates are one a label, passages are (label, text) besides."""
    ship(docs.sparkSession)
    auto = docs.sparkSession.sparkContext.broadcast(Automaton(phrases, templates, tuple(passages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [scan(auto.value, x.as_py()) for x in b.column("text")]
            cols = [pa.array([g[k] for g in got], t) for k, t in FIELDS.items()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", *FIELDS])

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, " + ", ".join(f"{k} {kinds[t]}" for k, t in FIELDS.items())
    return source.mapInArrow(run, schema)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def license_places(spark, sf_dir: str) -> DataFrame:
    """What of op2 SQL can say: words, places of the base phrases, their labels."""
    return op2_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def _places_sql() -> str:
    each = [
        f"SELECT doc_id, i - 1 AS i, '{label}' AS label FROM placed WHERE w[i:i + {len(words) - 1}] = {words!r}"
        for words, label in ((tokens(p), label) for p, label in PHRASES.items())
    ]
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), placed AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w
), found AS ({' UNION ALL '.join(each)}
), grouped AS (
  SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY 1
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word, coalesce(labels, '') AS base_labels
FROM w LEFT JOIN grouped ON grouped.doc_id = w.doc_id
"""


PLACES_SQL = _places_sql()

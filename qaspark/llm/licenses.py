"""License notices in texts: MinHash bands retrieve templates for overlapping windows, exact shingle
containment verifies them.

For every length a template has, a text is read in windows of that many words, each an eighth of the
length after the one before. A window's signature of ``BANDS * ROWS`` minima looks up the templates that
agree in a whole band. The window that fits a passage best misses at most a sixteenth of it at either
end, so a passage that holds the share ``CONTAINED`` of a template's shingles has a similarity of 0.6 to
it at least, and is retrieved with a probability of 1 - (1 - 0.6 ** 2) ** 24 > 0.9999. Templates of less
than 16 words have too few shingles for bands and are all looked at. Retrieved templates are then checked
exactly: the share of their shingles found in the window and one step around it. Windows that no shingle of
a template of their length is near cannot match and get no signature.

Licenses that differ in a version or a word only (GPL 2 and 3, GPL and LGPL) are told apart by ``MARKS``:
a match has to hold a shingle of each phrase that is listed for the template.

The templates are a fixed list, so what is sent to the tasks does not grow; texts are not moved.

Rows: null, empty and short texts have no shingles and no match; repeated rows each give their matches;
a template of fewer words than a shingle is refused; other columns are kept as a struct.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from qaspark.llm.flat import SpanHash, blocks, byte_class, flat_bytes, fold_case, words_of

SHINGLE = 5
CONTAINED = 0.8
BANDS, ROWS = 24, 2
WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

# fixed values: notices as the licenses give them
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
    "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
    "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License.",
    "MIT line": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
    "all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
    "of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
    "International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
}
_MIT_AS_IS = (
    " THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_BSD_AS_IS = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_GNU = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
    "the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
TEMPLATES |= {
    "Apache-2.0 line (full)": "Licensed under the Apache License 2.0.",
    "MIT line (licensed)": "Licensed under the MIT License.",
    "MIT line (project)": "This project is licensed under the MIT License.",
    "MIT whole": TEMPLATES["MIT"] + _MIT_AS_IS,
    "ISC whole": TEMPLATES["ISC"] + " THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
    "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause whole": TEMPLATES["BSD-2-Clause"] + _BSD_AS_IS,
    "BSD-3-Clause": TEMPLATES["BSD-2-Clause"] + _BSD_NAMES,
    "BSD-3-Clause whole": TEMPLATES["BSD-2-Clause"] + _BSD_NAMES + _BSD_AS_IS,
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0": _GNU.format("This program", "General Public License", "2"),
    "LGPL-2.1": _GNU.format("This library", "Lesser General Public License", "2.1"),
    "LGPL-3.0": _GNU.format("This library", "Lesser General Public License", "3"),
    "AGPL-3.0": _GNU.format("This program", "Affero General Public License", "3"),
    "CC0-1.0 line": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "Zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
    "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
    "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
    "to the following restrictions: The origin of this software must not be misrepresented; you must not claim that "
    "you wrote the original software. If you use this software in a product, an acknowledgment in the product "
    "documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, "
    "and must not be misrepresented as being the original software. This notice may not be removed or altered from any "
    "source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
    "any purpose, commercial or non-commercial, and by any means.",
}
# whole license texts, as they are published
TEXTS = {f"{p.stem} text": p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
MARKS = {
    "Apache-2.0 line": ["Apache License Version 2 0"],
    "Apache-2.0 line (full)": ["the Apache License 2 0"],
    "Apache-2.0": ["Apache License Version 2 0"],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors"],
    "BSD-3-Clause whole": ["nor the names of its contributors may be used to endorse or promote products"],
    "GPL-2.0 line": ["General Public License version 2"],
    "GPL-3.0 line": ["General Public License version 3"],
    "GPL-2.0": ["the GNU General Public License", "version 2 of the License"],
    "GPL-3.0": ["the GNU General Public License", "version 3 of the License"],
    "LGPL-2.1": ["GNU Lesser General Public License", "version 2 1 of the License"],
    "LGPL-3.0": ["GNU Lesser General Public License", "version 3 of the License"],
    "AGPL-3.0": ["GNU Affero General Public License", "version 3 of the License"],
    "GPL-2.0 text": ["GNU GENERAL PUBLIC LICENSE Version 2 June 1991"],
    "GPL-3.0 text": ["LICENSE Version 3 29 June 2007"],
    "LGPL-2.1 text": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2 1"],
    "LGPL-3.0 text": ["GNU LESSER GENERAL PUBLIC LICENSE"],
}
MATCHES = "array<struct<license:string,first:int,last:int,containment:double>>"


class Shingles:
    """Shingle hashes of all texts of a block."""

    def __init__(self, size: int):
        self.size, self.hash = size, SpanHash(fold_case(), 51)
        self.factors = np.random.default_rng(52).integers(1, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of the shingle from each word on, whether it is inside one text, words before each text)."""
        content, offsets = flat_bytes(texts)
        starts, ends, owner = words_of(content, offsets, WORD)
        words = self.hash(content, starts, ends)
        first = np.searchsorted(owner, np.arange(len(offsets)))
        out = np.zeros(len(words), np.uint64)
        whole = np.zeros(len(words), bool)
        count = len(words) - self.size + 1
        if count > 0:
            for n, factor in enumerate(self.factors):
                out[:count] += words[n : n + count] * factor
            whole[:count] = owner[:count] == owner[self.size - 1 :]
            out ^= out >> np.uint64(31)
        return out, whole, first


class Templates:
    """The templates' shingles, and the bands that retrieve them."""

    def __init__(self, templates: Mapping[str, str], size: int, contained: float, marks: Mapping[str, Sequence[str]] = {}):
        self.shingles, self.contained, self.size = Shingles(size), contained, size
        rng = np.random.default_rng(53)
        self.mix = rng.integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.names = list(templates)
        hashes, whole, first = self.shingles(pa.array(list(templates.values()), pa.string()))
        self.sets, self.lengths = [], []
        self.bands: dict[tuple, list[int]] = defaultdict(list)
        for n in range(len(templates)):
            part = slice(first[n], first[n + 1])
            own = np.unique(hashes[part][whole[part]])
            words = int(first[n + 1] - first[n])
            if not len(own):
                raise ValueError(f"{self.names[n]}: a template needs {size} words")
            self.sets.append(set(own.tolist()))
            self.lengths.append(words)
            for band in self.signature(own):
                self.bands[band].append(n)
        self.marks = [[self._phrase(p) for p in marks.get(name, ())] for name in self.names]
        self.of_length: dict[int, list[int]] = defaultdict(list)
        for n, length in enumerate(self.lengths):
            self.of_length[length].append(n)
        self.known = {
            length: np.array(sorted(set().union(*(self.sets[n] for n in own))), np.uint64) for length, own in self.of_length.items()
        }
        self.all = np.array(sorted(set().union(*self.sets)), np.uint64)

    def _phrase(self, phrase: str) -> set[int]:
        hashes, whole, _ = self.shingles(pa.array([phrase]))
        return set(hashes[whole].tolist())

    def signature(self, hashes: np.ndarray) -> list[tuple]:
        mixed = hashes[:, None] * self.mix[None, :]
        low = (mixed ^ (mixed >> np.uint64(32))).min(axis=0).reshape(BANDS, ROWS).tolist()
        return [(n, *values) for n, values in enumerate(low)]

    def windows(self, words: int, hits: np.ndarray, own: np.ndarray, length: int) -> tuple[np.ndarray, int]:
        """(starts of the windows that hold a hit and have one of their own length at most a step away, step)."""
        step = max(1, length // 8)
        last = max(0, -(-(words - length) // step))  # the window that reaches the end
        reach = length - self.size

        def spread(hits: np.ndarray, more: int) -> np.ndarray:
            lows = np.clip(-(-(hits - reach) // step) - more, 0, last + 1)
            highs = np.clip(hits // step + more, -1, last)
            edges = np.bincount(lows, minlength=last + 2) - np.bincount(highs + 1, minlength=last + 2)
            return np.cumsum(edges)[: last + 1] > 0

        return np.flatnonzero(spread(hits, 0) & spread(own, 1)) * step, step

    def contains(self, template: int, hashes: np.ndarray) -> float:
        return len(self.sets[template].intersection(hashes.tolist())) / len(self.sets[template])

    def match(self, hashes: np.ndarray, words: int, hits: np.ndarray) -> list[dict]:
        """Matches in one text; ``hashes`` of its shingles, ``hits`` those that some template has."""
        found: dict[int, list[tuple[int, int, float]]] = defaultdict(list)
        for length in sorted(set(self.lengths)):
            known = self.known[length]
            at = np.minimum(np.searchsorted(known, hashes[hits]), len(known) - 1)
            own = hits[known[at] == hashes[hits]]
            if not len(own):
                continue
            starts, step = self.windows(words, hits, own, length)
            for start in starts.tolist():
                inside = hashes[start : start + length - self.size + 1]
                if not len(inside):
                    continue
                near = self.of_length[length]
                if step > 1:
                    near = {t for band in self.signature(inside) for t in self.bands.get(band, ()) if self.lengths[t] == length}
                for template in near:
                    around = hashes[max(start - step, 0) : start + length + step - self.size + 1]
                    share = self.contains(template, around)
                    if share >= self.contained and all(not mark.isdisjoint(around.tolist()) for mark in self.marks[template]):
                        found[template].append((start, min(start + length, words) - 1, share))
        return [match for template in sorted(found) for match in self._join(template, found[template])]

    def _join(self, template: int, spans: list[tuple[int, int, float]]) -> Iterator[dict]:
        """Windows that overlap are one match, with the best of their shares."""
        spans.sort()
        first, last, best = spans[0]
        for a, b, share in spans[1:]:
            if a > last:
                yield {"license": self.names[template], "first": first, "last": last, "containment": best}
                first, last, best = a, b, share
            else:
                last, best = max(last, b), max(best, share)
        yield {"license": self.names[template], "first": first, "last": last, "containment": best}

    def scan(self, texts: pa.Array) -> list[list[dict]]:
        hashes, whole, first = self.shingles(texts)
        at = np.minimum(np.searchsorted(self.all, hashes), len(self.all) - 1)
        hit = np.flatnonzero(whole & (self.all[at] == hashes))
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        owner = np.searchsorted(first, hit, side="right") - 1
        for text in np.unique(owner).tolist():
            begin, end = int(first[text]), int(first[text + 1])
            stop = max(end - self.size + 1, begin)
            out[text] = self.match(hashes[begin:stop], end - begin, hit[owner == text] - begin)
        return out


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES | TEXTS,
    text: str = "text",
    contained: float = CONTAINED,
    shingle: int = SHINGLE,
    marks: Mapping[str, Sequence[str]] = MARKS,
) -> DataFrame:
    """(row, license, first, last, containment): a row per match, places in words of the text."""
    shared = docs.sparkSession.sparkContext.broadcast((dict(templates), dict(marks)))
    kind = pa.list_(
        pa.struct([("license", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("containment", pa.float64())])
    )

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        templates, marks = shared.value
        index = Templates(templates, shingle, contained, marks)
        for batch in batches:
            parts = [pa.array([], kind)]
            parts += [pa.array(index.scan(block), kind) for block in blocks(batch)]
            yield pa.concat_arrays(parts)

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = rows.withColumn("found", F.arrow_udf(run, MATCHES)(F.col("text")))
    return found.select("row", F.explode("found").alias("m")).select("row", "m.*")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all matches in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("row.doc_id", "license", "first", "last", "containment")

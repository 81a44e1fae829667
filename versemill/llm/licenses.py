"""License scans: phrases in place, and an exact set-similarity join with license notices.

Phrases are found as consecutive words. The join finds every block of a document that holds at
least ``CONTAINMENT`` of a notice's distinct words. Words of the notices are ordered by how
often they occur in the whole corpus, the rarest first. A block that holds ``need`` of a
notice's ``m`` words holds one of its ``m - need + 1`` rarest, the prefix; the place of the first
prefix word it holds bounds how many words can follow, and its number of notice words bounds
the overlap as well. Only blocks that pass these filters are counted word by word.

The blocks of a notice are twice as long as it is and start every notice length, so every run of
words as long as the notice lies in one of them. The notices are few and fixed, hence every task
joins its blocks with all of them; frequencies are counted in each task before their shuffle,
and one row a notice word reaches the driver.

Defined results: a null text has no words; a text shorter than a block is one block; a text
without places and blocks has no labels. Notices that share a block are all reported, the one it
holds more of first, then by label. Repeated rows give repeated results, other columns are carried along; columns that have the
name of a result already are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.llm.words import hashed_words, slices

CONTAINMENT = 0.8
# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices by which files and pages state their license, and short licenses in full.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {program} is free software: you can redistribute it and/or modify it under the terms of the {license} as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
    "version. This {program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {license} for more details. You should "
    "have received a copy of the {license} along with this {program}. If not, see <https://www.gnu.org/licenses/>."
)
NOTICES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS +
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
        '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "bsd-2": _REDISTRIBUTION + _DISCLAIMER,
    "bsd-3": _REDISTRIBUTION + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "
    ) + _DISCLAIMER,
    "apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "gpl": _GNU.format(program="program", license="GNU General Public License", version="3"),
    "lgpl": _GNU.format(program="library", license="GNU Lesser General Public License", version="2.1"),
    "agpl": _GNU.format(program="program", license="GNU Affero General Public License", version="3"),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to "
        "be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        + _AS_IS + "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this "
        "license, visit http://creativecommons.org/licenses/by/4.0/"
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of "
        "this license, visit http://creativecommons.org/licenses/by-sa/4.0/"
    ),
    "cc0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
        "neighboring rights to this work. http://creativecommons.org/publicdomain/zero/1.0/"
    ),
}


def _hashes(text: str) -> np.ndarray:
    return hashed_words(pa.array([text]), alnum=True)[0]


@dataclass
class Notices:
    """Notice words by number, their order, and each notice's numbers with the rarest first."""

    vocabulary: np.ndarray  # sorted hashes; a word's number is its place
    sets: dict[str, np.ndarray]
    strides: dict[str, int]
    containment: float

    @classmethod
    def of(cls, texts: dict[str, str], containment: float) -> Notices:
        hashes = {label: _hashes(text) for label, text in texts.items()}
        vocabulary = np.unique(np.concatenate(list(hashes.values())))
        sets = {label: np.unique(np.searchsorted(vocabulary, h)) for label, h in hashes.items()}
        return cls(vocabulary, sets, {label: len(h) for label, h in hashes.items()}, containment)

    def ordered(self, counts: dict[int, int]) -> Notices:
        """The same with words that occur less often first."""
        rank = lambda numbers: sorted(numbers.tolist(), key=lambda w: (counts.get(w, 0), w))
        return Notices(self.vocabulary, {n: np.array(rank(s)) for n, s in self.sets.items()}, self.strides, self.containment)

    def numbers(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of notice words among ``words``, and their numbers."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        places = np.flatnonzero(self.vocabulary[at] == words)
        return places, at[places]

    def blocks(self, begins: np.ndarray, places: np.ndarray, numbers: np.ndarray) -> dict[int, list[tuple[str, int, float]]]:
        """By text the ``(label, first word, containment)`` of its blocks that hold enough of a notice, the best first.

        ``begins`` are the places where texts begin among the words of a slice.
        """
        found: dict[int, list[tuple[str, int, float]]] = {}
        for label, words in self.sets.items():
            need, stride = math.ceil(self.containment * len(words) - 1e-9), self.strides[label]
            in_prefix = np.zeros(len(self.vocabulary), bool)
            in_prefix[words[: len(words) - need + 1]] = True
            hits = places[in_prefix[numbers]]
            texts = np.searchsorted(begins, hits, "right") - 1
            seen = np.unique(np.column_stack([texts, (hits - begins[texts]) // stride]), axis=0)
            both = np.concatenate([seen, np.column_stack([seen[:, 0], np.maximum(seen[:, 1] - 1, 0)])])
            for text, block in np.unique(both, axis=0).tolist():
                start = begins[text] + block * stride
                low, high = np.searchsorted(places, [start, min(start + 2 * stride, begins[text + 1])])
                if high - low < need:
                    continue
                held = np.isin(words, numbers[low:high])
                if len(words) - int(held.argmax()) < need:
                    continue
                if held.sum() >= need:
                    found.setdefault(text, []).append((label, block * stride, float(held.mean())))
        return {text: sorted(rows, key=lambda b: (-b[2], b[0], b[1])) for text, rows in found.items()}


def word_frequencies(docs: DataFrame, notices: Notices, text_col: str = "text") -> dict[int, int]:
    """How often each notice word occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(notices.vocabulary), np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(notices.numbers(hashed_words(batch.column("text"), alnum=True)[0])[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word bigint, n bigint")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_PLACE = pa.struct([("label", pa.string()), ("word", pa.int64())])
_BLOCK = pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())])


def scan_licenses(
    docs: DataFrame, text_col: str = "text", keep_text: bool = True, phrases: dict[str, str] = PHRASES, texts: dict[str, str] = NOTICES, containment: float = CONTAINMENT
) -> DataFrame:
    """``docs`` with ``n_words``, ``places array<struct<label, word>>`` of the phrases by word, and
    ``blocks array<struct<label, word, containment>>`` of the notices, the best first."""
    added = ("n_words", "places", "blocks")
    docs = docs.drop(*added)
    plain = Notices.of(texts, containment)
    notices = plain.ordered(word_frequencies(docs, plain, text_col))
    wanted = [(_hashes(phrase), label) for phrase, label in phrases.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            words, begins = hashed_words(batch.column(text_col), alnum=True)
            places: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for phrase, label in wanted:
                at = np.flatnonzero(words[: max(len(words) - len(phrase) + 1, 0)] == phrase[0])
                for i in range(1, len(phrase)):
                    at = at[words[at + i] == phrase[i]]
                text = np.searchsorted(begins, at, "right") - 1
                for word, t in zip(at.tolist(), text.tolist()):
                    if word + len(phrase) <= begins[t + 1]:
                        places[t].append({"label": label, "word": word - int(begins[t])})
            where, numbers = notices.numbers(words)
            by_text = notices.blocks(begins, where, numbers)
            blocks = [
                [{"label": n, "word": w, "containment": c} for n, w, c in by_text.get(t, ())] for t in range(batch.num_rows)
            ]
            kept = batch if keep_text else batch.drop_columns([text_col])
            yield pa.RecordBatch.from_arrays(
                [
                    *kept.columns,
                    pa.array(np.diff(begins)),
                    pa.array([sorted(p, key=lambda x: x["word"]) for p in places], pa.list_(_PLACE)),
                    pa.array(blocks, pa.list_(_BLOCK)),
                ],
                names=[*kept.schema.names, *added],
            )

    fields = [f for f in docs.schema if keep_text or f.name != text_col]
    new = T.StructType.fromDDL(
        "n_words bigint, places array<struct<label:string,word:bigint>>, "
        "blocks array<struct<label:string,word:bigint,containment:double>>"
    )
    return docs.mapInArrow(scan, T.StructType([*fields, *new.fields]))

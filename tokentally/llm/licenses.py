"""License scans: a positional index of the templates' rare words, looked up by each file.

A template is a passage with mandatory key phrases. The corpus says how many documents hold
each key word. A file's own key words are indexed with their places; then, from the
highest inverse document frequency down, each is looked up among the templates that it is
the rarest key word of. Its places give where such a template may begin, and these are
intersected with the places of the template's next rarest key words by relative position: a
word may stand up to the template's ``slack`` from where it should, so that inserted,
left out or changed words between the phrases lose no place. At what is left every key phrase is
verified word for word, the first at the place itself and the others within the slack, and
the template's words found there in order give the score.

Templates whose key words a file does not all hold cost nothing. All words of a file are
looked up and no template's search hangs on another's, so all places are found.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokentally.llm.common import ship_code, text_bytes
from tokentally.llm.hashing import word_hashes

#: Least share of a template's words in order at its place.
LEAST_SCORE = 0.6

#: Words by which a phrase may stand off its place: these, and one for so many words of the template.
SLACK, SLACK_EVERY = 4, 8

# Phrases whose every place is found, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Passages of well-known licences and notices, opening passages or whole texts ("-full"); key phrases
# stand in brackets.
TEMPLATES = {
    "mit-text": "[permission is hereby granted] free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software [without restriction] including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "mit-full": "[permission is hereby granted] free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software [without restriction] including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions "
    "the above copyright notice and this permission notice [shall be included in all copies] or substantial portions of the software "
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
    "of merchantability fitness for a particular purpose and noninfringement [in no event shall] the authors or copyright holders "
    "be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or "
    "in connection with the software or the use or other dealings in the software",
    "mit-notice": "released [under the mit license]",
    "apache-2.0": "licensed under the [apache license version 2 0]",
    "apache-2.0-text": "you may [not use this file except in compliance with the license] you may obtain a copy of the license at",
    "apache-2.0-full": "licensed under the [apache license version 2 0] the license you may [not use this file except in compliance] "
    "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
    "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "[without warranties or conditions of any kind] either express or implied see the license for the specific language "
    "governing permissions and limitations under the license",
    "gpl-3.0": "this work is licensed under the [gnu general public license version 3]",
    "gpl-2.0": "this work is licensed under the [gnu general public license version 2]",
    "gpl-text": "this program is [free software] you can redistribute it and or modify it under the terms of the "
    "[gnu general public license] as published by the free software foundation",
    "gpl-3.0-full": "this program is [free software] you can redistribute it and or modify it under the terms of the "
    "[gnu general public license] as published by the free software foundation either [version 3 of the license] or at your option "
    "any later version this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "gpl-2.0-full": "this program is [free software] you can redistribute it and or modify it under the terms of the "
    "[gnu general public license] as published by the free software foundation either [version 2 of the license] or at your option "
    "any later version this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "lgpl": "licensed under the [gnu lesser general public license]",
    "agpl": "under the terms of the [gnu affero general public license]",
    "mpl-2.0": "this source code form is subject to the terms of the [mozilla public license v 2 0]",
    "cc-by-4.0": "licensed under [cc by 4 0]",
    "cc-by-sa-4.0": "licensed under [cc by sa 4 0]",
    "cc-by-nc-4.0": "licensed under [cc by nc 4 0]",
    "bsd-text": "[redistribution and use in source and binary forms] with or without modification are permitted "
    "provided that the following conditions are met",
    "bsd-2-full": "[redistribution and use in source and binary forms] with or without modification are permitted provided that the "
    "following conditions are met 1 redistributions of source code must [retain the above copyright notice] this list of conditions and "
    "the following disclaimer 2 redistributions in binary form must [reproduce the above copyright notice] this list of conditions and "
    "the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by "
    "the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-3-full": "[redistribution and use in source and binary forms] with or without modification are permitted provided that the "
    "following conditions are met 1 redistributions of source code must [retain the above copyright notice] this list of conditions and "
    "the following disclaimer 2 redistributions in binary form must [reproduce the above copyright notice] this list of conditions and "
    "the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of the "
    "copyright holder nor the names of its contributors may be used to [endorse or promote products] derived from this software without "
    "specific prior written permission",
    "isc-text": "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted",
    "isc-full": "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice [appear in all copies] the software is provided as is and the "
    "author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "zlib-full": "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
    "for any damages arising from the use of this software [permission is granted to anyone to use this software for any purpose] "
    "including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of "
    "this software [must not be misrepresented] you must not claim that you wrote the original software",
    "unlicense": "this is [free and unencumbered software] released into the public domain",
    "unlicense-full": "this is [free and unencumbered software] released into the public domain anyone is free to copy modify publish "
    "use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non "
    "commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software [dedicate any and "
    "all copyright interest] in the software to the public domain",
}

_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


class Template:
    """A passage as word hashes, with the runs of its key phrases."""

    def __init__(self, label: str, passage: str, base: bool):
        self.label, self.base = label, base
        marked = re.findall(r"[\[\]]|[^\[\] ]+", passage if not base else f"[{passage}]")
        self.words, self.keys = [], []
        for item in marked:
            if item == "[":
                self.keys.append([len(self.words), None])
            elif item == "]":
                self.keys[-1][1] = len(self.words)
            else:
                self.words.append(item)
        self.hashes = word_hashes(" ".join(self.words).encode(), _APART)
        self.slack = 0 if base else SLACK + len(self.words) // SLACK_EVERY
        self.bits: dict[int, int] = {}  # the places of each word, a bit each
        for place, word in enumerate(self.hashes.tolist()):
            self.bits[word] = self.bits.get(word, 0) | 1 << place

    def share(self, window: np.ndarray) -> float:
        """The share of the template's words that ``window`` has in their order (longest common subsequence)."""
        whole = (1 << len(self.words)) - 1
        row = whole
        for places in map(self.bits.get, window.tolist()):
            if places:
                kept = row & places
                row = ((row + kept) | (row - kept)) & whole
        return (len(self.words) - row.bit_count()) / len(self.words)


def templates(phrases: dict[str, str] = PHRASES, passages: dict[str, str] = TEMPLATES) -> list[Template]:
    return [Template(v, k, True) for k, v in phrases.items()] + [Template(k, v, False) for k, v in passages.items()]


class Index:
    """The templates' key words with their places in each, and which documents of a corpus hold each word."""

    def __init__(self, found: list[Template], held: dict[int, int]):
        self.words = np.unique(np.concatenate([t.hashes[a:b] for t in found for a, b in t.keys]))
        number = {w: i for i, w in enumerate(self.words.tolist())}
        self.rarity = np.array([held.get(w, 0) for w in self.words.tolist()])
        self.led_by: dict[int, list] = defaultdict(list)
        for template in found:
            keyed = {(number[int(template.hashes[p])], p) for a, b in template.keys for p in range(a, b)}
            postings = sorted(keyed, key=lambda x: (self.rarity[x[0]], *x))  # rarest first
            self.led_by[postings[0][0]].append((template, postings, frozenset(w for w, _ in keyed)))

    def scan(self, h: np.ndarray) -> list[tuple[Template, int, float]]:
        """``(template, first word, score)`` of every accepted place in a file's word hashes."""
        at = np.searchsorted(self.words, h)
        at[at == len(self.words)] = 0
        hits = np.flatnonzero(self.words[at] == h)
        by_word = np.argsort(at[hits], kind="stable")
        present, first = np.unique(at[hits][by_word], return_index=True)
        places = dict(zip(present.tolist(), np.split(hits[by_word], first[1:])))
        out = []
        for word in sorted(places, key=lambda w: (self.rarity[w], w)):
            for template, postings, needed in self.led_by.get(word, ()):
                if needed <= places.keys():
                    out += self._placed(h, places, template, postings)
        return out

    def _placed(self, h: np.ndarray, places: dict, template: Template, postings: list) -> list[tuple[Template, int, float]]:
        starts = places[postings[0][0]] - postings[0][1]
        for word, place in postings[1:]:  # both words may be off by the slack
            starts = starts[near(starts, places[word] - place, 2 * template.slack)]
            if not len(starts):
                return []
        phrases = []
        for a, b in template.keys:
            found = places[postings_rarest(postings, a, b)[0]] - (postings_rarest(postings, a, b)[1] - a)
            found = found[(found >= 0) & (found + b - a <= len(h))]
            for k in range(b - a):
                found = found[h[found + k] == template.hashes[a + k]]
            phrases.append(found - a)
        starts = phrases[0][near(phrases[0], starts, template.slack)]
        for found in phrases[1:]:
            starts = starts[near(starts, found, template.slack)]
        if template.base:
            return [(template, start, 1.0) for start in starts.tolist()]
        out = []
        for start in starts.tolist():
            score = template.share(h[max(0, start - template.slack) : start + len(template.words) + template.slack])
            if score >= LEAST_SCORE:
                out.append((template, start, score))
        return out


def postings_rarest(postings: list[tuple[int, int]], a: int, b: int) -> tuple[int, int]:
    """The rarest word, and its place, of the key phrase at ``a`` to ``b``."""
    return next((w, p) for w, p in postings if a <= p < b)


def near(values: np.ndarray, others: np.ndarray, slack: int) -> np.ndarray:
    """Which of ``values`` have one of ``others`` (sorted) at most ``slack`` away."""
    at = np.searchsorted(others, values - slack)
    return (at < len(others)) & (others[np.minimum(at, len(others) - 1)] <= values + slack) if len(others) else np.zeros(len(values), bool)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = np.unique(np.concatenate([t.hashes[a:b] for t in templates() for a, b in t.keys]))
    for batch in batches:
        count = np.zeros(len(vocabulary), np.int64)
        for text in text_bytes(batch.column(0)):
            h = word_hashes(text.lower(), _APART)
            at = np.searchsorted(vocabulary, h)
            at[at == len(vocabulary)] = 0
            count[np.unique(at[vocabulary[at] == h])] += 1
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary.view(np.int64)), pa.array(count)], names=["word", "n"])


def _scanned(index: Index):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_base", pa.int64()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("base_labels", pa.string()),
            ("labels", pa.string()),
            ("score", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                h = word_hashes(text.lower(), _APART)
                found = index.scan(h)
                base = [(t.label, start) for t, start, _ in found if t.base]
                starts = [start for _, start in base]
                out.append(
                    (
                        doc_id,
                        len(h),
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted({label for label, _ in base})),
                        ",".join(sorted({t.label for t, _, _ in found})),
                        max((score for _, _, score in found), default=0.0),
                    )
                )
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``[doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score]`` per row of ``docs``.

    A-Z are lower-cased; words are runs of digits, letters and non-ASCII characters,
    counted from 0. ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are
    about the places of ``PHRASES``; ``labels`` adds the templates' labels; ``score``
    is the best share of a template's words found in order at a place, 0 without any. A null, empty or
    wordless text has no places. Repeated rows and null ids are carried along; other
    columns are ignored; an empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    held = docs.select("text").mapInArrow(_held, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"] % (1 << 64): r["n"] for r in held.collect()}  # one row for each key word of the templates
    return docs.mapInArrow(
        _scanned(Index(templates(), counts)),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )

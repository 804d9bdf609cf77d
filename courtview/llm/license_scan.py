"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Texts and templates become lower-cased words (letters and digits) and ``width``-word shingles (a shorter template: one
shingle of all its words). Templates of up to s shingles, s a power of two, are looked up in windows of 2 s shingles
that start every s shingles, so that each run of s + 1 shingles lies within a window. A template is found in a window
if at least ``threshold`` of its distinct shingles are in it; neighbouring windows merge into one span from the first
to the last matched word.

Bands: one row each, ``bands`` of them. A window that holds 0.8 of the n > s / 2 shingles of a template has a Jaccard
similarity of at least 0.19 with it, so one of 64 bands collides with a probability over 0.999998 (1 - 0.81 ** 64).

Null and empty texts have no match; texts of any length are scanned whole, a long one in overlapping parts;
repeated rows each give a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from courtview.llm.common import small_batches

WIDTH = 5
THRESHOLD = 0.8
BANDS = 64
PART = 1 << 12
CACHED_WORDS = 1 << 19
BIT_ROWS = 20
SMALL_TABLE = 1 << 15
# fixed values: names that notices give licenses, by identifier
NAMES = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache, Version 2.0", "Apache 2.0", "Apache Version 2.0"], "BSD-2-Clause": ["BSD 2-Clause", "2-Clause BSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "3-Clause BSD"], "ISC": ["ISC"], "Zlib": ["zlib"], "BSL-1.0": ["Boost Software", "Boost Software License 1.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL v2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPL v3", "GPLv3", "GPL-3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL v2.1", "LGPLv2.1", "LGPL-2.1"], "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL v3", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL v3", "AGPLv3", "AGPL-3.0"], "MPL-2.0": ["Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License v2.0", "EPL 2.0", "EPL-2.0"], "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International"], "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"], "CC-BY-ND-4.0": ["CC BY-ND 4.0"], "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
}
# fixed values: what stands before a license's name in a notice, after whatever verb
LEADS = ("under the", "under", "terms of the")
# fixed values: headers, titles and passages of licenses, as they word them
PASSAGES = {
    "MIT-notice": "Released under the MIT License.", "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "MIT-disclaimer": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
        under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "Apache-2.0": """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
    "BSD-3-Clause-names": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
        this software without specific prior written permission.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the
        use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions""",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003",
    "GPL-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
        Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "GPL-2.0-header": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You
        can obtain one at""",
    "EPL-2.0": "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0": "Creative Commons CC0 1.0 Universal",
    "CC-BY-SA": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def notice_templates() -> dict[str, str]:
    """Short notices by rule: each lead-in and name of a license, and its machine-readable line. Keys are ``license-notice-k``."""
    out: dict[str, str] = {}
    for license_id, names in NAMES.items():
        forms = [f"SPDX-License-Identifier: {license_id}"]
        for name in names:
            core = name if "license" in name.lower() else f"{name} License"
            plain = [name] if name[:2] in ("CC", "GP", "LG", "AG", "MP", "EP") else []
            if license_id == "Apache-2.0" and "Version" in name:  # the name has the word inside it
                core = name.replace("Apache", "Apache License", 1)
            forms += [f"{lead} {x}" for lead in LEADS for x in (plain or [core])]
        out.update({f"{license_id}-notice-{k}": f for k, f in enumerate(forms)})
    return out


TEMPLATES = PASSAGES | notice_templates()
_WORD = re.compile(r"[^\W_]+")
_KIND = re.compile("-(?:notice|header|names|disclaimer)")
_A = np.uint64(0x9E3779B97F4A7C15)


def _word_id(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _shingles(ids: np.ndarray, width: int) -> np.ndarray:
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(width))
    for i in range(width):
        h = (h ^ ids[i:i + n]) * _A
        h ^= h >> np.uint64(32)
    return h


def _salts(bands: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(b"band%d" % i, digest_size=8).digest(), "little") | 1 for i in range(bands)], np.uint64)


class Scanner:
    """Templates, their signatures by window class, and a bounded cache of words."""

    def __init__(self, templates: dict[str, str], width: int, threshold: float, bands: int) -> None:
        self.width, self.threshold, self.salts = width, threshold, _salts(bands)
        self.words: dict[str, int] = {}
        self.groups: dict[tuple[int, int], list[tuple[str, np.ndarray, np.ndarray]]] = {}  # by (shingle width, s)
        for name, text in templates.items():
            ids = np.array([_word_id(w.lower()) for w in _WORD.findall(text)], np.uint64)
            if len(ids):
                own = min(width, len(ids))
                x = np.unique(_shingles(ids, own))
                s = 1 << max(0, int(len(x) - 1).bit_length())
                self.groups.setdefault((own, s), []).append((name, x, (x[None, :] * self.salts[:, None]).min(axis=1)))
        self.known = {g: self._table([sig for _, _, sig in v]) for g, v in self.groups.items()}
        self.signatures = {g: np.stack([sig for _, _, sig in v], axis=1) for g, v in self.groups.items()}
        self.shingles = {}
        for own in {g[0] for g in self.groups}:
            every, bits = np.unique(np.concatenate([x for g, v in self.groups.items() if g[0] == own for _, x, _ in v])), np.zeros(1 << BIT_ROWS, bool)
            bits[(every >> np.uint64(64 - BIT_ROWS)).astype(np.int64)] = True
            self.shingles[own] = every, bits

    @staticmethod
    def _table(signatures: list[np.ndarray]) -> np.ndarray:
        """For each band, which remainders of 2**14 some template has."""
        table = np.zeros((len(signatures[0]), 1 << 14), bool)
        for sig in signatures:
            table[np.arange(len(sig)), (sig >> np.uint64(50)).astype(np.int64)] = True
        return table.ravel()

    def near_templates(self, x: np.ndarray, own: int) -> np.ndarray:
        """Places of the shingles of a width that some template has: by a bit table, then exactly."""
        every, bits = self.shingles[own]
        at = np.flatnonzero(bits[(x >> np.uint64(64 - BIT_ROWS)).astype(np.int64)])
        if not len(at):
            return at
        return at[every[np.minimum(np.searchsorted(every, x[at]), len(every) - 1)] == x[at]]

    def ids(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        for w in set(words).difference(self.words):
            self.words[w] = _word_id(w)
        return np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))

    def candidates(self, x: np.ndarray, near: np.ndarray, group: tuple[int, int]) -> Iterator[tuple[int, int]]:
        """(window, template number) pairs with a colliding band; ``near`` are the places of template shingles in ``x``.

        Only windows that hold a template shingle at all are given band signatures: containment needs one.
        """
        s = group[1]
        blocks = max(1, -(-len(x) // s))
        maybe = np.zeros(blocks + 1, bool)
        maybe[near // s] = True
        windows = np.flatnonzero(maybe[:-1] | maybe[1:])
        per = max(1, PART // s)
        for part in np.split(windows, range(per, len(windows), per)) if len(windows) else ():
            at = part[:, None] * s + np.arange(2 * s)  # the last window ends with the text: its last shingle is repeated
            held = x[np.minimum(at, len(x) - 1)]
            least = np.empty((len(self.salts), len(part)), np.uint64)
            for i, salt in enumerate(self.salts):
                least[i] = (held * salt).min(axis=1)
            offset = np.arange(len(self.salts))[:, None] << 14
            hit = self.known[group][offset + (least >> np.uint64(50)).astype(np.int64)].any(axis=0)
            for w in np.flatnonzero(hit):
                for t in np.flatnonzero((least[:, w, None] == self.signatures[group]).any(axis=0)):
                    yield int(part[w]), int(t)

    def windows(self, x: np.ndarray, near: np.ndarray, group: tuple[int, int]) -> Iterator[tuple[int, int]]:
        """All pairs: the plain way that ``candidates`` is tested against."""
        for w in range(max(1, -(-len(x) // group[1]))):
            for t in range(len(self.groups[group])):
                yield w, t

    def scan(self, text: str | None, plain: bool = False) -> list[tuple[str, int, int, float]]:
        """(template, first word, end word, containment) of each span."""
        if not text:
            return []
        ids = self.ids(text)
        shingles = {own: _shingles(ids, own) for own in self.shingles}
        near = {own: self.near_templates(x, own) for own, x in shingles.items()}
        found: dict[str, list[list]] = {}
        for group in self.groups:
            own, s = group
            x = shingles[own]
            if not len(x) or not (plain or len(near[own])):
                continue
            for w, t in (self.windows if plain else self.candidates)(x, near[own], group):
                name, wanted, _ = self.groups[group][t]
                window = x[w * s:(w + 2) * s]
                if len(window) * len(wanted) <= SMALL_TABLE:
                    equal = window[:, None] == wanted
                    here, share = equal.any(axis=1), int(equal.any(axis=0).sum()) / len(wanted)
                else:
                    here = np.isin(window, wanted)
                    share = len(np.unique(window[here])) / len(wanted)
                if share >= self.threshold:
                    at = np.flatnonzero(here) + w * s
                    spans = found.setdefault(name, [])
                    if spans and w <= spans[-1][3] + 1 and at[0] < spans[-1][1]:
                        spans[-1][1:] = [max(spans[-1][1], int(at[-1]) + own), max(spans[-1][2], share), w]
                    else:
                        spans.append([int(at[0]), int(at[-1]) + own, share, w])
        return sorted((name, a, b, share) for name, spans in found.items() for a, b, share, _ in spans)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, width: int = WIDTH, threshold: float = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """Per row: doc_id, n_matches, licenses (template names, comma-joined), spans (name:first:end:containment, in words) and
    license_ids (the licenses themselves: names without what follows ``-notice``, ``-header``, ``-names`` or ``-disclaimer``)."""
    small_batches(docs.sparkSession)
    chosen = dict(templates if templates is not None else TEMPLATES)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, width, threshold, bands)
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(f) for f in found], pa.int64()), pa.array([",".join(sorted({n for n, *_ in f})) for f in found], pa.string()),
                 pa.array([",".join(f"{n}:{a}:{b}:{c:.3f}" for n, a, b, c in f) for f in found], pa.string()),
                 pa.array([",".join(sorted({_KIND.split(n)[0] for n, *_ in f})) for f in found], pa.string())], names=["doc_id", "n_matches", "licenses", "spans", "license_ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_matches long, licenses string, spans string, license_ids string")

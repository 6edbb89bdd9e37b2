"""Licence scan: a trained paragraph classifier, an unknown class with calibrated scores, and templates that confirm.

A paragraph ends at a line without words. Its lines are read one by one, long ones in windows that overlap by half, and so
are the windows that run over the ends of its lines, as notices are wrapped. A window's hashed word 1-grams and 2-grams go through one logistic regression for each licence family, fitted by follow-the-regularised-leader on
the licences' names and sentences in usual forms, and on a bounded sample of the corpus's own lines as the unknown class.
Scores are calibrated and a limit is set on examples kept out of the fit. A window over the limit still has to hold, with the
words of its paragraph around it, a licence's name word by word with its version, or nearly all of one of its sentences. Every
family that it holds is named, unless it is there only as part of another one's name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recado.llm.quality import Leader
from recado.llm.words import buffer_of, by_batch, lower_ascii, mix, small_batches, words_of

BITS = 16
WINDOW, STEP = 16, 8  # words
AROUND_WORDS = 24  # words before and behind a window in which its template may lie, too
SAMPLE, SAMPLE_CHARS = 1_000, 4_000  # pieces of the corpus's lines that the fit reads, and the characters of a piece
PASSED = 0.01  # share of unknown paragraphs, kept out of the fit, that may pass the classifier: names and versions decide after it
HELD = 0.8  # share of a body's word pairs that a paragraph must hold
SCALE = 4.0
_U = np.uint64

#: Licences by their SPDX identifier, with the names they go by. A number is the version, without ".0" and the words
#: around it ("version 2.0", "v2", "2"); it must stand there. Abbreviations are names, too.
NAMES: dict[str, tuple[str, ...]] = {
    "AFL-3.0": ("Academic Free License 3",),
    "AGPL-3.0": ("Affero General Public License 3", "AGPL 3", "Affero GPL 3"),
    "Apache-1.1": ("Apache Software License 1.1", "Apache License 1.1"),
    "Apache-2.0": ("Apache License 2", "Apache 2", "Apache Software License 2", "Apache Public License 2", "ASL 2"),
    "Artistic-1.0": ("Artistic License 1",),
    "Artistic-2.0": ("Artistic License 2",),
    "BSD-2-Clause": ("BSD 2 Clause", "2 Clause BSD", "Simplified BSD", "FreeBSD License", "Two Clause BSD"),
    "BSD-3-Clause": ("BSD 3 Clause", "3 Clause BSD", "New BSD", "Modified BSD", "Revised BSD", "Three Clause BSD", "BSD style license", "BSD license"),
    "BSD-4-Clause": ("BSD 4 Clause", "4 Clause BSD", "Original BSD"),
    "BSL-1.0": ("Boost Software License 1", "Boost Software License", "Boost License 1"),
    "BUSL-1.1": ("Business Source License 1.1", "Business Source License"),
    "CC-BY-2.0": ("CC BY 2", "Creative Commons Attribution 2"),
    "CC-BY-3.0": ("CC BY 3", "Creative Commons Attribution 3"),
    "CC-BY-4.0": ("CC BY 4", "Creative Commons Attribution 4"),
    "CC-BY-NC-4.0": ("CC BY NC 4", "Creative Commons Attribution NonCommercial 4", "Creative Commons Attribution Non Commercial 4"),
    "CC-BY-NC-ND-4.0": ("CC BY NC ND 4", "Creative Commons Attribution NonCommercial NoDerivatives 4", "Creative Commons Attribution NonCommercial NoDerivs 4"),
    "CC-BY-NC-SA-4.0": ("CC BY NC SA 4", "Creative Commons Attribution NonCommercial ShareAlike 4", "Creative Commons Attribution Non Commercial Share Alike 4"),
    "CC-BY-ND-4.0": ("CC BY ND 4", "Creative Commons Attribution NoDerivatives 4", "Creative Commons Attribution NoDerivs 4"),
    "CC-BY-SA-3.0": ("CC BY SA 3", "Creative Commons Attribution ShareAlike 3", "Creative Commons Attribution Share Alike 3"),
    "CC-BY-SA-4.0": ("CC BY SA 4", "Creative Commons Attribution ShareAlike 4", "Creative Commons Attribution Share Alike 4"),
    "CC0-1.0": ("CC0 1", "CC0", "Creative Commons Zero"),
    "CDDL-1.0": ("Common Development and Distribution License 1", "CDDL 1"),
    "CECILL-2.1": ("CeCILL 2.1", "CeCILL Free Software License Agreement 2.1"),
    "CPL-1.0": ("Common Public License 1", "CPL 1"),
    "ECL-2.0": ("Educational Community License 2",),
    "EPL-1.0": ("Eclipse Public License 1", "EPL 1"),
    "EPL-2.0": ("Eclipse Public License 2", "EPL 2"),
    "EUPL-1.1": ("European Union Public License 1.1", "EUPL 1.1"),
    "EUPL-1.2": ("European Union Public License 1.2", "EUPL 1.2"),
    "GFDL-1.2": ("Free Documentation License 1.2", "GFDL 1.2"),
    "GFDL-1.3": ("Free Documentation License 1.3", "GFDL 1.3"),
    "GPL-1.0": ("GNU General Public License 1", "GPL 1"),
    "GPL-2.0": ("GNU General Public License 2", "GPL 2"),
    "GPL-3.0": ("GNU General Public License 3", "GPL 3"),
    "ISC": ("ISC License",),
    "LGPL-2.0": ("Library General Public License 2", "LGPL 2"),
    "LGPL-2.1": ("Lesser General Public License 2.1", "LGPL 2.1", "Lesser GPL 2.1"),
    "LGPL-3.0": ("Lesser General Public License 3", "LGPL 3", "Lesser GPL 3"),
    "MIT": ("MIT License", "MIT X11 License", "Expat License", "licensed under MIT", "released under MIT", "under the terms of MIT", "MIT licensed", "MIT Apache", "Apache MIT", "MIT or Apache", "dual MIT"),
    "MIT-0": ("MIT 0", "MIT No Attribution"),
    "MPL-1.1": ("Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License 2", "MPL 2"),
    "MS-PL": ("Microsoft Public License", "MS PL"),
    "NCSA": ("University of Illinois NCSA Open Source License", "NCSA Open Source License"),
    "ODbL-1.0": ("Open Database License 1", "ODbL 1", "Open Database License"),
    "OFL-1.1": ("SIL Open Font License 1.1", "Open Font License 1.1", "SIL Open Font License"),
    "OSL-3.0": ("Open Software License 3", "OSL 3"),
    "PostgreSQL": ("PostgreSQL License",),
    "PSF-2.0": ("Python Software Foundation License 2", "PSF License 2", "Python Software Foundation License"),
    "SSPL-1.0": ("Server Side Public License 1", "SSPL 1", "Server Side Public License"),
    "Unlicense": ("The Unlicense", "released under Unlicense"),
    "UPL-1.0": ("Universal Permissive License 1", "UPL 1"),
    "WTFPL": ("Do What The Fuck You Want To Public License", "WTFPL"),
    "Zlib": ("zlib License", "zlib libpng License"),
    "ZPL-2.1": ("Zope Public License 2.1", "ZPL 2.1"),
    "all-rights-reserved": ("All rights reserved",),
}
#: Sentences of licence texts that name no licence. ``HELD`` of their word pairs must be there, and all ``DECISIVE`` words.
BODIES: dict[str, tuple[str, ...]] = {
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                "documentation covered by this license",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
    "WTFPL": ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed",),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
             "arising from the use of this software",),
    **{f"{short}-{version}": (f"under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License",
                              f"under the terms of the GNU {name} as published by the Free Software Foundation, version {version}",
                              f"under the terms of version {version} of the GNU {name}")
       for short, name, versions in (("GPL", "General Public License", ("1.0", "2.0", "3.0")), ("AGPL", "Affero General Public License", ("3.0",)),
                                     ("LGPL", "Lesser General Public License", ("2.1", "3.0")), ("LGPL", "Library General Public License", ("2.0",)))
       for version in versions},
}
DECISIVE = {"affero", "lesser", "library", "organization", "hereby", "unencumbered", "fee"}
#: Sentences about rights that name no licence; they stand for the unknown class, too.
UNKNOWN = ("A licence to drive is the right of the public in general.", "The general public may use the source of the river free of charge.",
           "Version 2 of the report is published under the name of the foundation.", "This document is provided for information, with no claim to be complete.",
           "The software is distributed to members, who may copy the files.", "Permission of the owner is needed to enter the building.",
           "Terms and conditions of the sale are printed on the back of the ticket.", "The new terms of the public library are free of any fee.")
#: Openings and endings that notices come with; each is put around each name for the fit.
AROUND = ("{}", "Licensed under the {}.", "SPDX-License-Identifier: {}", "This file is released under the terms of the {}",
          "Copyright (c) 2020 the authors. {} See the file LICENSE for details.")

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Segments:
    """Windows of a batch: the text each belongs to, its words' first and last place in the batch, and with what is around."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def moved(self, by: int) -> Segments:
        return Segments(self.text, self.first + by, self.last + by, self.low + by, self.high + by)


@dataclass
class Model:
    weights: np.ndarray  # a row for each feature, a column for each family and one for any; the last row is the constant
    temperature: float
    limit: float


def _windows(text: np.ndarray, starts: np.ndarray, paragraphs: np.ndarray) -> Segments:
    """Windows of the pieces that begin at the words ``starts``; what is around them ends with their paragraph."""
    n = len(text)
    if not n:
        return Segments(*[np.zeros(0, np.int64)] * 5)
    stops = np.append(starts[1:], n)
    count = np.maximum(1, -(-(stops - starts - (WINDOW - STEP)) // STEP))
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(starts, count) + nth * STEP
    last = np.minimum(first + WINDOW, np.repeat(stops, count))
    of = np.searchsorted(paragraphs, first, side="right")
    low = np.maximum(first - AROUND_WORDS, paragraphs[of - 1])
    high = np.minimum(last + AROUND_WORDS, np.append(paragraphs, n)[of])
    return Segments(text[first], first, last, low, high)


def _read(texts: pa.Array) -> tuple[list[tuple[np.ndarray, Segments]], np.ndarray]:
    """Features of each word (alone, and with the word before) and windows, of lines and over the ends of lines; first byte of
    each word."""
    words = words_of(texts, lower_ascii(), is_word=_IS_WORD)
    data, _ = buffer_of(texts)
    one = words.hashes[0]
    n = len(one)
    text = np.repeat(np.arange(len(words.ends)), np.diff(np.concatenate([[0], words.ends])))
    line = np.searchsorted(np.flatnonzero(data == 10), words.starts) if n else np.zeros(0, np.int64)
    new, apart = np.ones(n, bool), np.ones(n, bool)  # first of a line, of a paragraph
    if n:
        new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
        apart[1:] = (text[1:] != text[:-1]) | (line[1:] > line[:-1] + 1)
    before = np.ones(n, _U)
    before[1:] = one[:-1]
    alone = (mix(one) >> _U(64 - BITS)).astype(np.int64)

    def found(begins: np.ndarray) -> np.ndarray:
        pair = mix(np.where(begins, _U(1), before) * _U(0x9E3779B97F4A7C15) + one)
        return np.stack([alone, (mix(pair ^ _U(23)) >> _U(64 - BITS)).astype(np.int64)])

    starts, paragraphs = np.flatnonzero(new), np.flatnonzero(apart)
    out = [(found(new), _windows(text, starts, paragraphs))]
    if len(starts) > len(paragraphs):
        over = _windows(text, paragraphs, paragraphs)
        wraps = line[over.first] != line[over.last - 1]
        out.append((found(apart), Segments(*[x[wraps] for x in (over.text, over.first, over.last, over.low, over.high)])))
    return out, words.starts


def _logits(found: np.ndarray, at: Segments, weights: np.ndarray) -> np.ndarray:
    sums = np.vstack([np.zeros((1, weights.shape[1])), np.cumsum(weights[found].sum(axis=0), axis=0)])
    return SCALE * (sums[at.last] - sums[at.first]) / np.maximum(1, at.last - at.first)[:, None] + weights[-1]


def _likely(found: np.ndarray, at: Segments, model: Model, columns: slice | list[int]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_logits(found, at, model.weights[:, columns]) / model.temperature, -35, 35)))


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


_TOKEN = re.compile(r"[0-9]+(?:\.[0-9]+)*|[a-z\u0080-\U0010ffff]+")
_DROPPED = {"version", "v", "ver", "the", "a", "an", "unported", "international", "generic"}
_SAME = {"licence": "license", "licenced": "licensed", "licences": "license", "licenses": "license", "gplv": "gpl", "lgplv": "lgpl", "agplv": "agpl", "mplv": "mpl", "eplv": "epl"}


def plain(text: str) -> list[str]:
    """Words as they are compared: lower case, one spelling, without "version" and articles; 2.0 is 2."""
    out = []
    for w in _TOKEN.findall(text.lower().replace("cc0", "cczero")):
        while w.endswith(".0"):
            w = w[:-2]
        w = _SAME.get(w, w)
        if w not in _DROPPED:
            out.append(w)
    return out


def _sequences() -> dict[tuple[str, ...], str]:
    """Each name and identifier as the words it must stand in, one after the other."""
    out: dict[tuple[str, ...], str] = {}
    for family, names in NAMES.items():
        for name in (*names, f"SPDX License Identifier {family}", *([family] if len(plain(family)) > 1 else [])):
            out.setdefault(tuple(plain(name)), family.lower())
    return out


FAMILIES = sorted(f.lower() for f in NAMES)
_SPDX = {f.lower(): f for f in NAMES}
_SEQUENCES = _sequences()
_BY_FIRST: dict[str, list[tuple[str, ...]]] = {}
for _words in _SEQUENCES:
    _BY_FIRST.setdefault(_words[0], []).append(_words)
_BODY_PAIRS = [(f.lower(), _pairs(plain(t)), {w for w in plain(t) if w[0].isdigit() or w in DECISIVE}) for f, ts in BODIES.items() for t in ts]


def _where(places: list[list[int]]) -> tuple[int, ...]:
    """A place for each pair, of its ``places``, so that they lie as close together as they can."""
    found = sorted((p, k) for k, ps in enumerate(places) for p in ps)
    latest: dict[int, int] = {}
    best: tuple[int, ...] = ()
    for p, k in found:
        latest[k] = p
        if len(latest) == len(places) and (not best or p - min(latest.values()) < best[-1] - best[0]):
            best = tuple(sorted(latest.values()))
    return best


def families_held(text: str) -> list[str]:
    """Families whose name stands in the text, word by word and with its version, or of one of whose sentences it holds
    ``HELD`` of the word pairs, close together, with every number and decisive word.

    A match that lies inside a longer one of another family says nothing: CC BY is part of CC BY-NC. A list of versions ("2 or 3")
    names each.
    """
    words = plain(text)
    matches: list[tuple[int, int, str]] = []  # first word, the one after the last, family
    for at, word in enumerate(words):
        for name in _BY_FIRST.get(word, ()):
            end = at + len(name)
            if tuple(words[at:end]) == name and not (name[-1][0].isdigit() is False and name[-1] == "license" and words[end:end + 1] and words[end][0].isdigit()):
                matches.append((at, end, _SEQUENCES[name]))
                while name[-1][0].isdigit() and words[end:end + 1] in (["or"], ["and"]) and words[end + 1:end + 2] and words[end + 1][0].isdigit():
                    other = _SEQUENCES.get((*name[:-1], words[end + 1]))
                    end += 2
                    if other:
                        matches.append((end - 1, end, other))
    places: dict[tuple[str, str], list[int]] = {}
    for p, pair in enumerate(zip(words, words[1:], strict=False)):
        places.setdefault(pair, []).append(p)
    bodies = []
    for family, pairs, decisive in _BODY_PAIRS:
        there = [places[pair] for pair in pairs if pair in places]
        if len(there) >= HELD * len(pairs):
            found = _where(there)
            first, last = found[0], found[-1] + 2
            if last - first <= 2 * len(pairs) + 4 and decisive <= set(words[first:last]):
                bodies.append((len(there) / len(pairs), first, last, family))
    # sentences that share their words with others: the one held most fully, then the longest
    taken: list[tuple[int, int, str]] = []
    for _, first, last, family in sorted(bodies, key=lambda b: (-b[0], b[1] - b[2], b[3])):
        if not any(first < stop and start < last and family != f for start, stop, f in taken):
            taken.append((first, last, family))
    matches += taken
    alone = [(a, b, f) for a, b, f in matches if not any(x <= a and b <= y and (y - x) > (b - a) and g != f for x, y, g in matches)]
    return sorted({f for _, _, f in alone})


def train(lines: list[str]) -> Model:
    """The classifier, from names and bodies in usual forms, and ``lines`` of the corpus as unknown (those that hold a family left out)."""
    lines = [x for x in lines if not families_held(x)]
    examples = [(form.format(name), k) for k, f in enumerate(FAMILIES) for name in (*NAMES[_SPDX[f]], _SPDX[f]) for form in AROUND]
    examples += [(form.format(t), k) for k, f in enumerate(FAMILIES) for t in BODIES.get(_SPDX[f], ()) for form in AROUND[::4]]
    # notices inside running text: words of the corpus before and behind, or a few of no meaning where there is no corpus
    running = [x.split() for x in lines] or [["some", "words", "of", "a", "text"]]
    for i, (text, k) in enumerate(examples[::len(AROUND)]):
        for j in (2 * i, 2 * i + 1):
            before, behind = running[j % len(running)], running[(7 * j + 3) % len(running)]
            examples.append((" ".join([*before[:12], text, *behind[:12]]), k))
    examples += [(x, -1) for x in lines]
    examples += [(x, -1) for x in UNKNOWN]
    found, at = _read(pa.array([x for x, _ in examples], pa.string()))[0][0]
    label = np.array([k for _, k in examples])[at.text] if len(at.text) else np.zeros(0, int)
    rows = []
    for a, b in zip(at.first, at.last, strict=True):
        f, n = np.unique(found[:, a:b], return_counts=True)
        rows.append((np.append(f, 1 << BITS), np.append(SCALE * n / (b - a), 1.0)))
    order = np.argsort(mix(np.arange(1, len(rows) + 1, dtype=_U)))
    out = mix(np.arange(1, len(rows) + 1, dtype=_U) ^ _U(99)) % _U(5) == 0  # kept out of the fit
    weights = np.zeros(((1 << BITS) + 1, len(FAMILIES) + 1))  # the last column: any licence at all
    belongs = np.hstack([label[:, None] == np.arange(len(FAMILIES)), label[:, None] >= 0])
    for k in range(len(FAMILIES) + 1):
        leader = Leader((1 << BITS) + 1, rate=1.0)
        for _ in range(2):
            for i in order:
                if not out[i]:
                    leader.learn(*rows[i], float(belongs[i, k]), 4.0 if belongs[i, k] and k < len(FAMILIES) else 1.0)
        weights[:, k] = leader.weights()
    scores = _logits(found, at, weights)[out]
    hit = belongs[out]

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(hit, -scores, scores) / t)))
    temperature = min((0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss) if len(scores) else 1.0
    likely = 1 / (1 + np.exp(-np.clip(scores / temperature, -35, 35)))
    unknown = likely[label[out] < 0, -1] if (label[out] < 0).any() else np.zeros(1)
    return Model(weights, temperature, float(min(0.2, max(0.02, np.quantile(unknown, 1 - PASSED)))))


def sample(docs: DataFrame, text: str = "text", size: int = SAMPLE) -> list[str]:
    """About ``size`` pieces of the corpus's lines, chosen by a hash of id, line and place: all pieces have the same chance.

    Lines are cut every ``SAMPLE_CHARS`` characters. Pieces are counted first; only those under a limit on the hash, four times as many
    as are wanted, are ordered and come to the driver, whatever the size of the corpus.
    """
    lines = docs.select("doc_id", F.explode(F.split(F.col(text), "\n")).alias("line")).where("length(line) > 0")
    last = F.floor((F.length("line") - 1) / SAMPLE_CHARS).cast("int")
    pieces = lines.select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(
        F.col("line"), i * SAMPLE_CHARS + 1, F.lit(SAMPLE_CHARS)))).alias("at", "piece"))
    n = pieces.count()
    order = F.xxhash64("doc_id", "piece", "at")
    chance = F.pmod(F.xxhash64("doc_id", "piece", "at", F.lit(3)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = pieces.where(chance * F.lit(n) < 4 * size)
    return [r["piece"] for r in few.orderBy(order, "piece").limit(size).select("piece").collect()]


def scan(docs: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row_id``, ``families`` (sorted, by comma; empty if there is none), ``n_notices`` (windows confirmed, those over the
    end of a line where no window of a line is) and ``score`` (largest probability of a confirmed window, else 0) of each row.
    A NULL text holds no notice."""
    used = docs.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    schema = used.select(F.col("_id").alias(row_id)).schema.add("families", "string").add("n_notices", "long").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "_text", 1 << 18):
                texts = part.column("_text")
                families: list[set[str]] = [set() for _ in range(len(part))]
                notices, best = np.zeros(len(part), np.int64), np.zeros(len(part))
                read, starts = _read(texts)
                data, ends = buffer_of(texts)
                counted = np.zeros(len(starts), bool)  # words of confirmed windows
                for found, at in read:
                    over = np.flatnonzero(_likely(found, at, model, slice(-1, None))[:, 0] >= model.limit)
                    confirmed = []
                    for i in over:
                        row, last = int(at.text[i]), int(at.high[i])
                        stop = min(int(starts[last]) if last < len(starts) else len(data), int(ends[row]))
                        names = families_held(data[starts[at.low[i]]:stop].tobytes().decode(errors="ignore"))
                        if names:
                            families[row].update(names)
                            notices[row] += not counted[at.first[i]:at.last[i]].any()
                            confirmed.append(i)
                            window = Segments(*[x[i:i + 1] for x in (at.text, at.first, at.last, at.low, at.high)])
                            likely = _likely(found[:, at.first[i]:at.last[i]], window.moved(-at.first[i]), model, [FAMILIES.index(f) for f in names])
                            best[row] = max(best[row], float(likely.max()))
                    for i in confirmed:
                        counted[at.first[i]:at.last[i]] = True
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array([",".join(sorted(f)) for f in families], pa.string()),
                                                  pa.array(notices), pa.array(best)], names=schema.names)

    return by_batch(used, run, schema)

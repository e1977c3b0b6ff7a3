"""License scans: MinHash bands over overlapping text windows.

A template is the set of its five-word shingles; it is found where 2s
consecutive shingles of a document hold at least 80 % of it, s being the
template's shingle count rounded up to its class (classes grow by a quarter,
in blocks of four shingles from four on). So up to a whole template's length
of foreign words may stand between its parts.

Candidates come from windows of three blocks of s shingles at stride s: any
2s consecutive shingles lie in one of them whole, and the Jaccard similarity of
that window with the template is at least 0.8 / (3 * 1.25 + 0.2) = 0.2025.
With ``BANDS`` = 64 bands of one row the two collide in some band with a
probability of at least 1 - 0.7975**64 > 0.9999994. Collisions are candidates;
exact containment decides, sliding over every position of the window.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filesystem, scratch_path, small_batches, write_atomically

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
#: Text bytes of templates in one file (or one template); tasks go through the files one at a time.
GROUP_BYTES = 4 << 20
#: Text bytes of documents that are scanned together (or one document).
SCAN_BYTES = 2 << 20

#: Public notices by licence: one-line statements and headers. Fixed values.
NOTICES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}

#: The notices, and whole public licence texts from the folder beside this module.
TEMPLATES = NOTICES | {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

#: A-Z to a-z; digits, letters and bytes of non-ASCII characters kept; all else parts words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def shingles_of(words: list[bytes]) -> list[tuple[bytes, ...]]:
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def stride_of(n_shingles: int) -> int:
    """The class of a template: the least of 1, 2, 3, 4, 8, ... that holds it; from 16 on a class is at most a quarter above the last."""
    s = 1
    while s < n_shingles:
        s = s + 1 if s < 4 else max(s + 4, s * 5 // 16 * 4)
    return s


def template_table(templates: Mapping[str, str]) -> dict[str, tuple[int, frozenset]]:
    """Name: (stride, shingles)."""
    out = {}
    for name, text in templates.items():
        found = frozenset(shingles_of(words_of(text.encode())))
        if not found:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        out[name] = (stride_of(len(found)), found)
    return out


def _multipliers(bands: int):
    import numpy as np

    return np.random.default_rng(5).integers(0, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingle_hashes(words: list[bytes]):
    """Hashes of all five-word runs of a word stream, uint64."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    coded = pa.array(words, pa.binary()).dictionary_encode()
    unique = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = unique[coded.indices.to_numpy(zero_copy_only=False)]
    with np.errstate(over="ignore"):
        x = np.zeros(len(h) - SHINGLE + 1, np.uint64)
        for j in range(SHINGLE):
            x = x * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - SHINGLE + 1 + j]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def fullest(got: list[tuple[int, tuple]], length: int) -> tuple[int, int, int]:
    """(distinct shingles, first, last) of the fullest run of ``length``
    consecutive places, given the places that hold a template's shingles;
    of equally full runs the first."""
    best, counts, low = (0, 0, 0), {}, 0
    for high, (place, shingle) in enumerate(got):
        counts[shingle] = counts.get(shingle, 0) + 1
        while got[low][0] <= place - length:
            counts[got[low][1]] -= 1
            if not counts[got[low][1]]:
                del counts[got[low][1]]
            low += 1
        if len(counts) > best[0]:
            best = (len(counts), got[low][0], place)
    return best


class _Scanner:
    def __init__(self, table: dict[str, tuple[int, frozenset]], bands: int):
        import numpy as np

        self.table, self.mult = table, _multipliers(bands)
        self.by_stride: dict[int, list[str]] = {}
        for name, (s, _) in sorted(table.items()):
            self.by_stride.setdefault(s, []).append(name)
        # Per class and band: the templates' minima, and a sieve on their upper 16 bits.
        self.minima, self.sieve = {}, {}
        with np.errstate(over="ignore"):
            for s, names in self.by_stride.items():
                sets = [np.array([_shingle_hashes(list(t))[0] for t in table[n][1]], np.uint64) for n in names]
                self.minima[s] = np.array([[(x * m).min() for x in sets] for m in self.mult])
                self.sieve[s] = np.zeros((bands, 1 << 16), bool)
                for b in range(bands):
                    self.sieve[s][b, (self.minima[s][b] >> np.uint64(48)).astype(np.int64)] = True

    def scan(self, docs: list[list[bytes]]) -> list[list[tuple[str, int, int, float]]]:
        """Per document: (template, first word, end word, containment) of each
        matching window's fullest place."""
        import numpy as np

        out: list[list] = [[] for _ in docs]
        lengths = np.array([max(0, len(d) - SHINGLE + 1) for d in docs], np.int64)
        if not lengths.sum():
            return out
        # One stream of shingles of all documents; runs across documents are left out.
        hashes = _shingle_hashes([w for d in docs for w in d])
        sizes = np.array([len(d) for d in docs], np.int64)
        first_word = np.cumsum(sizes) - sizes
        own = np.repeat(first_word - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        hashes = hashes[own]
        some = np.flatnonzero(lengths)

        def blocks(of, s: int):
            """Of documents with so many units each: the first unit of every block of s, its document and number."""
            n = -(-of // s)
            doc = np.repeat(np.arange(len(of)), n)
            number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            return (np.cumsum(of) - of)[doc] + number * s, doc, number

        quarters = -(-lengths[some] // 4)
        cuts4 = blocks(lengths[some], 4)[0]
        layout, met = {}, {}
        for s, names in self.by_stride.items():
            cuts, doc, number = blocks(quarters, s // 4) if s >= 4 else blocks(lengths[some], s)
            follows = [np.zeros(len(doc), bool) for _ in range(2)]  # the next block, and the one after, are of the same document
            for k in (1, 2):
                follows[k - 1][:-k] = doc[k:] == doc[:-k]
            layout[s] = cuts, doc, number, follows
            met[s] = np.zeros((len(doc), len(names)), bool)
        with np.errstate(over="ignore"):
            for b, m in enumerate(self.mult):
                values = hashes * m
                by4 = np.minimum.reduceat(values, cuts4)
                for s in self.by_stride:
                    cuts, _, _, follows = layout[s]
                    low = values if s == 1 else by4 if s == 4 else np.minimum.reduceat(by4 if s >= 4 else values, cuts)
                    whole = low.copy()
                    for k in (1, 2):
                        whole[:-k] = np.where(follows[k - 1][:-k], np.minimum(whole[:-k], low[k:]), whole[:-k])
                    near = np.flatnonzero(self.sieve[s][b][(whole >> np.uint64(48)).astype(np.int64)])
                    if len(near):
                        met[s][near] |= whole[near][:, None] == self.minima[s][b][None, :]
        for s, names in self.by_stride.items():
            _, doc, number, _ = layout[s]
            for w, t in zip(*np.nonzero(met[s])):
                d, a = int(some[doc[w]]), int(number[w]) * s
                wanted = self.table[names[t]][1]
                got = [(a + i, x) for i, x in enumerate(shingles_of(docs[d][a : a + 3 * s + SHINGLE - 1])) if x in wanted]
                n, first, last = fullest(got, 2 * s)
                if n / len(wanted) >= CONTAINMENT:
                    out[d].append((names[t], first, last + SHINGLE, n / len(wanted)))
        return out


def _groups(templates: Mapping[str, str], group_bytes: int) -> list[dict[str, str]]:
    out, size = [{}], 0
    for name, text in templates.items():
        n = len(text.encode())
        if out[-1] and size + n > group_bytes:
            out.append({})
            size = 0
        out[-1][name] = text
        size += n
    return out


#: The group of templates used last in this Python process.
_last: dict[tuple, _Scanner] = {}


def _scanner(uri: str, bands: int) -> _Scanner:
    if (uri, bands) not in _last:
        store, path = filesystem(uri)
        with store.open_input_stream(path) as f:
            found = _Scanner(template_table(json.loads(f.read())), bands)
        _last.clear()
        _last[uri, bands] = found
    return _last[uri, bands]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: ``doc_id`` and ``matches``, an array of
    (template, start, end, containment) in words, one per template and place
    (of overlapping matches the fuller one). Null, empty and short texts match
    nothing; a very long text is scanned whole, by itself; repeated rows are
    each answered; an empty table gives an empty result. Any number of
    templates may be asked for: they travel in files of ``group_bytes``."""
    small_batches(docs.sparkSession)
    template_table(templates)  # faults are raised here, not in a task
    folder = scratch_path(docs.sparkSession, "templates")
    paths = [f"{folder}/group-{i:05d}" for i, _ in enumerate(_groups(templates, group_bytes))]
    for path, group in zip(paths, _groups(templates, group_bytes)):
        write_atomically(path, iter([json.dumps(group).encode()]))
    source = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("binary"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        place = pa.list_(pa.struct([("template", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

        def out(ids: list, docs: list):
            matches: list[list] = [[] for _ in docs]
            for path in paths:
                for all_, more in zip(matches, _scanner(path, bands).scan(docs)):
                    all_ += more
            found = []
            for of_doc in matches:
                best: dict[str, list] = {}
                for name, a, b, share in sorted(of_doc):
                    last = best.setdefault(name, [])
                    if last and a < last[-1]["end"]:
                        if share > last[-1]["containment"]:
                            last[-1] = {"template": name, "start": a, "end": b, "containment": share}
                    else:
                        last.append({"template": name, "start": a, "end": b, "containment": share})
                found.append([m for name in sorted(best) for m in best[name]])
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, place)], names=["doc_id", "matches"])

        ids, docs, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if ids and size + len(text or b"") > SCAN_BYTES:
                    yield out(ids, docs)
                    ids, docs, size = [], [], 0
                ids.append(i)
                docs.append(words_of(text))
                size += len(text or b"")
        if ids:
            yield out(ids, docs)

    return source.mapInArrow(run, "doc_id bigint, matches array<struct<template:string,start:bigint,end:bigint,containment:double>>")

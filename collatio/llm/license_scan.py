"""License notices in texts: MinHash bands retrieve templates, exact shingle containment verifies them.

Templates and texts are sets of hashed five-word shingles. Overlapping windows as long as a template are taken wherever
a text holds one of its shingles; their MinHash bands are looked up in the templates' band table, and a template that
is found is verified by the share of its shingles that the window holds. Shingles that stand as far from one another as
in the template make one notice, so notices that are repeated or lie side by side are told apart and cut where they end. A window that starts within a quarter of the
template's length of a notice shares at least half of the joint set with it, and with BANDS bands of ROWS values the
chance to miss it is (1 - 0.5**ROWS)**BANDS < 1e-8.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.near_dedup import SAMPLES, min_hashes
from collatio.llm.shingles import WordHashes, mix, shared, shingles

ROWS = 2
BANDS = SAMPLES // ROWS
NGRAM, CONTAINED = 5, 0.8

#: Short notices by which texts name their license, and the first words of full license texts.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "GPL-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "All-Rights-Reserved": ("All rights reserved.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
}
OUTPUT = "doc_id long, license string, first_word long, n_words long, containment double"
#: Characters around a word that don't count: a notice may end a sentence, or stand in brackets.
AROUND = b".,;:!?\"'()[]{}<>*#/"


def _hashes(text: bytes, known: WordHashes) -> np.ndarray:
    found = [w.strip(AROUND) or w for w in text.lower().split()]
    return np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))


def _bands(items: np.ndarray) -> np.ndarray:
    parts = min_hashes(items).astype(np.uint64).reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return keys


@dataclass
class Group:
    """Templates whose shingles have the same number of words."""

    ngram: int
    names: list[str] = field(default_factory=list)
    sets: list[np.ndarray] = field(default_factory=list)
    #: Where a shingle stands in its template, by template.
    places: list[dict[int, int]] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    bands: dict[int, list[int]] = field(default_factory=dict)
    all: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))

    def add(self, name: str, hashes: np.ndarray) -> None:
        inside = shingles(hashes, self.ngram)
        items = np.unique(inside)
        self.places.append({h: i for i, h in reversed(list(enumerate(inside.tolist())))})
        for key in _bands(items).tolist():
            self.bands.setdefault(key, []).append(len(self.names))
        self.names.append(name)
        self.sets.append(items)
        self.sizes.append(len(hashes))
        self.all = np.union1d(self.all, items)


class Scanner:
    """Finds templates in texts; the same in every process. Templates of fewer than ngram words are one shingle of their own."""

    def __init__(self, templates: dict[str, tuple[str, ...]], ngram: int = NGRAM):
        self.known, groups = WordHashes(), {}
        for name, notices in templates.items():
            for notice in notices:
                hashes = _hashes(notice.encode(), self.known)
                n = min(ngram, len(hashes))
                groups.setdefault(n, Group(n)).add(name, hashes)
        self.groups = list(groups.values())

    def scan(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """(license, first word, words, containment) of each notice; where hits overlap, the one that is more of its template, then the longer one."""
        hashes = _hashes(text, self.known)
        hits: dict[str, list[tuple[int, int, float]]] = {}
        for group in self.groups:
            if len(hashes) >= group.ngram:
                self._windows(group, shingles(hashes, group.ngram), hits)
        found = {(-share, -n, first, name) for name, spans in hits.items() for first, n, share in spans}
        taken: list[tuple[int, int, str, float]] = []  # (first word, words, ...), in order and apart
        for share, n, first, name in sorted(found):
            at = bisect_left(taken, (first,))
            if (at == 0 or sum(taken[at - 1][:2]) <= first) and (at == len(taken) or first - n <= taken[at][0]):
                taken.insert(at, (first, -n, name, -share))
        return [(name, first, n, share) for first, n, name, share in taken]

    @staticmethod
    def _windows(group: Group, items: np.ndarray, hits: dict[str, list[tuple[int, int, float]]]) -> None:
        at = np.searchsorted(group.all, items)
        at[at == len(group.all)] = 0
        marked = np.flatnonzero(group.all[at] == items)
        if not len(marked):
            return  # no window of this text shares anything with a template
        for size in sorted(set(group.sizes)):
            step, wide = max(1, size // 4), size - group.ngram + 1
            # Windows of this size, from every step-th place, that hold a marked shingle.
            lo, hi = np.maximum(marked - wide + 1, 0) // step, marked // step
            for start in sorted({int(s) * step for a, b in zip(lo, hi, strict=True) for s in range(a, b + 1)}):
                window = items[start : start + wide + step]
                inside = np.unique(window)
                for t in {t for key in _bands(inside).tolist() for t in group.bands.get(key, ())}:
                    if shared(group.sets[t], inside) >= CONTAINED * len(group.sets[t]):
                        at = np.flatnonzero(np.isin(window, group.sets[t]))
                        places = np.array([group.places[t][h] for h in window[at].tolist()])
                        for first, n, share in _notices(at + start, places, group.sizes[t], group.ngram, len(group.sets[t])):
                            hits.setdefault(group.names[t], []).append((first, n, share))


def _notices(at: np.ndarray, places: np.ndarray, size: int, ngram: int, n_items: int) -> Iterator[tuple[int, int, float]]:
    """(first word, words, containment) of each run of a template's shingles that keep their distance up to a quarter of its length."""
    cuts = np.flatnonzero(np.abs(np.diff(at - places)) > size // 4) + 1
    for part in np.split(np.arange(len(at)), cuts):
        share = len(np.unique(places[part])) / n_items
        if share >= CONTAINED:
            yield int(at[part[0]]), int(at[part[-1]] - at[part[0]]) + ngram, share


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A row for each license notice in a text: doc_id, license, first_word, n_words, containment.

    Whole texts are read; null and empty ones hold no notice; repeated rows are scanned each, and repeated notices are
    hits of their own. Words are compared with A-Z lowered and without punctuation around them. Other columns of docs are
    ignored, whatever their names. An empty table gives no hits.
    """
    chosen = TEMPLATES if templates is None else templates
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            rows = [(i, *hit) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True) for hit in scanner.scan(text.as_py())]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in OUTPUT.split(", ")])

    return source.mapInArrow(run, OUTPUT)

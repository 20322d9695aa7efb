"""Operator 9: license scan by MinHash bands over overlapping windows.

A template is a set of word shingles (five words; all its words if it has
fewer). A window is a run of a quarter more shingles than the template has, at
every place of the text. Window and template get ``BANDS`` MinHash values, one
row a band; an equal band makes the window a candidate, and exact containment
decides: a match holds ``CONTAINED`` or more of the template's shingles.

Bands: a window that holds a share c of a template with S shingles has a
similarity of at least c S / (1.25 S + (1 - c) S), which is 0.55 for c = 0.8. One
window is missed by all 24 bands with a probability under 0.45 ** 24 = 5e-9, and
an occurrence lies in many windows.

An equal band means that the window holds the template's least shingle of that
band, so only windows around those shingles are looked at.

Defined cases: words are runs of letters and digits (bytes beyond ASCII
included), A-Z count as a-z; null and empty texts match nothing; a template
without words matches nothing; repeated rows are reported each; null doc_ids
stay null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stormmart.llm.common import text_bytes, tidy
from stormmart.llm.shingles import mixed, shingle_row, words_of

WORDS = 5
CONTAINED = 0.8
BANDS = 24
CUT_BYTES = 4_000_000

# --- fixed values: license notices ---------------------------------------------
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version."),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction"),
}
# --- end of fixed values -------------------------------------------------------

_GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_SALTS = np.random.default_rng(909).integers(1, 1 << 63, BANDS, dtype=np.uint64)


def _banded(shingles: np.ndarray) -> np.ndarray:
    """Values of shingles in every band (bands x shingles)."""
    return mixed(shingles[None, :] ^ _SALTS[:, None])


@dataclass(frozen=True)
class Template:
    name: str
    width: int
    shingles: np.ndarray
    bands: np.ndarray
    #: The shingles that have the least value of a band.
    least: np.ndarray

    @property
    def window(self) -> int:
        return len(self.shingles) + -(-len(self.shingles) // 4)

    @staticmethod
    def of(name: str, text: str) -> Template | None:
        words = words_of([text.encode()], _GAPS)[0]
        if not len(words):
            return None
        width = min(WORDS, len(words))
        shingles = np.unique(shingle_row(words, width))
        values = _banded(shingles)
        return Template(name, width, shingles, values.min(axis=1), np.unique(shingles[values.argmin(axis=1)]))


def _candidates(row: np.ndarray, places: np.ndarray, t: Template) -> np.ndarray:
    """Starts of the windows around ``places`` that share a band with the template."""
    last = max(0, len(row) - t.window)
    starts = np.unique(np.clip(places[:, None] - np.arange(t.window)[None, :], 0, last).ravel())
    at = np.minimum(starts[:, None] + np.arange(t.window)[None, :], len(row) - 1)
    used, back = np.unique(at, return_inverse=True)
    values = _banded(row[used])
    hit = np.zeros(len(starts), dtype=bool)
    for band in range(BANDS):
        hit |= values[band][back].reshape(at.shape).min(axis=1) == t.bands[band]
    return starts[hit]


#: Windows that are compared at once.
WINDOWS_AT_ONCE = 4096


def matches(words: np.ndarray, templates: list[Template]) -> list[tuple[str, int, float, int]]:
    """(template, occurrences, best containment, its first word) of a text."""
    found, rows = [], {}
    for t in templates:
        if t.width not in rows:
            rows[t.width] = shingle_row(words, t.width)
        row = rows[t.width]
        places = np.flatnonzero(np.isin(row, t.least))
        good: dict[int, float] = {}
        step = max(1, WINDOWS_AT_ONCE // t.window)
        for i in range(0, len(places), step):
            for start in _candidates(row, places[i:i + step], t).tolist():
                held = np.isin(t.shingles, row[start:start + t.window]).sum() / len(t.shingles)
                if held >= CONTAINED:
                    good[start] = float(held)
        if good:
            starts = sorted(good)
            runs = 1 + sum(b - a > t.window for a, b in zip(starts, starts[1:]))
            best = max(starts, key=lambda s: (good[s], -s))
            inside = np.isin(row[best:best + t.window], t.shingles)
            found.append((t.name, runs, good[best], best + int(np.argmax(inside))))
    return found


REPORT = "doc_id long, license string, occurrences long, containment double, first_word long"


def scan(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """A row for every document and template that it holds."""
    prepared = [t for t in (Template.of(n, x) for n, x in sorted(templates.items())) if t]
    widths = sorted({t.width for t in prepared})
    # Texts without any of the templates' least shingles (most texts) end here.
    wanted = {w: np.unique(np.concatenate([t.least for t in prepared if t.width == w])) for w in widths}
    slots = {w: np.zeros(1 << 16, dtype=bool) for w in widths}
    for w in widths:
        slots[w][(wanted[w] >> np.uint64(48)).astype(np.int64)] = True

    def promising(words: np.ndarray) -> bool:
        for w in widths:
            row = shingle_row(words, w)
            some = row[slots[w][row >> np.uint64(48)]]
            if len(some) and np.isin(some, wanted[w]).any():
                return True
        return False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            held, size = [], 0
            for i in range(batch.num_rows):
                held.append((ids[i], column[i].as_py()))
                size += len(held[-1][1])
                if size >= CUT_BYTES or i == batch.num_rows - 1:
                    rows = [(doc, *m) for (doc, _), words in zip(held, words_of([t for _, t in held], _GAPS))
                            if promising(words) for m in matches(words, prepared)]
                    cols = list(zip(*rows)) or [()] * 5
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                     names=[x.split()[0] for x in REPORT.split(", ")])
                    held, size = [], 0

    return docs.select("doc_id", text_bytes("text").alias("text")).mapInArrow(tidy(run), REPORT)


def op9_minhash_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), TEMPLATES)

"""Fill-in-the-middle: a text's prefix, middle and suffix around sentinels, cut at hash-chosen units.

One Aho-Corasick automaton finds, in a single scan, the ASCII characters at which a text changes class and the sentinels
themselves. Between two such events all code points are of one class, so the units of a gap follow from its length: no
list of units is built. The few segments between events hold the units before them, and a rank is found by bisection
and a subtraction.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import releasing

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SCHEMA = "doc_id long, n_units long, n long, form string, prefix_chars long, middle_chars long, output string"


class Kind(NamedTuple):
    """How texts are cut into units: characters of a class of their own, whether a gap's code points are units each, and whether a marked character ends the unit before it."""

    marked: str
    single: bool
    ends: bool


#: Every code point; runs of white space and runs of anything else; lines with their ends.
KINDS = {"code_points": Kind("", True, False), "words": Kind("\t\n\v\f\r ", False, False), "lines": Kind("\n", False, True)}


@lru_cache
def automaton(kind: str) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in KINDS[kind].marked:
        found.add_word(c, 0)
    for s in (PREFIX, SUFFIX, MIDDLE):
        found.add_word(s, 1)
    found.make_automaton()
    return found


@dataclass
class Segments:
    """A text's segments: where each starts, the units before it, and whether its code points are units each."""

    single: bool
    starts: list[int] = field(default_factory=lambda: [0])
    before: list[int] = field(default_factory=lambda: [0])
    n: int = 0
    sentinel: bool = False

    def offset(self, rank: int, length: int) -> int:
        """The code point at which unit number `rank` begins; the text's length for its number of units."""
        if rank >= self.n:
            return length
        k = bisect_right(self.before, rank) - 1
        return self.starts[k] + (rank - self.before[k] if self.single else 0)


def scan(text: str, kind: str = "code_points", stop: bool = False) -> Segments:
    """The segments of a text from one pass of the automaton; stop: end at the first sentinel, since such texts stay as they are."""
    rule = KINDS[kind]
    out = Segments(rule.single, [], [])
    at, run = 0, -1  # end of what is counted, end of the last run of marked characters

    def add(start: int, units: int) -> None:
        out.starts.append(start)
        out.before.append(out.n)
        out.n += units

    for end, sentinel in automaton(kind).iter(text):
        if sentinel:
            out.sentinel = True
            if stop:
                break
        elif rule.ends:
            add(at, 1)
            at = end + 1
        else:
            if end > at:
                add(at, end - at if rule.single else 1)
            if run != end or end == 0:
                add(end, 1)
            at = run = end + 1
    if at < len(text):
        add(at, len(text) - at if rule.single else 1)
    return out


def hashes(doc_id: int | None, seed: int) -> list[int]:
    """The first four 32-bit numbers of the sha256 of seed, colon and id; a null id is the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def rearranged(doc_id: int | None, text: str, kind: str, seed: int, percent: int, spm_percent: int) -> tuple:
    """The row of one text: id, units, code points, form, code points of prefix and middle, output."""
    h1, h2, h3, h4 = hashes(doc_id, seed)
    found = scan(text, kind)
    if not text or found.sentinel or h3 % 100 >= percent:
        return doc_id, found.n, len(text), "plain", None, None, text
    first, second = sorted((h1 % (found.n + 1), h2 % (found.n + 1)))
    a, b = found.offset(first, len(text)), found.offset(second, len(text))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return doc_id, found.n, len(text), "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return doc_id, found.n, len(text), "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, kind: str = "code_points", seed: int = 1, percent: int = 90, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_units, n (code points), form, prefix_chars, middle_chars, output.

    `percent` of a hundred texts are rearranged, `spm_percent` of those with the suffix first. Empty texts, null ones
    (which count as empty) and texts that hold a sentinel stay plain: their output is the text, and the lengths are null.
    A row's form and cuts depend on its id, the seed and its text only, so repeated rows give equal ones. A null id hashes
    as the empty string. Other columns are ignored, whatever their names; an empty table gives no row.
    """
    if kind not in KINDS:
        raise ValueError(f"units are one of {', '.join(KINDS)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [rearranged(i, t.as_py(), kind, seed, percent, spm_percent) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(releasing(run), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No sentinel can arise where text and sentinel meet, since each begins with its only `<`."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)

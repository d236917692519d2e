"""Best-fit packing of tokenised documents by a plan over the histogram of lengths.

Best fit with longest first treats pieces of one length alike, so it runs over at most `capacity` counts instead of
over pieces: groups of equally filled sequences take q pieces of the next length at a time. Its plan has a row for
each (length, group) pair it meets and says which ranks within a length go where. Pieces find their rank from their
place in their task and the counts of the tasks before it, then take their slot by a join on length and rank.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collatio.llm.shared import durable, releasing, worker_state

CAPACITY = 1024
#: Text that a worker encodes at a time: an Arrow batch of the usual size whole. It takes some 25 times as much memory meanwhile.
CHUNK_BYTES = 5_000_000
END_ID = 2
#: Units whose ids a worker remembers while it packs; when it has more, it forgets them all and learns anew.
REMEMBERED = 600_000
#: New units that are encoded in one text.
TOGETHER = 1024
#: White space as both Python and the tokenizer see it, then the rest up to the next such run. The tokenizer never joins characters over the seam.
UNIT = re.compile(r"[^\S\x1c-\x1f]*(?:\S|[\x1c-\x1f])+|[^\S\x1c-\x1f]+")
_SPACES = "\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: Where cutting at single spaces and in front of lines is not the same thing; RE2.
SPACE_BEFORE_SPACE = f"[{_SPACES}] | \\n|\\x00"
#: The end of a line that does not end in white space; RE2.
LINE_END = f"([^{_SPACES}])\\n"
#: In front of a unit that begins at a point right behind a word, which no blank precedes; texts that hold it are cut one by one.
BARE = "\x00"
#: The seam between a letter of the Latin blocks and a point; RE2. The tokenizer's pattern ends a word there.
POINT = "([A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{24f}])([,.;:!?])"
#: Ranks within a length that meet the plan in one chunk of the join.
RANKS = 4096
#: Rows of the plan, cut into chunks, up to which it is broadcast (some 50 bytes each); a longer one is joined by a shuffle.
BROADCAST_ROWS = 100_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLAN_SCHEMA = "length long, first long, n long, each long, sequence long, at long"


class Tokens:
    """Token ids of texts by a `tokenizers` file, remembering the ids of units between blanks.

    A text is cut in front of each blank, of each new line behind a line's last word and of each point behind a letter, or
    of each run of white space where two kinds of it meet. A byte-level BPE of the GPT-2 kind splits there in any case, so the ids of a text are
    those of its units one after the other; a test compares both. Units that open with a new line have no blank before
    it. Strings of special tokens are what the tokenizer takes them for by default.
    """

    def __init__(self, path: str):
        # A task has one core: threads of the tokenizer's own would only wait for one another.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Byte-level BPE writes a blank as U+0120 and a new line as U+010A: the tokens that a unit can open with.
        self.opens = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith(("\u0120", "\u010a"))
        self.known: dict[str, int] = {}
        self.remembered = REMEMBERED
        self.ids, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.starts, self.counts = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def store(self, n: int, counts: np.ndarray, ids: np.ndarray) -> None:
        """Units number n and following have these counts of these ids."""
        m = len(counts)
        while n + m > len(self.starts):
            self.starts, self.counts = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.counts, 2 * len(self.counts))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[n : n + m] = self.used + np.cumsum(counts) - counts
        self.counts[n : n + m] = counts
        self.used += len(ids)

    def one_by_one(self, n: int, texts: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.store(n, counts, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(counts.sum())))

    def learn(self, units: list[str]) -> None:
        """Remember the ids of units as they are behind a blank, or with the new line that they open with."""
        inner, rest = [], []
        for unit in units:
            word = unit[1:] if unit[:1] == "\n" else unit
            (inner if word and word == word.strip() and "\n" not in word and word[0] != BARE else rest).append(unit)
        whole = lambda unit: unit if unit[:1] == "\n" else unit[1:] if unit[:1] == BARE else " " + unit
        if inner:
            # Many in one text; a token that opens with a blank or a new line opens the next unit.
            texts = ["".join(map(whole, inner[i : i + TOGETHER])) for i in range(0, len(inner), TOGETHER)]
            ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(inner) and at[0] == 0:
                self.store(len(self.known), np.diff(at, append=len(ids)), ids)
                self.known.update(zip(inner, range(len(self.known), len(self.known) + len(inner)), strict=True))
            else:
                rest = units
        if rest:
            self.one_by_one(len(self.known), list(map(whole, rest)))
            self.known.update(zip(rest, range(len(self.known), len(self.known) + len(rest)), strict=True))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array without nulls."""
        if not len(texts):
            return []
        if len(self.known) > self.remembered:
            self.known, self.used = {}, 0
        rare = np.flatnonzero(pc.match_substring_regex(texts, SPACE_BEFORE_SPACE).to_numpy(zero_copy_only=False))
        cut = pc.replace_substring_regex(pc.replace_substring_regex(texts, LINE_END, "\\1 \n"), POINT, f"\\1 {BARE}\\2")
        cut = pc.split_pattern(cut, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        values = cut.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets -= offsets[0]
        coded = values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if new := [w for w in words if w not in self.known]:
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))[coded.indices.to_numpy()]
        # Units that no blank stands before: the first of each text, and all of texts where white space meets.
        firsts = values.take(pa.array(offsets[:-1])).to_pylist()
        odd = [UNIT.findall(texts[int(i)].as_py()) for i in rare]
        bare = {u: len(self.known) + i for i, u in enumerate(dict.fromkeys(chain(firsts, *odd)))}
        used = self.used
        self.one_by_one(len(self.known), list(bare))
        self.used = used
        at[offsets[:-1]] = np.fromiter(map(bare.__getitem__, firsts), dtype=np.int64, count=len(firsts))
        if len(rare):
            parts = [at[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            for i, units in zip(rare, odd, strict=True):
                parts[i] = np.array([bare[u] for u in units], dtype=np.int64)
            at, offsets = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        counts = self.counts[at]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[at] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[offsets]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def spans(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences but for the first, which takes the remainder."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int, chunk_bytes: int, remembered: int) -> DataFrame:
    """The pieces, each with the task that made it and its number among that task's pieces of its length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = worker_state(f"tokens of {tokenizer_path}", lambda: Tokens(tokenizer_path)), TaskContext.get().partitionId()
        tokens.remembered = remembered
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows: list[tuple] = []
            # Some megabytes at a time, so that the ids of one Arrow batch are never all in memory.
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            cuts = np.unique([0, *np.searchsorted(ends, np.arange(chunk_bytes, ends[-1], chunk_bytes), side="right"), len(ids)]) if len(ids) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                for doc_id, found in zip(ids[lo:hi], tokens.encode(texts.slice(lo, hi - lo)), strict=True):
                    raw = found.astype("<u4").tobytes() + end
                    for k, (start, length) in enumerate(spans(len(found) + 1, capacity)):
                        rows.append((doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), part, int(seen[length])))
                        seen[length] += 1
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(releasing(pieces, f"tokens of {tokenizer_path}"), PIECE_SCHEMA)


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit, longest first, over counts of lengths.

    Returns rows (length, first_rank, n, per_sequence, first_sequence, offset), by length and rank: the pieces of that
    length with ranks first_rank .. first_rank + n - 1 go per_sequence at a time into sequences from first_sequence on,
    from offset on; and the number of sequences. Gives the very filling that best fit over single pieces gives.
    """
    rows: list[tuple[int, int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, how many)
    rooms: list[int] = []  # the keys of groups, in order
    n_sequences = 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room, first = capacity, n_sequences
                many = -(-left // (capacity // length))
                n_sequences += many
            each = room // length
            whole = min(many, left // each)
            if whole:
                rows.append((length, rank, whole * each, each, first, capacity - room))
                put(room - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            if left and whole < many:  # fewer than `each` are left: one sequence takes them
                rows.append((length, rank, left, left, first + whole, capacity - room))
                put(room - left * length, first + whole, 1)
                whole, rank, left = whole + 1, rank + left, 0
            put(room, first + whole, many - whole)
    return rows, n_sequences


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, chunk_bytes: int = CHUNK_BYTES, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone; longer documents are cut into pieces of `capacity`, the first taking the
    remainder. Repeated rows are packed each; no document is dropped. An empty table gives no pieces. Other columns of
    docs are ignored, whatever their names. chunk_bytes and remembered bound a worker's memory; no result depends on them.
    """
    pieces = durable(tokenised_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, chunk_bytes, remembered))
    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    # At most `capacity` counts come to the driver, whatever the input.
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    plan, _ = best_fit_plan(counts, capacity)
    rows = docs.sparkSession.createDataFrame(plan, PLAN_SCHEMA)
    chunk = lambda rank: F.floor(rank / RANKS)
    slots = rows.withColumn("chunk", F.explode(F.sequence(chunk(F.col("first")), chunk(F.col("first") + F.col("n") - 1))))
    # How long the plan is follows from itself: chunks of ranks, and rows that begin inside one.
    if len(plan) + sum(n for _, _, n, *_ in plan) // RANKS + len(plan) <= BROADCAST_ROWS:
        slots = F.broadcast(slots)
    met = ranked.withColumn("chunk", chunk(F.col("rank"))).join(slots, ["length", "chunk"]).where("rank >= first and rank < first + n")
    nth = F.col("rank") - F.col("first")
    sequence, offset = F.col("sequence") + F.floor(nth / F.col("each")), F.col("at") + nth % F.col("each") * F.col("length")
    return met.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))

"""SentencePiece BPE by a table of prefixes, and its decoding.

Taking away the last token of an encoded text leaves the encoding of the rest, so every prefix of a text has one last
token. It is the one piece that ends there (an automaton of all pieces finds them) and that goes together with the last
token of the prefix in front of it: two tokens go together if merging their characters alone gives these two again.
The table of last tokens is filled from left to right, in time linear in the text whatever the merges, and read from
the end. Units between blanks and line ends are encoded once and remembered; new ones fill their tables side by side,
prefix by prefix.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import count

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import free_of, releasing, worker_state

BLANK = "▁"
#: What stands between the units of a column of texts; texts that hold it are cut one by one.
SEPARATOR = "\x00"
#: Signs that close a word.
POINTS = ",.;:!?"
NEVER = float("-inf")
#: Units and pairs that a worker remembers; when it has more it forgets them and learns anew.
REMEMBERED = 500_000
REMEMBERED_PAIRS = 1_000_000
#: Characters of units up to which they are remembered: longer ones hardly come again.
LONG_UNIT = 64
#: New units whose prefix tables are filled side by side.
SIDE_BY_SIDE = 16_384
#: Fewer new units are encoded one by one.
FEW = 64
#: Documents whose ids are Python lists at once, for the library to decode.
TOGETHER = 256


class Pieces:
    """Encoder over the pieces of one model file, which must be BPE with byte fallback, the identity as normaliser and a blank in front.

    Pieces in which a blank follows another sign, and characters that stand in pieces but are none themselves, are an
    error: units between blanks and single unknown characters would not be independent then.
    """

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
        self.names, self.scores = {i: p for p, i in self.ids.items()}, {p: model.get_score(i) for p, i in self.ids.items()}
        if len(self.bytes) != 256 or any(BLANK in p.lstrip(BLANK) or any(c not in self.ids for c in p) for p in self.ids) or model.encode("Ⅷ  é") != model.encode(f"Ⅷ{BLANK} é"):
            raise ValueError(f"{path} is no BPE model of the kind that this encoder knows")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        # The same pieces as a tree for arrays: signs have numbers from 1, a state is the beginning of a piece, that of one sign has the sign's number.
        states = {c: i for i, c in enumerate(sorted({c for p in self.ids for c in p}), 1)}
        self.width = len(states) + 1
        self.sign = np.zeros(sys.maxunicode + 1, dtype=np.int64)
        self.sign[list(map(ord, states))] = list(states.values())
        edges: dict[int, int] = {}
        for piece in self.ids:
            for end in range(2, len(piece) + 1):
                if (state := states.setdefault(piece[:end], len(states) + 1)) == len(states):
                    edges[states[piece[: end - 1]] * self.width + states[piece[end - 1]]] = state
        self.edges, self.targets = pd.Index(np.array(list(edges), dtype=np.int64)), np.array(list(edges.values()), dtype=np.int64)
        self.tokens = np.array([0, *(self.ids.get(p, 0) for p in states)], dtype=np.int64)
        #: Units for ids_together.
        self.plain = re.compile(f"[{re.escape(''.join(sorted({c for p in self.ids for c in p})))}]{{1,{LONG_UNIT}}}").fullmatch
        # Where no piece has two signs side by side no token crosses, so units may end there: line ends, words before points.
        beside = {(x, y) for p in self.ids for x, y in zip(p, p[1:])}  # noqa: B905
        line = "" if "\n" in self.ids else "\n"
        inside = re.escape("".join(sorted({x for x, y in beside if y in POINTS and x.isalnum()})))
        rest = f"{BLANK}{line}"
        self.unit = re.compile(f"{BLANK}*[^\\W_{inside}]+(?=[{POINTS}])|{BLANK}+[^{rest}]*|[^{rest}]+" + (f"|{line}" if line else ""))
        #: Whether whole columns can be cut at once: by SEPARATOR, in front of blanks, around line ends, before points.
        self.columnar = bool(line) and not any(SEPARATOR in p for p in self.ids) and not any(unicodedata.category(x)[0] == "L" or x.isdecimal() for x in inside)
        self.size = n
        self.pairs: dict[int, bool] = {}
        self.tested, self.fits = pd.Index([], dtype=np.int64), np.zeros(0, dtype=bool)
        self.steps: dict[int, tuple[list[float], list[str], list[str]]] = {}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.store, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.starts, self.counts = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def merges(self, token: int) -> tuple[list[float], list[str], list[str]]:
        """How a token comes about from its characters, best score first and leftmost among equals.

        The score of each merge, NEVER behind the last, and the first and the last part before each merge and at the end.
        """
        if token not in self.steps:
            parts, scores, firsts, lasts = list(self.names[token]), [], [], []
            while True:
                firsts.append(parts[0])
                lasts.append(parts[-1])
                found = [(-self.scores[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.scores]
                if not found:
                    break
                score, i = min(found)
                scores.append(-score)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.steps[token] = ([*scores, NEVER], firsts, lasts)
        return self.steps[token]

    def together(self, left: int, right: int) -> bool:
        """Whether token `right` can follow token `left` (0: the beginning or an unknown character, with which nothing merges).

        Their characters are merged side by side; the tokens go together unless a merge over the seam is ever the best.
        """
        if len(self.pairs) > REMEMBERED_PAIRS:
            self.pairs.clear()
        b, firsts, wholes = self.merges(right)
        fits = wholes[-1] == self.names[right]
        if left and fits:
            a, _, lasts = self.merges(left)
            i = j = 0
            while True:
                seam = self.scores.get(lasts[i] + firsts[j], NEVER)
                if seam > a[i] and seam >= b[j] and seam > NEVER:
                    fits = False
                    break
                if a[i] == b[j] == NEVER:
                    break
                if a[i] >= b[j]:
                    i += 1
                else:
                    j += 1
        self.pairs[left * self.size + right] = fits
        return fits

    def ids_of(self, unit: str) -> list[int]:
        """The ids of one unit, by the last token of each of its prefixes."""
        last, back = [0] * (len(unit) + 1), [1] * (len(unit) + 1)
        pairs, size = self.pairs, self.size
        for end, (token, n) in self.automaton.iter(unit):
            end += 1
            if not last[end]:
                left = last[end - n]
                fits = pairs.get(left * size + token)
                if fits or fits is None and self.together(left, token):
                    last[end], back[end] = token, n
        out: list[int] = []
        at = len(unit)
        while at:
            if token := last[at]:
                out.append(token)
            else:  # no piece has this character: its bytes stand for it
                out.extend(self.bytes[b] for b in reversed(unit[at - 1].encode()))
            at -= back[at]
        out.reverse()
        return out

    def all_together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`together` of many pairs."""
        keys = left * self.size + right
        at = self.tested.get_indexer(keys)
        new = np.flatnonzero(at < 0)
        if not len(new):
            return self.fits[at]
        fits = np.zeros(len(keys), dtype=bool)
        fits[at >= 0] = self.fits[at[at >= 0]]
        unknown, where = np.unique(keys[new], return_inverse=True)
        tested = [self.together(*divmod(k, self.size)) if (fit := self.pairs.get(k)) is None else fit for k in unknown.tolist()]
        fits[new] = np.array(tested, dtype=bool)[where]
        return fits

    def ids_together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain units one after the other, and how many each has: ids_of by arrays of one entry a prefix."""
        if not len(self.tested) <= len(self.pairs) <= 1.25 * len(self.tested):
            self.tested, self.fits = pd.Index(np.fromiter(self.pairs, np.int64, len(self.pairs))), np.fromiter(self.pairs.values(), bool, len(self.pairs))
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        # In front of each unit is an entry for its empty prefix, a sign that no piece has.
        begins = np.cumsum(sizes) - sizes + np.arange(len(units))
        at = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(units) + 1), sizes)
        signs = np.zeros(len(at) + len(units) + 1, dtype=np.int64)
        signs[at] = state = self.sign[np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)]
        lengths = np.arange(len(signs) - 1) - np.repeat(begins, sizes + 1)
        # Every piece in the units: where it ends, how long it is and its token.
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in count(1):
            tokens = self.tokens[state]
            some = tokens > 0
            found.append((at[some], np.full(np.count_nonzero(some), n), tokens[some]))
            edge = self.edges.get_indexer(state * self.width + signs[at + 1])
            on = edge >= 0
            if not on.any():
                break
            at, state = at[on] + 1, self.targets[edge[on]]
        ends, long, tokens = map(np.concatenate, zip(*found, strict=True))
        prefix = lengths[ends].astype(np.uint8)
        order = np.argsort(prefix, kind="stable")
        ends, long, tokens = ends[order], long[order], tokens[order]
        last, back = np.zeros(len(signs) - 1, dtype=np.int64), np.ones(len(signs) - 1, dtype=np.int64)
        steps = np.cumsum(np.bincount(prefix))
        for lo, hi in zip(steps[:-1], steps[1:], strict=True):
            end, n, token = ends[lo:hi], long[lo:hi], tokens[lo:hi]
            fits = self.all_together(last[end - n], token)
            last[end[fits]], back[end[fits]] = token[fits], n[fits]
        used = np.zeros(len(last), dtype=bool)
        at = begins + sizes
        while len(at):
            used[at] = True
            at = at - back[at]
            at = at[lengths[at] > 0]
        return last[used], np.add.reduceat(used, begins, dtype=np.int64)

    def learn(self, units: list[str], number: int, plain: bool = False) -> None:
        """Store the ids of units that are not known yet, from this number on."""
        if plain and len(units) >= FEW:
            parts = [self.ids_together(units[i : i + SIDE_BY_SIDE]) for i in range(0, len(units), SIDE_BY_SIDE)]
        else:
            parts = [(ids := self.ids_of(unit), [len(ids)]) for unit in units]
        if not parts:
            return
        flat, counts = (np.concatenate([np.asarray(x, dtype=np.int64) for x in part]) for part in zip(*parts, strict=True))
        n, total = number, len(flat)
        while n + len(units) > len(self.starts):
            self.starts, self.counts = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.counts, 2 * len(self.counts))
        while self.used + total > len(self.store):
            self.store = np.resize(self.store, 2 * len(self.store))
        self.store[self.used : self.used + total] = flat
        self.starts[n : n + len(units)] = self.used + np.cumsum(counts) - counts
        self.counts[n : n + len(units)] = counts
        self.used += total

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text]))[0]

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array without nulls."""
        if not len(texts):
            return []
        if len(self.known) > REMEMBERED:
            self.forget()
        if not self.columnar:
            return list(map(self.encode_odd, texts.to_pylist()))
        odd = np.flatnonzero(pc.match_substring_regex(texts, f"^$|^ |  |{BLANK}|{SEPARATOR}").to_numpy(zero_copy_only=False))
        cut = pc.replace_substring(pc.replace_substring(texts, " ", SEPARATOR + BLANK), "\n", f"{SEPARATOR}\n{SEPARATOR}")
        cut = pc.split_pattern(pc.replace_substring_regex(cut, f"([\\pL\\p{{Nd}}])([{POINTS}])", f"\\1{SEPARATOR}\\2"), SEPARATOR)
        offsets = cut.offsets.to_numpy().astype(np.int64)
        values = cut.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets -= offsets[0]
        # The blank in front of each text belongs to its first unit.
        firsts = pc.binary_join_element_wise(BLANK, values.take(pa.array(offsets[:-1])), "").to_numpy(zero_copy_only=False)
        coded = values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        at, opening = self.numbers([words, firsts])
        at = at[coded.indices.to_numpy()]
        at[offsets[:-1]] = opening
        ids, ends = self.gathered(at)
        ends = ends[offsets]
        out = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in odd:
            out[i] = self.encode_odd(texts[int(i)].as_py())
        return out

    def encode_odd(self, text: str) -> np.ndarray:
        """The ids of a text whose blanks may stand together, or that is empty."""
        units = self.unit.findall(BLANK + text.replace(" ", BLANK)) if text else []
        return self.gathered(self.numbers([units])[0])[0]

    def numbers(self, lists: list[Sequence[str]]) -> list[np.ndarray]:
        """Where the ids of units are stored. Those of long units are overwritten by what is learned next."""
        known = self.known
        found = [list(map(known.get, units)) for units in lists]
        missing = [[i for i, n in enumerate(at) if n is None] for at in found]
        new = {units[i] for units, places in zip(lists, missing, strict=True) for i in places}
        if not new:
            return [np.array(at, dtype=np.int64) for at in found]
        plain, odd, long = [], [], []
        for u in new:
            (plain if self.plain(u) else odd if len(u) <= LONG_UNIT else long).append(u)
        for short in (plain, odd):
            self.learn(short, len(known), short is plain)
            known.update(zip(short, range(len(known), len(known) + len(short)), strict=True))
        used, once = self.used, dict(zip(long, range(len(known), len(known) + len(long)), strict=True))
        self.learn(long, len(known))
        self.used = used
        for units, at, places in zip(lists, found, missing, strict=True):
            for i in places:
                at[i] = once[u] if (n := known.get(u := units[i])) is None else n
        return [np.array(at, dtype=np.int64) for at in found]

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of stored units one after the other, and where those of each begin and the last ones end."""
        counts = self.counts[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.store[np.repeat(self.starts[at] - ends[:-1], counts) + np.arange(ends[-1])], ends


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids", end_id: int | None = 2) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, exactly those of the sentencepiece library, with end_id behind them unless it is None.

    A null text is an empty one: the end id alone. Rows are encoded one by one, repeated ones and null ids too; an empty
    table gives no row. Other columns are ignored, whatever their names.
    """
    keep = f"pieces of {model_path}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_state(keep, lambda: Pieces(model_path))
        end = np.array([] if end_id is None else [end_id], dtype=np.int32)
        for batch in batches:
            found = pieces.encode_all(batch.column(1))
            offsets = np.cumsum([0, *(len(x) + len(end) for x in found)]).astype(np.int32)
            ids = np.concatenate([x for part in found for x in (part, end)]) if found else end[:0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))], names=["doc_id", ids_col])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(releasing(run, keep), f"doc_id long, `{ids_col}` array<int>")


def lists_of(column: pa.ListArray) -> list[list[int] | None]:
    """to_pylist of lists of numbers, without an object of Arrow's for each number on the way."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
    return [values[a:b].tolist() if there else None for a, b, there in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist(), strict=True)]


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """encoded with the text of its ids in a column of its own, by the library's decode; a null list is null, an empty one empty.

    The input keeps its other columns; a column with the name of the new one is an error.
    """
    free_of(encoded, text_col)
    # The state of the encoder, so that a worker that serves both in turn forgets nothing.
    keep = f"pieces of {model_path}"
    ids_at = encoded.columns.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + f", `{text_col}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_state(keep, lambda: Pieces(model_path)).model
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(lo, TOGETHER)
                texts = [None if x is None else model.decode(x) if x else "" for x in lists_of(part.column(ids_at))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text_col])

    return encoded.mapInArrow(releasing(run, keep), schema)

"""Token counts at every prefix of a text, by dynamic programming over the pieces that end there.

The vocabulary is a sentencepiece model of type BPE. The tokens of a prefix are those of a shorter
prefix and one last piece: of all pieces that end at a position, exactly one stands next to the last
piece before it as the merges would leave them (`PieceTable.adjacent`). So one pass gives the exact
number of tokens of every prefix, and truncation and budget questions need no further encoding.

No piece holds certain pairs of neighbouring characters (a space after a letter, for instance), so a
text falls apart at such pairs and equal stretches are counted once. `Counts` keeps the count before
each stretch and the prefix counts inside it.

Rows and edge cases: a NULL text counts as empty, which has no tokens; special strings inside a text
are ordinary text; repeated rows give repeated results; a NULL id stays NULL; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate
from operator import itemgetter

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Prefixes of stretches and pairs of pieces kept by a worker, and the longest stretch kept.
KEPT_PREFIXES, KEPT_PAIRS, KEPT_LENGTH = 400_000, 400_000, 64
#: Characters whose counts are made in one go.
WINDOW = 1 << 16


def _letter(char: str) -> bool:
    return regex.match(r"\p{L}", char) is not None


class PieceTable:
    """Pieces, merge order and separable neighbours of one model."""

    def __init__(self, model: bytes) -> None:
        loaded = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = [i for i in range(loaded.vocab_size()) if not (loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_byte(i))]
        self.order = {loaded.id_to_piece(i): -loaded.get_score(i) for i in ids}
        self.longest = max(map(len, self.order))
        self.inside = {p[i : i + 2] for p in self.order for i in range(len(p) - 1)}
        self.after_space = not any(pair[0] != SPACE and pair[1] == SPACE for pair in self.inside)
        self.by_kind = not any(SPACE not in pair and _letter(pair[0]) != _letter(pair[1]) for pair in self.inside)
        self._pairs: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.order.get(a + b, float("inf")) for a, b in zip(parts, parts[1:])]
            best = min(scores)
            if best == float("inf"):
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, piece: str) -> bool:
        """Merging the characters of the piece gives the piece."""
        found = self._whole.get(piece)
        if found is None:
            found = self._whole[piece] = len(piece) == 1 or self.merged(piece) == [piece]
        return found

    def adjacent(self, left: str, right: str) -> bool:
        """Merging leaves the two pieces side by side, so no text around them joins them."""
        if left[-1] + right[0] not in self.inside:
            return True
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            found = self._pairs[left, right] = self.merged(left + right) == [left, right]
        return found

    def cost(self, piece: str) -> int:
        """Tokens of a piece: one, or one for each byte of a character that the model does not have."""
        return 1 if piece in self.order else len(piece.encode())

    def last_piece(self, text: str, end: int, before: Callable[[int], str]) -> str:
        """The last piece of text[:end]; `before` gives the last piece of each shorter prefix."""
        order, longest = self.order, self.longest
        for start in range(end - longest if end > longest else 0, end):
            piece = text[start:end]
            if piece not in order and start < end - 1 or not self.stands(piece):
                continue
            if start == 0 or self.adjacent(before(start), piece):
                return piece
        raise AssertionError("some piece ends at every position")

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of text[:1], text[:2], ... for a text with its spaces already replaced."""
        counts, last = [0], [""]
        for end in range(1, len(text) + 1):
            piece = self.last_piece(text, end, last.__getitem__)
            counts.append(counts[end - len(piece)] + self.cost(piece))
            last.append(piece)
        return counts[1:]


class _Prefixes(dict):
    """(token count, last piece) of stretches and of all their prefixes.

    Stretches with equal beginnings share entries. Two generations are kept: what was not asked for
    since the table was last full is dropped.
    """

    def __init__(self, table: PieceTable) -> None:
        self.table = table
        self.older: dict[str, tuple[int, str]] = {}

    def __missing__(self, stretch: str) -> tuple[int, str]:
        found = self.older.get(stretch)
        if found is None:
            if len(stretch) > KEPT_LENGTH:
                return self.table.prefix_counts(stretch)[-1], ""
            piece = self.table.last_piece(stretch, len(stretch), lambda start: self[stretch[:start]][1])
            rest = len(stretch) - len(piece)
            found = (self[stretch[:rest]][0] if rest else 0) + self.table.cost(piece), piece
        if len(self) >= KEPT_PREFIXES:
            self.older = dict(self)
            self.clear()
        self[stretch] = found
        return found

    def counts(self, stretch: str) -> list[int]:
        if len(stretch) > KEPT_LENGTH:
            return self.table.prefix_counts(stretch)
        return [self[stretch[:end]][0] for end in range(1, len(stretch) + 1)]


class _Stretches:
    """The stretches of a text by the characters before each."""

    def __init__(self, text: str, chars: list[int]) -> None:
        self.text, self.chars = SPACE + text.replace(" ", SPACE), chars

    def __len__(self) -> int:
        return len(self.chars) - 1

    def __getitem__(self, k: int) -> str:
        return self.text[self.chars[k] : self.chars[k + 1]]


class Counts:
    """Token counts of every prefix of one text: those before each stretch, and shared ones inside."""

    def __init__(self, stretches: list[str], prefixes: _Prefixes) -> None:
        self.stretches, self.prefixes = stretches, prefixes
        self.chars = list(accumulate(map(len, stretches), initial=0))
        self.tokens = list(accumulate((prefixes[s][0] for s in stretches), initial=0))

    @classmethod
    def stored(cls, text: str, chars: list[int], tokens: list[int], prefixes: _Prefixes) -> Counts:
        """Counts made earlier: a stretch is cut from the text, and counted inside, only when it is asked for."""
        counts = cls.__new__(cls)
        counts.stretches, counts.prefixes, counts.chars, counts.tokens = _Stretches(text, chars), prefixes, chars, tokens
        return counts

    @property
    def total(self) -> int:
        return self.tokens[-1]

    def at(self, length: int) -> int:
        """Tokens of the first `length` characters."""
        if length <= 0 or not self.stretches:
            return 0
        position = min(length + 1, self.chars[-1])  # a space stands before the text
        k = bisect_right(self.chars, position - 1) - 1
        return self.tokens[k] + self.prefixes.counts(self.stretches[k])[position - self.chars[k] - 1]

    def fitting(self, budget: int) -> int:
        """The most characters whose prefix has at most `budget` tokens.

        Inside a stretch a longer prefix can have fewer tokens, but it has at least one.
        """
        for k in range(bisect_right(self.tokens, budget - 1, hi=len(self.stretches)) - 1, -1, -1):
            inner = self.prefixes.counts(self.stretches[k])
            for i in range(len(inner) - 1, -1, -1):
                if self.tokens[k] + inner[i] <= budget:
                    return self.chars[k] + i
        return 0


class Counter:
    """Prefix counts of texts."""

    def __init__(self, model: bytes) -> None:
        self.table = PieceTable(model)
        if not self.table.after_space:
            raise ValueError("the model has pieces with a space inside")
        self.prefixes = _Prefixes(self.table)
        if self.table.by_kind:  # no piece holds a letter next to another mark
            pattern = rf"{SPACE}*\p{{L}}+|{SPACE}*[^\p{{L}}{SPACE}]+|{SPACE}+"
        else:
            pattern = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        self._cut = regex.compile(f"[^{SPACE}]{SPACE}")
        self._split = regex.compile(pattern).findall

    def _parts(self, text: str) -> Iterator[list[str]]:
        """Stretches, window by window; windows end before a space that follows another character."""
        text, start = SPACE + text.replace(" ", SPACE), 0
        while start < len(text):
            stop = start + WINDOW
            if stop < len(text):
                cut = self._cut.search(text, stop)
                stop = cut.start() + 1 if cut else len(text)
            yield self._split(text[start:stop])
            start = stop

    def counts(self, text: str) -> Counts:
        """The counts of every prefix of a text."""
        return Counts([s for part in self._parts(text) for s in part] if text else [], self.prefixes)

    def total(self, text: str) -> int:
        """The count at the last prefix, without keeping those before it."""
        lookup, count = self.prefixes.__getitem__, itemgetter(0)
        return sum(sum(map(count, map(lookup, part))) for part in self._parts(text)) if text else 0


_LOADED: dict[str, Counter] = {}


def _loaded(model: bytes) -> Counter:
    key = hashlib.sha256(model).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Counter(model)
    return _LOADED[key]


def count_documents(docs: DataFrame, model: str, budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", store: bool = False) -> DataFrame:
    """(id, n_bytes, n_tokens [, fitting_chars, fitting_tokens] [, prefix_chars, prefix_tokens]) for every row.

    `model` is a path on the driver; the file's bytes are broadcast (a vocabulary has a fixed size).
    With a `budget`, `fitting_chars` is the length of the longest prefix that has no more tokens, and
    `fitting_tokens` its count, both read off the prefix counts, which are made once. With `store` these
    are returned as well, per stretch; `stored_budget` answers any other budget from them.
    """
    with open(model, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _loaded(content.value)
        for batch in batches:
            sizes, totals, chars, tokens, before = [], [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                sizes.append(len(text.encode()))
                if budget is None and not store:
                    totals.append(counter.total(text))
                    continue
                counts = counter.counts(text)
                totals.append(counts.total)
                if budget is not None:
                    chars.append(len(text) if counts.total <= budget else counts.fitting(budget))
                    tokens.append(counts.total if counts.total <= budget else counts.at(chars[-1]))
                if store:
                    before.append((counts.chars, counts.tokens))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())]
            names = ["id", "n_bytes", "n_tokens"]
            if budget is not None:
                columns += [pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())]
                names += ["fitting_chars", "fitting_tokens"]
            if store:
                columns += [pa.array([b[i] for b in before], pa.list_(pa.int64())) for i in (0, 1)]
                names += ["prefix_chars", "prefix_tokens"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "id long, n_bytes long, n_tokens long" + ", fitting_chars long, fitting_tokens long" * (budget is not None)
    schema += ", prefix_chars array<long>, prefix_tokens array<long>" * store
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(per_batch, schema)


def stored_budget(counted: DataFrame, model: str, budget: int, text_col: str = "text") -> DataFrame:
    """(id, fitting_chars, fitting_tokens) from stored counts (id, prefix_chars, prefix_tokens) beside their texts.

    Texts are not counted again; inside the stretches where the budget runs out, counts are made on demand.
    """
    with open(model, "rb") as file:
        content = counted.sparkSession.sparkContext.broadcast(file.read())

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = _loaded(content.value).prefixes
        for batch in batches:
            chars, tokens = [], []
            for value, before, held in zip(batch.column(1), batch.column(2), batch.column(3)):
                text = value.as_py() or ""
                counts = Counts.stored(text, before.as_py(), held.as_py(), prefixes)
                chars.append(len(text) if counts.total <= budget else counts.fitting(budget))
                tokens.append(counts.total if counts.total <= budget else counts.at(chars[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())], names=["id", "fitting_chars", "fitting_tokens"])

    narrow = counted.select("id", F.col(text_col).alias("text"), "prefix_chars", "prefix_tokens")
    return narrow.mapInArrow(per_batch, "id long, fitting_chars long, fitting_tokens long")

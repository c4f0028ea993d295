"""Byte-pair encoding as a bounded-lookahead streaming transducer, and decoding as a state machine.

The vocabulary is a `tokenizers` JSON file whose model lower-cases text, drops white space and ends
words with a suffix. Its merge list fixes how many bytes beyond a position can still change the tokens
before it (`MergeTable.lookahead`); the encoder holds back that much and emits everything older, so a
text of any length, and a single word of any length, is encoded in constant memory.

Rows and edge cases: a NULL text counts as empty and gives no tokens; special strings inside a text
give their special id; repeated rows give repeated results; a NULL id stays NULL; an empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters fed to the transducer at once; longest word kept in the cache, and words kept.
WINDOW, CACHED_WORD, CACHED_WORDS = 1 << 16, 64, 300_000
#: A pair of ids as one number; the rank of pairs that no rule merges.
_SHIFT, _NEVER = 20, 1 << 62
#: The vocabulary's pre-tokenizer: contractions, runs of letters, single digits, runs of other marks.
#: Code points that Unicode assigned after version 16 may be classed otherwise than by the library.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_RUNS = (regex.compile(r"\p{L}+"), regex.compile(r"[^\p{White_Space}\p{L}\p{N}]+"))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in shown:
            shown[b] = chr(0x100 + len(shown) - len(plain))
    return [shown[b] for b in range(256)]


class MergeTable:
    """Ids, ranks and lookahead of one vocabulary."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.final = [vocab[c + self.suffix] for c in alphabet]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.surface = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.surface[i] = token
        self.to_byte = {c: b for b, c in enumerate(alphabet)}
        self.rules = []
        for left, right in model["merges"]:
            self.rules.append((vocab[left], vocab[right], vocab[left + right]))
        self.rank = {a << _SHIFT | b: r << _SHIFT | new for r, (a, b, new) in enumerate(self.rules)}

    def size(self, token: int) -> int:
        """Bytes that a token of the merge list stands for."""
        return len(self.surface[token].removesuffix(self.suffix))

    def lookahead(self) -> int:
        """Bytes after a position that can still change the tokens before it.

        A merge is prevented from the right only if a token on the right edge of its right part is
        taken by an earlier rule, which itself can only be prevented by a still earlier one. Ranks
        fall along such a chain, so its reach is found in one pass in the order of the ranks. A
        position is settled once the longest token and the longest chain after it are known.
        """
        made: dict[int, list[tuple[int, int]]] = {}  # token: (rank, right part) of rules that make it
        ranks: dict[int, list[int]] = {}  # left part: ranks of its rules
        reach: dict[int, list[int]] = {}  # and the farthest reach up to each
        longest = 0
        for rank, (left, right, new) in enumerate(self.rules):
            far, edge, seen = 0, [(right, rank)], set()
            while edge:
                token, taken = edge.pop()
                if (token, taken) in seen:
                    continue
                seen.add((token, taken))
                if at := bisect_left(ranks.get(token, ()), taken):
                    far = max(far, reach[token][at - 1])
                edge += [(part, r) for r, part in made.get(token, ())]
            made.setdefault(new, []).append((rank, right))
            best = max(self.size(right) + far, *reach.get(left, [0])[-1:])
            ranks.setdefault(left, []).append(rank)
            reach.setdefault(left, []).append(best)
            longest = max(longest, far)
        return longest + max(self.size(new) for _, _, new in self.rules)


def merge(ids: list[int], rank: dict[int, int]) -> list[int]:
    """Apply the merge list to the symbols of one word, lowest rank first, then leftmost."""
    if len(ids) < 40:
        find = rank.get
        pairs = [find(a << _SHIFT | b, _NEVER) for a, b in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != _NEVER:
            at, new = pairs.index(best), best & (1 << _SHIFT) - 1
            ids[at : at + 2] = [new]
            del pairs[at]  # only the pairs on both sides are others now
            if at:
                pairs[at - 1] = find(ids[at - 1] << _SHIFT | new, _NEVER)
            if at < len(pairs):
                pairs[at] = find(new << _SHIFT | ids[at + 1], _NEVER)
        return ids
    after, before, alive = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), [True] * len(ids)
    heap = [(rank[p], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (p := a << _SHIFT | b) in rank]
    heapq.heapify(heap)
    while heap:
        rule, i = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= len(ids) or rank.get(ids[i] << _SHIFT | ids[j]) != rule:
            continue
        ids[i], alive[j] = rule & (1 << _SHIFT) - 1, False
        after[i] = k = after[j]
        if k < len(ids):
            before[k] = i
            if (p := ids[i] << _SHIFT | ids[k]) in rank:
                heapq.heappush(heap, (rank[p], i))
        h = before[i]
        if h >= 0 and (p := ids[h] << _SHIFT | ids[i]) in rank:
            heapq.heappush(heap, (rank[p], h))
    return [t for t, keep in zip(ids, alive) if keep]


class WordTransducer:
    """Tokens of one word whose bytes arrive piece by piece."""

    def __init__(self, table: MergeTable, lookahead: int, step: int = 4096) -> None:
        self.table, self.lookahead, self.step = table, lookahead, step
        self.held = b""

    def feed(self, piece: bytes) -> list[int]:
        """Tokens that no later byte can change."""
        self.held += piece
        out: list[int] = []
        while len(self.held) >= self.lookahead + self.step:
            window = self.held[: self.lookahead + self.step]
            settled = 0
            for token in merge([self.table.inner[b] for b in window[:-1]], self.table.rank):
                end = settled + self.table.size(token)
                if end + self.lookahead > len(window) - 1:
                    break
                out.append(token)
                settled = end
            self.held = self.held[settled:]
        return out

    def finish(self) -> list[int]:
        """The rest, once the word has ended."""
        held, self.held = self.held, b""
        if not held:
            return []
        return merge([*(self.table.inner[b] for b in held[:-1]), self.table.final[held[-1]]], self.table.rank)


class _Words(dict):
    """Token ids of short words as little-endian bytes; emptied when full."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= CACHED_WORD:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Text to token ids, window by window."""

    def __init__(self, table: MergeTable) -> None:
        self.table, self.lookahead = table, table.lookahead()
        self.words = _Words(self._word)
        self.specials = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None

    def _word(self, word: str) -> bytes:
        transducer = WordTransducer(self.table, self.lookahead)
        return _packed(transducer.feed(word.encode()) + transducer.finish())

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids, little by little, in order."""
        at = 0
        if self.specials and "<" in text:
            for found in self.specials.finditer(text):
                yield from self._plain(text, at, found.start())
                yield _packed([self.table.special[found.group()]])
                at = found.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, start: int, end: int) -> Iterator[bytes]:
        lookup = self.words.__getitem__
        carry, run, word = "", None, None  # unread text; the kind of run and the transducer of an open word
        while start < end:
            stop = _safe_cut(text, start, end)
            part = carry + normalise(text[start:stop])
            carry, start, last = "", stop, stop >= end
            if word is not None:  # an open word goes on as long as its kind of character does
                more = run.match(part)
                cut = more.end() if more else 0
                yield _packed(word.feed(part[:cut].encode()))
                if cut == len(part) and not last:
                    continue
                yield _packed(word.finish())
                part, word = part[cut:], None
            found = _WORDS.findall(part)
            if found and not last and part.endswith(found[-1]):
                tail = found.pop()
                if len(tail) == 1 and found and found[-1] == "'":  # the next letter may complete a contraction
                    tail = found.pop() + tail
                kind = next((r for r in _RUNS if r.fullmatch(tail)), None)
                if kind is None or tail.startswith("'") and len(tail) < 3 or len(tail) <= CACHED_WORD:
                    carry = tail
                else:
                    run, word = kind, WordTransducer(self.table, self.lookahead)
                    yield _packed(word.feed(tail.encode()))
            yield b"".join(map(lookup, found))
        if word is not None:
            yield _packed(word.finish())


def normalise(text: str) -> str:
    """Composed and lower-cased character by character; white space needs no change, it is dropped."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _safe_cut(text: str, start: int, end: int) -> int:
    """Where a window may stop: before white space, else before a character that composes with none."""
    stop = start + WINDOW
    if stop >= end:
        return end
    blank = max(text.rfind(" ", start + 1, stop), text.rfind("\n", start + 1, stop))
    if blank > 0:
        return blank
    while stop < end and text[stop] >= "̀" and not _stands_alone(text[stop]):
        stop += 1
    return stop


def _stands_alone(char: str) -> bool:
    return unicodedata.category(char)[0] in "LNPSZ" and not "ᅠ" <= char <= "ᇿ"


class Decoder:
    """Token ids to text, as a state machine over bytes.

    `spaced` gives what the vocabulary file's own decoding gives: the tokens as they are written in
    the vocabulary, a space between them. Otherwise byte characters become bytes again and each word
    end a space. Bytes enter an incremental UTF-8 decoder, whose state is at most three bytes.
    """

    def __init__(self, table: MergeTable, spaced: bool = False) -> None:
        self.spaced, self.begun = spaced, False
        if spaced:
            self.units = [s.encode() for s in table.surface]
        else:
            self.units = [self._text_bytes(table, s) for s in table.surface]
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    @staticmethod
    def _text_bytes(table: MergeTable, surface: str) -> bytes:
        if surface in table.special:
            return surface.encode()
        body = surface.removesuffix(table.suffix)
        return bytes(table.to_byte[c] for c in body) + b" " * (body != surface)

    def feed(self, packed: bytes) -> str:
        units = map(self.units.__getitem__, struct.unpack(f"<{len(packed) // 4}I", packed))
        joined = (b" " if self.spaced else b"").join(units)
        if self.spaced and packed:
            joined = b" " * self.begun + joined
            self.begun = True
        return self.state.decode(joined)

    def finish(self) -> str:
        self.begun = False
        rest = self.state.decode(b"", final=True)
        self.state.reset()
        return rest


_LOADED: dict[str, tuple[Encoder, Decoder, Decoder]] = {}


def _loaded(content: bytes) -> tuple[Encoder, Decoder, Decoder]:
    key = hashlib.sha256(content).hexdigest()
    if key not in _LOADED:
        table = MergeTable(content)
        _LOADED[key] = Encoder(table), Decoder(table, spaced=True), Decoder(table)
    return _LOADED[key]


#: Token ids gathered before a batch of results is handed on.
_BATCH_IDS = 1 << 21


def encode_documents(
    docs: DataFrame, vocabulary: str, with_ids: bool = True, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256 [, ids] [, decoded]) for every row.

    `vocabulary` is a path on the driver; the file's bytes are broadcast (a vocabulary has a fixed
    size). `ids` is the array of token ids, `decoded` the text that the ids stand for, words separated
    by spaces; the digests are of the little-endian ids and of the spaced vocabulary tokens.
    """
    with open(vocabulary, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def result(rows: list[tuple]) -> pa.RecordBatch:
        ids, counts, id_digests, text_digests, packed, texts = zip(*rows)
        columns = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.frombuffer(b"".join(packed), dtype="<i4")
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            names.append("ids")
        if with_text:
            columns.append(pa.array(texts, pa.string()))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(columns, names=names)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spaced, plain = _loaded(content.value)
        for batch in batches:
            rows, gathered = [], 0
            for row_id, text in zip(batch.column(0), batch.column(1)):
                id_digest, text_digest, count, packed, texts = hashlib.sha256(), hashlib.sha256(), 0, [], []
                for piece in encoder.encode(text.as_py() or ""):
                    id_digest.update(piece)
                    text_digest.update(spaced.feed(piece).encode())
                    count += len(piece) // 4
                    if with_ids:
                        packed.append(piece)
                    if with_text:
                        texts.append(plain.feed(piece))
                text_digest.update(spaced.finish().encode())
                if with_text:
                    texts.append(plain.finish())
                rows.append((row_id.as_py(), count, id_digest.hexdigest(), text_digest.hexdigest(), b"".join(packed), "".join(texts)))
                gathered += count
                if gathered >= _BATCH_IDS:
                    yield result(rows)
                    rows, gathered = [], 0
            if rows:
                yield result(rows)

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(per_batch, schema)

"""Byte-level BPE by ranks, by dynamic programming over byte prefixes.

A text is cut into the matches of the published pattern, and a match that is a
token itself is that token. For any other match each prefix has exactly one *last
token*: the one that ends there, fits behind the last token of the prefix before
it, and is what its own bytes are encoded as. Two tokens fit when the merges of
their joint bytes end in just these two. So one number per byte holds the encodings
of all prefixes, and walking back from the end gives the ids, in linear memory.

The table of last tokens can be kept (``PrefixTable``): appended bytes only add
entries, and after an edit the entries are made again from the edit on until they
agree with the old ones over the length of the longest token, from where on
nothing can differ.

Texts are split at single blanks by Arrow, and only distinct parts are encoded;
what a task remembers is bounded in bytes and dropped when the task ends.

Defined cases: null text is empty text and has no tokens; null ids and repeated
rows are encoded like any other; very long texts and words take memory in
proportion to their length; ids that are no rank decode to an error; an empty
table gives an empty one; other columns are not read, or carried along by
``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from martloom.llm.common import slim_batches, tidied

CACHE_BYTES = 48 << 20  # of remembered parts, about
PAIRS = 1 << 19  # remembered pairs of tokens
_NEVER = 1 << 60
_START = -1  # stands before the first token


class RankEncoder:
    """Encoder and decoder for a file of ranks: a token in base64 and its rank a line."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as file:
            for line in file:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, self.ranks))
        self.bits = max(self.tokens).bit_length()
        self.sizes = [len(self.tokens.get(rank, b"")) for rank in range(max(self.tokens) + 1)]
        self._begun = ahocorasick.Automaton()  # a trie of all tokens
        for token, rank in self.ranks.items():
            self._begun.add_word(token.decode("latin-1"), rank)
        self._reset()
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._growth: dict[tuple[int, bool], list[tuple[bytes, int]]] = {}
        self._fits: dict[int, bool] = {}
        self._seen: dict[str, bytes] = {}
        self._seen_bytes = 0

    def forget(self) -> None:
        """Drop what was remembered of texts; the tables of the vocabulary stay."""
        self._fits, self._seen, self._seen_bytes = {}, {}, 0
        self._reset()

    def _reset(self) -> None:
        """No states but the first: the longest ends of texts that begin a token, the tokens that end there, the moves between them."""
        self._states, self._texts, self._ending, self._moves = {"": 0}, [""], [()], {}

    # ---- which tokens may stand side by side ---------------------------------

    def parts(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for a token that merges never make."""
        if rank not in self._parts:
            raw = self.tokens[rank]
            pieces = [raw[i : i + 1] for i in range(len(raw))]
            while len(pieces) > 2:
                made = [self.ranks.get(a + b, _NEVER) for a, b in zip(pieces, pieces[1:], strict=False)]
                lowest = min(made)
                if lowest >= rank:
                    break
                at = made.index(lowest)
                pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
            self._parts[rank] = (self.ranks[pieces[0]], self.ranks[pieces[1]]) if len(pieces) == 2 else None
        return self._parts[rank]

    def whole(self, rank: int) -> bool:
        """True if the merges make this token of its bytes."""
        return len(self.tokens[rank]) == 1 or self.parts(rank) is not None

    def growth(self, rank: int, right_end: bool) -> list[tuple[bytes, int]]:
        """What stands at one end of a token while it is built: the bytes, and the rank of the merge that takes them up."""
        known = self._growth.get((rank, right_end))
        if known is None:
            known = [(self.tokens[rank], _NEVER)]
            at = rank
            while (halves := self.parts(at)) is not None:
                until, at = at, halves[right_end]
                known.append((self.tokens[at], until))
            known.reverse()
            self._growth[rank, right_end] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """True if the two tokens stay as they are when their bytes are encoded together.

        Merges run in the order of their ranks, the leftmost of equal ones first. So
        the piece at the border grows on the left or on the right, whichever has the
        lower rank, unless a merge across the border comes before.
        """
        if left == _START:
            return self.whole(right)
        if not self.whole(right):
            return False
        ends, starts = self.growth(left, True), self.growth(right, False)
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = ends[i], starts[j]
            across = self.ranks.get(a + b)
            if across is not None and across < until_a and across <= until_b:
                return False
            if until_a <= until_b:
                if until_a == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    # ---- prefixes --------------------------------------------------------------

    def _move(self, state: int, byte: int) -> int:
        """The state behind ``state`` and one more byte."""
        text = self._texts[state] + chr(byte)
        while not self._begun.match(text):
            text = text[1:]
        new = self._states.get(text)
        if new is None:
            new = self._states[text] = len(self._texts)
            self._texts.append(text)
            ranks = [self._begun.get(text[i:], None) for i in range(len(text))]
            self._ending.append(tuple((r, self.sizes[r]) for r in ranks if r is not None and self.whole(r)))
        self._moves[state << 8 | byte] = new
        return new

    def _bounded(self) -> None:
        if len(self._fits) > PAIRS:
            self._fits.clear()

    def extend(self, last: list[int] | array, raw: bytes, first: int, path: list[int], stop=None) -> None:
        """Add the last tokens of the prefixes longer than ``first``; ``last[n]`` belongs to the prefix of n bytes.

        ``path`` holds the states up to ``first`` (the last one is enough) and is added to. ``stop(n)`` may end the work early.
        """
        moves, ending, fits, bits = self._moves, self._ending, self._fits, self.bits
        state = path[-1]
        for end in range(first + 1, len(raw) + 1):
            key = state << 8 | raw[end - 1]
            state = moves[key] if key in moves else self._move(state, raw[end - 1])
            for token, size in ending[state]:
                before = last[end - size]
                key = before << bits | token
                fit = fits.get(key)
                if fit is None:
                    fit = fits[key] = self.fits(before, token)
                if fit:
                    break
            last.append(token)
            path.append(state)
            if stop is not None and stop(end):
                return

    def state_at(self, raw: bytes, size: int) -> int:
        """The state behind the first ``size`` bytes."""
        state = 0
        for byte in raw[max(0, size - self.longest) : size]:
            state = self._moves.get(state << 8 | byte) or self._move(state, byte)
        return state

    def walk_back(self, last: list[int] | array, end: int) -> list[int]:
        """The ids of the prefix of ``end`` bytes."""
        out, sizes = [], self.sizes
        while end:
            token = last[end]
            out.append(token)
            end -= sizes[token]
        out.reverse()
        return out

    def encode_matches(self, matches: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each match with its ids, little-endian in 32 bits.

        The matches are taken in the order of their bytes: what one has in common with
        the one before is a prefix whose table is kept, and the rest is appended to it.
        """
        last, path, before = [_START], [0], b""
        for raw, match in sorted([(m.encode(), m) for m in matches]):
            if raw in self.ranks:
                yield match, self.ranks[raw].to_bytes(4, "little")
                continue
            self._bounded()
            same, most = 0, min(len(raw), len(before))
            while same < most and raw[same] == before[same]:
                same += 1
            del last[same + 1 :], path[same + 1 :]
            self.extend(last, raw, same, path)
            before = raw
            yield match, array("I", self.walk_back(last, len(raw))).tobytes()

    # ---- texts -----------------------------------------------------------------

    def _learn(self, parts: list[str]) -> None:
        """Remember the ids of parts and of their matches; each distinct match is encoded once."""
        seen, findall = self._seen, self.pattern.findall
        # letters only, perhaps behind one blank, are one match
        mixed = {p: findall(p) for p in parts if not (p.isalpha() or p[:1] == " " and p[1:].isalpha())}
        wanted = {p for p in parts if p not in mixed}
        wanted.update(*mixed.values())
        for match, ids in self.encode_matches(wanted.difference(seen)):
            seen[match] = ids
            self._seen_bytes += 150 + 2 * len(match) + len(ids)
        for part, matches in mixed.items():
            ids = seen[part] = b"".join([seen[m] for m in matches])
            self._seen_bytes += 150 + 2 * len(part) + len(ids)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the place where each text's begin (and the end)."""
        parts, counts = _parts(texts)
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if self._seen_bytes > CACHE_BYTES:
            self._seen, self._seen_bytes = {}, 0
        if new := [p for p in distinct if p not in self._seen]:
            self._learn(new)
        ids = [self._seen[p] for p in distinct]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        pool, codes = np.frombuffer(b"".join(ids), dtype="<u4"), coded.indices.to_numpy()
        each = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = pool[np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], each) + np.arange(ends[-1])]
        return flat, ends[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of the ids."""
        return b"".join([self.tokens[i] for i in ids])


# The white space characters of the pattern.
_WHITE = "\t-\r \x85\xa0  -     　"
_part = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
# No match reaches from other characters into white space behind them, so a text may be cut there.
_BESIDE = f"[{_WHITE}] | [{_WHITE}]"


def _parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of all texts that can be matched alone, and their number per text.

    Where every blank stands alone, a text is cut before each blank; others are cut
    before each run of white space. The blank itself is put back in front.
    """
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _BESIDE).to_numpy(zero_copy_only=False)
    split = pc.split_pattern(texts, " ")
    counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
    words = split.flatten()
    first = np.zeros(len(words), dtype=bool)
    first[np.cumsum(counts) - counts] = True
    words = pc.binary_join_element_wise(pc.if_else(pa.array(first), "", " "), words, "")
    if not odd.any():
        return words, counts
    cut, at, pieces = np.concatenate([[0], np.cumsum(counts)]), 0, []
    for i in np.flatnonzero(odd):
        pieces.append(words[cut[at] : cut[i]])
        own = pa.array(_part.findall(texts[i].as_py()), pa.string())
        pieces.append(own)
        counts[i], at = len(own), i + 1
    pieces.append(words[cut[at] :])
    return pa.concat_arrays(pieces), counts


class PrefixTable:
    """The last token of every prefix of one match, kept for appending and editing."""

    def __init__(self, encoder: RankEncoder, raw: bytes = b""):
        self.encoder, self.raw, self.last = encoder, b"", array("i", [_START])
        self.append(raw)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; the entries so far stay."""
        size, self.raw = len(self.raw), self.raw + more
        self.encoder._bounded()
        self.encoder.extend(self.last, self.raw, size, [self.encoder.state_at(self.raw, size)])

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in the place of the bytes from ``start`` to ``end``; returns how many entries were made again."""
        old, moved = self.last, len(new) - (end - start)
        state = self.encoder.state_at(self.raw, start)
        self.raw = self.raw[:start] + new + self.raw[end:]
        self.last = old[: start + 1]
        same = 0

        def settled(at: int) -> bool:
            nonlocal same  # entries in a row that end in the untouched rest and are as before
            same = same + 1 if at > start + len(new) and self.last[at] == old[at - moved] else 0
            return same > self.encoder.longest

        self.encoder._bounded()
        self.encoder.extend(self.last, self.raw, start, [state], settled)
        made = len(self.last) - 1 - start
        self.last += old[len(self.last) - moved :]
        return made

    def ids(self, size: int | None = None) -> list[int]:
        """The ids of the first ``size`` bytes, of all by default."""
        size = len(self.raw) if size is None else size
        whole = self.encoder.ranks.get(self.raw[:size])
        return [whole] if whole is not None else self.encoder.walk_back(self.last, size)


_loaded: dict[str, RankEncoder] = {}


def encoder(path: str) -> RankEncoder:
    """One encoder per worker process and file."""
    if path not in _loaded:
        _loaded[path] = RankEncoder(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The documents with ``ids``: the tokens of the whole text as little-endian 32-bit integers."""
    schema = docs.drop("ids").schema.add("ids", "binary")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in slim_batches(rows):
                flat, ends = bpe.encode_texts(batch.column("text"))
                ids = pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
                yield pa.record_batch([*batch.columns, ids], names=[*batch.schema.names, "ids"])
        finally:
            bpe.forget()

    return docs.drop("ids").mapInArrow(tidied(run), schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``: the bytes of their ``ids``."""
    schema = tokens.drop("decoded").schema.add("decoded", "binary")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in rows:
            raw = [bpe.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "decoded"])

    return tokens.drop("decoded").mapInArrow(tidied(run), schema)


def rank_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids and of the bytes they decode to."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in slim_batches(rows):
                flat, ends = bpe.encode_texts(batch.column("text"))
                each = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                ids = [hashlib.sha256(x.tobytes()).hexdigest() for x in each]
                back = [hashlib.sha256(bpe.decode(x.tolist())).hexdigest() for x in each]
                yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=names)
        finally:
            bpe.forget()

    columns = docs.select("doc_id", "text")
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(tidied(run), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

"""Byte-level BPE over distinct words by a prefix-sharing trie.

A text is cut into pieces (a run of blanks and the word after it), pieces into
the pre-tokens of the published pattern. Only distinct pre-tokens are encoded:
they go into a trie, and a walk down it gives each node its *last token*: one
level after the other, all nodes of a level at once, or node by node for very long words.
The encoding of a prefix is the encoding of a shorter prefix plus one token, so
a node needs nothing but the states of the nodes above it, and words with a
common beginning share the work for it. A token fits behind another one when no
merge ever joins them at their border, which is decided from the ranks of the
merges that make up their facing sides.

Defined cases: null text is empty text; an empty text has no tokens; strings of
added tokens in a text become their single id, as in the library; null ids and
repeated rows are encoded like any other; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martloom.llm.common import slim_batches, tidied

# The published pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SLICE_BYTES = 3 << 20  # text encoded in one go
CACHE_BYTES = 48 << 20  # of pieces remembered by a task, about
PAIRS = 1 << 19  # pairs of tokens remembered by a task
DEEP = 32  # letters of a word up to which it is walked by level
WORDS = 1 << 15  # words walked at once
KEYS = 1 << 13  # missing values worked out at once
_NEVER = (1 << 31) - 1
_MARKS = ".,!?;:"  # never letters, numbers or part of a contraction


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in vocabulary files: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Slots:
    """Values of integer keys, looked up many at a time; a key whose place is taken by another one pushes it out."""

    def __init__(self, bits: int, make: Callable[[np.ndarray], np.ndarray]):
        self.make, self._shift = make, np.uint64(64 - bits)
        self._keys, self._values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        places = self._places(keys)
        out = self._values[places]
        missing = np.flatnonzero(self._keys[places] != keys)
        if len(missing):
            new, back = np.unique(keys[missing], return_inverse=True)
            made = np.concatenate([self.make(new[at : at + KEYS]) for at in range(0, len(new), KEYS)])
            out[missing] = made[back]
            places, one = np.unique(self._places(new), return_index=True)
            self._keys[places], self._values[places] = new[one], made[one]
        return out

    def clear(self) -> None:
        self._keys.fill(-1)


class TrieEncoder:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], _byte_letters()
        shown = {ord(c): b for c, b in letters.items()}
        as_bytes = lambda token: token.translate(shown).encode("latin-1")
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.added.values()]) + 1
        self.token = [b""] * size
        for token, i in self.ids.items():
            self.token[i] = token
        for text, i in self.added.items():
            self.token[i] = text.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            one, two = pair if isinstance(pair, list) else pair.split(" ")
            left, right, made = model["vocab"][one], model["vocab"][two], model["vocab"][one + two]
            self.rank[left, right] = rank
            self.halves.setdefault(made, (left, right, rank))
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self._begins = {t[:n] for t in self.ids for n in range(len(t) + 1)}
        self._states, self._texts, self._ends, self._next = {b"": 0}, [b""], [[]], {}
        self._packed = [i.to_bytes(4, "little") for i in range(size)]
        self._sides: dict[int, tuple] = {}
        self._fits: dict[int, bool] = {}
        self._wholes: dict[int, bool] = {}
        self._width = np.array([len(t) for t in self.token])
        # per state the place of its first end; per end its token, length, and whether it is the state's last
        self._first, self._end_token, self._end_length, self._end_last = (np.zeros(0, dtype=np.int64) for _ in range(4))
        borders = np.array([a << 20 | b for a, b in self.rank], dtype=np.int64)
        order = np.argsort(borders)
        self._merges = borders[order], np.fromiter(self.rank.values(), dtype=np.int64, count=len(borders))[order]
        self._chains = [self._chain(half) for half in (1, 0)]
        self._moves, self._apart = _Slots(18, self._step_all), _Slots(19, self._apart_all)
        self.forget()
        self.pattern = regex.compile(PATTERN)
        self.marks = {text[0] for text in self.added}  # what added tokens begin with
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def forget(self) -> None:
        """Drop what was remembered of texts; the tables of the vocabulary stay."""
        self._fits.clear()
        self._apart.clear()
        self._forget_pieces()

    def _forget_pieces(self) -> None:
        self._seen: dict[str, bytes] = {text: self._packed[i] for text, i in self.added.items()}
        self._seen_bytes = 0

    def _step(self, state: int, byte: int) -> int:
        """The state behind ``state`` and one more byte: the longest end of both that begins a token."""
        text = self._texts[state] + bytes([byte])
        while text not in self._begins:
            text = text[1:]
        if text not in self._states:
            self._states[text] = len(self._texts)
            self._texts.append(text)
            ends = [(self.ids[text[i:]], len(text) - i) for i in range(len(text)) if text[i:] in self.ids]
            self._ends.append([x for x in ends if self._whole(x[0])])
        self._next[state << 8 | byte] = self._states[text]
        return self._states[text]

    def _step_all(self, keys: np.ndarray) -> np.ndarray:
        """The next states of keys of state and byte."""
        steps = self._next
        return np.array([steps[k] if k in steps else self._step(k >> 8, k & 255) for k in keys.tolist()], dtype=np.int32)

    def _chain(self, half: int) -> tuple[np.ndarray, ...]:
        """``_side`` of every token, at the left (0) or right (1) end: place and number of its pieces; the pieces, the ranks."""
        size = len(self.token)
        inner, taken = np.full(size, -1, dtype=np.int32), np.full(size, _NEVER, dtype=np.int32)
        made, halves = list(self.halves), np.array(list(self.halves.values()), dtype=np.int64).reshape(-1, 3)
        inner[made], taken[made] = halves[:, half], halves[:, 2]
        owner = piece = np.arange(size, dtype=np.int32)
        until, levels = np.full(size, _NEVER, dtype=np.int32), []
        while len(owner):
            levels.append((owner, piece, until))
            more = inner[piece] >= 0
            owner, piece, until = owner[more], inner[piece[more]], taken[piece[more]]
        owner, piece, until = (np.concatenate(x) for x in zip(*levels, strict=True))
        order, counts = np.argsort(owner, kind="stable"), np.bincount(owner, minlength=size)
        return np.cumsum(counts) - counts, counts, piece[order], until[order]

    def _apart_all(self, keys: np.ndarray) -> np.ndarray:
        """1 for keys of two tokens that stay apart, 0 for others: ``fits`` of all of them."""
        borders, ranks = self._merges
        if not len(ranks):
            return np.ones(len(keys), dtype=np.int32)
        (begin_a, many_a, piece_a, until_a), (begin_b, many_b, piece_b, until_b) = self._chains
        left, right = keys >> 20, keys & (1 << 20) - 1
        each = many_a[left] * many_b[right]
        key = np.repeat(np.arange(len(keys)), each)
        i, j = np.divmod(np.arange(len(key)) - np.repeat(np.cumsum(each) - each, each), many_b[right][key])
        a, b = begin_a[left][key] + i, begin_b[right][key] + j
        border = piece_a[a].astype(np.int64) << 20 | piece_b[b]
        at = np.minimum(np.searchsorted(borders, border), len(borders) - 1)
        rank = np.where(borders[at] == border, ranks[at], _NEVER)
        joined = key[(rank < until_a[a]) & (rank <= until_b[b])]
        return (np.bincount(joined, minlength=len(keys)) == 0).astype(np.int32)

    def _side(self, token: int) -> tuple[list, list]:
        """The pieces at the right and at the left end of a token while it is built, each with the rank of the merge that takes it up."""
        if token not in self._sides:
            out: tuple[list, list] = ([], [])
            for pieces, half in zip(out, (1, 0), strict=True):
                at, until = token, _NEVER
                pieces.append((at, until))
                while at in self.halves:
                    until, at = self.halves[at][2], self.halves[at][half]
                    pieces.append((at, until))
            self._sides[token] = out
        return self._sides[token]

    def fits(self, left: int, right: int) -> bool:
        """True when the two tokens stay apart: no merge across their border comes before both sides have grown past it.

        A merge across the border wins a tie against the merge that grows the
        right token (it stands further left), and loses one against the left's.
        """
        known = self._fits.get(left << 20 | right)
        if known is None:
            if len(self._fits) > PAIRS:
                self._fits.clear()
            known = self._fits[left << 20 | right] = not self._joined(left, right, _NEVER)
        return known

    def _joined(self, left: int, right: int, before: int) -> bool:
        """True if a merge of rank under ``before`` joins pieces of the two tokens across their border."""
        for a, until_a in self._side(left)[0]:
            for b, until_b in self._side(right)[1]:
                rank = self.rank.get((a, b))
                if rank is not None and rank < before and rank < until_a and rank <= until_b:
                    return True
        return False

    def _whole(self, token: int) -> bool:
        """True if the bytes of the token are encoded as the token itself."""
        known = self._wholes.get(token)
        if known is None:
            if token in self.halves:
                left, right, rank = self.halves[token]
                known = self._whole(left) and self._whole(right) and not self._joined(left, right, rank)
            else:
                known = len(self.token[token]) == 1
            self._wholes[token] = known
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of each distinct word (pre-token)."""
        out: dict[str, bytes] = {}
        words = sorted(words)  # in the order of their bytes
        self._walk([w for w in words if len(w) > DEEP], out)
        words = [w for w in words if len(w) <= DEEP]
        for at in range(0, len(words), WORDS):
            self._sweep(words[at : at + WORDS], out)
        return out

    def _sweep(self, words: list[str], out: dict[str, bytes]) -> None:
        """Put the ids of sorted words into ``out``: the trie of the words is walked level by level.

        A node is a run of words with one prefix, and its first word stands for it.
        """
        text, n = "".join(words), len(words)
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        places = np.concatenate([[0], np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF))])
        sizes = np.diff(places[np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n))], prepend=0)
        begins = np.cumsum(sizes) - sizes
        last = np.full((int(sizes.max()) + 1, n), -1, dtype=np.int32)  # last token by level and word
        live, nodes, states = np.arange(n), np.zeros(n, dtype=np.int64), np.zeros(1, dtype=np.int64)
        for end in range(1, len(last)):
            kept = sizes[live] >= end
            live, nodes = live[kept], nodes[kept]
            byte = data[begins[live] + (end - 1)].astype(np.int64)
            begun = np.ones(len(live), dtype=bool)
            begun[1:] = (nodes[1:] != nodes[:-1]) | (byte[1:] != byte[:-1])
            states = self._moves[states[nodes[begun]] << 8 | byte[begun]].astype(np.int64)
            nodes = np.cumsum(begun) - 1
            last[end, live] = self._last_tokens(states, last, live[begun], end)[nodes]
        # from the end back, a token of every word at a time
        at, live, found = sizes.copy(), np.flatnonzero(sizes), []
        counts = np.zeros(n, dtype=np.int64)
        while len(live):
            tokens = last[at[live], live]
            found.append((live, tokens))
            counts[live] += 1
            at[live] -= self._width[tokens]
            live = live[at[live] > 0]
        ends = np.cumsum(counts)
        ids = np.zeros(int(ends[-1]), dtype="<u4")
        for i, (live, tokens) in enumerate(found):
            ids[ends[live] - 1 - i] = tokens
        packed, ends, begins = ids.tobytes(), (4 * ends).tolist(), (4 * (ends - counts)).tolist()
        out.update({word: packed[a:b] for word, a, b in zip(words, begins, ends, strict=True)})

    def _last_tokens(self, states: np.ndarray, last: np.ndarray, words: np.ndarray, end: int) -> np.ndarray:
        """Last token of nodes ``end`` bytes deep: the longest end of the state that fits behind the token before it."""
        if new := self._ends[len(self._first) :]:
            many = [len(x) for x in new]
            flat = np.array([x for ends in new for x in ends], dtype=np.int64).reshape(-1, 2)
            final = np.zeros(len(flat), dtype=np.int64)
            final[np.cumsum([n for n in many if n]) - 1] = 1
            self._first = np.concatenate([self._first, len(self._end_token) + np.cumsum(many) - many])
            self._end_token = np.concatenate([self._end_token, flat[:, 0]])
            self._end_length = np.concatenate([self._end_length, flat[:, 1]])
            self._end_last = np.concatenate([self._end_last, final])
        out = np.zeros(len(states), dtype=np.int64)
        at, open_ = self._first[states], np.arange(len(states))
        while len(open_):
            tokens, lengths = self._end_token[at], self._end_length[at]
            taken = (lengths == end) | (self._end_last[at] == 1)
            asked = np.flatnonzero(~taken)
            before = last[end - lengths[asked], words[open_[asked]]].astype(np.int64)
            taken[asked] = self._apart[before << 20 | tokens[asked]] == 1
            out[open_[taken]] = tokens[taken]
            at, open_ = at[~taken] + 1, open_[~taken]
        return out

    def _walk(self, words: list[str], out: dict[str, bytes]) -> None:
        """Put the ids of sorted words into ``out``, node by node.

        Neighbours share their common prefix, and the states of its nodes stay on the path.
        """
        steps, ends, known, packed, token_bytes = self._next, self._ends, self._fits, self._packed, self.token
        # per node on the path: matching state, last token
        path, states, last = b"", [0], [-1]
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            same, most = 0, min(len(path), len(raw))
            while same < most and path[same] == raw[same]:
                same += 1
            del states[same + 1 :], last[same + 1 :]
            state = states[same]
            for end in range(same + 1, len(raw) + 1):
                byte = raw[end - 1]
                state = steps[state << 8 | byte] if state << 8 | byte in steps else self._step(state, byte)
                for token, n in ends[state]:
                    if n == end:
                        break
                    before = last[end - n]
                    fit = known.get(before << 20 | token)
                    if fit or fit is None and self.fits(before, token):
                        break
                states.append(state)
                last.append(token)
            path, end, codes = raw, len(raw), []
            while end:  # from the end back, a token at a time
                codes.append(packed[last[end]])
                end -= len(token_bytes[last[end]])
            codes.reverse()
            out[word] = b"".join(codes)

    # A piece is a run of spaces and line feeds and what follows it. The pattern never joins a
    # character other than white space with white space behind it, so pieces can be cut there; texts with
    # any other white space are matched as they are.
    _piece = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    _odd = re.compile(r"[^\S \n]")

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pieces not seen yet, all their pre-tokens in one walk."""
        plain, cut, seen = [], {}, self._seen
        for piece in pieces:
            # letters only, perhaps behind one space, are one pre-token; marks behind them are one more
            word = piece.rstrip(_MARKS)
            if word.isalpha() or word[:1] == " " and word[1:].isalpha():
                if len(word) == len(piece):
                    plain.append(piece)
                else:
                    cut[piece] = (word, piece[len(word) :])
            else:
                cut[piece] = self.pattern.findall(piece)
        words = self.encode_words({w for w in set(plain).union(*cut.values()) if w not in seen})
        known = words.get
        seen.update({p: words[p] for p in plain})
        for piece, found in cut.items():
            seen[piece] = b"".join([known(w) or seen[w] for w in found])
        self._seen_bytes += sum([150 + 2 * len(p) + len(seen[p]) for p in pieces])

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._pieces(text or "") for text in texts]
        if self._seen_bytes > CACHE_BYTES:
            self._forget_pieces()
        seen = self._seen
        if new := set().union(*cut) - seen.keys():
            self._learn(new)
        return [b"".join([seen[p] for p in pieces]) for pieces in cut]

    def _pieces(self, text: str) -> list[str]:
        if self.special and any(m in text for m in self.marks) and len(parts := self.special.split(text)) > 1:
            return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else self._pieces(part))]
        return self.pattern.findall(text) if self._odd.search(text) else self._piece.findall(text)

    def decode(self, ids: bytes) -> str:
        """Text of the ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def each_task(path: str, work: Callable) -> Callable:
    """A map over record batches for which a task loads an encoder, and drops it at the end: a worker lives on."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(TrieEncoder(path), rows)

    return tidied(run)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The documents with ``ids``: the tokens of the whole text as little-endian 32-bit integers."""
    schema = docs.drop("ids").schema.add("ids", "binary")

    def run(bpe: TrieEncoder, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slim_batches(rows, size=SLICE_BYTES):
            ids = pa.array(bpe.encode_batch(batch.column("text").to_pylist()), pa.binary())
            yield pa.record_batch([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return docs.drop("ids").mapInArrow(each_task(path, run), schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``: the text of their ``ids``."""
    schema = tokens.drop("decoded").schema.add("decoded", "string")

    def run(bpe: TrieEncoder, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slim_batches(rows, "ids"):
            text = pa.array([bpe.decode(x or b"") for x in batch.column("ids").to_pylist()], pa.string())
            yield pa.record_batch([*batch.columns, text], names=[*batch.schema.names, "decoded"])

    return tokens.drop("decoded").mapInArrow(each_task(path, run), schema)


def roundtrip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids and of the text they decode to."""

    def run(bpe: TrieEncoder, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slim_batches(rows, size=SLICE_BYTES):
            ids = bpe.encode_batch(batch.column("text").to_pylist())
            texts = [bpe.decode(x).encode() for x in ids]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    columns = docs.select("doc_id", "text")
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(each_task(path, run), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

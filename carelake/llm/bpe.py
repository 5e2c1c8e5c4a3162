"""Byte-level BPE with exact merges in linear time, and decoding by an offset table.

The encoder walks a piece of text from the left.  At each place it takes the longest
vocabulary token (found by an Aho-Corasick automaton in one pass over the piece) and
accepts it only if a table of merges says that the merge order would really leave it beside
the token before; otherwise it tries the next shorter token or steps back.  Places from
which no tiling exists are remembered, so every place is left for good at most once.
Texts are encoded in runs of pieces; the short pieces of a run that are new walk side by
side, one step of all of them at a time.  An automaton of the reversed tokens reads them from
their ends: after each byte its state tells the longest token that begins there.

The automaton and tables are built once in each Python worker from the vocabulary file.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from carelake.llm.common import KEPT, released_after

#: Encoded pieces (pre-tokens) a worker remembers, in two generations (see ``_Pieces``): about 0.2 KB each.
CACHE_PIECES = 400_000
#: Characters of the longest piece that is remembered.
CACHE_CHARACTERS = 64
#: Fewer pieces than this walk one by one; no more than these side by side.
FEW_PIECES = 32
MOST_PIECES = 8_192
#: Pairs of tokens whose verdict the walk side by side finds without a call, as a power of two; 8 bytes each.
PAIR_BITS = 20
#: Documents whose results are held at a time.
BATCH_ROWS = 1_000
#: How the byte-level vocabulary cuts a text into pre-tokens.
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: The same cuts by Python's faster engine, for texts of ASCII and the Latin letters U+00C0 to U+024F alone.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_IS_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ɏ]*")
_CUT_LATIN = re.compile(
    rf" ?[{_LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\x09-\x0D 0-9{_LATIN}]+|[\x09-\x0D ]+(?![^\x09-\x0D ])|[\x09-\x0D ]+"
)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Vocabulary, automaton, merge tables and offset table of one ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        to_byte = byte_alphabet()
        latin = {c: chr(b) for c, b in to_byte.items()}  # a token's bytes as Latin-1 characters
        spell = "".join

        # Tokens are numbered by merge order: first the single bytes, then each merge's result.
        names = [chr(b) for b in range(256)]
        number = {c: b for b, c in enumerate(names)}
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(len(names))]
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in merges:
            left, right = spell(map(latin.get, left)), spell(map(latin.get, right))
            pair = (number[left], number[right])
            number.setdefault(left + right, len(names))
            if number[left + right] == len(names):
                names.append(left + right)
                self.halves.append(pair)
            self.merged.setdefault(pair, number[left + right])
        self.lengths = [len(n) for n in names]
        ids = {spell(map(latin.get, n)): i for n, i in vocab.items() if all(c in latin for c in n)}
        self.ids = np.array([ids[n] for n in names], dtype="<u4")
        self._id_bytes = [i.tobytes() for i in self.ids]
        self.automaton = ahocorasick.Automaton()
        for n, i in number.items():
            self.automaton.add_word(n, i)
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}  # left * number of tokens + right
        #: For each token the longest one that is a proper prefix of it; -1 if there is none.
        self.shorter = [next((number[n[:e]] for e in range(len(n) - 1, 0, -1) if n[:e] in number), -1) for n in names]

        # Offset table for decoding: the bytes of token id i are data[offsets[i]:offsets[i + 1]].
        by_id = {i: n.encode("latin-1") for n, i in ids.items()}
        by_id |= {i: content.encode() for content, i in self.special.items()}
        size = max(by_id) + 1
        self.offsets = np.concatenate([[0], np.cumsum([len(by_id.get(i, b"")) for i in range(size)])])
        self.data = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), dtype=np.uint8)

        self._special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self._special_ids = {c: np.array([i], dtype="<u4").tobytes() for c, i in self.special.items()}
        self._reversed = _Reversed(number)
        self._length_of, self._shorter_of = np.array(self.lengths), np.array(self.shorter)
        self._verdicts = np.full(1 << PAIR_BITS, -1)  # at a pair's place: twice the last pair asked there, plus its verdict
        self._pieces = _Pieces(self._encode_piece, self._encode_pieces, CACHE_PIECES)
        self._run = max(1, CACHE_PIECES // 4)

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether merging in order leaves ``left`` and ``right`` side by side.

        Undo the later of the two merges again and again; if the tokens that touch at the
        border could ever have merged before the pieces around them did, they would have.
        """
        halves, merged = self.halves, self.merged
        before = len(halves)  # merges from this number on come too late to matter
        while True:
            if merged.get((left, right), before) < before:
                return False
            undo_left = left > right
            for _ in range(2):  # a single byte cannot be undone: then the other side is
                token = left if undo_left else right
                inner = halves[token][1 if undo_left else 0]
                if inner != token:
                    before = token if undo_left else token + 1
                    if undo_left:
                        left = inner
                    else:
                        right = inner
                    break
                undo_left = not undo_left
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pairs, pair = self._pairs, left * len(self.lengths) + right
        found = pairs.get(pair)
        if found is None:
            if len(pairs) > 300_000:
                pairs.clear()
            found = pairs[pair] = self._neighbours(left, right)
        return found

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens (by merge number) of one pre-token, written as Latin-1 characters, one for each byte."""
        n, lengths, shorter = len(piece), self.lengths, self.shorter
        longest = [-1] * n
        for last, token in self.automaton.iter(piece):  # at each end from the longest match to the shortest
            start = last + 1 - lengths[token]
            longest[start] = token  # ends only grow, so what is written last is the longest
        dead = bytearray(n + 1)
        path: list[int] = []
        pairs, many = self._pairs, len(lengths)
        at, token, before = 0, longest[0], -1
        while True:
            end = at + lengths[token]
            fits = not dead[end]
            if fits and before >= 0 and (fits := pairs.get(before * many + token)) is None:
                fits = self.compatible(before, token)
            if fits:
                path.append(token)
                if end == n:
                    return path
                at, before, token = end, token, longest[end]
                continue
            token = shorter[token]
            if token < 0:  # nothing fits here: step back and shorten the token that led here
                dead[at] = 1
                token = path.pop()
                before = path[-1] if path else -1
                at -= lengths[token]

    def _compatible(self, pair: np.ndarray) -> np.ndarray:
        """``compatible`` of many pairs (left * number of tokens + right)."""
        place = (pair * 0x9E3779B97F4A7C1 >> 64 - PAIR_BITS - 4) & ((1 << PAIR_BITS) - 1)
        found = self._verdicts[place]
        new = np.flatnonzero(found >> 1 != pair)
        if new.size:
            fresh, many = pair[new], len(self.lengths)
            found[new] = fresh * 2 + [self.compatible(*divmod(p, many)) for p in fresh.tolist()]
            self._verdicts[place[new]] = found[new]
        return (found & 1).astype(bool)

    def _walk(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """At each place of ``data`` the token that begins there, else -1, as ``encode_piece`` cuts data[start:end].

        All pieces go one step at a time; a byte that belongs to no piece stands at each end.
        """
        many = len(self.lengths)
        longest = self._reversed.longest(data, start, end)
        none = data.size  # the place before a piece's first token
        chosen, came = np.full(none + 1, -1), np.full(none + 1, none)  # token at a place; where the token before begins
        dead, final = np.zeros(none + 1, bool), np.zeros(none + 1, bool)
        final[end] = True
        at, token, before, piece = start, longest[start], np.full(start.size, -1), np.arange(start.size)
        while at.size >= FEW_PIECES:
            after = at + self._length_of[token]
            fits = ~dead[after]
            asked = np.flatnonzero(fits & (before >= 0))
            fits[asked] = self._compatible(before[asked] * many + token[asked])
            there, next_place = at[fits], after[fits]
            chosen[there], came[next_place] = token[fits], there
            at = np.where(fits, after, at)
            before = np.where(fits, token, before)
            token = np.where(fits, longest[after], self._shorter_of[token])
            back = np.flatnonzero(~fits & (token < 0))  # nothing fits here: step back
            if back.size:
                dead[at[back]] = True
                place = came[at[back]]
                at[back], token[back] = place, chosen[place]
                chosen[place] = -1
                before[back] = chosen[came[place]]
            going = ~final[at]
            at, token, before, piece = at[going], token[going], before[going], piece[going]
        for s, e in zip(start[piece].tolist(), end[piece].tolist()):  # the last few
            path = self.encode_piece(data[s:e].tobytes().decode("latin-1"))
            chosen[s:e] = -1
            chosen[s : s + len(path)] = path
        return chosen

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token."""
        if len(pieces) < FEW_PIECES:
            return [self._encode_piece(p) for p in pieces]
        if len(pieces) > MOST_PIECES:
            parts = (pieces[at : at + MOST_PIECES] for at in range(0, len(pieces), MOST_PIECES))
            return [ids for part in parts for ids in self._encode_pieces(part)]
        written = b"\xff".join(map(str.encode, pieces)) + b"\xff"  # a byte that UTF-8 never has
        data = np.frombuffer(written, np.uint8)
        end = np.flatnonzero(data == 0xFF)
        chosen = self._walk(data, np.concatenate([[0], end[:-1] + 1]), end)
        ids = self.ids[chosen[chosen >= 0]].tobytes()
        to = (4 * np.cumsum(chosen >= 0)[end]).tolist()
        found = [ids[a:b] for a, b in zip([0, *to], to)]
        for i, p in enumerate(pieces) if self._special else ():
            if p in self._special_ids:
                found[i] = self._special_ids[p]
        return found

    def _encode_piece(self, piece: str) -> bytes:
        if piece in self._special_ids:
            return self._special_ids[piece]
        of = self._id_bytes
        return b"".join([of[t] for t in self.encode_piece(piece.encode().decode("latin-1"))])

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers; null is empty."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """``encode`` of each text, in runs of texts; a text longer than a run is a run in several parts."""
        held: list[list[str]] = []
        n = 0
        for text in texts:
            cut = self._cut(text)
            size = max(len(cut), len(text or "") // 16)  # a run has few characters, too
            if held and n + size > self._run:
                yield from self._looked_up(held)
                held, n = [], 0
            held.append(cut)
            n += size
        yield from self._looked_up(held)

    def _looked_up(self, cuts: list[list[str]]) -> list[bytes]:
        if len(cuts) == 1 and len(cuts[0]) > self._run:
            parts = (cuts[0][at : at + self._run] for at in range(0, len(cuts[0]), self._run))
            return [b"".join([self._looked_up([part])[0] for part in parts])]
        pieces = self._pieces
        found = [list(map(pieces.get, cut)) for cut in cuts]
        gaps = [[i for i, ids in enumerate(own) if ids is None] for own in found]
        pieces.learn({cut[i] for cut, gap in zip(cuts, gaps) for i in gap})
        for cut, own, gap in zip(cuts, found, gaps):
            for i in gap:
                own[i] = pieces[cut[i]]
        return [b"".join(own) for own in found]

    def _cut(self, text: str | None) -> list[str]:
        """Pre-tokens and special tokens of the whole text; a pre-token never equals a special token, which splits first."""
        if not text:
            return []
        if self._special is None:
            return self._plain(text)
        out, at = [], 0
        for found in self._special.finditer(text):
            out += [*self._plain(text[at : found.start()]), found[0]]
            at = found.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    def _plain(self, text: str) -> list[str]:
        return (_CUT_LATIN if _IS_LATIN.fullmatch(text) else _CUT).findall(text)

    def decode_bytes(self, ids: bytes) -> bytes:
        """Bytes of the tokens, gathered through the offset table in one step."""
        i = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        starts, sizes = self.offsets[i], self.offsets[i + 1] - self.offsets[i]
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return self.data[np.arange(shift.size) + shift].tobytes()

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


class _Reversed:
    """Aho-Corasick automaton of the reversed tokens that reads many pieces side by side.

    A transition (state * 256 + byte) lies in an open hash table, its target in the low 32 bits.
    Every byte is a token, so the root (state 0) has a transition for each.
    """

    def __init__(self, number: dict[str, int]):
        states: dict[int, int] = {}
        word = {}
        depth = [0]
        for name, token in number.items():
            state = 0
            for byte in reversed(name.encode("latin-1")):
                key = state << 8 | byte
                state = states.get(key, 0)
                if not state:
                    state = states[key] = len(depth)
                    depth.append(depth[key >> 8] + 1)
            word[state] = token
        keys, targets = np.fromiter(states, np.int64, len(states)), np.fromiter(states.values(), np.int64, len(states))
        self._bits = int(4 * len(states) - 1).bit_length()
        self._slots = np.full(1 << self._bits, -1)
        place, left = self._place(keys), np.arange(keys.size)
        while left.size:
            left_free = left[self._slots[place[left]] < 0]
            self._slots[place[left_free]] = keys[left_free] << 32 | targets[left_free]
            left = left[self._slots[place[left]] >> 32 != keys[left]]
            place[left] = place[left] + 1 & (1 << self._bits) - 1

        self._fail = np.zeros(len(depth), np.int64)
        self._token = np.full(len(depth), -1)
        self._token[list(word)] = list(word.values())
        level = np.array(depth)[targets]
        order = np.argsort(level, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
            state = targets[at]
            if level[at[0]] > 1:
                self._fail[state] = self._next(self._fail[keys[at] >> 8], keys[at] & 255)
            self._token[state] = np.where(self._token[state] < 0, self._token[self._fail[state]], self._token[state])

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key * 0x9E3779B97F4A7C1 >> 60 - self._bits) & ((1 << self._bits) - 1)

    def _goto(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Target of each transition, -1 where there is none."""
        key = state << 8 | byte
        place = self._place(key)
        entry = self._slots[place]
        other = np.flatnonzero((entry >> 32 != key) & (entry >= 0))
        while other.size:  # another key's slot: the next one
            place[other] = place[other] + 1 & (1 << self._bits) - 1
            entry[other] = self._slots[place[other]]
            other = other[(entry[other] >> 32 != key[other]) & (entry[other] >= 0)]
        return np.where(entry < 0, -1, entry & 0xFFFFFFFF)

    def _next(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """State after ``byte``, by failure links where there is no transition."""
        after = self._goto(state, byte)
        stuck = np.flatnonzero(after < 0)
        state = state[stuck]
        while stuck.size:
            state = self._fail[state]
            after[stuck] = target = self._goto(state, byte[stuck])
            stuck, state = stuck[target < 0], state[target < 0]
        return after

    def longest(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token that begins at each place and ends within its piece data[start:end]; -1 between pieces."""
        found = np.full(data.size, -1)
        size = end - start
        order = np.argsort(-size, kind="stable")
        place, size = end[order], -size[order]
        state = np.zeros(place.size, np.int64)
        for read in range(int(-size[0])):
            going = np.searchsorted(size, -read)  # pieces longer than what is read come first
            place = place[:going] - 1
            state = self._next(state[:going], data[place].astype(np.int64))
            found[place] = self._token[state]
        return found


class _Pieces(dict):
    """Piece -> encoded ids, filled on first use or, many at once, by ``learn``.

    Two generations bound the memory: when the young one is full it becomes the old one, and
    what is asked for again moves back.  Long pieces are not kept.
    """

    def __init__(self, encode: Callable[[str], bytes], encode_many: Callable[[list[str]], list[bytes]], keep: int):
        super().__init__()
        self._encode, self._encode_many = encode, encode_many
        self._half = keep // 2
        self._old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            ids = self._encode(piece)
        if len(piece) <= CACHE_CHARACTERS:
            self._room(1)
            self[piece] = ids
        return ids

    def _room(self, n: int) -> None:
        if len(self) + n > self._half:
            self._old = dict(self)
            self.clear()

    def learn(self, pieces: set[str]) -> None:
        """Keep those of ``pieces``, none of them young, that are not long: at most half of what is kept in all."""
        old = self._old
        new = [p for p in pieces if len(p) <= CACHE_CHARACTERS]
        back = {p: old[p] for p in new if p in old}
        unknown = [p for p in new if p not in back]
        self._room(len(new))
        self.update(back)
        self.update(zip(unknown, self._encode_many(unknown)))


_LOADED: dict[str, ByteBpe] = {}
KEPT["bpe"] = _LOADED


def codec(path: str) -> ByteBpe:
    """The codec of ``path``, built once in this Python process."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ids (binary, little-endian unsigned 32-bit), decoded text.

    Equal to the ``tokenizers`` library's encode without added special tokens and decode
    that keeps them.  Null text is empty: no ids, empty decoded text.  Keys may be null or
    repeat; an empty table gives no rows.  No shuffle; one text is in memory at a time
    besides its Arrow batch.
    """

    def run(rows: Iterator[tuple[list, list]]) -> Iterator[list[list]]:
        bpe = codec(path)
        for keys, texts in rows:
            ids = list(bpe.encode_all(texts))
            yield [keys, ids, [bpe.decode(i) for i in ids]]

    return _mapped(docs, key, text, run, "ids binary, decoded string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode_decode``, but only n_tokens and the SHA-256 of ids and decoded text leave the workers."""

    def run(rows: Iterator[tuple[list, list]]) -> Iterator[list[list]]:
        bpe = codec(path)
        for keys, texts in rows:
            n, of_ids, of_text = [], [], []
            for ids in bpe.encode_all(texts):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield [keys, n, of_ids, of_text]

    return _mapped(docs, key, text, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def pieces(docs: DataFrame, path: str, size: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ids plus ``end_id``, cut into pieces of at most ``size``; all but the first are full.

    Columns: key, piece (from 0), start, length, ids_crc32, ids (binary).
    """

    def run(rows: Iterator[tuple[list, list]]) -> Iterator[list[list]]:
        bpe = codec(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for keys, texts in rows:
            made: list[list] = [[] for _ in range(6)]
            for k, ids in zip(keys, bpe.encode_all(texts)):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n - (n - 1) // size * size, n + 1, size)]
                for p, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * s : 4 * e]
                    for column, value in zip(made, (k, p, s, e - s, zlib.crc32(part), part)):
                        column.append(value)
            yield made

    return _mapped(docs, key, text, run, "piece int, start long, length long, ids_crc32 long, ids binary")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Keys and texts in smaller batches, as what is made of a batch is held beside it."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            part = b.slice(at, BATCH_ROWS)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _mapped(docs: DataFrame, key: str, text: str, run: Callable, out: str) -> DataFrame:
    """``run`` over keys (as strings) and texts; it yields the columns key and ``out`` as lists."""
    kind = docs.schema[key].dataType.simpleString()
    given = docs.selectExpr(f"cast(`{key}` as string) AS key", f"`{text}` AS text")
    out = f"key string, {out}"
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, out.split(", "))])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(_cut(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    done = given.mapInArrow(lambda batches: released_after(mapped(batches), "bpe"), out)
    rest = [c for c in done.columns if c != "key"]
    return done.selectExpr(f"cast(key as {kind}) AS `{key}`", *rest)

"""Byte-pair tokenizers compiled to finite-state transducers.

Two machines run one after the other.

*Splitter*: a small deterministic transducer over character classes marks where
pre-tokens begin.  Text is cut into chunks of equal length; each chunk's map from
every start state to its end state is computed for all chunks side by side, a
parallel prefix scan composes the maps, and a second run from the now known start
states emits the marks.

*Merger*: a transducer over bytes whose transitions carry the number of tokens
they add, so the sum along a pre-token is its token count.  A prefix of a
byte-pair encoding is the encoding of the prefix up to a token's end, and a
sequence is an encoding exactly if each neighbouring pair is.  So the last token
of every prefix is the longest vocabulary entry that ends there and fits the last
token of the prefix before it.  A state is that last token and, for every suffix
that begins some entry, its place in the vocabulary tree with the last token and
the relative count where it starts.  States are found on demand and interned;
beyond ``MAX_STATES`` the machine is emptied and rebuilt from the states in use,
which costs time and never changes a count.
"""

from __future__ import annotations

import json
import struct
import sys
import unicodedata

import numpy as np

MAX_STATES = 1 << 18
_SLOTS = 1 << 21  # hash places for transitions, at most half of them used
_CHUNK = 256  # characters
PIECE = 1 << 19  # characters handled at once

# character classes
LETTER, ONE, RV, L, E, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE, STOP = range(11)
# splitter states
START, IN_L, IN_N, IN_O, IN_SPACE, IN_WHITE, AFTER_A, AFTER_RV, AFTER_L = range(9)
HERE, BEFORE = 1, 2  # a mark before this character, before the one before it


def _char_classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = NUMBER
    # Unicode White_Space, fixed values
    for cp in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[cp] = WHITE
    out[0x20] = SPACE
    out[ord("'")] = APOSTROPHE
    for chars, kind in (("stmd", ONE), ("rv", RV), ("l", L), ("e", E)):
        for c in chars:
            out[ord(c)] = kind
    return out


def _splitter(joins_space: bool, single_numbers: bool) -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state and class.

    ``joins_space``: one space goes with the run after it, other white space is
    split before its last character; else white space only separates.
    """
    states, classes = 9, 11
    nxt, marks = np.zeros((states, classes), np.uint8), np.zeros((states, classes), np.uint8)
    run_of = {NUMBER: IN_N, OTHER: IN_O, SPACE: IN_SPACE, WHITE: IN_WHITE}
    letters = (LETTER, ONE, RV, L, E)
    for s in range(states):
        for c in range(classes):
            mark = 0
            at = s
            if s in (AFTER_RV, AFTER_L):
                if (s == AFTER_RV and c == E) or (s == AFTER_L and c == L):
                    nxt[s, c] = START  # the contraction is whole
                    continue
                mark, at = BEFORE, IN_L  # the apostrophe stood alone, a letter run began after it
            if at == AFTER_A:
                if c in (ONE, RV, L):
                    nxt[s, c] = {ONE: START, RV: AFTER_RV, L: AFTER_L}[c]
                    continue
                at = IN_O
            if c == STOP:
                nxt[s, c], marks[s, c] = START, mark | HERE
                continue
            to = IN_L if c in letters else run_of.get(c, IN_O)
            if c == APOSTROPHE and at not in (IN_O, *((IN_SPACE,) if joins_space else ())):
                to = AFTER_A
            white, was_white = to in (IN_SPACE, IN_WHITE), at in (IN_SPACE, IN_WHITE)
            if white:
                mark |= 0 if was_white else HERE
            elif joins_space and at == IN_SPACE:
                mark |= BEFORE
            elif joins_space and at == IN_WHITE:
                mark |= BEFORE | HERE
            elif to != at or at == START or (to == IN_N and single_numbers):
                mark |= HERE
            nxt[s, c], marks[s, c] = to, mark
    return nxt, marks


class Splitter:
    def __init__(self, joins_space: bool, single_numbers: bool):
        self.next, self.marks = _splitter(joins_space, single_numbers)
        self.classes = _char_classes()

    def starts(self, chars: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Places where pre-tokens (or white space, or a stop) begin; a stop follows every text."""
        kinds = self.classes[chars]
        kinds[stops] = STOP
        lanes = -(-len(kinds) // _CHUNK)
        grid = np.full(lanes * _CHUNK, STOP, np.uint8)
        grid[: len(kinds)] = kinds
        grid = np.ascontiguousarray(grid.reshape(lanes, _CHUNK).T).astype(np.intp)
        width, (nxt, marks) = self.next.shape[1], (self.next.ravel(), self.marks.ravel())
        rows = nxt.astype(np.intp) * width
        # map of every chunk: end state for each start state
        maps = np.repeat((np.arange(self.next.shape[0]) * width)[:, None], lanes, axis=1)
        for column in grid:
            maps = rows[maps + column]
        maps = np.ascontiguousarray(maps.T) // width
        reach = 1
        while reach < lanes:  # prefix scan over map composition
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
            reach *= 2
        state = np.r_[START, maps[:-1, START]] * width
        found = np.empty(grid.shape, np.uint8)
        for column, out in zip(grid, found):
            at = state + column
            out[:] = marks[at]
            state = rows[at]
        flat = np.ascontiguousarray(found.T).ravel()[: len(kinds)]
        begins = (flat & HERE) != 0
        begins[:-1] |= (flat[1:] & BEFORE) != 0
        return np.flatnonzero(begins)


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that vocabulary files of byte-level tokenizers use (fixed rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Token counts (and tokens) of pre-tokens given as symbols: bytes, plus 256 on the last if words have ends."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str | None = None):
        to_byte = _byte_of_char()

        def symbols(token: str) -> tuple[int, ...]:
            end = bool(suffix) and token.endswith(suffix)
            parts = [to_byte[c] for c in (token[: -len(suffix)] if end else token)]
            if end and parts:
                parts[-1] += 256
            return tuple(parts)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        made = {t for _, t in self.rank.values()}
        self.tokens = {i: s for s, i in ((symbols(t), i) for t, i in vocab.items() if all(c in to_byte for c in (
            t[: -len(suffix)] if suffix and t.endswith(suffix) else t))) if s and (len(s) == 1 or i in made)}
        self.single = {s[0]: i for i, s in self.tokens.items() if len(s) == 1}
        self.tree: list[dict[int, int]] = [{}]
        self.ends = [-1]
        for i, parts in self.tokens.items():
            node = 0
            for part in parts:
                child = self.tree[node].get(part)
                if child is None:
                    child = self.tree[node][part] = len(self.tree)
                    self.tree.append({})
                    self.ends.append(-1)
                node = child
            self.ends[node] = i
        self.length = np.zeros(max(self.tokens) + 1, np.int32)
        for i, parts in self.tokens.items():
            self.length[i] = len(parts)
        self._clear()

    def _clear(self) -> None:
        self.fits: dict[tuple[int, int], bool] = {}
        self.names: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.last = np.zeros(1024, np.int32)
        self.keys = np.full(_SLOTS, -1, np.int64)
        self.values = np.zeros(_SLOTS, np.int32)
        self.used = 0
        self._named(struct.pack("i", -1))

    def _named(self, state: bytes) -> int:
        found = self.names.get(state)
        if found is None:
            found = self.names[state] = len(self.states)
            self.states.append(state)
            if found >= len(self.last):
                self.last = np.concatenate([self.last, np.zeros_like(self.last)])
            self.last[found] = struct.unpack_from("i", state)[0]
        return found

    def _merged(self, ids: list[int]) -> list[int]:
        """Plain byte-pair merging of a short sequence."""
        while len(ids) > 1:
            ranked = [(self.rank[p], p) for p in zip(ids, ids[1:]) if p in self.rank]
            if not ranked:
                break
            (_, whole), (a, b) = min(ranked)
            out, i = [], 0
            while i < len(ids):
                both = i + 1 < len(ids) and ids[i] == a and ids[i + 1] == b
                out.append(whole if both else ids[i])
                i += 2 if both else 1
            ids = out
        return ids

    def _fit(self, left: int, right: int) -> bool:
        found = self.fits.get((left, right))
        if found is None:
            parts = (self.tokens[left] if left >= 0 else ()) + self.tokens[right]
            found = self._merged([self.single[s] for s in parts]) == ([left, right] if left >= 0 else [right])
            self.fits[left, right] = found
        return found

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        packed = self.states[state]
        fields = struct.unpack(f"{len(packed) // 4}i", packed)
        tree, ends = self.tree, self.ends
        going, token, added = [], None, 0
        for at in range(1, len(fields) + 1, 3):
            # the last round starts a new entry here
            node, before, rel = fields[at : at + 3] if at < len(fields) else (0, fields[0], 0)
            child = tree[node].get(symbol)
            if child is None:
                continue
            if token is None and ends[child] >= 0 and self._fit(before, ends[child]):
                token, added = ends[child], rel + 1
            if tree[child]:
                going.append((child, before, rel))
        if token is None:
            raise ValueError(f"no token for byte {symbol & 255}")
        flat = [token]
        for child, before, rel in going:
            flat += (child, before, rel - added)
        return self._named(struct.pack(f"{len(flat)}i", *flat)), added

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Hash place of each key: where it is, or a free one."""
        place = ((keys * -7046029254386353131).view(np.uint64) >> np.uint64(43)).astype(np.int64)
        wrong = np.flatnonzero((self.keys[place] != keys) & (self.keys[place] >= 0))
        while len(wrong):
            place[wrong] = (place[wrong] + 1) & (_SLOTS - 1)
            held = self.keys[place[wrong]]
            wrong = wrong[(held != keys[wrong]) & (held >= 0)]
        return place

    def _compile(self, keys: np.ndarray) -> None:
        for key in keys.tolist():
            to, added = self._step(key >> 9, key & 511)
            place = int(self._places(np.array([key], np.int64))[0])
            self.keys[place], self.values[place] = key, to | (added + 64) << 20
            self.used += 1

    def walk(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """Token count of each pre-token; with ``keep`` also the last token after every symbol."""
        order = np.argsort(-np.minimum(sizes, 30000).astype(np.int16), kind="stable")
        if len(sizes) and sizes.max() >= 30000:
            order = np.argsort(-sizes, kind="stable")
        at, left = starts[order], sizes[order]
        alive = len(sizes) - np.searchsorted(left[::-1], np.arange(int(left[0]) if len(left) else 0), side="right")
        state, count = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int32)
        lasts = np.full(len(symbols), -1, np.int32) if keep else None
        for step, n in enumerate(alive.tolist()):
            place_of = at[:n] + step
            keys = (state[:n] << 9) | symbols[place_of]
            place = self._places(keys)
            absent = self.keys[place] != keys
            if absent.any():
                if len(self.states) > MAX_STATES or self.used > _SLOTS // 2 - (1 << 18):
                    keys = self._rebuilt(state, n, symbols[place_of])
                    absent = np.ones(n, bool)
                missing = np.unique(keys[absent])
                for some in range(0, len(missing), 1 << 16):
                    self._compile(missing[some : some + (1 << 16)])
                place = self._places(keys)
            value = self.values[place]
            state[:n] = value & 0xFFFFF
            count[:n] += (value >> 20) - 64
            if keep:
                lasts[place_of] = self.last[state[:n]]
        counts = np.empty_like(count)
        counts[order] = count
        return counts, lasts

    def _rebuilt(self, state: np.ndarray, n: int, symbols: np.ndarray) -> np.ndarray:
        held, at = np.unique(state[:n], return_inverse=True)
        names = [self.states[i] for i in held.tolist()]
        self._clear()
        state[:n] = np.array([self._named(x) for x in names], np.int64)[at]
        return (state[:n] << 9) | symbols


class Tokenizer:
    """Splitter and merger of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or None
        self.lowers = spec["normalizer"] is not None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = Splitter(joins_space=not self.lowers, single_numbers=self.lowers)
        self.merge = Merger(model["vocab"], model["merges"], self.suffix)

    def normal(self, text: str) -> str:
        if not self.lowers:
            return text
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def run(self, texts: list[str], keep: bool = False):
        """Token count of each text, and with ``keep`` the token ids of each."""
        if not texts:
            return np.zeros(0, np.int64), []
        joined = "\0".join(texts) + "\0"
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = self.split.starts(chars, stops)
        kinds = self.split.classes[chars[starts]]
        owner = np.searchsorted(stops, starts)
        is_stop = stops[owner] == starts
        wanted = ~is_stop if not self.lowers else ~is_stop & (kinds != SPACE) & (kinds != WHITE)
        ends = np.r_[starts[1:], len(chars)]
        wide = 1 + (chars >= 0x80).astype(np.int8) + (chars >= 0x800) + (chars >= 0x10000)
        offset = np.r_[0, np.cumsum(wide, dtype=np.int64)]
        symbols = np.frombuffer(joined.encode("utf-8"), np.uint8).astype(np.int64)
        first, stop = offset[starts[wanted]], offset[ends[wanted]]
        if self.suffix:
            symbols[stop - 1] += 256
        counts, lasts = self.merge.walk(symbols, first, stop - first, keep)
        per_text = np.bincount(owner[wanted], weights=counts, minlength=len(texts)).astype(np.int64)
        if not keep:
            return per_text, []
        taken = np.zeros(len(symbols), bool)
        at, low = stop - 1, first
        while len(at):  # from the last token of each pre-token back to its first
            taken[at] = True
            at = at - self.merge.length[lasts[at]]
            more = at >= low
            at, low = at[more], low[more]
        ids = lasts[taken]
        return per_text, np.split(ids, np.cumsum(per_text)[:-1])


def pieces(text: str, size: int = PIECE) -> list[str]:
    """A text in parts of about ``size`` characters, cut only where a word is followed by white space."""
    out, at = [], 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] in " \n\t\r" and not text[cut - 1].isspace() and text[cut - 1].isprintable()):
            cut += 1
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]

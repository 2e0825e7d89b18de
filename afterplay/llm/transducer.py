"""A tokenizer compiled into a deterministic transducer that counts the tokens it would emit.

The tokenizer normalises, cuts at classes of characters and merges pairs of signs by rank. Which
merges hold at the end of a beginning of a word is decided by its last token, and the last token by
those of the shorter beginnings from which a token may still reach on: so a word's state is the set
of tree nodes of tokens under way, each with the last token before it and the count up to there,
relative to the count now. Steps between such states, with the change of the count, make up the
transducer; the cut into words is part of the state. States and steps are made when a text first
needs them and kept as a dense table, which a run over many chunks of text at once only looks up.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

WIDTH = 128
MAX_STATES = 1 << 18
CHUNK = 256
BLOCK = 1 << 20
FEW = 6
UNKNOWN, UNSAFE = -1, -2
SPACE, LETTER, NUMBER, OTHER = range(4)
BETWEEN, IN_LETTERS, IN_SIGNS, QUOTE, QUOTED = range(5)
START = (BETWEEN, (), 0)
LINE_END = "\n"

# fixed values: what the tokenizer cuts out of a text, in its own notation, and the endings it knows
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
STEPS_BEFORE = ("NFC", "Replace", "Lowercase")
# Hangul letters that may join the one before them
JOINING = (range(0x1100, 0x1200), range(0xA960, 0xA980), range(0xD7B0, 0xD800))


def byte_signs() -> list[str]:
    """How byte-level tokenizers spell each byte: itself if it shows, else the next sign from 256 on."""
    signs, others = [], 0
    for byte in range(256):
        shown = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        signs.append(chr(byte if shown else 256 + others))
        others += not shown
    return signs


class Merges:
    """Which tokens are whole words of the merge rules, and which may stand side by side.

    Two tokens stay apart if no rule joins a right end of the first with a left end of the second
    while both ends exist: an end exists until the rule that takes it up. Of equal rules the left
    one goes first.
    """

    def __init__(self, model: dict):
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.parts = {self.ids[a + b]: (self.ids[a], self.ids[b], r) for r, (a, b) in enumerate(pairs)}
        # the rules by their left part
        self.joins: dict[int, dict[int, int]] = {}
        for left, right, rank in self.parts.values():
            self.joins.setdefault(left, {})[right] = rank
        if len(self.parts) != len(pairs) or any(
            r <= max(self.born(a), self.born(b)) for a, b, r in self.parts.values()
        ):
            raise ValueError("a merge rule comes before its parts, or a token has two rules")
        self._apart: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}

    def born(self, token: int) -> int:
        return self.parts[token][2] if token in self.parts else -1

    def _ends(self, token: int, side: int, until: float) -> list[tuple[int, float]]:
        """The left (0) or right (1) ends of a token, each with the rule that takes it up."""
        ends = [(token, until)]
        while token in self.parts:
            until = self.parts[token][2]
            token = self.parts[token][side]
            ends.append((token, until))
        return ends

    def _joined_early(self, left: int, right: int, until: float) -> bool:
        right_ends = self._ends(right, 0, until)
        for x, x_until in self._ends(left, 1, until):
            rules = self.joins.get(x)
            if rules is None:
                continue
            for y, y_until in right_ends:
                rank = rules.get(y)
                if rank is not None and rank < until and rank < x_until and rank <= y_until:
                    return True
        return False

    def apart(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) > 1 << 20:
                self._apart.clear()
            known = self._apart[key] = not self._joined_early(left, right, float("inf"))
        return known

    def whole(self, token: int) -> bool:
        """Whether the rules make this one token of its own signs."""
        known = self._whole.get(token)
        if known is None:
            if token not in self.parts:
                known = True
            else:
                left, right, rank = self.parts[token]
                known = self.whole(left) and self.whole(right) and not self._joined_early(left, right, rank)
            self._whole[token] = known
        return known


class Words:
    """States within a word: nodes of tokens under way with the last token and the count before them."""

    def __init__(self, model: dict):
        self.merges = Merges(model)
        end = model["end_of_word_suffix"]
        signs = {s: b for b, s in enumerate(byte_signs())}
        if any(s not in self.merges.ids or s + end not in self.merges.ids for s in signs):
            raise ValueError("the vocabulary lacks single bytes")
        nodes: dict[int, int] = {}
        tokens, inner, closing = [-1], [False], {}
        for text, token in self.merges.ids.items():
            last = text.endswith(end)
            path = [signs[c] for c in (text[: -len(end)] if last else text)]
            at = 0
            for sign in path[:-1] if last else path:
                inner[at] = True
                key = at << 8 | sign
                if key not in nodes:
                    nodes[key] = len(tokens)
                    tokens.append(-1)
                    inner.append(False)
                at = nodes[key]
            if last:
                inner[at] = True
                closing[at << 8 | path[-1]] = token
            else:
                tokens[at] = token
        # by node and byte: the next node (-1 if nothing lies below it), its token, and the token of a word that ends here
        self.below = {
            key: (nodes[key] if key in nodes and inner[nodes[key]] else -1, tokens[nodes[key]] if key in nodes else -1, closing.get(key, -1))
            for key in {**nodes, **closing}
        }
        self.first = ((0, -1, 0),)

    def step(self, state: tuple, data: bytes) -> tuple[tuple, int, int]:
        """The state after a character, the change of the count, and what the count gains if the word ends here."""
        change = 0
        for byte in data:
            state, more, closed = self._next(state, byte)
            change += more
        return state, change, closed - more

    def _next(self, state: tuple, byte: int) -> tuple[tuple, int, int]:
        """The state after a byte, its count, and the count if the byte ends the word, both from the count before."""
        apart, whole = self.merges.apart, self.merges.whole
        ahead, last, count, end, closed = [], -1, 0, -1, 0
        for node, before, so_far in state:
            found = self.below.get(node << 8 | byte)
            if found is None:
                continue
            node, token, closing = found
            if node >= 0:
                ahead.append((node, before, so_far))
            if last < 0 <= token and (before < 0 or apart(before, token)) and whole(token):
                last, count = token, so_far + 1
            if end < 0 <= closing and (before < 0 or apart(before, closing)) and whole(closing):
                end, closed = closing, so_far + 1
        return (*[(node, before, n - count) for node, before, n in ahead], (0, last, 0)), count, closed


class TokenCounter:
    """Counts the tokens of texts as ``tokenizers`` would give them for the file at ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._check(spec)
        self.tokenizer = Tokenizer.from_file(path)
        names = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(names)) if names else None
        self.words = Words(spec["model"])
        self.classes: dict[str, int] = {}
        self.sequences: list[str] = []
        self.symbol_ids: dict[str, int] = {}
        self.resets = np.zeros(0, bool)
        # symbols of characters as they stand, and of normalised ones
        self.raw = np.full(0x110000, UNKNOWN, np.int32)
        self.plain = np.full(0x110000, UNKNOWN, np.int32)
        self.lone = {text: self._whole_count(text) for text in ("'", *("'" + e for e in ENDINGS))}
        self._forget()

    @staticmethod
    def _check(spec: dict) -> None:
        cut, spell = (spec["pre_tokenizer"].get("pretokenizers") or [{}, {}])[:2]
        steps = tuple(n["type"] for n in (spec["normalizer"] or {}).get("normalizers", []))
        known = (
            spec["model"]["type"] == "BPE"
            and spec["model"].get("end_of_word_suffix")
            and not spec["model"].get("ignore_merges")
            and steps == STEPS_BEFORE
            and cut.get("pattern") == {"Regex": SPLIT}
            and spell.get("type") == "ByteLevel"
            and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        if not known:
            raise ValueError("only byte-level merges with word ends and this way to cut are compiled")

    # states and their steps

    def _forget(self) -> None:
        self.states = [START]
        self.numbers = {START: 0}
        self.next = np.full(64 * WIDTH, -1, np.int32)
        self.gain = np.zeros(64 * WIDTH, np.int32)
        self.rare: dict[tuple[int, int], tuple[int, int]] = {}
        self.live: list[np.ndarray] = []

    def _number(self, state: tuple) -> int:
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
            if known * WIDTH >= len(self.next):
                self.next = np.concatenate([self.next, np.full(len(self.next), -1, np.int32)])
                self.gain = np.concatenate([self.gain, np.zeros(len(self.gain), np.int32)])
        return known

    def _make_room(self) -> None:
        """With too many states, all are forgotten but those that the runs stand in."""
        if len(self.states) < MAX_STATES:
            return
        arrays, old = self.live, self.states
        self._forget()
        self.live = arrays
        for array in arrays:
            found, place = np.unique(array, return_inverse=True)
            array[:] = np.array([self._number(old[s]) for s in found.tolist()], array.dtype)[place]

    def _class(self, char: str) -> int:
        known = self.classes.get(char)
        if known is None:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            after = cut("a" + char)
            if len(after) == 1:
                known = LETTER if after[0][1][1] == 2 else SPACE
            else:
                known = OTHER if len(cut(char + "!")) == 1 else NUMBER
            self.classes[char] = known
        return known

    def _whole_count(self, text: str) -> int:
        state, total, ending = self.words.first, 0, 0
        for char in text:
            state, change, ending = self.words.step(state, char.encode())
            total += change
        return total + ending

    def _begin(self, kind: int, char: str) -> tuple[tuple, int]:
        state, change, ending = self.words.step(self.words.first, char.encode())
        return (kind, state, ending), change

    def _follow(self, state: tuple, char: str) -> tuple[tuple, int]:
        """One character from a state: the next state and how the count changes."""
        kind, inner, ending = state
        gained = 0
        if kind == QUOTE:
            if char in ENDINGS:
                return START, self.lone["'" + char]
            if any(e[0] == char for e in ENDINGS):
                return (QUOTED, char, 0), 0
            (kind, inner, ending), gained = self._begin(IN_SIGNS, "'")
        elif kind == QUOTED:
            if inner + char in ENDINGS:
                return START, self.lone["'" + inner + char]
            (kind, inner, ending), more = self._begin(IN_LETTERS, inner)
            gained = self.lone["'"] + more
        found = self._class(char)
        run = {LETTER: IN_LETTERS, OTHER: IN_SIGNS}.get(found)
        if run is not None and run == kind:
            inner, change, ending = self.words.step(inner, char.encode())
            return (kind, inner, ending), gained + change
        gained += ending
        if run is None:
            return START, gained + (self._whole_count(char) if found == NUMBER else 0)
        if char == "'":
            return (QUOTE, "", 0), gained
        state, change = self._begin(run, char)
        return state, gained + change

    def _finish(self, state: tuple, sequence: str) -> tuple[tuple, int]:
        gained = 0
        for char in sequence:
            state, change = self._follow(state, char)
            gained += change
        return state, gained

    def _learn(self, state: int, symbol: int) -> None:
        after, gained = self._finish(self.states[state], self.sequences[symbol])
        after = self._number(after)
        if symbol < WIDTH:
            self.next[state * WIDTH + symbol] = after
            self.gain[state * WIDTH + symbol] = gained
        else:
            if len(self.rare) > 1 << 20:
                self.rare.clear()
            self.rare[state, symbol] = after, gained

    # symbols of characters

    def _symbol(self, sequence: str) -> int:
        known = self.symbol_ids.get(sequence)
        if known is None:
            known = self.symbol_ids[sequence] = len(self.sequences)
            self.sequences.append(sequence)
            # after a space or a number the state is the same whatever was before
            self.resets = np.append(self.resets, self._class(sequence[-1]) in (SPACE, NUMBER))
        return known

    def _look_up(self, codes: np.ndarray, table: np.ndarray) -> np.ndarray:
        found = table[codes]
        if (found == UNKNOWN).any():
            for code in np.unique(codes[found == UNKNOWN]).tolist():
                char = chr(code)
                if table is self.plain:
                    table[code] = self._symbol(char)
                elif self._stands_alone(char):
                    table[code] = self._symbol(self.tokenizer.normalizer.normalize_str(char))
                else:
                    table[code] = UNSAFE
            found = table[codes]
        return found

    @staticmethod
    def _stands_alone(char: str) -> bool:
        """Whether normalising cannot join or reorder this character with others."""
        category = unicodedata.category(char)
        return (
            category[0] != "M"
            and category != "Cn"
            and not unicodedata.combining(char)
            and not any(ord(char) in r for r in JOINING)
            and unicodedata.is_normalized("NFC", char)
        )

    # running over texts

    def _run(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray, gains: np.ndarray) -> None:
        """Takes each lane from its state through ``symbols[start:end]``; states and gains are written in place."""
        order = np.argsort(starts - ends, kind="stable")
        lane_states = states[order]
        first, length = starts[order], (ends - starts)[order]
        self.live.append(lane_states)
        alone = bool(len(symbols)) and int(symbols.max()) < WIDTH
        lanes, at = len(order), 0
        while True:
            lanes = int(np.searchsorted(-length[:lanes], -at, side="left"))
            if lanes <= FEW:
                break
            place = first[:lanes] + at
            self._step(symbols[place], lane_states[:lanes], place, gains, alone)
            at += 1
        for lane in range(lanes):
            self._run_one(symbols, int(first[lane]) + at, int(first[lane] + length[lane]), lane_states, lane, gains)
        # by position: forgetting states may have replaced what is live, never the array itself
        self.live = [a for a in self.live if a is not lane_states]
        states[order] = lane_states

    def _step(self, symbol: np.ndarray, state: np.ndarray, place: np.ndarray, gains: np.ndarray, alone: bool) -> None:
        common = None if alone else symbol < WIDTH
        while True:
            at = state * WIDTH + (symbol if alone else np.where(common, symbol, 0))
            after = self.next[at]
            missing = after < 0
            if not alone:
                missing &= common
            if not missing.any():
                break
            self._make_room()
            at = state * WIDTH + symbol
            for key in np.unique(at[missing]).tolist():
                if self.next[key] < 0:
                    self._learn(key // WIDTH, key % WIDTH)
        gained = self.gain[at]
        if not alone and not common.all():
            for lane in np.flatnonzero(~common).tolist():
                after[lane], gained[lane] = self._rare_step(int(state[lane]), int(symbol[lane]))
        gains[place] = gained
        state[:] = after

    def _rare_step(self, state: int, symbol: int) -> tuple[int, int]:
        if (state, symbol) not in self.rare:
            self._learn(state, symbol)
        return self.rare[state, symbol]

    def _run_one(self, symbols, start: int, end: int, states: np.ndarray, lane: int, gains: np.ndarray) -> None:
        state, found = int(states[lane]), []
        for symbol in symbols[start:end].tolist():
            if symbol < WIDTH:
                after = self.next.item(state * WIDTH + symbol)
                if after < 0:
                    states[lane] = state
                    self._make_room()
                    state = int(states[lane])
                    self._learn(state, symbol)
                    after = self.next.item(state * WIDTH + symbol)
                found.append(self.gain.item(state * WIDTH + symbol))
                state = after
            else:
                state, gained = self._rare_step(state, symbol)
                found.append(gained)
        gains[start:end] = found
        states[lane] = state

    def _gains(self, symbols: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """What each symbol adds to the count, from the state in ``entry``, which becomes the last state.

        Chunks go side by side. A chunk's map from the state before it to the state behind it is
        constant from its first reset on, so what follows that runs at once, from the state between
        words. Maps then compose: for every chunk the last constant map before it is found by a
        prefix maximum, and the stretches before the resets run from there, chunk after chunk where
        several in a row have no reset.
        """
        gains = np.zeros(len(symbols), np.int32)
        starts = np.arange(0, len(symbols), CHUNK)
        ends = np.minimum(starts + CHUNK, len(symbols))
        marks = np.flatnonzero(self.resets[symbols])
        nearest = np.searchsorted(marks, starts)
        head = np.minimum(np.append(marks, len(symbols))[nearest] + 1, ends)
        constant = np.append(marks, len(symbols))[nearest] < ends
        behind = np.zeros(len(starts), np.int32)
        self.live.append(behind)
        some = np.flatnonzero(constant)
        after = behind[some]
        self._run(symbols, head[some], ends[some], after, gains)
        behind[some] = after
        number = np.arange(len(starts))
        from_chunk = np.maximum.accumulate(np.where(constant, number, -1))
        from_chunk = np.append(-1, from_chunk[:-1])
        turn = number - from_chunk
        for now in range(1, int(turn.max()) + 1 if len(turn) else 0):
            lanes = np.flatnonzero(turn == now)
            states = np.where(lanes > 0, behind[lanes - 1], entry[0]).astype(np.int32)
            self._run(symbols, starts[lanes], head[lanes], states, gains)
            passing = ~constant[lanes]
            behind[lanes[passing]] = states[passing]
        entry[0] = behind[-1] if len(behind) else entry[0]
        self.live = [a for a in self.live if a is not behind]
        return gains

    def _counts(self, segments: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each segment, and whether it must be normalised as a whole first."""
        joined = LINE_END.join([*segments, ""])
        bounds = np.cumsum([0, *(len(s) + 1 for s in segments)])
        totals, unsafe = np.zeros(len(segments), np.int64), np.zeros(len(segments), bool)
        entry = np.zeros(1, np.int32)
        self.live = [entry]
        for lo in range(0, len(joined), BLOCK):
            codes = np.frombuffer(joined[lo : lo + BLOCK].encode("utf-32-le"), np.uint32)
            symbols = self._look_up(codes, table)
            bad = np.flatnonzero(symbols == UNSAFE)
            if len(bad):
                unsafe[np.searchsorted(bounds, bad + lo, side="right") - 1] = True
                symbols[bad] = self._symbol(LINE_END)
            sums = np.append(0, np.cumsum(self._gains(symbols, entry), dtype=np.int64))
            inside = np.clip(bounds - lo, 0, len(codes))
            totals += np.diff(sums[inside])
        self.live = []
        return totals, unsafe

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null is empty."""
        owner, segments, totals = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = text or ""
            parts = self.special.split(text) if self.special and "<|" in text else [text]
            totals[i] += len(parts) - 1
            owner += [i] * len(parts)
            segments += parts
        if not segments:
            return []
        found, unsafe = self._counts(segments, self.raw)
        redo = np.flatnonzero(unsafe).tolist()
        if redo:
            whole = [self.tokenizer.normalizer.normalize_str(segments[i]) for i in redo]
            found[redo] = self._counts(whole, self.plain)[0]
        np.add.at(totals, owner, found)
        return totals.tolist()
